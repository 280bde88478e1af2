"""The pipeline on tables without rows, and on rows without texts or labels."""

import sys

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_empty_and_textless_documents(spark, tmp_path):
    import corpus_pipeline

    for name, rows in (("none", []), ("blank", [(1, None, None, None, 0), (None, "", "en", "a", 0), (3, "  ", "en", "a", 2), (3, "  ", "en", "a", 2)])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for stage, fn in corpus_pipeline.STAGES[:-1]:
            out = fn(spark, docs, folder)
            assert out.columns == docs.columns
            assert out.count() == (0 if stage == "mix_sources" else len(rows)), stage
        assert corpus_pipeline.run(spark, folder).count() == 0
