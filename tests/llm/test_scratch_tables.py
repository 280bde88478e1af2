import os

from basketrec.llm import jaccard_join
from basketrec.llm.common import discard, materialise
from basketrec.session import checkpoint_dir


def _tables(spark):
    return {x for x in os.listdir(checkpoint_dir(spark)) if x.startswith("basketrec-")}


def test_ngram_join_leaves_only_the_tables_its_result_reads(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, text), (4, "other words"), (5, None)], "doc_id long, text string")
    before = _tables(spark)
    out = jaccard_join.ngram_join(docs)
    left = sorted(x.split("-")[2] for x in _tables(spark) - before)
    assert left == ["all", "rows"]
    assert {r[0]: r[2] for r in out.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}


def test_discard_spares_tables_that_are_not_scratch(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "own"))
    own, scratch = spark.read.parquet(str(tmp_path / "own")), materialise(spark.range(4), "gone")
    folder = scratch.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://").removeprefix("file:")
    discard(own.crossJoin(scratch))
    assert own.count() == 3 and not os.path.exists(folder)
