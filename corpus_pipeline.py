"""Training-corpus pipeline: filter, de-duplicate, redact, mix and tokenise ``documents``.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as
Parquet and read again as the next stage's documents.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketrec.llm import jaccard_join, mixing, pii, sentencepiece_codec, toxicity
from basketrec.llm.common import discard, importable, materialise, table
from basketrec.llm.queries import piece_model

#: Characters of one block of texts in the last stage, whose workers come after four other stages.
BLOCK_CHARS = 4_000_000

#: The toxicity model is trained and not expressible in SQL.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 stay; trained on the labelled ones among them.

    Null and empty texts score lowest and stay; copies, whatever their ids, go or stay together;
    without labels of both kinds the score is the share of toxic labels."""
    importable(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.filter(model.score(F.col("text")) < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows one stays: that with the smallest id, rows without an id
    last, ties by a hash of the row.  Rows are told apart by a key of their own, so that
    repeated ids and rows without an id are decided like any others."""
    importable(spark)
    rows = materialise(docs.withColumn("__key", F.monotonically_increasing_id()), "keyed-documents")
    found = jaccard_join.ngram_join(rows.select(F.col("__key").alias("doc_id"), "text"))
    linked = materialise(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__key"), F.col("component_id").alias("__group")), "linked-documents")
    members = linked.union(linked.select(F.col("__group").alias("__key"), "__group").distinct())
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64(*docs.columns).alias("tie"), "__key").alias("order")
    kept = members.join(rows.select("__key", order), "__key").groupBy("__group").agg(F.min("order")["__key"].alias("__key"))
    gone = members.join(kept.select("__key"), "__key", "left_anti").select("__key")
    return rows.join(gone, "__key", "left_anti").select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with its spans replaced by their kind.

    Null texts stay null, texts without spans as they are; rows with null or repeated ids are
    redacted like any others; an empty table trains nothing and stays empty."""
    importable(spark)
    model = pii.train(materialise(pii.findings(docs, "doc_id"), "pii-found"))
    return pii.redact(docs, model)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Null, empty and blank texts have size 0 and come as often as the complete epochs of their
    source and its threshold say; a source without words is not taken; rows of equal id, source
    and size are taken alike."""
    importable(spark)
    return mixing.mixed_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, one row a row; null texts are empty ones."""
    importable(spark)
    return sentencepiece_codec.encode_decode(docs, piece_model(), BLOCK_CHARS).select(
        "doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("pii", redact_personal_data),
    ("mix_sources", mix_sources),
    ("sentencepiece", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        found = stage(spark, docs, sf_dir)
        docs = materialise(found, f"stage-{name}")
        if i:  # what it was made of, the stage before included, is not read again; the first stage reads the input
            discard(found)
    return STAGES[-1][1](spark, docs, sf_dir)
