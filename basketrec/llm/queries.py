"""Registered queries of this subpackage: one opN_<name> per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketrec.llm import ann, average_search, bpe_codec, embed_dedup, jaccard_join, langid, mixing, pii, sentencepiece_codec, suffix_dedup, threshold_clusters, toxicity, url_filter
from basketrec.llm.common import importable, table

Builder = Callable[[SparkSession, str], DataFrame]


def piece_model() -> str:
    """Path of the public SentencePiece model on this machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def word_bpe() -> str:
    """Path of the public word BPE file on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_embedding_dedup(spark, sf_dir):
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_suffix_dedup(spark, sf_dir):
    return suffix_dedup.op2_query(table(spark, sf_dir, "documents"))


def op3_ngram_join(spark, sf_dir):
    return jaccard_join.ngram_join(table(spark, sf_dir, "documents"))


def op4_url_filter(spark, sf_dir):
    return url_filter.op4_query(table(spark, sf_dir, "pages"))


def op5_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.op5_query(table(spark, sf_dir, "documents"), piece_model())


def op6_toxicity(spark, sf_dir):
    return toxicity.op6_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language(spark, sf_dir):
    return langid.op7_query(table(spark, sf_dir, "documents"))


def op8_mix_sources(spark, sf_dir):
    return mixing.op8_query(table(spark, sf_dir, "documents"))


def op9_ann(spark, sf_dir):
    return ann.op9_query(table(spark, sf_dir, "embeddings"))


def op10_pii(spark, sf_dir):
    return pii.op10_query(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark, sf_dir):
    return average_search.op11_query(table(spark, sf_dir, "embeddings"))


def op12_centroids(spark, sf_dir):
    return threshold_clusters.op12_query(table(spark, sf_dir, "embeddings"))


def op13_bpe(spark, sf_dir):
    return bpe_codec.op13_query(table(spark, sf_dir, "documents"), word_bpe())


OPERATORS = (
    op1_embedding_dedup, op2_suffix_dedup, op3_ngram_join, op4_url_filter, op5_sentencepiece, op6_toxicity, op7_language, op8_mix_sources,
    op9_ann, op10_pii, op11_vector_codes, op12_centroids, op13_bpe,
)


def _ready(fn: Builder) -> Builder:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return fn(spark, sf_dir)

    build.__name__, build.__doc__ = fn.__name__, fn.__doc__
    return build


def queries() -> dict[str, Builder]:
    return {f.__name__: _ready(f) for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {"op4_url_filter": url_filter.OP4_SQL, "op8_mix_sources": mixing.OP8_SQL, "op11_vector_codes": average_search.OP11_SQL,
            "op12_centroids": threshold_clusters.OP12_SQL}
