"""Decisions of the n-gram stage by row."""

import random

import corpus_pipeline


def test_near_copies_go_by_row_not_by_id(spark):
    rng = random.Random(11)
    prose = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40))
    a, b, c, d, e = (prose() for _ in range(5))
    rows = [(1, a), (5, a + " more"), (5, b), (7, c), (7, c), (None, d), (None, d), (None, e), (9, e), (None, None), (None, None), (8, ""), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    want = [(1, a), (5, b), (7, c), (None, d), (9, e), (None, None), (None, None), (8, ""), (8, "")]
    assert sorted(got, key=str) == sorted(want, key=str)
