"""Remembered scores of words belong to one model."""

import numpy as np

from basketrec.llm import toxicity


def test_models_of_equal_label_counts_share_no_scores(spark):
    rows = [(i, ("alpha beta gamma " * 3) + (word if i % 2 else "delta"), i % 2) for word in ("blarghfoo", "zzynkwart") for i in range(200)]
    models = [toxicity.train(d := spark.createDataFrame(part, "doc_id long, text string, toxic int"), d.select("doc_id", "toxic")) for part in (rows[:200], rows[200:])]
    texts = ["blarghfoo", "zzynkwart"]
    got = [m.raw_scores(texts) for m in models]
    assert all(np.allclose(g, np.maximum(m.unit_scores(texts), toxicity.FLOOR)) for g, m in zip(got, models))
    assert got[0][0] > got[0][1] and got[1][1] > got[1][0]
