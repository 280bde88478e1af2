"""Searches that must find k candidates, and a toxicity model that takes all strong evidence."""

import random

import numpy as np
import pytest

from basketrec.llm import ann, toxicity
from basketrec.llm.common import importable
from pyspark.sql import functions as F


@pytest.mark.parametrize("n, dim, seed", [(587, 8, 1), (300, 3, 2), (40, 2, 3)])
def test_every_query_has_k_results(spark, monkeypatch, n, dim, seed):
    importable(spark)
    monkeypatch.setattr(ann, "BLOCK", 3)
    monkeypatch.setattr(ann, "CHUNK", 16)
    monkeypatch.setattr(ann, "TARGET", 0.2)          # very few visits
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=dim) * rng.choice([0.01, 1, 30])]) for i in range(n)]
    rows += [(100, [float(j)] * dim) for j in range(1, 9)]      # a repeated query id
    found = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4), F.col("vec_id") % 20 == 0).collect()
    by = {}
    for r in found:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert sorted(by) == list(range(0, n, 20)) + ([100] if n < 100 else [])
    assert all(sorted(r for r, _ in got) == list(range(1, 11)) and q not in {v for _, v in got} for q, got in by.items())


def brute_kernel(a, b):
    """Common subsequences of three letters in spans of at most SPAN, by nested loops."""
    def weights(s):
        out = {}
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, min(len(s), i + toxicity.SPAN)):
                    key = s[i] + s[j] + s[k]
                    out[key] = out.get(key, 0.0) + toxicity.DECAY ** (k - i + 1)
        return out
    x, y = weights(a), weights(b)
    dot = lambda u, v: sum(w * v.get(key, 0.0) for key, w in u.items())
    return dot(x, y) / np.sqrt(dot(x, x) * dot(y, y))


def test_kernel_and_folded_vector():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randrange(3, 15))) for _ in range(30)]
    dense = toxicity._dense(words).astype(float)
    want = np.array([[brute_kernel(a, b) for b in words] for a in words])
    assert np.allclose(dense @ dense.T, want, atol=1e-6)
    # scoring by the folded vector is scoring by Nystrom features
    marks = toxicity._dense(words[:10])
    vals, vecs = np.linalg.eigh((marks @ marks.T).astype(float))
    keep = vals > 1e-6 * vals.max()
    root, beta = vecs[:, keep] / np.sqrt(vals[keep]), np.arange(1, keep.sum() + 1) / 10.0
    model = toxicity.Model(marks.T.astype(float) @ (root @ beta), 0.25, 1.0, 0.0)
    assert np.allclose(model.unit_scores(words), toxicity._kernel(words, marks) @ root @ beta + 0.25, atol=1e-5)


def test_strong_units_are_all_positive(spark):
    """Each of several insults scores as toxic alone, although a few of them cover all toxic documents."""
    importable(spark)
    rng = random.Random(8)
    clean = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randrange(3, 9))) for _ in range(400)]
    bad = ["qwyxol", "zzarvek", "jikkuw", "vyxxan", "kwozzle", "xubjav"]
    rows, labels = [], []
    for i in range(1500):
        words = [rng.choice(clean) for _ in range(30)]
        toxic = i % 8 == 0
        if toxic:
            words += ["qwyxol"] + rng.sample(bad[1:], 2)
            rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic if rng.random() < 0.98 else not toxic)))
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    score = lambda texts: model.probability(model.raw_scores(texts))
    assert (score(bad) >= 0.5).all() and (score([" ".join(w) for w in bad]) >= 0.5).all()
    assert (score(["qw yx ol", "zz ar ve k", "jik-kuw", "vyxx.an"]) >= 0.5).all()
    assert (score(clean + ["", None]) < 0.5).mean() > 0.98
