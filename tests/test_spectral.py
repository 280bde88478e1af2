"""Latent factors against numpy, on a fixture with groups of products and a noisy rest."""

import numpy as np
import pytest

from basketrec.operators import spectral


@pytest.fixture(scope="module")
def baskets():
    """Orders by products: five groups of products bought together, some noise, one product in most orders."""
    rng = np.random.default_rng(5)
    x = np.zeros((600, 90))
    for o in range(600):
        group = rng.choice(5, p=[0.4, 0.25, 0.15, 0.12, 0.08])
        x[o, group * 16 + rng.integers(0, 16, 6)] = 1
        x[o, rng.integers(0, 89, 2)] = 1
        x[o, 89] = rng.random() < 0.7
    return x


def long_form(spark, a):
    i, j = np.nonzero(a)
    rows = [(int(1000 - 7 * x), int(1000 - 7 * y), int(a[x, y])) for x, y in zip(i, j)]
    return spark.createDataFrame(rows, "product_id_left long, product_id_right long, cooccurances long")


def test_singular_values_and_vectors(spark, baskets):
    a = baskets.T @ baskets
    found = spectral.latent_factors(long_form(spark, a).repartition(5), rank=6)
    u, s, _ = np.linalg.svd(a)
    assert np.allclose(found.values, s[:6], rtol=0.01)
    rows = {r.product_id: np.array(r.vector) for r in found.factors.collect()}
    assert len(rows) == 90
    got = np.stack([rows[1000 - 7 * i] for i in range(90)])
    want = u[:, :6] * np.sqrt(s[:6])
    for j in range(5):  # the group directions are far apart
        assert abs(got[:, j] @ want[:, j]) / s[j] > 0.999
    checks = spectral.eigen_residuals(long_form(spark, a), found).collect()
    assert [c.component for c in checks] == [1, 2, 3, 4, 5, 6]
    assert all(abs(c.norm - 1) < 1e-6 and c.residual < 0.05 for c in checks)


def test_shuffled_directions_equal_broadcast_ones(spark, baskets, monkeypatch):
    a = (baskets.T @ baskets)[:40, :40]
    one = spectral.latent_factors(long_form(spark, a), rank=3).values
    monkeypatch.setattr(spectral, "BROADCAST_BYTES", 0)
    assert np.allclose(spectral.latent_factors(long_form(spark, a), rank=3).values, one, rtol=1e-6)


def test_low_rank_small_and_empty(spark):
    a = np.outer([1, 2, 3], [1, 2, 3]).astype(float)
    found = spectral.latent_factors(long_form(spark, a), rank=5)
    assert np.allclose(found.values, [14.0]) and found.factors.count() == 3
    none = spectral.latent_factors(long_form(spark, a).limit(0))
    assert none.values == [] and none.factors.count() == 0
    assert spectral.eigen_residuals(long_form(spark, a).limit(0), none).count() == 0


def test_large_blocks_are_not_broadcast(spark, baskets, monkeypatch, scratch):
    """The first block is of signs, so its file is small whatever its size in memory."""
    monkeypatch.setattr(spectral, "BROADCAST_BYTES", 0)
    pairs, thin = scratch("pairs"), scratch("thin")
    long_form(spark, baskets.T @ baskets).write.parquet(pairs)
    spark.range(100).selectExpr("id", "array_repeat(1D, 16) as v").write.parquet(thin)
    pairs, thin = spark.read.parquet(pairs), spark.read.parquet(thin)
    made = spectral.times(pairs, thin, 16, "product_id_left", "product_id_right", "cooccurances", 100)
    state = spectral.with_product(thin, made, 100, 16) if hasattr(spectral, "with_product") else thin.join(made, "id")
    assert "Broadcast" not in state._jdf.queryExecution().executedPlan().toString()


def test_pairs_are_dealt_once(spark, baskets, monkeypatch):
    """Steps that join by a shuffle move the directions, not the pairs."""
    monkeypatch.setattr(spectral, "BROADCAST_BYTES", 0)
    real, plans = spectral.times, []

    def kept(*args):
        made = real(*args)
        plans.append(made._jdf.queryExecution().executedPlan().toString())
        return made

    monkeypatch.setattr(spectral, "times", kept)
    spectral.latent_factors(long_form(spark, (baskets.T @ baskets)[:20, :20]), rank=2, max_steps=2)
    assert plans and all(p.count("hashpartitioning(product_id_right") == 1 for p in plans)
