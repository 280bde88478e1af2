"""Products by shared orders against all pairs."""

import random

import pytest

from basketrec.operators import minhash, similarity
from helpers import lines_df


def brute(rows, threshold):
    sets = {}
    for _, o, p, *_ in rows:
        sets.setdefault(p, set()).add(o)
    out, ids = {}, sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            shared = len(sets[a] & sets[b])
            j = shared / len(sets[a] | sets[b])
            if j >= threshold:
                out[a, b] = (shared, j)
    return sets, out


def fixture(seed=3):
    """Groups of products bought together most of the time, singles, repeated lines, a hot order."""
    rng = random.Random(seed)
    rows = []
    for o in range(400):
        group = rng.randrange(12)
        rows += [(1, o, group * 10 + j) for j in range(10) if rng.random() < 0.85]
        rows += [(1, o, 200 + rng.randrange(100)) for _ in range(3)]
    rows += [(1, 999, 400 + i) for i in range(60)]                 # equal sets: one order
    rows += [(1, 999, j) for j in range(50)] + rows[:50]
    return rows


@pytest.mark.parametrize("threshold, band_rows", [(0.5, 2), (0.3, 1), (1.0, 3)])
def test_links_equal_all_pairs(spark, threshold, band_rows):
    rows = fixture()
    sets, want = brute(rows, threshold)
    links, of_class = minhash.shared_order_links(lines_df(spark, rows).repartition(4), threshold, 0.9999, band_rows)
    name = {r.product_id: r["class"] for r in of_class.collect()}
    assert name == {p: min(q for q in sets if sets[q] == s) for p, s in sets.items()}
    got = {(r.product_id_left, r.product_id_right): (r.shared, r.jaccard) for r in links.collect()}
    assert got == {k: v for k, v in want.items() if name[k[0]] == k[0] and name[k[1]] == k[1]}


def test_nearest_products(spark):
    rows = fixture(4)
    sets, links = brute(rows, 0.3)
    near = {}
    for (a, b), (_, j) in links.items():
        near.setdefault(a, []).append((-j, b))
        near.setdefault(b, []).append((-j, a))
    got = {}
    for r in minhash.nearest_by_shared_orders(lines_df(spark, rows), 4, threshold=0.3, recall=0.9999).collect():
        got.setdefault(r.product_id_left, []).append((r.rank, -r.jaccard, r.product_id_right))
    assert {p: [x[1:] for x in sorted(v)] for p, v in got.items()} == {p: sorted(v)[:4] for p, v in near.items()}


def test_recall_against_cosine(spark):
    """Products of cosine 0.7 or more, at the recall asked for."""
    rows = sorted(set(fixture(5)))
    facts = lines_df(spark, rows)
    want = {(r.product_id_left, r.product_id_right) for r in similarity.cosine_similarity(facts, "set").where("cosine_similarity >= 0.7 and product_id_left < product_id_right").collect()}
    links, of_class = minhash.shared_order_links(facts, 0.5, 0.95, 2)
    name = {r.product_id: r["class"] for r in of_class.collect()}
    got = {(r.product_id_left, r.product_id_right) for r in links.collect()}
    found = [p for p in want if name[p[0]] == name[p[1]] or tuple(sorted((name[p[0]], name[p[1]]))) in got]
    assert len(want) > 1000 and len(found) >= 0.9 * len(want)


def test_salted_members_and_empty(spark):
    rows = fixture(6)
    signed = minhash.signatures(minhash.order_sets(lines_df(spark, rows)), 40, 1)
    plain = minhash.candidates(signed, 1, 40, 0.3)
    salted = minhash.candidates(signed, 1, 40, 0.3, members_per_task=5)
    assert plain.count() > 0 and plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0
    links, of_class = minhash.shared_order_links(lines_df(spark, rows).limit(0))
    assert links.count() == 0 and of_class.count() == 0


@pytest.mark.parametrize("crowd", [0, 8, 1000])
def test_bands_by_order_equal_bands_as_keys(spark, crowd):
    """The same candidates from one row a product and order as from one row a product and band."""
    rows = fixture(7)
    sets = minhash.order_sets(lines_df(spark, rows))
    signed = minhash.signatures(sets, 150, 1)
    least = minhash.least_orders(sets, signed, 150, 1)
    assert least.count() <= sets.count()
    crowded = minhash.heavy_keys(sets, "order_id", least=crowd).select("_hot")
    got, want = (sorted(map(tuple, d.collect())) for d in (minhash.candidates_by_order(least, crowded, 0.1), minhash.candidates(signed, 1, 150, 0.1)))
    assert want and got == want


def test_only_linked_products_are_signed(spark, monkeypatch):
    """Without crowded orders links are counted first, and the lines of other products are not hashed for bands."""
    rows = [(1, o, p) for o in range(10) for p in (1, 2)] + [(1, 100 + p, p) for p in range(3, 40)] + [(1, 200 + p, p) for p in range(3, 40)]
    rows += [(1, 99, 1)]
    real, seen = minhash.signatures, []
    monkeypatch.setattr(minhash, "signatures", lambda sets, *a: seen.append(sets.select("product_id").distinct().count()) or real(sets, *a))
    links, _ = minhash.shared_order_links(spark.createDataFrame(rows, "user_id long, order_id long, product_id long"), 0.5, 0.999999)
    assert [(r[0], r[1], r.shared) for r in links.collect()] == [(1, 2, 10)]
    assert seen == [2]
