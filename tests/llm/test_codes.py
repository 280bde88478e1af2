"""Vector codes, centroid clusters and word BPE against brute force and the library, with nulls,
empty and very long values, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from basketrec.llm import average_search, bpe_codec, threshold_clusters  # noqa: E402
from basketrec.llm.common import importable  # noqa: E402
from basketrec.llm.queries import word_bpe  # noqa: E402

VECTORS = "vec_id long, embedding array<double>, label string, part int, entry int, q string, cluster string"


def table_of(spark, rows):
    importable(spark)
    return spark.createDataFrame([(i, v, label, 0, 0, "clash", "clash") for i, v, label in rows], VECTORS)


def vector_rows(n, dim, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.1, dim)], rng.choice(["a", "b", None])) for i in rng.permutation(n) * 3 - 40]
    rows += [(i, list(v), label) for i, v, label in rows[:9]]                       # repeated rows
    rows += [(10_000 + i, list(rows[5][1]), "hot") for i in range(60)]              # ties
    rows += [(20_000, [0.0] * dim, "a"), (20_001, [-0.0] * dim, "a")]
    out = [(30_000, None, "a"), (30_001, [], "b"), (30_002, [float("nan")] * dim, "a"), (30_003, [None] * dim, None),
           (30_004, [float("inf")] + [0.0] * (dim - 1), "a"), (30_005, [0.5] * (dim + 16), "b"), (30_006, [1e300] * dim, "b")]
    return rows, out


def nearest(q, entries):
    dist = ((q[:, None, :] - entries[None]) ** 2).sum(2)
    return dist.argmin(1), dist.min(1)


def moved(q, entries, own):
    out = entries.copy()
    for e in set(own.tolist()):
        mine = q[own == e]
        out[e] = [int(s) // len(mine) for s in mine.sum(0)]
    return out


@pytest.mark.parametrize("n, dim", [(400, 64), (90, 16), (30, 48)])
def test_codes_equal_brute_force(spark, n, dim):
    rows, out = vector_rows(n, dim, n)
    got = sorted(map(tuple, average_search.op11_query(table_of(spark, rows + out).repartition(5)).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256").collect()))
    q = np.floor(256 * np.array([v for _, v, _ in rows])).astype(np.int64)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0], q[i].tolist()))[:64]
    parts = np.split(q, 16, axis=1)
    books = [p[order] for p in parts]
    for _ in range(2):
        books = [moved(p, b, nearest(p, b)[0]) for p, b in zip(parts, books)]
    found = [nearest(p, b) for p, b in zip(parts, books)]
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    error = sum(f[1] for f in found)
    labels = {}
    for (_, _, label), e in zip(rows, error.tolist()):
        labels[label] = labels.get(label, 0) + e
    want = [(rows[i][0], "".join(f"{f[0][i]:02x}" for f in found), int(error[i]), labels[rows[i][2]], digest) for i in range(len(rows))]
    assert got == sorted(want)


def test_codes_of_nothing(spark):
    assert average_search.op11_query(table_of(spark, [(1, None, "a"), (2, [], "a")])).count() == 0
    assert average_search.op11_query(table_of(spark, []).limit(0)).count() == 0
    one = average_search.op11_query(table_of(spark, [(None, [0.1] * 32, None)])).collect()
    assert [(r.vec_id, r.code, r.error, r.label_error) for r in one] == [(None, "00" * 16, 0, 0)]


def test_group_sums_by_salted_join(spark, monkeypatch):
    rows, _ = vector_rows(80, 16, 5)
    plain = sorted(map(str, average_search.op11_query(table_of(spark, rows)).collect()))
    monkeypatch.setattr(average_search, "BROADCAST_GROUPS", 0)
    assert sorted(map(str, average_search.op11_query(table_of(spark, rows)).collect())) == plain


@pytest.mark.parametrize("k, d, wide", [(64, 4, 40), (64, 1, 5), (7, 3, 3), (1, 2, 9), (200, 16, 4)])
def test_average_search_is_exact(k, d, wide):
    rng = np.random.default_rng(k)
    entries, x = rng.integers(-wide, wide, (k, d)), rng.integers(-2 * wide, 2 * wide, (3000, d))
    best, dist = average_search.AverageBook(entries).nearest(x)
    want = nearest(x, entries)
    assert (best == want[0]).all() and (dist == want[1]).all()


@pytest.mark.parametrize("k, d, wide", [(16, 64, 30), (16, 3, 2), (5, 64, 1), (1, 8, 9), (40, 2, 500)])
def test_threshold_walk_is_exact_and_stops_early(k, d, wide):
    rng = np.random.default_rng(k + d)
    c = rng.integers(-wide, wide + 1, (k, d))
    x = np.concatenate([rng.integers(-wide, wide + 1, (2000, d)), np.repeat(c, 3, 0)])
    best, dist, exact = threshold_clusters.SortedLists(c).nearest(x)
    want = nearest(x, c)
    assert (best == want[0]).all() and (dist == want[1]).all() and exact <= len(x) * k
    if (k, d) == (40, 2):
        assert exact < 0.7 * len(x) * k


@pytest.mark.parametrize("n", [300, 9])
def test_clusters_equal_brute_force(spark, n):
    rows, out = vector_rows(n, 64, 7 * n)
    if n == 9:
        rows = rows[:9]
    out = [o for o in out if o[1] is None or len(o[1]) != 64] + [out[2], out[3], out[4], out[6], (1, [0.1] * 63, None)]
    got = sorted(map(tuple, threshold_clusters.op12_query(table_of(spark, rows + out).repartition(3)).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()))
    q = np.floor(64 * np.array([v for _, v, _ in rows])).astype(np.int64)
    order = sorted(range(len(rows)), key=lambda i: (hashlib.sha256(f"1:{rows[i][0]}".encode()).hexdigest(), q[i].tolist()))[:16]
    c = q[order]
    for _ in range(3):
        c = moved(q, c, nearest(q, c)[0])
    own, dist = nearest(q, c)
    digest = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c.tolist()]
    want = [(rows[i][0], int(own[i]), int(dist[i]), int(dist[own == own[i]].sum()), int(dist.sum()), digest[own[i]]) for i in range(len(rows))]
    assert got == sorted(want)


def test_clusters_of_nothing(spark):
    assert threshold_clusters.op12_query(table_of(spark, [(1, None, "a"), (2, [0.5], "a")])).count() == 0
    assert threshold_clusters.op12_query(table_of(spark, []).limit(0)).count() == 0
    assert [(r.vec_id, r.cluster, r.inertia) for r in threshold_clusters.op12_query(table_of(spark, [(None, [0.5] * 64, "a")])).collect()] == [(None, 0, 0)]


# --- word BPE ------------------------------------------------------------------------------

RNG = random.Random(11)
TEXTS = [
    None, "", " \t\n\x0b\x85\xa0　", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>x<|ENDOFTEXT|> <|endoftext", "don't DON'T it's'll 'S'RE", "x</w> y</w>",
    "é É İ ß ﬁ Ⅻ ²½ ª º µ é \n̈x", "ΣΑΣ ΟΔΟΣ", "日本語 👍🏽 १२३", "a\x1cb\x00\x7f", "a" * 70_000, "ab" * 40_000 + "é" * 3000, "the " * 20_000,
    "tokens\tand\rline\x0cends", "the cat", "the cat", *["".join(RNG.choice("abeinrst'.- ") for _ in range(RNG.randrange(1, 60))) for _ in range(800)],
    *["".join(chr(RNG.choice([RNG.randrange(32, 127), RNG.randrange(128, 592), RNG.randrange(768, 12544)])) for _ in range(30)) for _ in range(300)],
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_bpe())


@pytest.mark.parametrize("block_chars", [500, bpe_codec.BLOCK_CHARS])
def test_bpe_equals_library(spark, library, block_chars):
    importable(spark)
    rows = [(None if i == 15 else i // 2, t, "clash", 1, "x") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int, decoded string").repartition(3)
    got = sorted(((r.doc_id, r.n_tokens, list(r.ids), r.decoded) for r in bpe_codec.encode_decode(docs, word_bpe(), block_chars).collect()), key=str)
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=str)
    digests = {r.n_tokens: (r.ids_sha256, r.decoded_sha256) for r in bpe_codec.op13_query(docs, word_bpe()).collect()}
    assert digests[0] == (hashlib.sha256(b"").hexdigest(),) * 2
    _, n, ids, text = max(want, key=lambda x: x[1])
    assert digests[n] == (hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe_codec.op13_query(docs.limit(0), word_bpe()).count() == 0


def test_merges_of_a_small_vocabulary():
    """Greedy cuts that merging does not give, unreached tokens and runs of one symbol."""
    vocab = {}
    for t in bpe_codec.byte_symbols():
        vocab[t] = len(vocab)
        vocab[t + "</w>"] = len(vocab)
    merges = [("a", "a"), ("b", "c"), ("a", "b"), ("ab", "c"), ("aa", "a"), ("aa", "aa"), ("c", "a"), ("bc", "a"), ("a", "a</w>"), ("bc", "c</w>")]
    for a, b in merges:
        vocab[a + b] = len(vocab)
    m = bpe_codec.Merges(vocab, merges)
    assert not m.reached[vocab["abc"]] and m.reached[vocab["aaaa"]]
    words = ["".join(RNG.choice("abc") for _ in range(RNG.randrange(1, 90))).encode() for _ in range(3000)] + [b"a" * n for n in range(1, 80)]
    words = sorted(set(words))
    raw = np.frombuffer(b"".join(words), np.uint8)
    ids, starts, lens, failed = m.encode_words(raw, np.cumsum([len(w) for w in words]))
    rank = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(merges)}
    assert 0 < failed < len(words)
    for w, s, n in zip(words, starts, lens):
        own = [int(m.base[c]) for c in w[:-1]] + [int(m.base[w[-1] + bpe_codec.END])]
        while found := [(*rank[p], i) for i, p in enumerate(zip(own, own[1:])) if p in rank]:
            _, t, i = min(found, key=lambda f: (f[0], f[2]))
            own[i:i + 2] = [t]
        assert ids[s:s + n].tolist() == own
