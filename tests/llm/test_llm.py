"""Operators of the llm subpackage against brute force, with nulls, empty and very long
texts, ties, repeated rows, empty tables and extra columns with clashing names."""


import random
import re
import sys

import numpy as np
import pytest

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from basketrec.llm import ann, embed_dedup, jaccard_join, langid, mixing, pii, sentencepiece_codec, suffix_dedup, toxicity, url_filter  # noqa: E402
from basketrec.llm.common import importable  # noqa: E402
from basketrec.llm.queries import piece_model  # noqa: E402

RNG = random.Random(3)
WORDS = ["".join(RNG.choice("abcdefghijklmnoprstu") for _ in range(RNG.randint(2, 8))) for _ in range(300)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


BASE = prose(120)
SHARED = prose(14)
TEXTS = [
    None, "", "   \t\n", "one", "one", "a b c d", "A  B c\nD", BASE, BASE, BASE.upper(), BASE + " tail", BASE.replace(" ", "\n"),
    prose(40) + " " + SHARED + " " + prose(40), prose(30) + "\n" + SHARED + " " + prose(20), "x " * 5000, "x " * 4990 + prose(9),
    "é " * 60 + SHARED + " ▁ <s>  \x00 ﬁ", "ab" * 3000, prose(3000), "mail me.a+b@ex-1.co.uk, 10.0.0.255 999.1.1.1 +1 (824) 555-5244 or 4111 1111 1111 1111 and 4190365555491447",
    "9" * 4000, "1.2.3.4.5.6.7.8 a@b.c.d%x@y.z", prose(200) + " " + BASE[:80],
]
ROWS = [(i, t, "en" if i % 2 else None, None if i % 7 == 0 else f"s{i % 4}", i, "clash", 1.0) for i, t in enumerate(TEXTS)] + [(None, BASE, "fr", "s1", 0, "clash", 1.0)]
SCHEMA = "doc_id long, text string, lang string, source string, size long, block string, key double"


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    return spark.createDataFrame(ROWS, SCHEMA)


def plain(rows, *names):
    return sorted((tuple(r[n] for n in names) for r in rows), key=str)


# --- sentencepiece ---------------------------------------------------------------------

def test_codec_equals_library(spark, docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    want = []
    for r in ROWS:
        ids = sp.encode(r[1] or "", add_bos=True, add_eos=True)
        want.append((r[0], len(ids), np.array(ids, "<u4").tobytes(), sp.decode(ids)))
    for size in (300, sentencepiece_codec.BLOCK_CHARS):
        got = sentencepiece_codec.encode_decode(docs, piece_model(), size).collect()
        assert plain([r.asDict() | {"ids": bytes(r.ids)} for r in got], "doc_id", "n_tokens", "ids", "decoded") == sorted(want, key=str)
    assert sentencepiece_codec.encode_decode(docs.limit(0), piece_model()).count() == 0


# --- suffix array ------------------------------------------------------------------------

def brute_cover(rows):
    first, out = {}, []
    low = lambda i: -(1 << 63) if i is None else i
    for i, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - 49):
            first[b[s:s + 50]] = min(first.get(b[s:s + 50], 1 << 62), low(i))
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 49):
            if first[b[s:s + 50]] < low(i):
                gone[s:s + 50] = True
        runs = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out.append((i, len(b), int(gone.sum()), runs, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return sorted(out, key=str)


@pytest.mark.parametrize("group", [suffix_dedup.GROUP, 1])  # 1: every anchor by the window count
def test_repeats_equal_brute_force(spark, docs, group):
    rng = random.Random(5)
    alphabet = [rng.choice("abc ") for _ in range(400)]
    extra = [(100 + i, "".join(alphabet[(a := rng.randint(0, 250)):a + rng.randint(40, 150)]) + rng.choice("xyz") * rng.randint(0, 60)) for i in range(40)]
    rows = [(r[0], r[1]) for r in ROWS] + extra
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, h string")
    got = suffix_dedup.remove_repeats(df, 3000, group).collect()
    assert plain([r.asDict() | {"kept": bytes(r.kept)} for r in got], "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == brute_cover(rows)


def test_repeats_of_empty_table(spark, docs):
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_interval_tree():
    # suffixes a, ab, abab, b, bab of "abab" with a sentinel: prefixes of 1, 2, 0, 1
    assert set(suffix_dedup.intervals([1, 2, 0, 1], 1)) == {(0, 2, 1), (1, 2, 2), (3, 4, 1)}


# --- n-gram join ---------------------------------------------------------------------------

def shingle_set(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    k = min(5, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def test_ngram_join_equals_brute_force(spark, docs):
    rng = random.Random(8)
    base, rows = prose(90, rng).split(), [(r[0], r[1]) for r in ROWS]
    for i in range(60):  # chains of edits, so that links are not all to one text
        for _ in range(rng.randint(0, 3)):
            base[rng.randrange(len(base))] = rng.choice(WORDS)
        rows.append((200 + i, " ".join(base[:rng.randint(70, 90)])))
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int")
    sets = [shingle_set(t) for _, t in rows]
    comp = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = comp[a], comp[b]
                comp = [y if c == x else c for c in comp]
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = sorted([(i, len(s), least.get(c)) for (i, _), s, c in zip(rows, sets, comp)], key=str)
    assert plain(jaccard_join.ngram_join(df).collect(), "doc_id", "n_shingles", "component_id") == want
    assert jaccard_join.ngram_join(df.limit(0)).count() == 0


# --- personal data ---------------------------------------------------------------------------

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def rule_holds(kind, m):
    d = re.sub("[^0-9]", "", m)
    luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.split(".")), "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]


def test_pii_base_spans_and_redaction(spark, docs):
    found = pii.findings(docs, "doc_id")
    got = {(r.doc_id, tuple((pii.KINDS[x.kind], x.s, x.e) for x in r.base)) for r in found.collect()}
    want = set()
    for r in ROWS:
        t = r[1] or ""
        spans = sorted((m.start(), k, m.end()) for k, name in enumerate(RULES) for m in re.finditer(RULES[name], t) if rule_holds(name, m.group()))
        want.add((r[0], tuple((pii.KINDS[k], s, e) for s, k, e in spans)))
    assert got == want
    out = {r.doc_id: r for r in pii.redact(docs, {}).collect()}
    assert out[19].text.startswith("mail [EMAIL], [IP] 999.1.1.1 [PHONE] or [CARD]") and out[0].text is None and out[7].text == BASE
    assert out[7].block == "clash" and pii.redact(docs.limit(0), {}).count() == 0


def test_pii_adds_spans_by_the_trees(spark):
    rng = random.Random(2)
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    texts = [f"{prose(3)} +1 ({num(3)}) {num(3)}-{num(4)} {prose(3)}" for _ in range(80)] + [f"{prose(3)} {num(16)} {prose(3)} {num(4)}.{num(4)}" for _ in range(80)]
    texts += ["call 1 (824) 555-5244 now"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.findings(df, "doc_id")
    model = pii.train(found)
    out = {r.doc_id: r for r in pii.spans(found, model).collect()}
    assert 3 in model and [x.kind for x in out[160].spans] == [3] and not out[160].base
    assert all(len(out[i].spans) == len(out[i].base) for i in range(160))


def card_number(rng, prefix=""):
    d = [int(c) for c in prefix] + [rng.randrange(10) for _ in range(15 - len(prefix))]
    total = sum(sum(divmod(c * (2 - i % 2), 10)) for i, c in enumerate(d))
    return "".join(map(str, d)) + str(-total % 10)


def test_pii_finds_numbers_next_to_each_other(spark):
    rng = random.Random(12)
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    fours = lambda c: " ".join(c[i:i + 4] for i in range(0, 16, 4))
    texts = [f"{prose(3)} {(fours if i % 2 else str)(card_number(rng))} {prose(3)} {num(16)}x {prose(2)} +1 ({num(3)}) {num(3)}-{num(4)}" for i in range(160)]
    a, b, c = (card_number(rng) for _ in range(3))
    bad = str(int(c) // 10 * 10 + (int(c) + 1) % 10)
    cases = [("pay ", a, " ", b, " now"), ("pay ", fours(a), "  ", fours(b), " now"), ("pay ", c, " " + bad + " now")]
    texts += ["".join(x) for x in cases] + ["1 2 3 4 5 6 7 8 9 " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.findings(df, "doc_id")
    got = {r.doc_id: {texts[r.doc_id][x.s:x.e] for x in r.spans if x.kind == 2} for r in pii.spans(found, pii.train(found)).collect()}
    assert (got[160], got[161], got[162]) == ({a, b}, {fours(a), fours(b)}, {c})
    runs = {r.doc_id: r.loose for r in found.collect()}
    assert max(x.digits for x in runs[163]) == 2700 and all(7 <= x.digits <= 19 for x in runs[163][1:]) and len(runs[163]) < 2700 * 13 + 2


# --- mixing ------------------------------------------------------------------------------------

def test_mix_targets_and_whole_epochs(spark, docs):
    got = mixing.mix(docs).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert plain(got, "doc_id", "size") == sorted(((r[0], words(r[1])) for r in ROWS), key=str)
    by = {}
    for r in got:
        s = by.setdefault(r.source, [r.source_size, r.target, 0, 0])
        s[2] += r.taken
        s[3] = max(s[3], r.size)
        assert r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
    assert sum(s[1] for s in by.values()) == pytest.approx(sum(s[0] for s in by.values()))
    for size, target, taken, largest in by.values():
        assert target <= 3 * size and abs(taken - target) <= largest / 2 + 1
    again = mixing.mix(docs.repartition(5)).collect()
    assert plain(got, "doc_id", "size", "taken") == plain(again, "doc_id", "size", "taken")
    assert mixing.mix(docs.limit(0)).count() == 0
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r.copies for r in got)


# --- classifiers -------------------------------------------------------------------------------

def test_toxicity_tolerates_insertions(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        w = prose(25, rng).split()
        if i % 3 == 0:
            w[rng.randrange(25)] = rng.choice(["blarghfoo", "zzynkwart"])
        rows.append((i, " ".join(w), int(i % 3 == 0), "clash"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int, score string")
    importable(spark)
    model = toxicity.train(docs, docs.select("doc_id", "toxic"))
    tests = [(rows[0][1], 1), (prose(30, rng), 0), (prose(9, rng) + " bla-rg.hfoo " + prose(9, rng), 1), (prose(9, rng) + " zzyxnkwart", 1), (None, 0), ("", 0)]
    df = spark.createDataFrame(list(enumerate(t for t, _ in tests)), "doc_id long, text string")
    got = [r.s for r in df.select("doc_id", model.score(df.text).alias("s")).orderBy("doc_id").collect()]
    assert [int(s >= 0.5) for s in got] == [y for _, y in tests] and all(0 <= s <= 1 for s in got)
    none = toxicity.train(docs.limit(0), docs.select("doc_id", "toxic").limit(0))
    assert df.select(none.score(df.text).alias("s")).first().s < 0.5


def test_language_of_held_out_texts(spark, docs):
    rng = random.Random(6)
    vocab = {"aa": ["kral", "mokra", "strak", "krum", "varsk"], "bb": ["ouille", "eau", "ienne", "leau", "oui"]}
    rows = [(i, " ".join(rng.choice(vocab[k]) + rng.choice("aeiou") for _ in range(30)), k, "clash") for i in range(200) for k in [("aa", "bb")[i % 2]]]
    rows += [(900, None, None, ""), (901, "", "aa", ""), (902, "12 !!", "bb", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    importable(spark)
    got = {r.doc_id: r for r in langid.op7_query(df).collect()}
    held = [r for r in rows if r[0] < 900 and got[r[0]].held_out]
    assert len(held) > 30 and sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.95 * len(held)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].rejected for i in (900, 901, 902))
    assert langid.op7_query(df.limit(0)).count() == 0


def test_rare_language_is_learned_at_every_size(spark):
    rng = random.Random(7)
    vocab = {"aa": ["kral", "mokra", "strak", "krum", "varsk"], "bb": ["ouille", "eau", "ienne", "leau", "oui"], "cc": ["qix", "zyx", "wexi", "qozu", "xiwu"]}
    text = lambda k: " ".join(rng.choice(vocab[k]) + rng.choice("aeiou") for _ in range(12))
    rows = [(i, text(k), k) for i in range(6000) for k in ["cc" if i % 150 == 0 else ("aa", "bb")[i % 2]]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    importable(spark)
    model = langid.train(df, max_docs=60)  # 1 row in 150 of one language: 0.4 expected in 60 of all
    got = df.filter("lang = 'cc'").select(model.predict(df.text).alias("p")).collect()
    assert model.langs == ["aa", "bb", "cc"] and sum(r.p.lang_pred == "cc" for r in got) >= 0.9 * len(got) > 30


def test_draws_by_group_are_exact(spark):
    from basketrec.llm.common import fair_share, smallest_draws_by

    rows = spark.range(5000).selectExpr("id", "xxhash64(7, id) as draw", "case when id % 100 = 0 then 'c' when id % 3 = 0 then 'a' else 'b' end as g")
    rows = rows.union(spark.range(300).selectExpr("id", "cast(9e18 as long)", "'same'"))  # none of these below the bound
    counts = {r["g"]: r["count"] for r in rows.groupBy("g").count().collect()}
    for n in (1, 40, 1700, 9000):
        want = [(g, r["draw"], r["id"]) for g in sorted(counts) for r in sorted(rows.filter(f"g = '{g}'").collect(), key=lambda r: (r["draw"], r["id"]))[:n]]
        got = smallest_draws_by(rows, "g", counts, "draw", n, "id")
        assert list(zip(*(got[c].to_pylist() for c in ("g", "draw", "id")))) == want
    assert smallest_draws_by(rows.filter("id < 0"), "g", {}, "draw", 5, "id").num_rows == 0
    assert fair_share({"a": 10, "b": 500, "c": 500}, 110, 5) == 50 and fair_share({"a": 10, "b": 9}, 110, 5) == 10 and fair_share({"a": 99, "b": 99}, 4, 5) == 5


# --- url filter -----------------------------------------------------------------------------------

def test_url_verdicts_as_of_the_fetch_day(spark):
    from datetime import date as d

    events = spark.createDataFrame([
        ("ex.org", d(2024, 1, 1), 1, "block"), ("ex.org", d(2024, 3, 1), 2, "remove"), ("a.ex.org", d(2024, 2, 1), 1, "allow"),
        ("a.ex.org/x", d(2024, 2, 10), 1, "block"), ("same.org", d(2024, 1, 1), 1, "block"), ("same.org", d(2024, 1, 1), 2, "allow"),
        (None, d(2024, 1, 1), 1, "block"), ("ex.org", None, 3, "block")], "key string, day date, seq int, action string")
    cases = [("http://ex.org/", d(2023, 12, 31), "none", 0), ("http://b.ex.org/p", d(2024, 1, 1), "blocked", 1), ("https://A.EX.org:80/y", d(2024, 2, 5), "allowed", 2),
             ("http://u@a.ex.org/x/z?q", d(2024, 2, 10), "blocked", 3), ("http://a.ex.org/x", d(2024, 3, 1), "blocked", 2), ("http://ex.org", d(2024, 3, 1), "none", 0),
             ("http://same.org/", d(2024, 5, 1), "allowed", 1), (None, d(2024, 1, 1), "none", 0), ("nonsense", d(2024, 1, 1), "none", 0), ("http://ex.org/", None, "none", 0)]
    caps = spark.createDataFrame([(i, u, t, "clash", "clash") for i, (u, t, _, _) in enumerate(cases * 2)], "page_id long, url string, day date, rank string, matched2 string")
    got = sorted((r.page_id, r.verdict, r.n_active) for r in url_filter.verdicts(caps, events).collect())
    assert got == [(i, v, n) for i, (_, _, v, n) in enumerate(cases * 2)]
    assert url_filter.verdicts(caps, events.limit(0)).filter("verdict <> 'none'").count() == 0
    assert url_filter.verdicts(caps.limit(0), events).count() == 0


# --- vectors ---------------------------------------------------------------------------------------

def vector_rows():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 24))
    rows = [(i, (base[i % 12] + rng.normal(size=24) * (0.02 if i % 3 else 0.5)).tolist(), "clash") for i in range(90)]
    rows += [(200, rows[4][1], ""), (201, [2 * x for x in rows[4][1]], ""), (202, None, ""), (203, [0.0] * 24, ""), (204, [float("nan")] * 24, ""), (205, [None] + [1.0] * 23, ""), (206, [1.0, 2.0], "")]
    return rows


@pytest.mark.parametrize("tile", [embed_dedup.TILE, 3])
def test_embedding_links_equal_brute_force(spark, tile, monkeypatch):
    importable(spark)
    monkeypatch.setattr(embed_dedup, "TILE", tile)
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string")
    f32 = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows if v and None not in v}
    good = {i: v / np.linalg.norm(v) for i, v in f32.items() if len(v) == 24 and np.isfinite(v).all() and v.any()}
    link = {i: {j for j in good if j != i and good[i] @ good[j] >= 0.95} for i in good}
    comp = {i: i for i, _, _ in rows}
    for _ in rows:
        for i in good:
            comp[i] = min([comp[i], *(comp[j] for j in link[i])])
    want = sorted((i, len(link.get(i, ())), comp[i], comp[i] == i) for i, _, _ in rows)
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(df, tables=12).collect())
    assert got == want
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_search_recall_and_order(spark):
    importable(spark)
    rows = vector_rows() + [(1000 + i, np.random.default_rng(i).normal(size=24).tolist(), "clash") for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    got = ann.op9_query(df).collect()
    good = {i: np.array(v) for i, v, _ in rows if v and len(v) == 24 and None not in v and np.isfinite(v).all() and np.any(v)}
    hit = total = 0
    for q in [i for i in good if i % 100 == 0]:
        true = sorted((float(np.sqrt(((good[q] - v) ** 2).sum())), i) for i, v in good.items() if i != q)[:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in mine] == list(range(1, 11)) and [(s, i) for _, i, s in mine] == sorted((s, i) for _, i, s in mine)
        hit, total = hit + len({i for _, i in true} & {i for _, i, _ in mine}), total + 10
    assert hit >= 0.9 * total
    assert ann.op9_query(df.limit(0)).count() == 0


# --- whole pipeline ---------------------------------------------------------------------------------

def test_pipeline_decisions(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    rows = [(i, prose(40, rng) + (" blarghfoo" if i % 5 == 0 else ""), "en", f"s{i % 3}", 1) for i in range(150)]
    clean = rows[1][1]
    rows += [(500, clean, "en", "s0", 1), (501, clean + " mail a@b.cd", "en", "s1", 1), (502, None, None, None, 0), (503, "", "en", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept, docs = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), docs.schema)
        kept[name] = [r.doc_id for r in docs.collect()]
    assert not any(i < 150 and i % 5 == 0 for i in kept["toxicity"]) and {1, 2, 500, 501, 502, 503} <= set(kept["toxicity"])
    assert set(kept["toxicity"]) - set(kept["ngram_join"]) == {500, 501}
    assert sorted(kept["pii"]) == sorted(kept["ngram_join"])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(kept["mix_sources"])


def test_smallest_draws_are_exact(spark):
    from basketrec.llm.common import smallest_draws

    rows = spark.range(5000).selectExpr("id", "xxhash64(7, id) as draw")
    for n in (1, 100, 4000, 6000):
        want = sorted(((r["draw"], r["id"]) for r in rows.collect()))[:n]
        got = smallest_draws(rows, "draw", n, "id")
        assert list(zip(got["draw"].to_pylist(), got["id"].to_pylist())) == want
    same = spark.range(1000).selectExpr("id", "cast(9e18 as long) as draw")  # none below the bound
    assert smallest_draws(same, "draw", 10, "id")["id"].to_pylist() == list(range(10))
    assert smallest_draws(same.filter("id < 0"), "draw", 10, "id").num_rows == 0
