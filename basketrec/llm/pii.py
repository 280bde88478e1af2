"""Personal data: candidate generators, boosted trees, calibrated thresholds.

Base rules find e-mail addresses, IP addresses, card numbers and phone numbers.
Two generators propose more, overlapping spans (number runs of any grouping, and
their stretches of whole digit groups with LEAST_DIGITS to MOST_DIGITS digits, so that
numbers next to each other are proposed one by one; address-like runs, also with
"(at)" and "[dot]").  Boosted trees for each kind judge a proposal by its format
(digits, groups, separators, check sum, ...) and context (words and letters around
it); proposals that overlap no base span and reach the threshold of their kind become
spans, the likeliest first, unless they overlap one taken before.  The trees learn from
the base rules: the proposals that are a base span of a kind (but for a bracket or sign
before it) are its examples; all others, pieces of base spans too, are not.  They do
not see the one sign that the base rules insist on ("@", the leading "+"), so they
carry over to spans without it.

Finding, features and trees are DataFrame functions: regular expressions give the
matches and the gaps between them, lengths give positions, trees are CASE
expressions.  Spark counts all proposals in cells of equal bins of the features; only the fitting, over at
most about MAX_CELLS such cells and their counts, is done on the driver.  Every expression is made of possessive parts that start at the edge of a
run, so long runs cost linear time.

Null texts are empty and have no spans.  Positions are code points, the end is
exclusive.  Repeated rows give the same spans; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketrec.llm.common import fair_share, materialise

#: Kinds in order, their patterns (possessive, from the edge of a run).
KINDS = ("email", "ip", "card", "phone")
LOCAL, HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{HOST}++(?:\.{HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE_NUMBER = r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+"
LOOSE_EMAIL = rf"(?:\G|(?<!{LOCAL})){LOCAL}++(?:@|\x20?[(\[]at[)\]]\x20?){HOST}++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?){HOST}++)++"
CONTEXT = {"ctx_mail": "mail|contact|write", "ctx_phone": "phone|tel|call|mobile|fax", "ctx_card": "card|visa|credit|account", "ctx_net": "host|server|addr|ip"}
FEATURES = ("digits", "groups", "longest", "parens", "dots", "dashes", "spaces", "check", "octet", "mail", "tail",
            "ctx_mail", "ctx_phone", "ctx_card", "ctx_net", "letter_before", "letter_after")
#: Digits of a proposed stretch of a number run, and its length with two separators before each digit.
LEAST_DIGITS, MOST_DIGITS = 7, 19
MOST_CHARS = 3 * MOST_DIGITS
#: Bounds and settings of the fit: the most cells in which all proposals are counted, and the greatest weight of all.  Half
#: of it are examples, in even shares by kind, raised by what other kinds leave; half are no examples.
MAX_CELLS, MAX_SAMPLE = 20000, 20000
ROUNDS, RATE, PRECISION, LEAST = 25, 0.3, 0.99, 5
SPAN = "struct<s:int,e:int,m:string>"


def _found(text: str, pattern: str, needs: str) -> str:
    """SQL: matches of a pattern in column ``text`` with start and end, [] unless the text ``needs``."""
    p = pattern.replace("\\", "\\\\")
    return f"""CASE WHEN {text} RLIKE '{needs}' THEN aggregate(
        zip_with(split({text}, '{p}', -1), regexp_extract_all({text}, '{p}', 0), (g, m) -> named_struct('g', length(g), 'm', m)),
        named_struct('at', 0, 'out', cast(array() as array<{SPAN}>)),
        (a, x) -> CASE WHEN x.m IS NULL THEN a ELSE named_struct('at', a.at + x.g + length(x.m),
            'out', concat(a.out, array(named_struct('s', a.at + x.g, 'e', a.at + x.g + length(x.m), 'm', x.m)))) END,
        a -> a.out) ELSE cast(array() as array<{SPAN}>) END"""


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _stretches(runs: str) -> str:
    """SQL: the stretches of whole digit groups of number runs, other than the runs themselves, with
    LEAST_DIGITS to MOST_DIGITS digits.  Each group starts at most MOST_DIGITS of them."""
    digit = lambda i: f"coalesce(get(x.c, {i}) between '0' and '9', false)"
    cut = f"transform(filter({runs}, x -> x.m rlike '[0-9][^0-9]'), x -> struct(x.s as s, x.m as m, split(x.m, '') as c))"
    edges = f"""transform({cut}, x -> struct(x.s as s, x.m as m, x.c as c,
        filter(sequence(0, length(x.m) - 1), i -> {digit('i')} and not {digit('i - 1')}) as b,
        filter(sequence(1, length(x.m)), i -> {digit('i - 1')} and not {digit('i')}) as e))"""
    sign = "int(coalesce(get(x.c, f - 1) in ('+', '('), false))"
    some = f"""flatten(transform({edges}, x -> flatten(transform(x.b, (f, i) -> transform(
        filter(slice(x.e, i + 1, {MOST_DIGITS}), t -> t - f <= {MOST_CHARS} and t - f + {sign} < length(x.m)),
        t -> struct(x.s + f - {sign} as s, x.s + t as e, substring(x.m, f - {sign} + 1, t - f + {sign}) as m))))))"""
    return f"filter({some}, x -> length({_digits('x.m')}) between {LEAST_DIGITS} and {MOST_DIGITS})"


def _luhn(d: str) -> str:
    v = f"int(substring({d}, i, 1)) * (1 + (length({d}) - i) % 2)"
    return f"aggregate(sequence(1, length({d})), 0, (a, i) -> a + {v} - IF({v} > 9, 9, 0)) % 10 = 0"


def _valid(kind: str) -> str:
    d = _digits("x.m")
    return {
        "email": "true",
        "ip": "forall(split(x.m, '[.]'), o -> length(ltrim('0', o)) <= 3 and int(right(concat('0', ltrim('0', o)), 3)) <= 255)",
        "card": f"length({d}) between 12 and 19 and {_luhn(d)}",
        "phone": f"length({d}) between 9 and 15",
    }[kind]


def findings(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep`` and base (kind as a number, s, e) and loose (features, s, e) of each row."""
    d = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    needs = {"email": "@", "ip": "[0-9][.][0-9]", "card": "[0-9]", "phone": "[+][0-9]"}
    d = d.select(*keep, "text", *[F.expr(_found("text", PATTERNS[k], needs[k])).alias(k) for k in KINDS],
                 F.expr(_found("text", LOOSE_NUMBER, "[0-9]")).alias("numbers"),
                 F.expr(_found("text", LOOSE_EMAIL, "@|[(\\\\[]at[)\\\\]]")).alias("mails"))
    base = ", ".join(f"transform(filter({k}, x -> {_valid(k)}), x -> struct(x.s as s, {i} as kind, x.e as e))" for i, k in enumerate(KINDS))
    d = d.select(*keep, "text", F.expr(f"array_sort(concat({base}))").alias("base"), F.expr(f"concat(numbers, {_stretches('numbers')}, mails)").alias("loose"))
    c = "substring(text, greatest(x.s - 23, 1), least(x.s, 24))"
    form = {
        "digits": f"length({_digits('x.m')})", "groups": "regexp_count(x.m, '[0-9]+')",
        "longest": "coalesce(array_max(transform(regexp_extract_all(x.m, '[0-9]+', 0), g -> length(g))), 0)",
        "parens": "regexp_count(x.m, '[(]')", "dots": "regexp_count(x.m, '[.]|dot')", "dashes": "regexp_count(x.m, '-')",
        "spaces": "regexp_count(x.m, ' ')", "check": f"int(length({_digits('x.m')}) between 12 and 19 and {_luhn(_digits('x.m'))})",
        "octet": "coalesce(array_max(transform(regexp_extract_all(x.m, '[0-9]+', 0), g -> int(right(concat('0', g), 6)))), 0)",
        "mail": "int(x.m rlike '[A-Za-z]')", "tail": "length(regexp_extract(x.m, '[A-Za-z]*$', 0))",
        **{k: f"int(lower({c}) rlike '{v}')" for k, v in CONTEXT.items()},
        "letter_before": "int(substring(text, x.s, 1) rlike '[A-Za-z0-9]' and x.s > 0)",
        "letter_after": "int(substring(text, x.e + 1, 1) rlike '[A-Za-z0-9]')",
    }
    fields = ", ".join(f"int({form[f]}) as {f}" for f in FEATURES)
    return d.select(*keep, "base", F.expr(f"transform(loose, x -> struct(x.s as s, x.e as e, {fields}))").alias("loose"))


# --- boosted trees ------------------------------------------------------------------------

def _stump(bins, cuts, g, h, w, rows):
    """Best split of rows by gain: (gain, feature, threshold).  Bin i of a feature holds values above i of its cuts."""
    best = (1e-6, None, None)
    gs, hs, n = g[rows].sum(), h[rows].sum(), w[rows].sum()
    for f, cut in enumerate(cuts):
        if not len(cut):
            continue
        gl, hl, nl = (np.bincount(bins[rows, f], v[rows], len(cut) + 1).cumsum()[:-1] for v in (g, h, w))
        gain = np.where((nl > 0) & (nl < n), gl ** 2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs ** 2 / (hs + 1), 0)
        at = int(gain.argmax())
        if gain[at] > best[0]:
            best = (float(gain[at]), f, int(cut[at]))
    return best


def boost(bins: np.ndarray, cuts: list[np.ndarray], y: np.ndarray, w: np.ndarray, rounds: int = ROUNDS) -> tuple[float, list]:
    """Logistic boosting over cells of ``w`` proposals with trees of depth two, each a list of (conditions, value)
    with conditions (feature, threshold, at most)."""
    share = np.clip((y * w).sum() / w.sum(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    raw, trees = np.full(len(y), start), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = w * (y - p), w * p * (1 - p)
        leaves = [((), np.ones(len(y), bool))]
        for _ in range(2):
            split = []
            for cond, rows in leaves:
                _, f, t = _stump(bins, cuts, g, h, w, rows)
                if f is None:
                    split.append((cond, rows))
                else:
                    low = bins[:, f] <= np.searchsorted(cuts[f], t)
                    split += [((*cond, (f, t, True)), rows & low), ((*cond, (f, t, False)), rows & ~low)]
            leaves = split
        tree = []
        for cond, rows in leaves:
            value = float(RATE * g[rows].sum() / (h[rows].sum() + 1))
            raw[rows] += value
            tree.append((cond, value))
        trees.append(tree)
    return start, trees


def raw_scores(bins: np.ndarray, cuts: list[np.ndarray], model) -> np.ndarray:
    start, trees = model
    out = np.full(len(bins), start)
    for tree in trees:
        for cond, value in tree:
            rows = np.ones(len(bins), bool)
            for f, t, low in cond:
                rows &= (bins[:, f] <= np.searchsorted(cuts[f], t)) == low
            out[rows] += value
    return out


def tree_sql(model, row: str) -> str:
    """The model's score of struct ``row`` as SQL."""
    start, trees = model
    one = lambda c: f"{row}.{FEATURES[c[0]]} {'<=' if c[2] else '>'} {c[1]}"
    case = lambda tree: "CASE " + " ".join(f"WHEN {' AND '.join(map(one, c)) or 'true'} THEN {v!r}D" for c, v in tree) + " END"
    return " + ".join([f"{start!r}D", *map(case, trees)])


def _cells(rows: DataFrame) -> tuple[pa.Table, list[np.ndarray]]:
    """All of ``rows`` (features, of, y, held) counted in cells of equal bins, y and held; and the cuts of the bins: quantiles
    of each feature in all rows and, fewer, by ``of``.  Fewer are taken until MAX_CELLS are enough; at last
    the medians of all rows only."""
    for parts, by in ((16, 16), (16, 4), (8, 4), (4, 2), (2, 1)):
        quantiles = lambda n: [F.percentile_approx(f, [i / n for i in range(1, n)], 10000).alias(f) for f in FEATURES]
        found = [rows.agg(*quantiles(parts)).first(), *(rows.groupBy("of").agg(*quantiles(by)).collect() if by > 1 else [])]
        cuts = [np.unique([v for r in found for v in r[f] or []]).astype(int) for f in FEATURES]
        bins = [F.expr(f"size(filter(cast(array({', '.join(map(str, cut))}) as array<int>), c -> c < {f}))").alias(f) for f, cut in zip(FEATURES, cuts)]
        cells = rows.select(*bins, "of", "y", "held").groupBy(*FEATURES, "of", "y", "held").agg(F.count(F.lit(1)).alias("n"))
        cells = materialise(cells, "pii-cells")
        if cells.count() <= MAX_CELLS:
            break
    return cells.toArrow(), cuts


def train(found: DataFrame, seed: int = 10) -> dict[int, tuple]:
    """Per kind with enough examples: (threshold, model), from all proposals, counted in cells of equal bins.  A quarter,
    drawn by a hash, is held out for the thresholds.  Kinds, and the proposals of none, weigh in even shares beyond
    MAX_SAMPLE.  Examples come before the others and stay there at equal scores: those may be spans that the base
    rules miss."""
    hit = ", ".join(f"int(exists(base, b -> b.kind = {k} and b.e = x.e and b.s - x.s in (0, 1)))" for k in range(len(KINDS)))
    rows = found.select("base", F.explode("loose").alias("x")).select("x.*", F.expr(f"array({hit})").alias("y"))
    rows = rows.withColumn("held", F.pmod(F.xxhash64(F.lit(seed), *FEATURES, "s"), F.lit(4)) == 0).withColumn("of", F.expr("array_position(y, 1)"))
    cells, cuts = _cells(rows)
    got = cells.to_pandas()
    got = got.assign(none=got["of"] == 0).sort_values(["none", *FEATURES, "held"], kind="stable", ignore_index=True)
    out: dict[int, tuple] = {}
    if not len(got):
        return out
    counts = got.groupby("of")["n"].sum().to_dict()
    share = fair_share({c: n for c, n in counts.items() if c}, MAX_SAMPLE // 2, 0)
    weight = {c: min(1.0, (share if c else MAX_SAMPLE // 2) / n) for c, n in counts.items()}
    bins, held, w = got[list(FEATURES)].to_numpy(), got["held"].to_numpy(), (got["n"] * got["of"].map(weight)).to_numpy(float)
    for k in range(len(KINDS)):
        y = np.array([v[k] for v in got["y"]], float)
        if min((y * w)[~held].sum(), (y * w)[held].sum()) < LEAST:
            continue
        model = boost(bins[~held], cuts, y[~held], w[~held])
        score = raw_scores(bins[held], cuts, model)
        order = np.argsort(-score, kind="stable")
        precise = np.cumsum((y * w)[held][order]) / np.cumsum(w[held][order])
        fine = np.flatnonzero(precise >= PRECISION)
        if len(fine):
            out[k] = (max(float(score[order][fine[-1]]), 0.0), model)
    return out


def spans(found: DataFrame, model: dict[int, tuple]) -> DataFrame:
    """Adds ``spans``: base spans and the proposals above the threshold of their likeliest
    kind, the likelier ones first, then the earlier ones, that overlap none taken before."""
    if model:
        scored = ", ".join(f"struct({tree_sql(m, 'x')} - {t!r}D as score, {k} as kind)" for k, (t, m) in sorted(model.items()))
        new = f"transform(filter(loose, x -> not exists(base, b -> b.s < x.e and x.s < b.e)), x -> struct(array_max(array({scored})) as best, x.s as s, x.e as e))"
        found = found.withColumn("__new", F.expr(f"array_sort(transform(filter({new}, n -> n.best.score >= 0), n -> struct(-n.best.score as rank, n.s as s, n.e as e, n.best.kind as kind)))"))
        taken = "cast(array() as array<struct<s:int,kind:int,e:int>>)"
        found = found.withColumn("__new", F.expr(f"""aggregate(__new, {taken}, (a, n) -> CASE WHEN exists(a, o -> o.s < n.e and n.s < o.e) THEN a
            ELSE concat(a, array(struct(n.s as s, n.kind as kind, n.e as e))) END)"""))
        return found.withColumn("spans", F.expr("array_sort(concat(base, __new))")).drop("__new", "loose")
    return found.withColumn("spans", F.col("base")).drop("loose")


def _joined(name: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({name}, x -> concat_ws(':', element_at(array({names}), x.kind + 1), x.s, x.e)), ',')")


def redact(docs: DataFrame, model: dict[int, tuple]) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets; overlapping
    spans (of different kinds) are one piece with the kind of the first."""
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    d = spans(findings(docs.select(F.struct(*docs.columns).alias("__row"), "text"), "__row"), model)
    text = "__row.text"
    built = f"""aggregate(spans, named_struct('at', 0, 'out', cast(array() as array<string>)),
        (a, x) -> CASE WHEN x.s < a.at THEN named_struct('at', greatest(a.at, x.e), 'out', a.out)
            ELSE named_struct('at', x.e, 'out', concat(a.out, array(substring({text}, a.at + 1, x.s - a.at), element_at(array({names}), x.kind + 1)))) END,
        a -> concat(array_join(a.out, ''), substring({text}, a.at + 1)))"""
    new = F.when(F.size("spans") > 0, F.expr(built)).otherwise(F.col(text))
    return d.withColumn("__text", new).select(*[F.col("__text").alias(c) if c == "text" else F.col(f"__row.{c}") for c in docs.columns])


def op10_query(docs: DataFrame) -> DataFrame:
    """Counts and base_sha256 are of the base spans; ``spans`` holds all, added ones too."""
    found = materialise(findings(docs, "doc_id"), "pii-found")
    out = spans(found, train(found))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return out.select("doc_id", *counts, F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))
