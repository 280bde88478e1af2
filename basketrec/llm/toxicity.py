"""Toxicity by a subsequence string-kernel support vector machine.

Kernel: strings are compared by their common subsequences of three letters that
span at most ``SPAN`` letters, each occurrence weighted ``DECAY`` to the power of
its span, and normalised.  Letters are folded first (case, accents, digits and
signs that stand for letters; other signs vanish), so inserted characters only
lengthen a span.  Pieces of one or two characters in a row ("a b c d", "ab cd e") form one
more unit; words of longer pieces do not, so the kernel does not cross those spaces.

The machine works in the span of Nyström landmarks: features are the kernels to
the landmarks times the inverse root of the landmarks' kernel matrix.  As this
kernel is an inner product of 27**3 subsequence weights, landmarks and machine
fold into one vector of that size, and scoring a unit costs its subsequences only.

Training sentences are bags of units.  A clean sentence has only clean units.  Positive
are all units that so many toxic and so few clean documents hold that chance does
not explain it, over all units tried, weighted by their toxic documents (near copies are one), but for units much like a clean one in as many documents; where toxic documents
are too few for that, the units of a smallest set that covers them and is (nearly)
absent from the clean ones.  Clean units that score too high join the training set in rounds.  A document scores as its highest unit
in a calibrated logistic curve.

Null or empty texts, and texts without three letters in a unit, get the score of
the lowest possible unit.  Repeated rows score alike; extra columns are not read;
without labels of both kinds the score is the share of toxic labels (0 if none).
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketrec.llm.common import crc_fold, materialise

SPAN = 6
DECAY = 0.6
LETTERS = 27
WINDOW = 24
FOLDS = 5
#: Bounds of the training sample: documents of each label, units of each kind, landmarks.
MAX_DOCS = 4000
MAX_CANDIDATES = 4000
MAX_CLEAN_UNITS = 40000
LANDMARKS = 200
#: Probability that any unit of a training table without toxic units is taken for one.
CHANCE = 0.01
#: Kernel of a positive and a clean unit from which the machine can't tell them apart.
ALIKE = 0.6
#: Minima of hashed units by which toxic documents of the sample are told to be near copies.
MINIMA = 16
#: Scored units that a worker remembers, of one model only.
MAX_MEMO = 150_000
#: Digits and signs read as letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
FLOOR = -1.5  # below any unit's score
_SPELLED = re.compile(r"(?<!\S)(?:\S\s+){3,}\S(?!\S)")
_PAIRS = re.compile(r"(?<!\S)(?:\S{1,2}\s+){2,}\S{1,2}(?!\S)")
_OFFSETS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]


class _Fold(dict):
    """Character -> folded letters, filled as characters are met."""

    def __missing__(self, code):
        c = LOOKALIKES.get(chr(code))
        if c is None:
            base = unicodedata.normalize("NFD", chr(code).lower())[:1]
            c = base if "a" <= base <= "z" else chr(97 + code % 26) if base.isalpha() else ""
        self[code] = c
        return c


_FOLD = _Fold({10: "\n"})


def units(text: str | None) -> set[str]:
    """Distinct white-space words, and runs of pieces of one or two characters, joined."""
    if not text:
        return set()
    text = text.lower()
    out = set(text.split())
    for pattern in (_SPELLED, _PAIRS):
        out.update("".join(m.split()) for m in pattern.findall(text))
    return out


def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters 1..26 of all words in one array, SPAN zeros after each window of a
    word, and the word of each letter.  Long words are overlapping windows."""
    raw = "\n".join(w.replace("\n", "") for w in words).translate(_FOLD).split("\n")
    pieces, owner = [], []
    for i, w in enumerate(raw):
        for at in range(0, max(1, len(w) - WINDOW // 2), WINDOW // 2) if len(w) > WINDOW else (0,):
            pieces.append(w[at:at + WINDOW])
            owner.append(i)
    gap = "`" * SPAN
    flat = np.frombuffer((gap.join(pieces) + gap).encode("ascii"), np.uint8).astype(np.int64) - 96
    piece = np.repeat(np.arange(len(pieces)), [len(p) + SPAN for p in pieces])
    return flat, piece, np.array(owner, np.int64)


def subsequences(words: list[str]):
    """(piece, feature, weight) summed per piece and feature, weights normalised per
    piece; and the word of each piece."""
    flat, piece, owner = encode(words)
    keys, weights = [], []
    n = len(flat) - SPAN
    for j, k in _OFFSETS:
        a, b, c = flat[:n], flat[j:n + j], flat[k:n + k]
        ok = np.flatnonzero((a > 0) & (b > 0) & (c > 0) & (piece[:n] == piece[k:n + k]))
        keys.append(piece[ok] * LETTERS ** 3 + (a[ok] * LETTERS + b[ok]) * LETTERS + c[ok])
        weights.append(np.full(len(ok), DECAY ** (k + 1)))
    keys, weights = np.concatenate(keys), np.concatenate(weights)
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), owner
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    weights, keys = np.add.reduceat(weights, first), keys[first]
    piece, feature = keys // LETTERS ** 3, keys % LETTERS ** 3
    norm = np.sqrt(np.bincount(piece, weights ** 2, len(owner)))
    return piece, feature, weights / norm[piece], owner


@dataclass
class Model:
    weights: np.ndarray  # of the subsequences
    bias: float
    slope: float
    offset: float

    def __post_init__(self):
        self.key = hashlib.sha256(self.weights.tobytes() + np.float64(self.bias).tobytes()).hexdigest()

    def unit_scores(self, words: list[str]) -> np.ndarray:
        """Decision values, the highest of a word's windows; FLOOR without subsequences."""
        piece, feature, w, owner = subsequences(words)
        raw = np.bincount(piece, w * self.weights[feature], len(owner)) + self.bias
        raw[np.bincount(piece, minlength=len(owner)) == 0] = FLOOR
        out = np.full(len(words), FLOOR)
        np.maximum.at(out, owner, raw)
        return out

    def raw_scores(self, texts) -> np.ndarray:
        if self.key not in _MEMO:
            _MEMO.clear()  # words of an earlier model in this worker
        known = _MEMO.setdefault(self.key, {})
        bags = [units(t) for t in texts]
        new = list(set().union(*bags).difference(known)) if bags else []
        for at in range(0, len(new), 20000):
            part = new[at:at + 20000]
            known.update(zip(part, self.unit_scores(part).tolist()))
        out = np.array([max(map(known.__getitem__, b), default=FLOOR) for b in bags], float)
        if len(known) > MAX_MEMO:
            known.clear()
        return np.maximum(out, FLOOR)

    def probability(self, raw):
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * raw + self.offset, -40, 40)))

    def score(self, text: Column) -> Column:
        """Column of probabilities, whole texts read."""
        def score(texts: pd.Series) -> pd.Series:
            out = [self.raw_scores(texts.iloc[at:at + 200]) for at in range(0, len(texts), 200)]
            return pd.Series(self.probability(np.concatenate(out)) if out else [], dtype=float)
        return F.pandas_udf(score, "double")(text)


_MEMO: dict[str, dict] = {}


def _dense(words):
    piece, feature, w, owner = subsequences(words)
    out = np.zeros((len(words), LETTERS ** 3), np.float32)
    np.add.at(out, (owner[piece], feature), w)
    return out


def _kernel(words, landmarks):
    """Kernels of words to landmarks, by blocks of words."""
    return np.concatenate([_dense(words[at:at + 500]) @ landmarks.T for at in range(0, len(words), 500)]).astype(float)


def _svm(z, y, weight, cost=10.0, rounds=30):
    """Linear machine with squared hinge loss by Newton steps; (weights, bias)."""
    x = np.c_[z, np.ones(len(z))]
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        on = y * (x @ beta) < 1
        a = x[on] * weight[on, None]
        new = np.linalg.solve(ridge + cost * a.T @ x[on], cost * a.T @ y[on])
        if np.allclose(new, beta, atol=1e-7):
            break
        beta = new
    return beta[:-1], beta[-1]


def _fit(positive: list[str], support: list[float], clean: list[str], seed: int):
    rng = np.random.default_rng(seed)
    pick = lambda words, n: [words[i] for i in rng.permutation(len(words))[:n]]
    marks = _dense(positive[:LANDMARKS // 2] + pick(clean, LANDMARKS // 2))
    vals, vecs = np.linalg.eigh((marks @ marks.T).astype(float))
    keep = vals > 1e-6 * vals.max()
    root = vecs[:, keep] / np.sqrt(vals[keep])
    chosen = set(pick(clean, 4000))
    zp = _kernel(positive, marks) @ root
    for _ in range(4):
        negative = sorted(chosen)
        z = np.r_[zp, _kernel(negative, marks) @ root]
        y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
        weight = np.r_[np.array(support) / np.mean(support), np.full(len(negative), len(positive) / len(negative))]
        beta, bias = _svm(z, y, weight)
        folded = marks.T.astype(float) @ (root @ beta)
        model = Model(folded, float(bias), 1.0, 0.0)
        every = np.concatenate([model.unit_scores(clean[at:at + 5000]) for at in range(0, len(clean), 5000)])
        hard = [clean[i] for i in np.argsort(-every)[:1500] if every[i] > -0.9]
        if chosen.issuperset(hard):
            break
        chosen.update(hard)
    return folded, float(bias)


def _platt(raw, y, weight):
    x, beta = np.c_[raw, np.ones(len(raw))], np.zeros(2)
    target = np.where(y > 0, 0.995, 0.005)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (weight * (target - p)) - 1e-4 * beta)
        size = np.abs(step).max()
        beta += step * min(1.0, 2.0 / max(size, 1e-9))
        if size < 1e-7:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def _cover(pairs: pd.DataFrame) -> dict[str, int]:
    """Greedy cover of documents by units: unit -> documents it newly covers."""
    by = {u: set(d) for u, d in pairs.groupby("unit")["doc"]}
    out: dict[str, int] = {}
    while by:
        best = max(by, key=lambda u: (len(by[u]), u))
        got = by.pop(best)
        if not got:
            break
        out[best] = len(got)
        by = {u: rest for u, d in by.items() if (rest := d - got)}
    return out


def _unlikely(tox: np.ndarray, clean: np.ndarray, share: np.ndarray, tried: int) -> np.ndarray:
    """Which units have more toxic documents than ``CHANCE`` allows among ``tried`` units, if each of a unit's
    documents is toxic with probability ``share`` (binomial tail)."""
    out = np.zeros(len(tox), bool)
    for i, (t, c, p) in enumerate(zip(tox.tolist(), clean.tolist(), np.clip(share, 1e-6, 1 - 1e-6).tolist())):
        term = np.cumsum(np.r_[0.0, np.log((t + c - np.arange(c)) / (np.arange(c) + 1.0))])  # log of n over j, j clean ones
        j = np.arange(c + 1)
        tail = np.logaddexp.reduce(term + (t + c - j) * np.log(p) + j * np.log1p(-p))
        out[i] = tail + np.log(max(tried, 1)) <= np.log(CHANCE)
    return out


def _toxic_share(sizes: pd.DataFrame, typical: np.ndarray) -> np.ndarray:
    """For units whose documents typically have that many units: the toxic share of all units in documents
    of at least half that size, since a rare word stands in long documents only, and those may
    be toxic more often than others."""
    s = sizes.sort_values("units")
    n, toxic = s["units"].to_numpy(float), (s["units"] * s["toxic"]).to_numpy(float)
    at = np.minimum(np.searchsorted(n, typical / 2), max(len(n) - 1, 0))
    return np.cumsum(toxic[::-1])[::-1][at] / np.cumsum(n[::-1])[::-1][at]


def _apart(positive: list[str], support: dict[str, int], clean: dict[str, int]) -> list[str]:
    """Positive units without a clean unit ``ALIKE`` in as many documents: such a word would always be taken for them."""
    near = _kernel(list(clean), _dense(positive))
    as_many = np.array(list(clean.values()))[:, None] >= np.array([support[u] for u in positive])
    return [u for u, lost in zip(positive, ((near >= ALIKE) & as_many).any(axis=0)) if not lost]


def _copies(marks: np.ndarray) -> np.ndarray:
    """Groups of documents that agree in half of their unit minima or more, by their smallest row."""
    root = np.arange(len(marks))
    for i in range(len(marks)):
        near = np.flatnonzero((marks[:i] == marks[i]).sum(axis=1) * 2 >= marks.shape[1])
        if len(near):
            joined = np.isin(root, root[near])
            root[joined] = root[i] = root[near].min()
    return root


def train(docs: DataFrame, labels: DataFrame, seed: int = 6, max_docs: int = MAX_DOCS) -> Model:
    """Fit on documents with a label, outside the held-out fold; at most ``max_docs``
    of each label, drawn by a hash of the id."""
    spark = docs.sparkSession
    lab = (labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
           .filter("id is not null and toxic in (0, 1)").filter(crc_fold(F.col("id"), FOLDS) != 0)
           .groupBy("id").agg(F.max("toxic").alias("toxic")))
    count = {r["toxic"]: r["n"] for r in lab.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not (count.get(0) and count.get(1)):
        share = 0.999 if count.get(1) else 0.001
        return Model(np.zeros(LETTERS ** 3), 0.0, 0.0, float(np.log(share / (1 - share))))
    parts = [lab.filter(F.col("toxic") == t).orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(max_docs) for t in (0, 1)]
    sample = parts[0].union(parts[1])  # at most 2 * max_docs rows of two numbers
    chosen = materialise(
        docs.select(F.col("doc_id").alias("id"), "text").filter("text is not null")
        .join(F.broadcast(sample), "id").dropDuplicates(["text"]), "tox-sample")

    bag = F.udf(lambda t: sorted(u for u in units(t) if 3 <= len(u) <= 200), "array<string>")
    by_doc = materialise(chosen.select("id", "toxic", F.explode(bag("text")).alias("unit")), "tox-units")
    stats = materialise(by_doc.groupBy("unit").agg(F.sum("toxic").alias("tox"), F.sum(1 - F.col("toxic")).alias("clean")), "tox-stats")
    cand = (stats.filter("tox > 0 and clean * 25 <= tox").orderBy(F.desc("tox"), "unit").limit(MAX_CANDIDATES))
    pairs = by_doc.filter("toxic = 1").join(F.broadcast(cand.select("unit")), "unit").select("unit", F.col("id").alias("doc")).toPandas()
    # near copies are one piece of evidence
    marks = by_doc.filter("toxic = 1").groupBy("id").agg(*[F.min(F.xxhash64(F.lit(i), "unit")).alias(f"h{i}") for i in range(MINIMA)]).toPandas()
    group = dict(zip(marks["id"], _copies(marks.drop(columns="id").to_numpy())))
    apart = pairs.assign(group=pairs["doc"].map(group)).groupby("unit")["group"].nunique()
    likely = cand.toPandas()
    likely["tox"] = likely["unit"].map(apart)
    sizes = by_doc.groupBy("id", "toxic").agg(F.count("*").alias("units")).toPandas()
    typical = pairs.assign(units=pairs["doc"].map(dict(zip(sizes["id"], sizes["units"])))).groupby("unit")["units"].median()
    share = _toxic_share(sizes, likely["unit"].map(typical).to_numpy(float)) if len(likely) else np.zeros(0)
    likely = likely[_unlikely(likely["tox"].to_numpy(), likely["clean"].to_numpy(), share, stats.count())]
    clean = {r["unit"]: r["clean"] for r in stats.filter("clean > 0 and tox < 2 * clean").select("unit", "clean")
             .orderBy(F.xxhash64(F.lit(seed), "unit"), "unit").limit(MAX_CLEAN_UNITS).collect()}
    cover = dict(zip(likely["unit"], likely["tox"].tolist()))
    if not cover:  # too few toxic documents for any unit to stand out
        cover = _cover(pairs)
        enough = 2 if sum(n for n in cover.values() if n > 1) >= 0.3 * max(1, pairs["doc"].nunique()) else 1
        cover = {u: n for u, n in cover.items() if n >= enough}
    positive = sorted(cover, key=lambda u: (-cover[u], u))
    if positive and clean:
        positive = _apart(positive, cover, clean) or positive
    if not positive or not clean:
        share = count[1] / (count[0] + count[1])
        return Model(np.zeros(LETTERS ** 3), 0.0, 0.0, float(np.log(share / (1 - share))))
    weights, bias = _fit(positive, [cover[u] for u in positive], list(clean), seed)
    rough = Model(weights, bias, 1.0, 0.0)

    def raw(texts: pd.Series) -> pd.Series:
        return pd.Series(rough.raw_scores(texts), dtype=float)

    fit = chosen.select("toxic", F.pandas_udf(raw, "double")("text").alias("raw")).toPandas()
    y = fit["toxic"].to_numpy()
    weight = np.where(y == 1, count[1] / max(1, (y == 1).sum()), count[0] / max(1, (y == 0).sum()))
    slope, offset = _platt(fit["raw"].to_numpy(), y, weight / weight.mean())
    return Model(weights, bias, slope, offset)


def op6_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    scored = docs.select("doc_id", (crc_fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
