"""Language identification by averaged hashed subword embeddings.

A text is the bag of the character n-grams (2 to 4, with word edges) of its lower-case
letter runs, hashed to BUCKETS; the mean of their embeddings goes through a linear
softmax.  Embeddings and softmax are trained together by stochastic gradient descent
in numpy.  As both are linear, a trained model is one row of logits per bucket, and a
text's logits are the mean over its n-grams; words are looked up, new ones hashed.

Scores are calibrated by a temperature and come with a rejection threshold, the
lowest score from which the accepted calibration texts are right often enough.  The
sample is drawn by language, so that rare ones are learned in a table of any size;
in the calibration its texts weigh as many rows as they stand for.

The predicted language is ``und`` with score 0 for null texts, texts without letters
and models without training rows.  Whole texts are read; repeated rows get equal
results; extra columns are not read; ties go to the first language by code point.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketrec.llm.common import crc_fold, fair_share, smallest_draws_by

BUCKETS = 1 << 16
DIM = 16
FOLDS, HELD = 3, 1
#: Bounds of the training sample: documents, and characters of each (a stretch from a
#: place drawn by the id; predictions read whole texts).  No language gives more documents
#: than an even share of MAX_DOCS, raised by what smaller ones leave; each may give LEAST_DOCS.
MAX_DOCS, MAX_CHARS, LEAST_DOCS = 4000, 600, 20
EPOCHS, BATCH, RATE = 4, 64, 0.5
ACCEPT = 0.99
_WORD = re.compile(r"[^\W\d_]+")
_MEMO: dict[str, tuple[dict, list]] = {}


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every n-gram of the words."""
    text = "".join(f"<{w}>" for w in words)
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    h, who, ids = np.zeros(len(code), np.uint64), [], []
    for n in range(1, 5):
        m = len(code) - n + 1
        if m <= 0:
            break
        h = (h[:m] * np.uint64(0x9E3779B97F4A7C15)) + (code[n - 1:] + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
        if n > 1:
            ok = owner[:m] == owner[n - 1:]
            mixed = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            who.append(owner[:m][ok])
            ids.append((mixed >> np.uint64(40))[ok] % np.uint64(BUCKETS))
    if not ids:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(who), np.concatenate(ids).astype(np.int64)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


@dataclass
class Model:
    langs: list[str]
    logits: np.ndarray  # BUCKETS x langs
    temperature: float
    reject_below: float
    key: str

    def text_logits(self, texts) -> np.ndarray:
        """Mean logits of each text, nan without letters."""
        known, rows = _MEMO.setdefault(self.key, ({}, []))
        bags = [words_of(t) for t in texts]
        new = list(set().union(*bags).difference(known)) if bags else []
        for at in range(0, len(new), 50000):
            part = new[at:at + 50000]
            who, ids = ngrams(part)
            sums = [np.bincount(who, self.logits[ids, k], len(part)) for k in range(len(self.langs))]
            first = sum(map(len, rows))
            rows.append(np.c_[np.array(sums).T, np.bincount(who, minlength=len(part))])
            known.update(zip(part, range(first, first + len(part))))
        table = np.concatenate(rows) if rows else np.zeros((0, len(self.langs) + 1))
        rows[:] = [table]
        out = np.full((len(bags), len(self.langs)), np.nan)
        for i, b in enumerate(bags):
            if b:
                total = table[np.fromiter(map(known.__getitem__, b), np.int64, len(b))].sum(axis=0)
                out[i] = total[:-1] / total[-1]
        if len(known) > 400_000:
            del _MEMO[self.key]
        return out

    def predict(self, text: Column) -> Column:
        """struct(lang_pred, score, rejected) of whole texts."""
        def predict(texts: pd.Series) -> pd.DataFrame:
            parts = [_softmax(self.text_logits(texts.iloc[at:at + 500]) / self.temperature) for at in range(0, len(texts), 500)]
            p = np.concatenate(parts) if parts and self.langs else np.full((len(texts), 1), np.nan)
            none = np.isnan(p).any(axis=1)
            p = np.where(none[:, None], 0.0, p)
            names = np.array(self.langs or ["und"], object)
            score = p.max(axis=1)
            return pd.DataFrame({"lang_pred": np.where(none, "und", names[p.argmax(axis=1)]), "score": score, "rejected": none | (score < self.reject_below)})
        return F.pandas_udf(predict, "lang_pred string, score double, rejected boolean")(text)


def _softmax(z):
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], y: np.ndarray, n_langs: int, seed: int = 7) -> np.ndarray:
    """Logits of the buckets after SGD on the texts."""
    rng = np.random.default_rng(seed)
    emb, out = rng.normal(0, 0.1, (BUCKETS, DIM)), np.zeros((DIM, n_langs))
    bags = [ngrams(words_of(t))[1] for t in texts]
    use = [i for i, b in enumerate(bags) if len(b)]
    steps, step = max(1, EPOCHS * -(-len(use) // BATCH)), 0
    for _ in range(EPOCHS):
        order = rng.permutation(use)
        for at in range(0, len(order), BATCH):
            rate = RATE * (1 - step / steps)
            step += 1
            rows = order[at:at + BATCH]
            n = np.array([len(bags[i]) for i in rows])
            ids, owner = np.concatenate([bags[i] for i in rows]), np.repeat(np.arange(len(rows)), n)
            uniq, inv = np.unique(ids, return_inverse=True)
            share = np.zeros((len(rows), len(uniq)))
            np.add.at(share, (owner, inv), 1.0 / n[owner])
            hidden = share @ emb[uniq]
            grad = _softmax(hidden @ out)
            grad[np.arange(len(rows)), y[rows]] -= 1
            back = grad @ out.T
            out -= rate * hidden.T @ grad / len(rows) * DIM
            emb[uniq] -= rate * share.T @ back * DIM
    return emb @ out


def train(docs: DataFrame, seed: int = 7, max_docs: int = MAX_DOCS) -> Model:
    """Fit on documents with a language outside the held-out fold, at most ``max_docs`` (or
    LEAST_DOCS of each language) drawn by a hash of the id within each language; a fifth
    of a language's only calibrates."""
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.greatest(F.length("text") - MAX_CHARS, F.lit(1))).cast("int") + 1
    rows = (docs.filter("text is not null and lang is not null").filter(crc_fold(F.col("doc_id"), FOLDS) != HELD)
            .select("doc_id", "lang", F.substring("text", place, F.lit(MAX_CHARS)).alias("part"))
            .withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "part")))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    rows = smallest_draws_by(rows, "lang", counts, "draw", fair_share(counts, max_docs, LEAST_DOCS), "doc_id").to_pandas()
    langs = sorted(rows["lang"].unique())
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)), 1.0, 1.0, "none")
    y = rows["lang"].map({k: i for i, k in enumerate(langs)}).to_numpy()
    texts, held = rows["part"].tolist(), (rows.groupby("lang").cumcount() % 5 == 4).to_numpy()
    weight = (rows["lang"].map(counts) / rows.groupby("lang")["lang"].transform("size")).to_numpy(float)
    logits = fit([t for t, h in zip(texts, held) if not h], y[~held], len(langs), seed)
    model = Model(langs, logits, 1.0, 0.0, f"{seed}-{max_docs}-{len(rows)}-{abs(logits).sum():.6f}")
    check = model.text_logits([t for t, h in zip(texts, held) if h])
    fine = ~np.isnan(check).any(axis=1)
    z, right, weight = check[fine], y[held][fine], weight[held][fine]
    if len(z):
        chance = lambda t: np.clip(_softmax(z / t)[np.arange(len(z)), right], 1e-12, 1 - 1e-12)
        # smoothed labels: a calibration sample without mistakes does not make scores certain
        loss = lambda t: -np.average(0.998 * np.log(chance(t)) + 0.002 * np.log(1 - chance(t)), weights=weight)
        model.temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
        p = _softmax(z / model.temperature)
        order = np.argsort(-p.max(axis=1))
        hit = np.cumsum((p.argmax(axis=1) == right)[order] * weight[order]) / np.cumsum(weight[order])
        good = np.flatnonzero(hit >= ACCEPT)
        model.reject_below = float(p.max(axis=1)[order][good[-1]]) if len(good) else 1.0
    _MEMO.pop(model.key, None)
    return model


def op7_query(docs: DataFrame) -> DataFrame:
    model = train(docs)
    return docs.select("doc_id", (crc_fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"),
                       model.predict(F.col("text")).alias("p")).select("doc_id", "held_out", "p.*")
