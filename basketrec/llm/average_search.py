"""Vector codes by codebooks, with equal-average nearest-entry search.

A vector of integers is cut into equal parts; each position has a codebook of its own, and a
part's code is the number of its nearest entry.  The nearest entry is found by sums: by the
Cauchy-Schwarz inequality, the squared distance of two parts of d components is at least the
squared gap of their component sums over d.  A codebook's entries are sorted by their sum; from
the place of a part's own sum the search goes outward, nearer side first, and ends as soon as
the squared gap over d strictly exceeds the best squared distance so far, so that ties are
still seen.  All arithmetic is in integers and exact.

Rounds of assignment and means move the entries: tasks send partial sums of the entries
only, whose number is bounded by the codebooks, not by the table.

Rows whose vector is null, empty, or holds a null or non-finite component take no part; so do
those with an integer of ``vectors.INTEGER_LIMIT`` or more, and those of another length than
most rows of the table (ties to the shorter), or of a length that parts do not divide.  Repeated
rows and repeated ids each count and give a row; the first entries are rows by vec_id,
null last, then by their components.  With fewer rows than entries there are as many entries as
rows; an empty table gives no row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketrec.llm import vectors
from basketrec.llm.common import materialise

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Entries looked at before the outward walk, and parts searched at once.
WINDOW, BATCH = 8, 16384
#: Groups whose sums are broadcast; more are joined by salted keys.
BROADCAST_GROUPS, SALTS = 200_000, 64
FAR = np.int64(1) << 62


class AverageBook:
    """Entries of one part position (entry, component), sorted by component sum."""

    def __init__(self, entries: np.ndarray):
        self.k, self.d = entries.shape
        total = entries.sum(1)
        self.order = np.argsort(total, kind="stable")
        self.sums, self.entries = total[self.order], entries[self.order]

    def _keys(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Squared distance, then number, of the sorted entries ``at``, as one integer."""
        return ((x - self.entries[at]) ** 2).sum(-1) * self.k + self.order[at]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest entry of each row, ties to the smaller number."""
        found = [self._nearest(x[i:i + BATCH]) for i in range(0, len(x), BATCH)] or [np.zeros(0, np.int64)]
        best = np.concatenate(found)
        return best % self.k, best // self.k

    def _nearest(self, x: np.ndarray) -> np.ndarray:
        own = x.sum(1)
        w = min(WINDOW, self.k)
        left = np.clip(np.searchsorted(self.sums, own) - w // 2, 0, self.k - w)
        best = self._keys(x[:, None, :], left[:, None] + np.arange(w)).min(1)
        left, right = left - 1, left + w
        live = np.arange(len(x))
        while len(live):
            s, l, r = own[live], left[live], right[live]
            # outside the first window sums lie outward of the own sum, or there is no entry
            gap_l = np.where(l >= 0, np.maximum(s - self.sums[np.maximum(l, 0)], 0), FAR)
            gap_r = np.where(r < self.k, np.maximum(self.sums[np.minimum(r, self.k - 1)] - s, 0), FAR)
            gap = np.minimum(gap_l, gap_r)
            on = gap < FAR
            on[on] = gap[on] ** 2 <= self.d * (best[live[on]] // self.k)
            live, go_left = live[on], (gap_l <= gap_r)[on]
            at = np.where(go_left, l[on], r[on])
            best[live] = np.minimum(best[live], self._keys(x[live], at))
            left[live] -= go_left
            right[live] += ~go_left
        return best


def _books(books: np.ndarray) -> list[AverageBook]:
    return [AverageBook(b) for b in books]


def _parts(column: pa.Array, parts: int) -> np.ndarray:
    q = vectors.matrix(column).astype(np.int64)
    return q.reshape(len(q), parts, -1)


def _move(books: np.ndarray):
    """Partial sums of the rows nearest to each entry."""
    def run(batches):
        search = _books(books)
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for rb in batches:
            if rb.num_rows:
                q = _parts(rb.column(0), len(books))
                for p, book in enumerate(search):
                    entry, _ = book.nearest(q[:, p])
                    counts[p] += np.bincount(entry, minlength=book.k)
                    np.add.at(sums[p], entry, q[:, p])
        if counts.any():
            yield vectors.partial_sums(sums, counts)

    return run


def _assign(books: np.ndarray):
    def run(batches):
        search, width = _books(books), 2 * len(books)
        for rb in batches:
            if rb.num_rows:
                q = _parts(rb.column(rb.num_columns - 1), len(books))
                found = [book.nearest(q[:, p]) for p, book in enumerate(search)]
                text = np.stack([f[0] for f in found], 1).astype(np.uint8).tobytes().hex()
                codes = [text[i:i + width] for i in range(0, len(text), width)]
                error = np.stack([f[1] for f in found], 1).sum(1)
                yield pa.RecordBatch.from_arrays([*rb.columns[:-1], pa.array(codes), pa.array(error)],
                                                 names=[*rb.schema.names[:-1], "code", "error"])

    return run


def usual_length(rows: DataFrame, parts: int) -> int:
    """The commonest length of ``q`` that ``parts`` divides; 0 without any."""
    found = rows.groupBy(F.size("q").alias("n")).count().filter(F.col("n") % parts == 0).orderBy(F.desc("count"), "n").first()
    return found["n"] if found else 0


def train(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) of ``rows`` (vec_id, q), all of length ``dim``."""
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits, so at most 256 entries")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").select("q").limit(entries).collect()
    if not first:
        return np.zeros((parts, 0, max(dim, parts) // parts), np.int64)
    books = np.array([r.q for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        means = vectors.floor_means(rows.select("q").mapInArrow(_move(books), vectors.PARTIAL_SCHEMA), books.size)
        for (p, e), mean in means.items():
            books[p, e] = mean
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``rows`` with ``code`` and ``error`` in place of their last column ``q``."""
    kept = rows.schema[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", code string, error long"
    if not books.shape[1]:
        return rows.sparkSession.createDataFrame([], schema)
    return rows.mapInArrow(_assign(books), schema)


def with_group_sum(rows: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """``rows`` (a written table) and the sum of ``value`` over those of equal ``group``, nulls together.  The sums are
    broadcast when few; else a group's rows meet its sum in ``SALTS`` salted parts."""
    sums = materialise(rows.groupBy(F.col(group).alias("__group")).agg(F.sum(value).alias(out)), "group-sums")
    if sums.count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(sums), F.col(group).eqNullSafe(F.col("__group"))).drop("__group")
    salted = sums.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("__own", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__own") == F.col("__salt"))).drop("__group", "__salt", "__own")


def op11_query(embeddings: DataFrame) -> DataFrame:
    rows = vectors.quantised(embeddings, SCALE, "label")
    dim = usual_length(rows, PARTS)
    rows = materialise(rows.filter(F.size("q") == dim), "quantised")
    books = train(rows.select("vec_id", "q"), dim)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = materialise(encode(rows, books), "coded")
    return with_group_sum(coded, "label", "error", "label_error").select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _round_sql(n: int) -> str:
    return f"""
d{n} AS (SELECT q.vec_id, q.part, b.entry, sum((q.v - b.c) * (q.v - b.c)) AS dist
         FROM q JOIN b{n} b ON q.part = b.part AND q.j = b.j GROUP BY q.vec_id, q.part, b.entry),
a{n} AS (SELECT vec_id, part, entry, dist FROM d{n}
         QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY dist, entry) = 1)"""


def _move_sql(n: int) -> str:
    return f"""
m{n} AS (SELECT q.part, a.entry, q.j, CAST(floor(sum(q.v) / count(*)) AS BIGINT) AS c
         FROM q JOIN a{n} a ON q.vec_id = a.vec_id AND q.part = a.part GROUP BY q.part, a.entry, q.j),
b{n + 1} AS (SELECT b.part, b.entry, b.j, coalesce(m.c, b.c) AS c
             FROM b{n} b LEFT JOIN m{n} m ON b.part = m.part AND b.entry = m.entry AND b.j = m.j)"""


OP11_SQL = f"""
WITH kept AS (SELECT vec_id, label, embedding FROM embeddings
              WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
long AS (SELECT vec_id, len(embedding) // {PARTS} AS width, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding) AS x FROM kept),
q AS (SELECT vec_id, pos // width AS part, pos % width AS j, CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) AS v FROM long),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {ENTRIES}),
b0 AS (SELECT q.part, f.entry, q.j, q.v AS c FROM q JOIN first f ON q.vec_id = f.vec_id),
{",".join(_round_sql(n) + "," + _move_sql(n) for n in range(ROUNDS))},{_round_sql(ROUNDS)},
coded AS (SELECT vec_id, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error
          FROM a{ROUNDS} GROUP BY vec_id),
book AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, j)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, b.codebooks_sha256
FROM kept k JOIN coded c ON k.vec_id = c.vec_id CROSS JOIN book b"""
