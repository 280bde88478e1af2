"""Repeated passages by an enhanced, sparse suffix array and its common-prefix intervals.

A string of LENGTH bytes that two texts share contains the same anchor in both: the
smallest hashed GRAM among its LENGTH - GRAM + 1 ones.  So it is enough to sort the
suffixes that start at anchors, with the bytes to the left of them.

1. ``_blocks``: texts in blocks of bounded size, compressed, one row each, with the places
   of their anchors, which later steps read back; bucketed by block, so that the steps
   that return to the texts shuffle no text.
2. ``_anchors`` and ``_repeated``: which anchors are in several documents.  Only
   sorted 48-bit hashes travel; chance matches are sorted out by the next step.
3. ``_contexts`` and ``_tree``: the bytes around repeated anchors, each distinct
   context of a block once with its smallest document, are sorted as suffixes.  A
   stack scan over the common prefixes of neighbours yields the intervals of the
   prefix tree; within an interval, the same scan over the left contexts yields the
   classes of left extensions.  A class whose left and right parts make LENGTH bytes
   or more, and whose members differ at both ends (the diversity tests), is a
   maximal repeat (within the context) with all its occurrences.
4. ``_cover``: bytes of occurrences in documents other than the smallest of a repeat.

Anchors in more than GROUP contexts would be large groups; their 50-byte windows
are instead counted by an ordinary grouped minimum, which gives the same bytes.

Null texts are empty; texts shorter than LENGTH lose nothing; an id that is null
counts as smaller than all others; rows of one id never remove from each other.
Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketrec.llm.common import materialise
from basketrec.llm.sentencepiece_codec import squeeze, stretch
from basketrec.session import scratch_path

LENGTH, GRAM = 50, 24
LEFT = LENGTH - GRAM
BLOCK_BYTES = 8_000_000
#: Parts of the contexts for each shuffle partition: a part is sorted in one task's memory.
FINER = 4
GROUP = 20000
NO_ID = -(1 << 63)
_BYTE = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
_BYTE ^= _BYTE >> np.uint64(29)


# --- anchors ----------------------------------------------------------------------------

def gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position (2 + 4 + 8 + 16, then 16 + 8)."""
    h, size, kept, prime = _BYTE[b], 1, {}, 0x9E3779B97F4A7C15
    power = prime
    while size < 16:
        h = h[:-size] * np.uint64(power) + h[size:]
        size, power = 2 * size, power * power % (1 << 64)
        kept[size] = h
    h = kept[16][:len(kept[16]) - 8] * np.uint64(pow(prime, 8, 1 << 64)) + kept[8][16:]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(30))


def anchors(raw: bytes) -> np.ndarray:
    """Positions of the first smallest gram of every window of LENGTH bytes."""
    if len(raw) < LENGTH:
        return np.zeros(0, np.int32)
    h = gram_hashes(np.frombuffer(raw, np.uint8))
    value, at, span = h, np.arange(len(h), dtype=np.int32), 1
    while True:
        step = min(span, LEFT + 1 - span)
        right = value[step:] < value[:-step]
        value, at = np.where(right, value[step:], value[:-step]), np.where(right, at[step:], at[:-step])
        span += step
        if span == LEFT + 1:
            break
    return at[np.concatenate([[True], at[1:] != at[:-1]])]


def gram_ids(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """48-bit hash of the GRAM bytes of ``flat`` from each of the places ``at``."""
    w = np.lib.stride_tricks.sliding_window_view(flat, GRAM)[at].view("<u8") if len(at) else np.zeros((0, 3), np.uint64)
    h = w[:, 0] * np.uint64(0x9E3779B97F4A7C15)
    h = ((h ^ (h >> np.uint64(29))) + w[:, 1]) * np.uint64(0xBF58476D1CE4E5B9)
    h = ((h ^ (h >> np.uint64(32))) + w[:, 2]) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(16)).astype(np.int64)


BLOCK_SCHEMA = "block string, ids binary, lens binary, raw binary, places binary"


def _blocks(block_bytes: int):
    def close(ids, texts):
        places = [anchors(t) for t in texts]
        counts = np.fromiter(map(len, places), np.int64, len(places))
        steps = np.concatenate([np.diff(p, prepend=0) for p in places])
        return pa.RecordBatch.from_arrays(
            [pa.array([uuid.uuid4().hex]), pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
             pa.array([np.array([len(t) for t in texts], "<i8").tobytes()], pa.binary()),
             pa.array([zstandard.compress(b"".join(texts))], pa.binary()), pa.array([squeeze(np.concatenate([counts, steps]))], pa.binary())],
            names=["block", "ids", "lens", "raw", "places"])

    def run(batches):
        ids, texts, held = [], [], 0
        for rb in batches:
            for i, t in zip(rb.column(0).to_pylist(), rb.column(1)):
                ids.append(i)
                texts.append(t.as_py())
                held += len(texts[-1]) + 16
                if held >= block_bytes:
                    yield close(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield close(ids, texts)

    return run


def _texts(ids: bytes, lens: bytes, raw: bytes):
    """(ids, texts) of a block."""
    raw, ends = zstandard.decompress(raw), np.cumsum(np.frombuffer(lens, "<i8"))
    return np.frombuffer(ids, "<i8"), [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def _block_anchors(texts, places: bytes):
    """Document number, position and 48-bit hash of all anchors of a block."""
    x = stretch(places).astype(np.int64)
    counts, steps = x[:len(texts)], x[len(texts):]
    doc = np.repeat(np.arange(len(texts)), counts)
    upto = np.concatenate([[0], np.cumsum(steps)])
    first = np.cumsum(counts) - counts
    pos = upto[1:] - np.repeat(upto[first], counts)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    return doc, pos, gram_ids(np.frombuffer(b"".join(texts), np.uint8), (np.cumsum(size) - size)[doc] + pos)


def _pack(h: np.ndarray) -> bytes:
    """Sorted 48-bit numbers: differences in two halves."""
    d = np.diff(h, prepend=0)
    return squeeze(np.concatenate([d & 0xFFFFFF, d >> 24]))


def _unpack(blob: bytes) -> np.ndarray:
    x = stretch(blob).astype(np.int64)
    return np.cumsum(x[:len(x) // 2] + (x[len(x) // 2:] << 24))


def _documents_of(doc, h):
    """Distinct hashes, sorted, and the number of distinct documents of each."""
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
    other = new | np.concatenate([[True], doc[1:] != doc[:-1]]) if len(h) else new
    first = np.flatnonzero(new)
    return h[first], np.add.reduceat(other.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)


def _anchors(deal: int):
    def run(batches):
        for rb in batches:
            for block, ids, lens, raw, places in zip(*(c.to_pylist() for c in rb.columns)):
                doc, _, h = _block_anchors(_texts(ids, lens, raw)[1], places)
                uniq, docs = _documents_of(doc, h)
                part, rows = uniq % deal, []
                for p in np.unique(part).tolist():
                    at = part == p
                    rows.append((p, block, _pack(uniq[at]), zstandard.compress(np.minimum(docs[at], 255).astype(np.uint8).tobytes())))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.string(), pa.binary(), pa.binary()))],
                                                     names=["part", "block", "h", "docs"])

    return run


def _repeated(group: int):
    """Per block, the anchors that are in several documents, and whether they are in very many."""
    def run(batches):
        rows = [r for rb in batches for r in zip(*(c.to_pylist() for c in rb.columns))]
        if not rows:
            return
        h = [_unpack(r[2]) for r in rows]
        docs = [np.frombuffer(zstandard.decompress(r[3]), np.uint8).astype(np.int64) for r in rows]
        every, weight = np.concatenate(h), np.concatenate(docs)
        order = np.argsort(every, kind="stable")
        s = every[order]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        total = np.add.reduceat(weight[order], first)
        count = np.empty(len(s), np.int64)
        count[order] = np.repeat(total, np.diff(np.concatenate([first, [len(s)]])))
        for r, x, c in zip(rows, h, np.split(count, np.cumsum([len(x) for x in h])[:-1])):
            if (c > 1).any():
                yield pa.RecordBatch.from_arrays([pa.array([r[1]]), pa.array([_pack(x[c > 1])], pa.binary()), pa.array([np.packbits(c[c > 1] > group).tobytes()], pa.binary())],
                                                 names=["block", "h", "hot"])

    return run


# --- contexts ---------------------------------------------------------------------------

def _block_contexts(texts, ids, places: bytes, answer: pa.Table):
    """Distinct contexts of the repeated anchors of a block, and their occurrences.

    Returns (hash, hot, bytes matrix, left size, right size, smallest id) of contexts
    and (document number, position, context) of occurrences."""
    hs = [_unpack(x) for x in answer["h"].to_pylist()]
    hots = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(h)).astype(bool) for x, h in zip(answer["hot"].to_pylist(), hs)]
    known = np.concatenate(hs or [np.zeros(0, np.int64)])
    hot = np.concatenate(hots or [np.zeros(0, bool)])
    order = np.argsort(known)
    known, hot = known[order], hot[order]
    doc, pos, h = _block_anchors(texts, places)
    at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
    keep = known[at] == h if len(known) else np.zeros(len(h), bool)
    doc, pos, h, hot = doc[keep], pos[keep], h[keep], hot[at[keep]] if len(known) else np.zeros(0, bool)
    pad_l, pad_r = b"\0" * LEFT, b"\0" * LENGTH
    flat = np.frombuffer(pad_l + (pad_r + pad_l).join(texts) + pad_r, np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(size + LEFT + LENGTH) - size - LENGTH  # of each text in flat
    ls, rs = np.minimum(pos, LEFT), np.minimum(size[doc] - pos, LENGTH)
    n = LEFT + LENGTH
    rows = np.zeros((len(doc), n + 2 + 8), np.uint8)
    rows[:, :n] = np.lib.stride_tricks.sliding_window_view(flat, n)[start[doc] + pos - LEFT]
    # the padding between two texts has the size of both contexts, so what is beyond a text is zero
    rows[:, n], rows[:, n + 1] = ls, rs
    rows[:, n + 2:] = h.astype(">i8").view(np.uint8).reshape(-1, 8)
    key = np.ascontiguousarray(rows).view(np.dtype((np.void, n + 10))).ravel()
    _, first, ctx = np.unique(key, return_index=True, return_inverse=True)
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, ctx, ids[doc])
    return (h[first], hot[first], rows[first, :n], ls[first], rs[first], least), (doc, pos, ctx)


CONTEXT_SCHEMA = "part int, block string, n int, meta binary, raw binary"


def _contexts(deal: int):
    """Rows by part of the hash: contexts packed; negative parts: hot ones, for the window count."""
    def run(blocks: pa.Table, answer: pa.Table) -> pa.Table:
        out = []
        for block, ids, lens, raw, places in zip(*(blocks[c].to_pylist() for c in ("block", "ids", "lens", "raw", "places"))):
            ids, texts = _texts(ids, lens, raw)
            (h, hot, mat, ls, rs, least), _ = _block_contexts(texts, ids, places, answer)
            part = np.where(hot, -1 - h % deal, h % deal)
            for p in np.unique(part).tolist():
                at = np.flatnonzero(part == p)
                meta = np.stack([h[at], least[at], at, ls[at], rs[at]]).astype("<i8")
                out.append((p, block, len(at), zstandard.compress(meta.view(np.uint8).reshape(5, -1, 8).transpose(0, 2, 1).tobytes()), zstandard.compress(mat[at].tobytes())))
        cols = list(zip(*out)) or [()] * 5
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary()))], names=["part", "block", "n", "meta", "raw"])

    return run


def _unpack_contexts(n, meta, raw):
    m = np.frombuffer(zstandard.decompress(meta), np.uint8).reshape(5, 8, n).transpose(0, 2, 1)
    m = np.ascontiguousarray(m).view("<i8").reshape(5, n)
    return m, np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(n, LEFT + LENGTH)


# --- the interval tree ------------------------------------------------------------------

def intervals(lcp: list[int], floor: int):
    """Intervals (first, last, depth) of the common-prefix tree over sorted suffixes, by a
    stack scan; lcp[i] is between suffix i and i + 1; only depths of ``floor`` or more."""
    stack: list[tuple[int, int]] = []  # (first suffix, depth), depths growing
    for i, depth in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][1] > depth:
            first, d = stack.pop()
            if d >= floor:
                yield first, i, d
        if depth >= 0 and (not stack or stack[-1][1] < depth):
            stack.append((first, depth))


def _common(a, b, na, nb):
    """Length of the common start of the rows of two matrices, within their sizes."""
    differ = a != b
    n = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return np.minimum(n, np.minimum(na, nb))


def repeats(right, rs, left, ls):
    """Maximal repeats of distinct contexts: (members, left part, right part).  ``left`` is
    reversed, so both sides are read from the anchor."""
    order = np.lexsort((rs, *right.T[::-1]))
    lcp = _common(right[order[:-1]], right[order[1:]], rs[order[:-1]], rs[order[1:]]).tolist()
    for lo, hi, depth in intervals(lcp, GRAM):
        need = max(0, LENGTH - depth)
        members = order[lo:hi + 1]
        by_left = np.lexsort((ls[members], *left[members].T[::-1]))
        m = members[by_left]
        left_lcp = _common(left[m[:-1]], left[m[1:]], ls[m[:-1]], ls[m[1:]]).tolist()
        for a, b, reach in intervals(left_lcp, need):
            # the class is of several branches of the interval, else a deeper one has it
            place = np.sort(by_left[a:b + 1])
            if min(min(lcp[lo + x:lo + y]) for x, y in pairwise(place.tolist())) == depth:
                yield m[a:b + 1], reach, depth


def _tree():
    """Per block and context, how far left and right of the anchor its smallest document
    repeats a document with a smaller id."""
    names = ("block", "ctx", "l", "r", "n", "meta", "raw")
    ints, nothing = pa.list_(pa.int32()), [pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())]

    def run(batches):
        rows = [r for rb in batches for r in zip(*(c.to_pylist() for c in rb.columns))]
        for part, block, n, meta, raw in rows:
            if part < 0:  # goes to the window count as it is
                yield pa.RecordBatch.from_arrays([pa.array([block]), *(pa.nulls(1, ints) for _ in range(3)), pa.array([n], pa.int32()), pa.array([meta], pa.binary()), pa.array([raw], pa.binary())], names=names)
        rows = [r for r in rows if r[0] >= 0]
        if not rows:
            return
        meta, mats = zip(*(_unpack_contexts(n, m, raw) for _, _, n, m, raw in rows))
        block = np.repeat(np.arange(len(rows)), [r[2] for r in rows])
        (h, doc, ctx, ls, rs), mat = np.concatenate(meta, axis=1), np.concatenate(mats)
        left, right = np.ascontiguousarray(mat[:, :LEFT][:, ::-1]), np.ascontiguousarray(mat[:, LEFT:])
        to_left, to_right = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        n = mat.shape[1]
        full = np.zeros((len(h), 8 + n + 2), np.uint8)
        full[:, :8], full[:, 8:8 + n], full[:, -2], full[:, -1] = h.astype(">i8").view(np.uint8).reshape(-1, 8), mat, ls, rs
        # equal contexts of several blocks: all but the smallest document repeat it whole
        _, first, same = np.unique(np.ascontiguousarray(full).view(np.dtype((np.void, full.shape[1]))).ravel(), return_index=True, return_inverse=True)
        least = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(least, same, doc)
        whole = (doc > least[same]) & (ls + rs >= LENGTH)
        to_left[whole], to_right[whole] = ls[whole], rs[whole]
        # np.unique sorts by the bytes of the hash first: the classes of an anchor are neighbours
        class_h, reach_l, reach_r = h[first], np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        edge = np.concatenate([[0], np.flatnonzero(class_h[1:] != class_h[:-1]) + 1, [len(first)]])
        size = np.diff(edge)
        two = edge[:-1][size == 2]
        i, j = first[two], first[two + 1]
        l2, r2 = _common(left[i], left[j], ls[i], ls[j]), _common(right[i], right[j], rs[i], rs[j])
        ok = (l2 + r2 >= LENGTH) & (r2 >= GRAM)
        for a, b in ((two, two + 1), (two + 1, two)):
            later = a[ok & (least[a] > least[b])]
            reach_l[later], reach_r[later] = l2[ok & (least[a] > least[b])], r2[ok & (least[a] > least[b])]
        for lo, hi in zip(edge[:-1][size > 2].tolist(), edge[1:][size > 2].tolist()):
            f = first[lo:hi]
            for m, l, r in repeats(right[f], rs[f], left[f], ls[f]):
                m = lo + m
                later = m[least[m] > least[m].min()]
                reach_l[later] = np.maximum(reach_l[later], l)
                reach_r[later] = np.maximum(reach_r[later], r)
        own = ~whole & (doc == least[same])
        to_left[own], to_right[own] = reach_l[same[own]], reach_r[same[own]]
        hit = np.flatnonzero(to_left + to_right >= LENGTH)
        for b, at in zip(*_runs(block[hit], hit)):
            yield pa.RecordBatch.from_arrays([pa.array([rows[b][1]]), *(pa.array([x[at].astype(np.int32).tolist()], ints) for x in (ctx, to_left, to_right)), *nothing], names=names)

    return run


def _runs(key, items):
    cut = np.flatnonzero(np.diff(key)) + 1
    return key[np.concatenate([[0], cut])].tolist() if len(key) else [], np.split(items, cut) if len(key) else []


def _windows():
    """All windows of LENGTH bytes around hot anchors: hash, id, block, context, left part."""
    def run(batches):
        for rb in batches:
            for block, n, meta, raw in zip(*(c.to_pylist() for c in rb.columns)):
                (_, doc, ctx, ls, rs), mat = _unpack_contexts(n, meta, raw)
                for a in range(LEFT + 1):
                    at = np.flatnonzero((ls >= a) & (rs >= LENGTH - a))
                    w = [hashlib.md5(x.tobytes()).digest() for x in mat[at, LEFT - a:LEFT - a + LENGTH]]
                    yield pa.RecordBatch.from_arrays([pa.array(w, pa.binary()), pa.array(doc[at]), pa.array([block] * len(at), pa.string()), pa.array(ctx[at].astype(np.int32)), pa.array(np.full(len(at), a, np.int32))],
                                                     names=["w", "doc", "block", "ctx", "a"])

    return run


# --- result -----------------------------------------------------------------------------

RESULT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, starts array<long>, ends array<long>"


def _cover():
    def run(blocks: pa.Table, answer: pa.Table) -> pa.Table:
        out = []
        anchor_rows = answer.filter(pa.compute.is_valid(answer["h"]))
        reach = answer.filter(pa.compute.is_null(answer["h"]))
        for ids, lens, raw, places in zip(*(blocks[c].to_pylist() for c in ("ids", "lens", "raw", "places"))):
            ids, texts = _texts(ids, lens, raw)
            (_, _, _, ls, rs, least), (doc, pos, ctx) = _block_contexts(texts, ids, places, anchor_rows)
            l, r = np.zeros(len(ls), np.int64), np.zeros(len(ls), np.int64)
            for c, x, y in zip(*(reach[k].to_pylist() for k in ("ctx", "l", "r"))):
                l[c], r[c] = np.maximum(l[c], x), np.maximum(r[c], y)
            later = (ids[doc] > least[ctx]) & (ls[ctx] + rs[ctx] >= LENGTH)
            lo = pos - np.where(later, ls[ctx], l[ctx])
            hi = pos + np.where(later, rs[ctx], r[ctx])
            use = hi - lo >= LENGTH
            lo, hi, doc = lo[use], hi[use], doc[use]
            cut = np.searchsorted(doc, np.arange(len(texts) + 1))
            for i, t in enumerate(texts):
                step = np.zeros(len(t) + 1, np.int64)
                np.add.at(step, lo[cut[i]:cut[i + 1]], 1)
                np.add.at(step, hi[cut[i]:cut[i + 1]], -1)
                gone = np.cumsum(step[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
                out.append((int(ids[i]), len(t), int(gone.sum()), len(edge) // 2, kept, edge[0::2].tolist(), edge[1::2].tolist()))
        cols = list(zip(*out)) or [()] * 7
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept", "starts", "ends")
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    return run


def remove_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES, group: int = GROUP) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): bytes, removed bytes, removed runs with their
    starts and ends, and the bytes that are left."""
    spark = docs.sparkSession
    deal = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    name = f"texts_{uuid.uuid4().hex}"
    (base.mapInArrow(_blocks(block_bytes), BLOCK_SCHEMA).write.bucketBy(deal, "block").option("path", scratch_path(spark, "texts"))
     .option("compression", "uncompressed").saveAsTable(name))
    blocks = spark.table(name)

    hashes = blocks.mapInArrow(_anchors(deal), "part int, block string, h binary, docs binary")
    answer = materialise(hashes.repartition(deal, "part").mapInArrow(_repeated(group), "block string, h binary, hot binary"), "repeat-anchors")
    contexts = blocks.groupBy("block").cogroup(answer.groupBy("block")).applyInArrow(_contexts(FINER * deal), CONTEXT_SCHEMA)
    reach_schema = "block string, ctx array<int>, l array<int>, r array<int>, n int, meta binary, raw binary"
    tree = materialise(contexts.repartition(FINER * deal, "part").mapInArrow(_tree(), reach_schema), "repeat-tree")
    hot = tree.filter("meta is not null").select("block", "n", "meta", "raw")
    windows = materialise(hot.mapInArrow(_windows(), "w binary, doc long, block string, ctx int, a int"), "repeat-windows")
    tree = tree.filter("meta is null").select("block", "ctx", "l", "r")
    least = windows.groupBy("w").agg(F.min("doc").alias("least"))
    wide = (windows.join(least, "w").filter("least < doc").groupBy("block", "ctx").agg(F.max("a").alias("l"), F.max(LENGTH - F.col("a")).alias("r"))
            .select("block", F.array("ctx").alias("ctx"), F.array("l").alias("l"), F.array("r").alias("r")))
    none = F.lit(None)
    arrays = [none.cast("array<int>").alias(c) for c in ("ctx", "l", "r")]
    both = answer.select("block", "h", "hot", *arrays).union(
        tree.union(wide).select("block", none.cast("binary").alias("h"), none.cast("binary").alias("hot"), "ctx", "l", "r"))
    out = blocks.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(_cover(), RESULT_SCHEMA)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def op2_query(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
