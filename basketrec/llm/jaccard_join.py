"""N-gram Jaccard self-join over size bands with bitmap signatures.

A text is the set of its distinct word shingles (64-bit hashes).  Equal sets are
one node, so copies are never compared.  Two sets of sizes a <= b with Jaccard
similarity of at least t have a >= t * b and share at least s shingles among
the first ``size - ceil(t * size) + s`` of any common order; the order used puts
shingles that are frequent somewhere last, so that boilerplate shared by many
texts rarely opens a tile, and s is SHARED.

1. Postings of those first shingles; shingles of one node only are dropped.
2. Every node is compared with one hub: of the nodes that share most in its tiles,
   the one it meets most often.  This
   settles groups of near copies in as many comparisons as they have nodes.
3. Nodes of different components that share a tile (shingle and size band) are
   compared; the tiles hold the bitmaps, and the tile join yields only pairs that
   the bit counts leave possible.

A comparison starts with the parity bitmaps: their xor has at most as many bits as
the symmetric difference has shingles, which bounds the overlap from above.  Pairs
that could still reach the threshold get the exact intersection of the sorted
arrays, made from the texts of their nodes only.

Links inside a component found in step 2 are not enumerated: components are the
result, and every pair of different components that could link is compared.

Null texts and texts without words have empty sets and link with nothing.
Rows with null ids take part and get the smallest id of their group, null if it
has none; rows with repeated ids are separate rows of one id; extra columns are not
read; an empty table gives no rows.

Tables of a step are deleted when the last step that reads them is done; the result reads
two small ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketrec.llm.common import discard, materialise
from basketrec.llm.components import connected_components

WIDTH = 5
NUM, DEN = 80, 100
LONGS = 8  # 64 bits each
#: A shingle is frequent if it is in at least so many, and this share, of the documents of a
#: batch, and a quarter of this share of all documents.
HOT_COUNT, HOT_SHARE = 6, 0.001
#: First shingles that linked sets must share (all that must be shared, if that is less).
SHARED = 4
#: Tiles of a node, in a common order, that are known in all of its tiles.
FIRST = 8
NO_ID = -(1 << 63)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_MUL = np.uint64(0x9E3779B97F4A7C15)
_BYTE = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ np.uint64(0xA5A5A5A5A5A5A5A5)


def _mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(32))) * _MUL
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


_LOWER = _lower_table()
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    while len(_POWERS) < n:
        top = _POWERS[-1:] * _MUL
        _POWERS = np.concatenate([_POWERS, _POWERS * top])
    return _POWERS[:n]


def _word_hashes(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of lower-cased bytes: a word's hash is the sum of its
    byte values times powers of its places, scrambled with its length."""
    ink = ~_WHITE[b]
    edge = np.flatnonzero(ink[1:] != ink[:-1]) + 1
    if ink[0]:
        edge = np.concatenate([[0], edge])
    if len(edge) % 2:
        edge = np.concatenate([edge, [len(b)]])
    start, size = edge[0::2], edge[1::2] - edge[0::2]
    at = np.flatnonzero(ink)
    first = np.cumsum(size) - size
    terms = _BYTE[b[at]] * _powers(int(size.max()))[np.arange(len(at)) - np.repeat(first, size)]
    return start, _mix(np.add.reduceat(terms, first) + size.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))


def _chain(w: np.ndarray, k: int) -> np.ndarray:
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = _mix(h * np.uint64(0x2545F4914F6CDD1D) + w[i:len(w) - k + 1 + i])
    return h


def shingle_sets(raws: list[bytes], width: int = WIDTH, at_once: int = 400_000) -> list[np.ndarray]:
    """Per text in UTF-8, A-Z as a-z: the sorted distinct hashes of its word shingles, one of
    all words if there are fewer.  Texts are hashed together, about ``at_once`` bytes at a time."""
    out, group, held = [], [], 0
    for i, raw in enumerate(raws):
        group.append(raw)
        held += len(raw)
        if held >= at_once or i == len(raws) - 1:
            out += _shingle_group(group, width)
            group, held = [], 0
    return out


def _shingle_group(raws, width):
    b = _LOWER[np.frombuffer(b" ".join(raws) + b" ", np.uint8)]
    if _WHITE[b].all():
        return [np.zeros(0, np.uint64)] * len(raws)
    start, w = _word_hashes(b)
    ends = np.cumsum([len(r) + 1 for r in raws])
    cut = np.concatenate([[0], np.searchsorted(start, ends)])
    h = _chain(w, width) if len(w) >= width else np.zeros(0, np.uint64)
    out = []
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        s = h[lo:hi - width + 1].copy() if hi - lo >= width else _chain(w[lo:hi], hi - lo) if hi > lo else w[:0]
        s.sort()
        out.append(s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) > 1 else s)
    return out


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parity bitmap: bit i is the parity of the number of shingles hashed to it."""
    at = (s >> np.uint64(3)) % np.uint64(64 * LONGS)
    odd = np.bincount(at.astype(np.int64), minlength=64 * LONGS) & 1
    return np.packbits(odd.astype(np.uint8)).view(">u8").astype(np.uint64).view(np.int64)


def signature(s: np.ndarray) -> bytes:
    """Parity bitmap of at least twice as many bits as shingles, a power of two."""
    bits = 64 * LONGS
    while bits < 2 * len(s):
        bits *= 2
    odd = np.bincount(((s >> np.uint64(3)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _fold(x: np.ndarray, size: int) -> np.ndarray:
    """A bitmap brought to fewer bits: halves on each other, parities stay right."""
    while len(x) > size:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def set_id(s: np.ndarray) -> int:
    """Equal sets have equal ids; a sum of scrambled shingles, scrambled with their number."""
    total = np.add.reduce(_mix(s ^ np.uint64(0x5851F42D4C957F2D)), keepdims=True)
    return int(_mix(total ^ np.uint64(len(s))).view(np.int64)[0])


def _parts(rb: pa.RecordBatch, column: int, at_once: int = 4_000_000):
    """A batch in parts of rows with about ``at_once`` bytes of text, so that the sets of all of its
    texts are never in memory together."""
    ends = np.cumsum(pc.binary_length(rb.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
    cut = np.flatnonzero(np.diff(ends // at_once)) + 1
    for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), rb.num_rows]):
        yield rb.slice(lo, hi - lo)


BIT = [f"m{i}" for i in range(LONGS)]
SKETCH_SCHEMA = "doc_id long, sid long, n int, prefix array<long>, reach long, " + ", ".join(f"{m} long" for m in BIT) + ", sig binary"


def _hot(width):
    """Shingles that are frequent within a batch, with their documents in it."""
    def run(batches):
        for rb in batches:
            h = np.concatenate([s for part in _parts(rb, 0) for s in shingle_sets(part.column(0).to_pylist(), width)] or [np.zeros(0, np.uint64)])
            h.sort()
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            n = np.diff(np.concatenate([first, [len(h)]]))
            hot = n >= max(HOT_COUNT, HOT_SHARE * rb.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(h[first[hot]].view(np.int64)), pa.array(n[hot])], names=["h", "docs"])

    return run


def _place(shingle: np.uint64, late: bool) -> int:
    """A shingle's place in the common order as a signed number; it loses the last bit."""
    return (int(late) << 63 | int(shingle) >> 1) - (1 << 63)


def _sketch(width, num, den, frequent):
    def run(batches):
        late_ones = np.sort(np.array(frequent.value, np.int64).view(np.uint64))
        for whole in batches:
            seen = set()
            for rb in _parts(whole, 1):
                rows = []
                for s in shingle_sets(rb.column(1).to_pylist(), width):
                    sid = set_id(s) if len(s) else None
                    if sid in seen:  # a copy: its first shingles are there already
                        rows.append((sid, len(s), [], None, bitmap(s), None))
                        continue
                    seen.add(sid)
                    late = late_ones[np.minimum(np.searchsorted(late_ones, s), len(late_ones) - 1)] == s if len(late_ones) else np.zeros(len(s), bool)
                    least = -(-num * len(s) // den)
                    take = len(s) - least + min(SHARED, least)
                    prefix = np.concatenate([s[~late], s[late]])[:take]
                    reach = _place(prefix[-1], take > len(s) - late.sum()) if take else None
                    rows.append((sid, len(s), prefix.view(np.int64), reach, bitmap(s), signature(s)))
                sid, n, prefix, reach, bits, sig = zip(*rows) if rows else ((),) * 6
                bits = np.array(bits, np.int64).reshape(-1, LONGS)
                cols = [rb.column(0), pa.array(sid, pa.int64()), pa.array(n, pa.int32()), pa.array(prefix, pa.list_(pa.int64())), pa.array(reach, pa.int64())]
                cols += [pa.array(bits[:, k]) for k in range(LONGS)] + [pa.array(sig, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "sid", "n", "prefix", "reach", *BIT, "sig"])

    return run


def band(n: Column) -> Column:
    """Sizes of linked sets are in one band or in two next to each other."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(DEN / NUM)) + 1e-9).cast("int")


def _sets(width):
    def run(batches):
        for rb in (part for whole in batches for part in _parts(whole, 0)):
            sets = shingle_sets(rb.column(0).to_pylist(), width)
            yield pa.RecordBatch.from_arrays([pa.array([set_id(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["sid", "s"])

    return run


def _close(num, den):
    """Pairs (a, b) that the long bitmaps leave possible."""
    def run(batches):
        for rb in batches:
            keep = []
            for n, x, y in zip((rb.column(2).to_numpy() + rb.column(3).to_numpy()).tolist(), rb.column(4), rb.column(5)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint8) for v in (x, y))
                size = min(len(x), len(y))
                differ = int(np.bitwise_count(_fold(x, size) ^ _fold(y, size)).sum())
                keep.append(den * (n - differ) >= num * (n + differ))  # of twice the overlap and the union
            rb = rb.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1)], names=["a", "b"])

    return run


def _exact(num, den):
    def run(batches):
        for rb in batches:
            keep = []
            for x, y in zip(rb.column(2), rb.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            rb = rb.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1)], names=["a", "b"])

    return run


def _reachable(num, den) -> Column:
    """The overlap that the bitmaps leave possible reaches the threshold."""
    differ = sum((F.bit_count(F.col(f"x.{m}").bitwiseXOR(F.col(f"y.{m}"))) for m in BIT[1:]), F.bit_count(F.col(f"x.{BIT[0]}").bitwiseXOR(F.col(f"y.{BIT[0]}"))))
    total = F.col("x.n") + F.col("y.n")
    most = (total - differ) / 2
    return den * most >= num * (total - most)


def _open(pairs: DataFrame, nodes: DataFrame, num, den, name: str) -> DataFrame:
    """Pairs (a, b) of nodes whose short bitmaps, then long ones, leave a link possible."""
    short = nodes.drop("sig")
    x, y = short.alias("x"), short.alias("y")
    left = pairs.join(x, F.col("a") == F.col("x.sid")).join(y, F.col("b") == F.col("y.sid")).filter(_reachable(num, den))
    return _open_long(left.select("a", "b", F.col("x.n").alias("an"), F.col("y.n").alias("bn")), nodes, num, den, name)


def _open_long(pairs: DataFrame, nodes: DataFrame, num, den, name: str) -> DataFrame:
    """Of pairs (a, b, an, bn), those whose bitmaps as long as the sets leave a link possible."""
    sig = nodes.select("sid", "sig")
    both = pairs.join(sig.toDF("a", "sa"), "a").join(sig.toDF("b", "sb"), "b").select("a", "b", "an", "bn", "sa", "sb")
    return materialise(both.mapInArrow(_close(num, den), "a long, b long"), name)


def _links(pairs: DataFrame, sets: DataFrame, num, den, name: str) -> DataFrame:
    """Pairs that link, by the exact intersection of their sets."""
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
    return materialise(both.mapInArrow(_exact(num, den), "a long, b long"), name)


def _meetings(tiles: DataFrame, comp: DataFrame, nodes: DataFrame, num, den) -> DataFrame:
    """Pairs (a, b) of nodes, and their sizes, of different components that share a tile: a
    first shingle within a size band, or two bands next to each other.  Tiles hold the short
    bitmaps, so a pair that they rule out is never a row.

    All shingles that two sets share up to the end of the shorter reach of their first
    shingles are counted (k), and beyond it the set that ends there has no more than its
    remaining ones: k and those must make the overlap that a link needs.  So in any common
    order of tiles the first one that they share leaves each node with open tiles for such a
    k from there on; where it does not, the pair is no row.

    Tiles hold the first FIRST tiles of their nodes, too.  If two nodes have one of them in
    common, the first such tile is the first of all that they share, and only there
    the pair is a row; near copies share hundreds of tiles.  Other pairs may be rows of several tiles."""
    own = tiles.join(comp, tiles.sid == comp.node, "left").withColumn("c", F.coalesce("root", "sid")).select("h", "sid", "n", "c")
    placed = own.withColumn("tile", F.explode(F.array(band(F.col("n")), band(F.col("n")) - 1))).withColumn("low", F.col("tile") == band(F.col("n")))
    # shingles whose tiles have the same members are one tile, with their number as its weight:
    # near copies share hundreds of shingles, but few different tiles
    w = Window.partitionBy("h", "tile")
    members = {f"s{i}": F.bit_xor(F.xxhash64(F.lit(i), "sid")) for i in (1, 2)}
    for out, found in ({"lo": F.min("c"), "hi": F.max("c"), "lower": F.max("low")} | members).items():
        placed = placed.withColumn(out, found.over(w))
    key = ["tile", "s1", "s2"]
    placed = placed.filter("lo <> hi and lower").groupBy(*key, "sid", "n", "c", "low").agg(F.count("*").alias("weight"))
    in_order = Window.partitionBy("sid", "tile").orderBy("s1", "s2")
    placed = placed.withColumn("at", F.row_number().over(in_order)).withColumn("before", F.sum("weight").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("weight"))
    placed = materialise(placed, "ngram-mixed")
    most = placed.groupBy("sid", "tile").agg(F.sum("weight").alias("most"), F.array_sort(F.collect_list(F.when(F.col("at") <= FIRST, F.col("s1")))).alias("first"))
    known = most.join(nodes.select("sid", "reach", *BIT), "sid")
    left = materialise(placed.join(known, ["sid", "tile"]), "ngram-open")
    discard(placed)
    rest = [*key, "sid", "n", "c", "before", "reach", "most", "first", *BIT]
    x, y = left.select(*rest).alias("x"), left.filter("low").select(*rest).alias("y")
    # x is the larger set (ties by id): of the same band, or of the band above
    larger = F.expr(f"x.tile = y.tile and x.s1 = y.s1 and x.s2 = y.s2 and x.c <> y.c and {den} * y.n >= {num} * x.n and (x.n > y.n or (x.n = y.n and x.sid > y.sid))")
    needed = f"({num} * (x.n + y.n) + {num + den - 1}) div {num + den}"
    beyond = lambda t: f"(({num} * {t}.n + {den - 1}) div {den} - least({SHARED}, ({num} * {t}.n + {den - 1}) div {den}))"
    # where the places are equal, which lost a bit, either set may end first
    remaining = f"case when x.reach < y.reach then {beyond('x')} when y.reach < x.reach then {beyond('y')} else greatest({beyond('x')}, {beyond('y')}) end"
    enough = F.expr(f"least(x.most - x.before, y.most - y.before) >= {needed} - {remaining}")
    here = F.expr("coalesce(array_min(array_intersect(x.first, y.first)), x.s1) = x.s1")
    return x.join(y, larger & _reachable(num, den) & enough & here).select(
        F.col("x.sid").alias("a"), F.col("y.sid").alias("b"), F.col("x.n").alias("an"), F.col("y.n").alias("bn"))


def _across(tiles: DataFrame, comp: DataFrame, nodes: DataFrame, num, den) -> DataFrame:
    """The pairs of ``_meetings``, each once."""
    return _meetings(tiles, comp, nodes, num, den).distinct()


def ngram_join(docs: DataFrame, width: int = WIDTH, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id reachable by links of
    Jaccard similarity num/den or more, of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    # no more than mean set size * 4 / HOT_SHARE shingles are in so large a share of the
    # documents, whatever their number: that bounds what is sent to all tasks
    hot = materialise(base.select("raw").mapInArrow(_hot(width), "h long, docs long"), "ngram-hot")
    often = max(HOT_COUNT, HOT_SHARE / 4 * base.count())
    frequent = spark.sparkContext.broadcast(
        [r["h"] for r in hot.groupBy("h").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= often).select("h").collect()])
    discard(hot)
    sketch = materialise(base.mapInArrow(_sketch(width, num, den, frequent), SKETCH_SCHEMA), "ngram-sketch")
    filled = sketch.filter("sid is not null")
    nodes = materialise(filled.groupBy("sid").agg(F.max("n").alias("n"), F.max("reach").alias("reach"), *[F.max(m).alias(m) for m in BIT],
                                                F.max("sig").alias("sig")), "ngram-nodes")

    rows = materialise(sketch.select("doc_id", "sid", "n"), "ngram-rows")
    postings = filled.select(F.explode("prefix").alias("h"), "sid", "n")
    in_tile = Window.partitionBy("h")
    tiles = postings.withColumn("lo", F.min("sid").over(in_tile)).withColumn("hi", F.max("sid").over(in_tile))
    tiles = tiles.withColumn("crowd", F.count("*").over(in_tile)).filter("lo <> hi").dropDuplicates(["h", "sid"])
    tiles = materialise(tiles.select("h", "sid", "n", "crowd"), "ngram-tiles")
    discard(sketch)
    # the original of a group of near copies shares more than each copy does: it makes the best hub
    popular = tiles.groupBy("sid").agg((F.sum("crowd") / F.max("n")).alias("pop"))
    hubs = tiles.join(popular, "sid").groupBy("h").agg(F.max(F.struct("pop", "n", "sid")).alias("hub"))
    stars = (tiles.join(hubs, "h").select("sid", "n", F.col("hub.sid").alias("hub"), F.col("hub.n").alias("hub_n"))
             .filter(f"sid <> hub and {den} * least(hub_n, n) >= {num} * greatest(hub_n, n)").groupBy("sid", "hub").agg(F.count("*").alias("k"))
             .groupBy("sid").agg(F.max_by("hub", F.struct("k", "hub")).alias("a")).select("a", F.col("sid").alias("b")))
    stars = _open(stars, nodes, num, den, "ngram-stars")

    def sets_of(pairs: DataFrame, name: str) -> DataFrame:
        """Sets of the nodes of ``pairs``, made from one text of each."""
        ends = [pairs.select(F.col(c).alias("sid")) for c in ("a", "b")]
        source = (rows.filter("sid is not null").select("sid", F.coalesce("doc_id", F.lit(NO_ID)).alias("key")).join(ends[0].union(ends[1]).distinct(), "sid", "left_semi")
                  .groupBy("sid").agg(F.min("key").alias("key")))
        source = materialise(source.select("key").distinct(), f"{name}-source")
        texts = base.withColumn("key", F.coalesce("doc_id", F.lit(NO_ID))).join(source, "key", "left_semi").select("raw")
        sets = materialise(texts.mapInArrow(_sets(width), "sid long, s binary").dropDuplicates(["sid"]), f"{name}-sets")
        discard(source)
        return sets

    def components(links: DataFrame, name: str) -> DataFrame:
        found = connected_components(links)
        comp = materialise(found, name)
        discard(found)
        return comp

    sets = sets_of(stars, "ngram-star")
    links = _links(stars, sets, num, den, "ngram-star-links")
    discard(stars, sets)
    # only verified links make components, so that pairs across them are sought once
    comp = components(links, "ngram-comp")
    across = _across(tiles, comp, nodes, num, den)
    rest = _open_long(across, nodes, num, den, "ngram-rest")
    discard(across, tiles, nodes, comp)
    sets = sets_of(rest, "ngram-rest")
    # one pair of each node first; of the others only those still across components
    one = materialise(rest.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "ngram-one")
    links = links.union(_links(one, sets, num, den, "ngram-one-links"))
    comp = components(links, "ngram-comp")
    at = lambda c: comp.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    rest = rest.join(one, ["a", "b"], "left_anti").join(at("a"), "a", "left").join(at("b"), "b", "left")
    rest = rest.filter("coalesce(a_root, a) <> coalesce(b_root, b)").select("a", "b")
    links = links.union(_links(rest, sets, num, den, "ngram-rest-links"))
    discard(rest, sets)
    comp = components(links, "ngram-all")
    discard(links)

    own = (rows.select("doc_id", "n", "sid").join(comp, rows.sid == comp.node, "left")
           .select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("root", "sid").alias("group")))
    least = own.filter("group is not null").groupBy("group").agg(F.min("doc_id").alias("least"))
    return own.join(least, "group", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
