"""SentencePiece encoding and decoding through a distinct-chunk table.

The vocabulary has no piece in which a white-space marker follows another
character, so no merge crosses the start of a marked word: a text is its
chunks (a run of markers and the characters up to the next run), and its ids
are the ids of its chunks, one after another.

1. ``_cut`` replaces each text by indices into the dictionary of its block of
   texts (blocks are closed at ``block_chars`` characters, so they are bounded),
   and writes the dictionaries dealt out by a hash of the chunk.
2. ``_segment`` meets all copies of a chunk in one task and runs the library
   once for each distinct chunk.
3. ``_assemble`` joins the ids back to the positions, block by block.

Nulls are empty texts; an empty text has the begin and end ids alone and
decodes to the empty text.  Repeated rows and repeated ids each give a row.
"""

from __future__ import annotations

import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketrec.session import scratch_path

MARK = "▁"
BLOCK_CHARS = 24_000_000
FREQUENT = 16384
_CHUNK = re.compile(" +[^ ]*")
_PROCESSORS: dict = {}


def processor(model: str):
    """The model, loaded once per worker process."""
    if model not in _PROCESSORS:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        crossing = [p for p in map(sp.id_to_piece, range(sp.vocab_size())) if MARK in p.lstrip(MARK)]
        if crossing:
            raise ValueError(f"pieces cross a white-space marker: {crossing[:3]}")
        _PROCESSORS[model] = sp
    return _PROCESSORS[model]


def chunks(text: str) -> list[str]:
    return _CHUNK.findall(" " + text.replace(MARK, " ")) if text else []


def segment(sp, words: list[str]) -> list[list[int]]:
    """Ids of chunks; the library itself puts one marker before what it is given."""
    found = sp.encode([w[1:] for w in words], num_threads=1)
    lone = [sp.piece_to_id(MARK)]
    return [lone if w == " " else ids for w, ids in zip(words, found)]


def squeeze(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers by byte planes, compressed."""
    return zstandard.compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def stretch(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def unpack(lens: np.ndarray, blob: bytes) -> list[str]:
    out, at, raw = [], 0, zstandard.decompress(blob)
    for n in lens.tolist():
        out.append(raw[at:at + n].decode("utf-8"))
        at += n
    return out


CUT_SCHEMA = "block string, part int, doc_id long, a binary, b binary, c binary"


def _deal_out(block: str, docs: list, words: dict[str, int], deal: int):
    """Rows of a block.  part -1: a document with its chunk indices (a); otherwise the
    indices (a, as differences), byte lengths (b) and bytes (c) of dictionary chunks.
    Frequent chunks have the smallest indices, the others follow by part, so that
    both kinds of rows compress well."""
    raw = [w.encode("utf-8") for w in words]
    part = np.fromiter((zlib.crc32(w) % deal for w in raw), np.int64, len(raw))
    count = np.bincount(np.concatenate([ix for _, ix in docs]), minlength=len(raw))
    order = np.argsort(-count, kind="stable")
    rare = sorted(order[FREQUENT:].tolist(), key=lambda i: (part[i], raw[i]))
    order = np.concatenate([order[:FREQUENT], np.array(rare, np.int64)])
    index = np.empty(len(raw), np.int64)
    index[order] = np.arange(len(raw))
    for d, ix in docs:
        yield block, -1, d, squeeze(index[ix]), None, None
    by_part = order[np.argsort(part[order], kind="stable")]
    for ix in np.split(by_part, np.flatnonzero(np.diff(part[by_part])) + 1) if len(raw) else ():
        own = [raw[i] for i in ix.tolist()]
        yield (block, int(part[ix[0]]), None, squeeze(np.diff(index[ix], prepend=0)),
               squeeze(np.fromiter(map(len, own), np.int64, len(own))), zstandard.compress(b"".join(own)))


def _cut(deal: int, block_chars: int):
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())

    def batches_of(docs, words):
        rows = list(_deal_out(uuid.uuid4().hex, docs, words, deal))
        for at in range(0, len(rows), 2000):
            cols = zip(*rows[at:at + 2000])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["block", "part", "doc_id", "a", "b", "c"])

    def run(batches):
        docs, words, held = [], {}, 0
        for rb in batches:
            for d, text in zip(rb.column(0).to_pylist(), rb.column(1)):
                text = text.as_py() or ""
                docs.append((d, np.fromiter((words.setdefault(w, len(words)) for w in chunks(text)), np.int64)))
                held += len(text) + 1
                if held >= block_chars:
                    yield from batches_of(docs, words)
                    docs, words, held = [], {}, 0
        if docs:
            yield from batches_of(docs, words)

    return run


SEGMENT_SCHEMA = "block string, a binary, b binary, ids binary"


def _segment(model: str):
    def run(batches):
        sp, known = processor(model), {}
        for rb in batches:
            out = []
            for lens, blob in zip(rb.column(2).to_pylist(), rb.column(3).to_pylist()):
                words = unpack(stretch(lens), blob)
                new = [w for w in words if w not in known]
                known.update((w, np.array(ids, "<u4")) for w, ids in zip(new, segment(sp, new)))
                ids = [known[w] for w in words]
                out.append((squeeze(np.fromiter(map(len, ids), np.int64, len(ids))), squeeze(np.concatenate(ids))))
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary())],
                names=["block", "a", "b", "ids"])

    return run


CODEC_SCHEMA = "doc_id long, n_tokens long, ids binary, decoded string"


def _assemble(model: str):
    def table_of(pieces: pa.Table):
        """Start and number of ids of every index, and the ids."""
        parts = [(np.cumsum(stretch(a).view(np.int32)), stretch(b), stretch(ids)) for a, b, ids in
                 zip(*(pieces[c].to_pylist() for c in ("a", "b", "ids")))]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")
        at, lens, ids = (np.concatenate(x) for x in zip(*parts))
        starts, size = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        starts[at], size[at] = np.cumsum(lens, dtype=np.int64) - lens, lens
        return starts, size, ids

    def run(docs: pa.Table, pieces: pa.Table) -> pa.Table:
        sp = processor(model)
        starts, size, ids = table_of(pieces)
        begin, end = np.array([sp.bos_id()], "<u4"), np.array([sp.eos_id()], "<u4")
        out = []
        for d, blob in zip(docs["doc_id"].to_pylist(), docs["a"].to_pylist()):
            ix = stretch(blob)
            n = size[ix]
            shift = np.repeat(starts[ix] - (np.cumsum(n) - n), n)
            own = np.concatenate([begin, ids[shift + np.arange(len(shift))], end])
            out.append((d, len(own), own.tobytes(), sp.decode(own.tolist())))
        cols = list(zip(*out)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.string())
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "n_tokens", "ids", "decoded"])

    return run


def encode_decode(docs: DataFrame, model: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ids with begin and end ids as
    little-endian unsigned 32-bit integers, their number, and the decoded text."""
    spark = docs.sparkSession
    deal = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cut = cut.mapInArrow(_cut(deal, block_chars), CUT_SCHEMA)
    # bucketed by block, so that the documents' side of the join below is not shuffled
    name, path = f"pieces_{uuid.uuid4().hex}", scratch_path(spark, "pieces-cut")
    cut.write.bucketBy(deal, "block").option("path", path).option("compression", "uncompressed").saveAsTable(name)
    cut = spark.table(name)
    words = cut.filter("part >= 0").repartition(deal, "part").select("block", "a", "b", "c")
    ids = words.mapInArrow(_segment(model), SEGMENT_SCHEMA)
    indexed = cut.filter("part < 0").select("block", "doc_id", "a")
    return indexed.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(_assemble(model), CODEC_SCHEMA)


def op5_query(docs: DataFrame, model: str) -> DataFrame:
    return encode_decode(docs, model).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
