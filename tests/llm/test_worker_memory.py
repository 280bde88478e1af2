import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

import corpus_pipeline
from basketrec.llm import jaccard_join, sentencepiece_codec

ROWS = 3000


def _batch():
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 100_000, 600)) for _ in range(ROWS)]
    texts[7] = texts[2900]
    return pa.RecordBatch.from_arrays([pa.array(range(ROWS), pa.int64()), pa.array(texts)], names=["doc_id", "text"])


def _peak(run, batch):
    """Largest MB of Python and numpy that a step takes for a batch, and its result."""
    tracemalloc.start()
    try:
        out = [x for x in run(iter([batch]))]
        return tracemalloc.get_traced_memory()[1] / 1e6, out
    finally:
        tracemalloc.stop()


def test_sketches_hold_sets_of_a_part_of_a_batch():
    rb = _batch()
    raw = pa.RecordBatch.from_arrays([rb.column(0), rb.column(1).cast(pa.binary())], names=["doc_id", "raw"])
    run = jaccard_join._sketch(5, 80, 100, SimpleNamespace(value=[]))
    peak, out = _peak(run, raw)
    whole = list(run(iter([raw.slice(0, 1)])))[0]
    got = pa.Table.from_batches(out)
    assert got["doc_id"].to_pylist() == list(range(ROWS)) and got.slice(0, 1).to_pylist() == whole.to_pylist()
    assert got["sid"][7] == got["sid"][2900] and got["prefix"][2900].as_py() == []  # a copy in another part of its batch
    assert peak < 33


def test_blocks_of_the_pipeline_are_small():
    """Texts of 24 MB are cut into blocks of 4 MB at most by a text."""
    rb = _batch()
    rb = pa.RecordBatch.from_arrays([pa.concat_arrays([c] * 6) for c in rb.columns], names=["doc_id", "text"])
    rows = pa.Table.from_batches(sentencepiece_codec._cut(4, corpus_pipeline.BLOCK_CHARS)(iter([rb])))
    docs = rows.filter(pc.equal(rows["part"], -1))
    assert docs["doc_id"].to_pylist() == rb.column(0).to_pylist()
    size, text_size = {}, pc.utf8_length(rb.column(1)).to_pylist()
    for block, n in zip(docs["block"].to_pylist(), text_size):
        size[block] = size.get(block, 0) + n + 1
    assert max(size.values()) < 4_000_000 + max(text_size) + 2
