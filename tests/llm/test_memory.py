"""What a Python worker of the pipeline's stages takes, and what it keeps between tasks."""

from __future__ import annotations

import random
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import decontaminate, pieces, sentencepiece_codec, shared

NUMBERS = Path("/proc/self/smaps_rollup")


def anonymous_mb() -> float:
    return int(re.search(r"\nPss_Anon:\s+(\d+)", NUMBERS.read_text())[1]) / 1024


@pytest.mark.skipif(not NUMBERS.exists() or shared._trim()(0) not in (0, 1), reason="memory can't be read here")
def test_memory_of_a_task_goes_back():
    kept: list[bytearray] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = []
        for _ in range(60):  # small blocks with one above them that stays: nothing goes back by itself
            held += [bytearray(8_000) for _ in range(250)]
            kept.append(bytearray(8_000))
        return batch

    class Frame:
        def mapInArrow(self, run, schema):
            return run

    run = shared.map_batches(Frame(), work, "text string")
    before = anonymous_mb()
    assert sum(b.num_rows for b in run(iter([pa.record_batch([pa.array(["x"])], names=["text"])]))) == 1
    assert len(kept) == 60 and anonymous_mb() - before < 40  # of 120


def test_marks_take_a_bit_and_spare_no_key():
    rng = np.random.RandomState(3)
    keys, others = (rng.randint(0, 1 << 63, 5_000).astype(np.uint64) * np.uint64(2) for _ in range(2))
    seen = decontaminate.marks(keys)
    assert seen.nbytes == 1 << 17
    assert decontaminate.marked(seen, keys).all()
    plain = np.isin(others >> np.uint64(44), keys >> np.uint64(44))
    assert (decontaminate.marked(seen, others).astype(bool) == plain).all()
    items = [(n, "".join(random.Random(n).choices("abcdefgh ", k=200))) for n in range(3)]
    index = decontaminate.Index(items)
    assert index.classes and all(t[3].nbytes == 1 << 17 for _, _, tables in index.classes for t in tables)
    found = index.finds(*decontaminate.folded(pa.array(["q" * 50 + items[1][1] + "q" * 50, "q" * 300])))
    assert found == {(0, 1): 0}


def test_codes_are_packed_without_a_wide_copy():
    encoder = sentencepiece_codec.Encoder(pieces.load(pieces.default_model()))
    codes = np.random.RandomState(4).randint(0, 60_000, 100_000 + encoder.width).astype(np.uint16)
    view = np.lib.stride_tricks.sliding_window_view(codes, encoder.width)[:100_000]
    tracemalloc.start()
    packed = encoder._pack(view)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < sum(k.nbytes for k in packed) + 2_000_000
    for k, column in enumerate(packed):
        for row in (0, 1, 99_999):
            wanted = int.from_bytes(b"".join(int(c).to_bytes(2, "big") for c in view[row, 4 * k : 4 * k + 4]), "big")
            assert int(column[row]) == wanted
