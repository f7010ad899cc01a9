"""Token counts by a finite-state transducer over characters.

The encoding of every prefix of a segment ends in one piece, found from earlier prefixes: those
where a piece that ends here began. What matters of the past is therefore finite: the starts whose
text so far is the beginning of some piece, each with its place in the vocabulary's tree, the last
piece before it, and its token count relative to the current one. That set is the state. A
transition reads a character and is annotated with the number of tokens by which the count of the
prefix changes (it may fall). States and transitions are compiled when first met and kept up to a
bound; beyond it the tables start anew.

A text is cut into chunks anywhere. A blank after another character always leads to the same
state, whatever came before, so the state map of a chunk is: a head that has to be read from the
incoming state, a count that does not depend on it, and the outgoing state, named by the text since
the last such blank. Chunk maps compose associatively, and the chunks of a long text are counted by
different tasks and composed in order.

Defined results: a null text counts as empty, an empty text has no tokens; repeated rows are
counted each; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pieces import ALONE, BLANK, SEGMENT, Pieces, default_model, load
from tidemark.llm.shared import map_batches, text_or_empty

LIMIT = 4096
CHUNK_CHARS = 32_768
MAX_STATES = 250_000
MAX_WORDS = 500_000


class Transducer:
    """Deterministic, compiled on demand: ``steps[state][character] = (state, tokens)``."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        for text, number in pieces.ids.items():
            node = 0
            for c in text:
                node = self.children[node].setdefault(c, len(self.children))
                if node == len(self.ends):
                    self.children.append({})
                    self.ends.append(-1)
            self.ends[node] = number
        self._restart()

    def _restart(self) -> None:
        start = frozenset([(0, ALONE, 0)])
        self.numbers = {start: 0}
        self.states = [start]
        self.steps: list[dict[str, tuple[int, int]]] = [{}]
        self.words: dict[str, int] = {}

    def _compile(self, state: int, c: str) -> tuple[int, int]:
        open_starts, found = [], None
        children, ends, fits = self.children, self.ends, self.pieces.fits
        for node, last, count in self.states[state]:
            after = children[node].get(c)
            if after is not None:
                piece = ends[after]
                if found is None and piece >= 0 and fits(last, piece):
                    found = (piece, count + 1)
                if children[after]:
                    open_starts.append((after, last, count))
        if found is None:  # a character outside the vocabulary: one token for each of its bytes
            piece, tokens = ALONE, len(c.encode())
            open_starts = []
        else:
            piece, tokens = found
        after = frozenset([(0, piece, 0), *((n, last, k - tokens) for n, last, k in open_starts)])
        number = self.numbers.get(after)
        if number is None:
            number = self.numbers[after] = len(self.states)
            self.states.append(after)
            self.steps.append({})
        self.steps[state][c] = (number, tokens)
        return number, tokens

    def count(self, segment: str) -> int:
        """Tokens of one segment, read from the start state."""
        steps, state, total = self.steps, 0, 0
        for c in segment:
            step = steps[state].get(c)
            if step is None:
                step = self._compile(state, c)
            state, tokens = step
            total += tokens
        return total

    def count_all(self, found: list[str]) -> int:
        words = self.words
        try:
            return sum(map(words.__getitem__, found))
        except KeyError:
            pass
        if len(self.states) > MAX_STATES or len(words) > MAX_WORDS:
            self._restart()
            words = self.words
        total = 0
        for segment in found:
            tokens = words.get(segment)
            if tokens is None:
                tokens = self.count(segment)
                if len(segment) <= 64:
                    words[segment] = tokens
            total += tokens
        return total


#: A chunk's state map: head, whether it has a blank after another character, tokens between the
#: first and the last such blank, and the text from the last one on. Without one all is head.
ChunkMap = tuple[str, bool, int, str]


def chunk_map(machine: Transducer, chunk: str) -> ChunkMap:
    """The map of a chunk of text in which blanks are already written as the vocabulary has them."""
    found = SEGMENT.findall(chunk)
    head = chunk[: len(chunk) - sum(map(len, found))]
    if not head and found:  # whether the first blank follows another character is not known here
        head, found = found[0], found[1:]
    if not found:
        return head, False, 0, ""
    return head, True, machine.count_all(found[:-1]), found[-1]


def compose(machine: Transducer, a: ChunkMap, b: ChunkMap) -> ChunkMap:
    """The map of two neighbouring chunks. Where they meet, the open ends are read together."""
    if not a[1] and not b[1]:
        return cut_again(machine, a[0] + b[0])
    if not a[1]:
        joint = cut_again(machine, a[0] + b[0])
        if not joint[1]:
            return joint[0], True, b[2], b[3]
        return joint[0], True, joint[2] + machine.count_all([joint[3]]) + b[2], b[3]
    joint = SEGMENT.findall(a[3] + b[0])
    if not b[1]:
        return a[0], True, a[2] + machine.count_all(joint[:-1]), joint[-1]
    return a[0], True, a[2] + machine.count_all(joint) + b[2], b[3]


def cut_again(machine: Transducer, text: str) -> ChunkMap:
    return chunk_map(machine, text)


def scan(machine: Transducer, maps: list[ChunkMap]) -> ChunkMap:
    """Compose a row of maps pairwise, as the levels of a parallel prefix scan do."""
    while len(maps) > 1:
        pairs = [compose(machine, a, b) for a, b in zip(maps[::2], maps[1::2])]
        maps = pairs + maps[len(pairs) * 2 :]
    return maps[0]


def total(machine: Transducer, whole: ChunkMap) -> int:
    """Tokens of a whole text: its first segment is read from the start state."""
    head, synced, between, tail = whole
    return machine.count_all(SEGMENT.findall(head)) + between + (machine.count_all([tail]) if synced else 0)


@lru_cache(maxsize=2)
def transducer(model: str) -> Transducer:
    return Transducer(load(model))


def _written(text: str) -> str:
    return BLANK + text.replace(" ", BLANK) if text else ""


def count_tokens(
    docs: DataFrame, model: str | None = None, limit: int = LIMIT, chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs`` (doc_id, text).

    Texts up to ``chunk_chars`` are counted where they are read. The chunks of longer ones are dealt
    out, mapped, and composed per text; only chunk maps meet there, not the text.
    """
    model = model or default_model()
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_or_empty().alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    is_long = F.length("text") > chunk_chars

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = transducer(model)
        counts = [
            machine.count_all(SEGMENT.findall(_written(t))) for t in batch.column(1).to_pylist()
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(counts, pa.int64())],
            names=["doc_id", "n_bytes", "n_tokens"],
        )

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text, n_bytes, row in zip(*(c.to_pylist() for c in batch.columns)):
                text = _written(text)
                parts = [text[i : i + chunk_chars] for i in range(0, len(text), chunk_chars)]
                n = len(parts)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": [doc_id] * n, "row": [row] * n, "n_bytes": [n_bytes] * n,
                     "part": list(range(n)), "text": parts},
                    schema=pa.schema([("doc_id", pa.int64()), ("row", pa.int64()),
                                      ("n_bytes", pa.int64()), ("part", pa.int64()),
                                      ("text", pa.string())]),
                )

    def mapped(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = transducer(model)
        maps = [chunk_map(machine, t) for t in batch.column(4).to_pylist()]
        head, synced, between, tail = zip(*maps)
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(head, pa.string()), pa.array(synced, pa.bool_()),
             pa.array(between, pa.int64()), pa.array(tail, pa.string())],
            names=["doc_id", "row", "n_bytes", "part", "head", "synced", "between", "tail"],
        )

    def composed(pdf: pd.DataFrame) -> pd.DataFrame:
        machine = transducer(model)
        pdf = pdf.sort_values("part")
        maps = list(zip(pdf["head"], pdf["synced"], pdf["between"], pdf["tail"]))
        counted = total(machine, scan(machine, maps))
        return pdf.iloc[:1][["doc_id", "n_bytes"]].assign(n_tokens=np.int64(counted))

    n_bytes = F.octet_length("text").cast("bigint").alias("n_bytes")
    short = map_batches(
        rows.where(~is_long).select("doc_id", "text", n_bytes),
        whole, "doc_id bigint, n_bytes bigint, n_tokens bigint",
    )
    dealt = (
        rows.where(is_long).select("doc_id", "text", n_bytes, "row")
        .mapInArrow(chunks, "doc_id bigint, row bigint, n_bytes bigint, part bigint, text string")
        .repartition("row", "part")
    )
    maps = map_batches(
        dealt, mapped,
        "doc_id bigint, row bigint, n_bytes bigint, part bigint, head string, synced boolean,"
        "between bigint, tail string",
    )
    long = maps.groupBy("row").applyInPandas(composed, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return short.unionByName(long).withColumn("over_limit", F.col("n_tokens") > limit)
