"""The elements of JSON arrays, whatever the size of the file.

A file is read in splits, as text cut at commas. Whether a split begins inside a string, at which depth, and
in which element, depends on everything before it; but a split changes that state in a way that can be
worked out without knowing it, for both cases of the string. So one pass sums up every split (quotes, brackets,
commas by depth), the sums are added up over the splits of a file, and a second pass cuts out the elements.
An element that lies within a split is complete at once; only pieces of elements that cross the border of a split
are shuffled, and put together by element. No task holds more than a batch of text and one element.

Neither a comma nor the border of a split can fall into an escape, as the comma would have to be the escaped
character, which JSON does not know.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_QUOTE, _COMMA, _OPEN, _CLOSE = ord('"'), ord(","), b"[{", b"]}"
_BLANK = b" \t\r\n,"
_BEGIN, _SEPARATOR, _END = range(3)
_ESCAPE = re.compile(rb"\\.", re.DOTALL)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes, bool]]:
    """(columns besides the text, text, first of its split) for every stretch of a split."""
    last = None
    for batch in batches:
        rest = [c for c in batch.schema.names if c != "value"]
        files, blocks = batch["file"].to_pylist(), batch["block"].to_numpy()
        changes = [i for i in range(1, len(files)) if files[i] != files[i - 1] or blocks[i] != blocks[i - 1]]
        for start, stop in zip([0, *changes], [*changes, len(files)]):
            if start == stop:
                continue
            key = tuple(batch[c][start].as_py() for c in rest)
            pieces = batch["value"].slice(start, stop - start).cast(pa.binary()).to_pylist()
            yield key, b",".join(pieces) + b",", key[:2] != last
            last = key[:2]


class _Marks:
    """Where the structure of a stretch of JSON lies."""

    def __init__(self, data: bytes, inside: int, depth: int):
        plain = _ESCAPE.sub(b"  ", data) if b"\\" in data else data
        raw = np.frombuffer(plain, dtype=np.uint8)
        quotes = raw == _QUOTE
        within = (np.cumsum(quotes) + inside) % 2 == 1
        free = ~within & ~quotes
        opened = free & ((raw == _OPEN[0]) | (raw == _OPEN[1]))
        closed = free & ((raw == _CLOSE[0]) | (raw == _CLOSE[1]))
        depths = depth + np.cumsum(opened.astype(np.int64) - closed)
        self.commas, self.depths = np.flatnonzero(free & (raw == _COMMA)), depths
        self.opened, self.closed = opened, closed
        self.inside = int(within[-1]) if len(raw) else inside
        self.depth = int(depths[-1]) if len(raw) else depth


_SUMMARY = (
    "file string, block bigint, inside int, quotes int, change bigint, depths array<int>, commas array<bigint>, "
    "opening string"
)
_CUT = "file string, index bigint, block bigint, whole boolean, array boolean, body string"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every split, begun outside (0) and inside (1) of a string: whether the quotes are odd, how the
    depth changes, how many commas stand at which depth, counted from its beginning, and its first sign."""
    held: dict[tuple, list] = {}
    for key, data, _ in _runs(batches):
        states, opening = held.setdefault(key[:2], ([[0, 0, {}], [1, 0, {}]], []))
        if not opening and data.strip(_BLANK):
            opening.append(data.lstrip(_BLANK)[:1].decode(errors="replace"))
        for state in states:
            marks = _Marks(data, state[0], state[1])
            at, n = np.unique(marks.depths[marks.commas], return_counts=True)
            for depth, count in zip(at.tolist(), n.tolist()):
                state[2][depth] = state[2].get(depth, 0) + count
            state[0], state[1] = marks.inside, marks.depth
    rows = [
        (file, block, begun, inside ^ begun, depth, list(commas), list(commas.values()), "".join(opening))
        for (file, block), (states, opening) in held.items()
        for begun, (inside, depth, commas) in enumerate(states)
    ]
    kinds = (
        pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()),
        pa.string(),
    )
    columns = [list(c) for c in zip(*rows)] or [[]] * len(kinds)
    names = ["file", "block", "inside", "quotes", "change", "depths", "commas", "opening"]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _starts(pieces: DataFrame) -> DataFrame:
    """(file, block, inside, depth, element, array) where each split of a file of several splits begins."""
    summed = pieces.mapInArrow(_summaries, _SUMMARY)
    whole = Window.partitionBy("file")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # the quotes of a split do not depend on how it begins
    state = summed.where("inside = 0").select(
        "file",
        "block",
        (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int").alias("inside"),
        (F.max("block").over(whole) > 0).alias("several"),
        (F.min(F.struct("block", "opening")).over(whole)["opening"] == "[").alias("array"),
    )
    true = summed.join(state.where("several").drop("several"), ["file", "block", "inside"])
    deep = true.withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
    own = F.aggregate(
        F.zip_with("depths", "commas", lambda d, n: F.when(F.col("depth") + d == 1, n).otherwise(F.lit(0).cast("bigint"))),
        F.lit(0).cast("bigint"),
        lambda a, b: a + b,
    )
    counted = deep.withColumn("own", own).withColumn("element", F.coalesce(F.sum("own").over(before), F.lit(0)))
    return counted.select("file", "block", "inside", "depth", "element", "array")


class _Split:
    """The elements of one split, cut out as its text comes."""

    def __init__(self, file: str, block: int, inside: int | None, depth: int | None, element: int | None, array: bool | None):
        self.file, self.block = file, block
        self.alone = inside is None  # the file has no other split
        self.inside, self.depth, self.element = inside or 0, depth or 0, element or 0
        self.array = array
        self.begun = False  # whether the current element began in this split
        self.text: list[bytes] = []

    def row(self, whole: bool, body: bytes) -> tuple:
        return self.file, self.element, self.block, whole, self.array, body

    def add(self, data: bytes) -> Iterator[tuple]:
        if self.array is None and data.strip(_BLANK):
            self.array = data.lstrip(_BLANK)[:1] == b"["
        if not self.array:
            self.text.append(data)
            return
        marks = _Marks(data, self.inside, self.depth)
        cuts = [(i, _SEPARATOR) for i in marks.commas[marks.depths[marks.commas] == 1].tolist()]
        cuts += [(i, _BEGIN) for i in np.flatnonzero(marks.opened & (marks.depths == 1)).tolist()]
        cuts += [(i, _END) for i in np.flatnonzero(marks.closed & (marks.depths == 0)).tolist()]
        at = 0
        for place, kind in sorted(cuts):
            if kind != _BEGIN:
                self.text.append(data[at:place])
                yield self.row(self.begun, b"".join(self.text))
                self.element += kind == _SEPARATOR
            self.text, self.begun, at = [], True, place + 1
        self.text.append(data[at:])
        self.inside, self.depth = marks.inside, marks.depth

    def rest(self) -> Iterator[tuple]:
        """What goes on in the next split; of a value that is no array, everything."""
        if self.array and self.depth > 0:
            yield self.row(False, b"".join(self.text))
        elif not self.array and self.array is not None:
            yield self.row(self.alone, b"".join(self.text))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
    names = ["file", "index", "block", "whole", "array", "body"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays([*columns[:5], columns[5].cast(pa.string())], names)

    split, rows = None, []
    for key, data, first in _runs(batches):
        if first:
            if split is not None:
                rows += split.rest()
            split = _Split(*key)
        rows += split.add(data)
        if rows:
            yield batch_of(rows)
            rows = []
    if split is not None:
        rows += split.rest()
    if rows:
        yield batch_of(rows)


def array_elements(pieces: DataFrame) -> DataFrame:
    """(file, index, body) from (file, block, value), the text of files cut at commas, straight from the
    scan: a row for each element of an array, one for any other value. ``body`` is the text as it stands
    in the file, without blanks around it. Files of blanks alone give nothing."""
    # a row for each split of 128 MB; files of one split are not in it
    told = pieces.join(F.broadcast(_starts(pieces)), ["file", "block"], "left").select(
        "file", "block", "inside", "depth", "element", "array", "value"
    )
    whole = told.mapInArrow(_cut, _CUT).where("whole")
    # only files of several splits have pieces of elements
    crossing = told.where("inside IS NOT NULL").mapInArrow(_cut, _CUT).where("NOT whole")
    joined = crossing.groupBy("file", "index", "array").agg(
        F.array_sort(F.collect_list(F.struct("block", "body"))).alias("parts")  # of one element
    )
    texts = whole.select("file", "index", "array", "body").unionByName(
        joined.select("file", "index", "array", F.array_join(F.col("parts.body"), "").alias("body"))
    )
    # after the last piece of a value that is no array stands the comma that was added
    body = F.when(F.col("array"), F.col("body")).otherwise(F.regexp_replace("body", r",\z", ""))
    trimmed = F.regexp_replace(body, r"^[\x20\t\r\n]+|[\x20\t\r\n]+\z", "")
    found = texts.select("file", "index", trimmed.alias("body"))
    # an empty array has one place and nothing in it
    return found.where((F.col("index") > 0) | (F.col("body") != ""))
