"""Fill-in-middle: a text is cut into prefix, middle and suffix, and its parts change places so that
a model learns to write the middle from both sides.

The rearrangement happens in one bytearray for each text. The cuts are found by scanning the words,
the sentinels are inserted at the cuts (``<P>`` prefix ``<M>`` middle ``<S>`` suffix), and two
neighbouring blocks are exchanged by a rotation of three reversals: middle and suffix for the form
``psm``, everything before the suffix and the suffix for ``spm``. Reversing works on mirrored
pieces of at most ``PIECE`` bytes, so next to the text itself only constant memory is used. ``restore``
finds the sentinels, does the inverse rotation and takes the sentinels out again; it sees nothing but
the output and its form. A text that already holds a sentinel stays plain, so the sentinels of a
rearranged text are the only ones in it.

The numbers that decide about a text come from a SHA-256 of the seed and the id alone: a task that is
repeated gives the same rows.

Defined results: a null text counts as empty, an empty text is plain with n = 0. A null id is hashed
as an empty string. Rows that repeat an id each give a row, with the same draws. Only ``id`` and
``text`` are read: other columns, whatever their names, are not carried. An empty table gives no
rows. A text is held whole, twice at most, within one task; batches hold ``shared.map_batches``'s
8 MB of text or a single longer text.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import map_batches, text_or_empty

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Longest piece that a reversal moves at once, in bytes.
PIECE = 1 << 16

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BLANKS = b" \t\n\r\x0b\x0c"


@dataclass(frozen=True)
class Draws:
    """How texts are drawn: ``rate`` percent are rearranged, ``spm`` percent of these suffix first."""

    seed: str = "42"
    rate: int = 50
    spm: int = 80

    def numbers(self, key: str) -> list[int]:
        digest = hashlib.sha256(f"{self.seed}:{key}".encode()).hexdigest()
        return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def reverse(buffer: np.ndarray, start: int, end: int) -> None:
    """Turn the bytes of a range round, by exchanging mirrored pieces."""
    while end - start > 1:
        step = min(PIECE, (end - start) // 2)
        held = buffer[start : start + step].copy()
        buffer[start : start + step] = buffer[end - step : end][::-1]
        buffer[end - step : end] = held[::-1]
        start, end = start + step, end - step


def rotate(data: bytearray, start: int, middle: int, end: int) -> None:
    """Exchange the neighbouring blocks [start, middle) and [middle, end) in place."""
    buffer = np.frombuffer(data, dtype=np.uint8)
    reverse(buffer, start, middle)
    reverse(buffer, middle, end)
    reverse(buffer, start, end)


def token_ends(data: bytes) -> list[int]:
    """End of every token in bytes: a word with the blanks before it, or the blanks at the end."""
    ends = [found.end() for found in _WORD.finditer(data)]
    if data and data[-1:] in _BLANKS:
        ends.append(len(data))
    return ends


def code_points(data: bytes) -> int:
    """Bytes that do not continue a character."""
    raw = np.frombuffer(data, dtype=np.uint8)
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def rearrange(data: bytes, key: str, draws: Draws) -> tuple[bytes, str, int, int | None, int | None]:
    """(output, form, number of tokens, prefix and middle in code points) of one text."""
    ends = token_ends(data)
    n = len(ends)
    h1, h2, h3, h4 = draws.numbers(key)
    if not data or h3 % 100 >= draws.rate or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)):
        return data, "plain", n, None, None
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    cut = ends[first - 1] if first else 0
    stop = ends[second - 1] if second else 0
    sizes = code_points(data[:cut]), code_points(data[cut:stop])
    out = bytearray(data)
    for place, mark in ((stop, SUFFIX), (cut, MIDDLE), (0, PREFIX)):
        out[place:place] = mark
    middle_at = len(PREFIX) + cut
    suffix_at = stop + len(PREFIX) + len(MIDDLE)
    form = "spm" if h4 % 100 < draws.spm else "psm"
    rotate(out, 0 if form == "spm" else middle_at, suffix_at, len(out))
    return bytes(out), form, n, *sizes


def put_back(output: bytes, form: str) -> bytes:
    """The text that ``rearrange`` was given."""
    if form == "plain":
        return output
    out = bytearray(output)
    middle_at = out.index(MIDDLE)
    if form == "spm":
        # the block that now comes first is the suffix; it ends where the prefix begins
        suffix = out.index(PREFIX)
        rotate(out, 0, suffix, len(out))
        middle_at -= suffix
        suffix_at = len(out) - suffix
    else:
        start = out.index(SUFFIX)
        suffix_at = start + len(out) - middle_at
        rotate(out, start, middle_at, len(out))
        middle_at = start
    for place, mark in ((suffix_at, SUFFIX), (middle_at, MIDDLE), (0, PREFIX)):
        del out[place : place + len(mark)]
    return bytes(out)


def _texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


_ROW = "doc_id {id}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def fill_in_middle(docs: DataFrame, text: str = "text", key: str = "doc_id", draws: Draws = Draws()) -> DataFrame:
    """One row per document: doc_id, n (tokens), form, prefix_chars, middle_chars, output."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        text_or_empty(text).alias("text"),
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = batch.column("key").to_pylist()
        found = [rearrange(data, k, draws) for data, k in zip(_texts(batch.column("text")), keys)]
        output, form, n, before, middle = (list(part) for part in zip(*found))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n, pa.int64()),
                pa.array(form, pa.string()),
                pa.array(before, pa.int64()),
                pa.array(middle, pa.int64()),
                pa.array(output, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )

    return map_batches(rows, work, _ROW.format(id=kind))


def restore(rearranged: DataFrame) -> DataFrame:
    """``rearranged`` (any frame with output and form) with the column ``restored``, the text as it
    was. A column of that name is replaced; all others are kept."""
    kept = [c for c in rearranged.columns if c != "restored"]
    rows = rearranged.select(*kept)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        forms = batch.column("form").to_pylist()
        back = [put_back(data, form) for data, form in zip(_texts(batch.column("output")), forms)]
        texts = pa.array(back, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "restored"])

    schema = rows.withColumn("restored", F.lit("")).schema
    return map_batches(rows, work, schema, text="output")


def op12(docs: DataFrame) -> DataFrame:
    digests = [F.sha2(F.col(c), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return restore(fill_in_middle(docs)).select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), k AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM t
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM k
), p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:n], '') AS suffix
  FROM c
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
