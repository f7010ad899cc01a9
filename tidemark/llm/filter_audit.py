"""How quality filters act together: what each of five filters removes in every order of them.

Two parts. ``flags`` gives every document a mask of the filters it fails; ``audit`` turns masks into
counts for all 120 orders.

Four filters look at one text. The fifth asks whether a text stands in the table under a smaller
doc_id, and is answered by radix tries over full texts (``text_trie``), whose terminals hold the
smallest id:

1. Every task inserts its texts into local tries of at most ``LOCAL_BYTES`` of text. A row whose id is
   larger than the one at its terminal is settled; of the others one row goes on with its text. So a
   text with very many copies leaves each task once.
2. Keys are adaptive prefixes: a text is dealt by its first ``DEPTHS[0]`` characters, by its first
   ``DEPTHS[1]`` where more than a quarter of a range begins with these, and so on, last by the whole text.
   The weight of prefixes is summed over all rows in Spark; only the heavy ones are kept, fewer than
   four for each range.
3. The texts are range-partitioned by that key, inserted into one trie for each range, and the tries
   are read out as flags. Equal texts have equal keys and meet in one trie.

The counts need only how many documents of a part have which mask and which labels: 32 masks for each
part, however many documents there are. Each filter's Shapley sum follows from the masks, too: of the
120 orders, 120/k begin with a given one of k failing filters.

Defined results: a null text counts as empty; a null source is the part ''. A null doc_id is neither
smaller nor larger than another: such a row is never a duplicate and makes no other row one. Rows that
repeat a doc_id and a text are no duplicates of each other and count as rows. Labels that repeat a
doc_id count as good (toxic) where one of them is; labels of null ids are ignored. Extra columns are
not read, whatever their names. Without documents there are no parts and no rows. A text is held
whole in one task; a range holds about ``RANGE_BYTES`` of different texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, text_or_empty
from tidemark.llm.text_trie import Node, TextTrie

FILTERS = "ABCDE"
#: Text in a local trie, and text (plus ROW_BYTES a row) of a range.
LOCAL_BYTES, RANGE_BYTES, ROW_BYTES = 16 << 20, 32 << 20, 512
#: Prefix lengths in characters; beyond the last the whole text is the key.
DEPTHS = (8, 32, 128, 512, 2048, 8192)

_DUPLICATE = 1 << FILTERS.index("E")
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUED = bytes(range(0x80, 0xC0))
_STRIDE = 1 << 20


@dataclass(frozen=True)
class Filters:
    """A: under ``words`` words; B: under ``distinct`` percent of them distinct; C: over ``capitals``
    percent capitals; D: one of ``signs``; E: text of a smaller doc_id."""

    words: int = 200
    distinct: int = 50
    capitals: int = 2
    signs: bytes = b"#$%&*|"


def _pieces(data: bytes) -> Iterator[bytes]:
    """The text in pieces of about a megabyte that end at blanks."""
    start = 0
    while start < len(data):
        stop = start + _STRIDE
        while stop < len(data) and data[stop] not in b" \t\n\r\x0b\x0c":
            stop += 1
        yield data[start:stop]
        start = stop


def own_mask(data: bytes, filters: Filters = Filters()) -> int:
    """Which of the filters A to D a text fails, as bits 0 to 3."""
    n, distinct = 0, set()
    for piece in _pieces(data):
        words = piece.split()
        n += len(words)
        distinct.update(words)
    capitals = len(data) - len(data.translate(None, _UPPER))
    characters = len(data.translate(None, _CONTINUED))
    signs = len(data.translate(None, filters.signs)) != len(data)
    failed = (
        n < filters.words,
        100 * len(distinct) < filters.distinct * n,
        100 * capitals > filters.capitals * characters,
        signs,
    )
    return sum(1 << bit for bit, bad in enumerate(failed) if bad)


_ROW = "doc_id {id}, part string, mask int, n bigint"


def _local(
    batches: Iterator[pa.RecordBatch], filters: Filters, kind: pa.DataType, local_bytes: int
) -> Iterator[pa.RecordBatch]:
    """Masks of a task's rows; the text stays with rows that a smaller id elsewhere may still flag."""
    trie, rows = TextTrie(), []
    known: dict[Node, tuple[bytes, int]] = {}  # text and mask of a terminal, once for all copies

    def settle() -> pa.RecordBatch:
        counted: dict[tuple, list] = {}
        for key, part, terminal in rows:
            text, mask = known[terminal]
            late = key is not None and terminal.least < key
            still_open = key is not None and not late
            at = (key, part, mask | _DUPLICATE if late else mask, terminal if still_open else None)
            entry = counted.setdefault(at, [0, text if still_open else None])
            entry[0] += 1
        found = list(counted.items())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([at[0] for at, _ in found], kind),
                pa.array([at[1] for at, _ in found], pa.string()),
                pa.array([at[2] for at, _ in found], pa.int32()),
                pa.array([entry[0] for _, entry in found], pa.int64()),
                pa.array([entry[1] for _, entry in found], pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "part", "mask", "n", "text"],
        )

    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        keys, parts = (batch.column(c).to_pylist() for c in ("doc_id", "part"))
        for key, part, text in zip(keys, parts, texts):
            terminal = trie.insert(text, key)
            if terminal not in known:
                known[terminal] = text, own_mask(text, filters)
            rows.append((key, part, terminal))
            if trie.held + 64 * len(rows) >= local_bytes:
                yield settle()
                trie, rows = TextTrie(), []
                known.clear()
    if rows:
        yield settle()


def _merged(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One trie of a range: insert everything, then read the flags from the terminals."""
    trie, held = TextTrie(), []
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        keys = batch.column("doc_id")
        ends = [trie.insert(text, key) for text, key in zip(texts, keys.to_pylist())]
        held.append((batch.select(["doc_id", "part", "mask", "n"]), ends))
    for batch, ends in held:
        late = [end.least < key for end, key in zip(ends, batch.column("doc_id").to_pylist())]
        masks = [m | _DUPLICATE if bad else m for m, bad in zip(batch.column("mask").to_pylist(), late)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(kind), batch.column("part"), pa.array(masks, pa.int32()), batch.column("n")],
            ["doc_id", "part", "mask", "n"],
        )


def with_key(rows: DataFrame, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, int]:
    """``rows`` with ``key``, the adaptive prefix of the text, and the number of ranges."""
    weight = F.octet_length("text") + F.lit(ROW_BYTES)
    total = rows.agg(F.sum(weight)).first()[0] or 0
    ranges = max(-(-total // range_bytes), rows.sparkSession.sparkContext.defaultParallelism)
    key: Column = F.left("text", F.lit(DEPTHS[0]))
    keyed, within = rows, rows.select("text")
    for level, depth in enumerate(DEPTHS):
        prefix = F.left("text", F.lit(depth))
        weights = within.groupBy(prefix.alias("prefix")).agg(F.sum(weight).alias("weight"))
        # their weights add up to at most the total, so they are fewer than 4 * ranges
        heavy = [r.prefix for r in weights.where(F.col("weight") > range_bytes // 4).select("prefix").collect()]
        if not heavy:
            break
        frame = rows.sparkSession.createDataFrame([(p, True) for p in heavy], f"prefix string, heavy{level} boolean")
        longer = F.left("text", F.lit(DEPTHS[level + 1])) if level + 1 < len(DEPTHS) else F.col("text")

        def marked(df: DataFrame, how: str) -> DataFrame:
            return df.withColumn("prefix", prefix).join(F.broadcast(frame), "prefix", how).drop("prefix")

        keyed = marked(keyed, "left")
        within = marked(within, "left_semi")
        key = F.when(F.col(f"heavy{level}"), longer).otherwise(key)
    return keyed.select(*rows.columns, key.alias("key")), ranges


def flags(
    docs: DataFrame, filters: Filters = Filters(), range_bytes: int = RANGE_BYTES, local_bytes: int = LOCAL_BYTES
) -> DataFrame:
    """(doc_id, part, mask, n): the filters that documents fail, bit 0 for A to bit 4 for E; ``n`` rows
    each. Other than by ``n``, rows are not merged."""
    row = _ROW.format(id=docs.schema["doc_id"].dataType.simpleString())
    given = docs.select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text_or_empty().alias("text")
    )

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            kind = first.schema.field("doc_id").type

            def every() -> Iterator[pa.RecordBatch]:
                yield first
                yield from batches

            yield from _local(every(), filters, kind, local_bytes)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            kind = first.schema.field("doc_id").type

            def every() -> Iterator[pa.RecordBatch]:
                yield first
                yield from batches

            yield from _merged(every(), kind)

    looked_at = cut(given.mapInArrow(local, row + ", text string"), "masks")
    still_open, ranges = with_key(looked_at.where("text is not null"), range_bytes)
    dealt = still_open.repartitionByRange(ranges, "key").drop("key")
    settled = looked_at.where("text is null").drop("text")
    return settled.unionByName(dealt.mapInArrow(merged, row))


def audit(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """The counts of every order and step for each part, zeros included."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    # summed first: rows without an id, which all meet in one task of the join, are few then
    rows = flagged.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")).join(known, "doc_id", "left")
    masks = range(1 << len(FILTERS))

    def by_mask(condition: Column) -> Column:
        each = [F.sum(F.when((F.col("mask") == m) & condition, F.col("n")).otherwise(0)) for m in masks]
        return F.array(*each)

    counts = rows.groupBy("part").agg(
        by_mask(F.lit(True)).alias("every"),
        by_mask(F.coalesce("good", F.lit(False))).alias("good"),
        by_mask(F.coalesce("toxic", F.lit(False))).alias("toxic"),
    )
    steps = [
        (
            "".join(order),
            step,
            sum(1 << FILTERS.index(f) for f in order[: step - 1]),
            1 << FILTERS.index(order[step - 1]),
        )
        for order in permutations(FILTERS)
        for step in range(1, len(FILTERS) + 1)
    ]
    columns = ("filter_order", "step", "earlier", "own")
    lists = [F.lit([s[i] for s in steps]).alias(c) for i, c in enumerate(columns)]
    placed = counts.withColumn("at", F.explode(F.arrays_zip(*lists)))
    placed = placed.select("part", "every", "good", "toxic", *[F.col(f"at.{c}").alias(c) for c in columns])
    earlier, own = F.col("earlier"), F.col("own")
    numbers = F.lit(list(masks))

    def total(of: str, use) -> Column:
        picked = F.zip_with(numbers, F.col(of), lambda m, n: F.when(use(m), n).otherwise(F.lit(0).cast("bigint")))
        return F.aggregate(picked, F.lit(0).cast("bigint"), lambda a, b: a + b)

    def here(m: Column) -> Column:
        return (m.bitwiseAND(earlier) == 0) & (m.bitwiseAND(own) != 0)

    shares = F.zip_with(
        numbers,
        "every",
        lambda m, n: F.when(m.bitwiseAND(own) != 0, n * (F.lit(120) / F.bit_count(m)).cast("bigint")).otherwise(
            F.lit(0).cast("bigint")
        ),
    )
    return placed.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        total("every", lambda m: m.bitwiseAND(earlier.bitwiseOR(own)) == 0).alias("kept"),
        total("every", here).alias("removed"),
        total("every", lambda m: (m.bitwiseAND(earlier) != 0) & (m.bitwiseAND(own) != 0)).alias("redundant"),
        total("every", lambda m: m == own).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        F.aggregate(shares, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("shapley"),
    )


def op11(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(flags(docs), labels)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY text) AS least
  FROM d
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN least < w.doc_id THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
), c AS (
  SELECT part, mask, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM m GROUP BY part, mask
), f AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(letter, bit)
), o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), s AS (
  SELECT filter_order, step, bits[step] AS own, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS earlier
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), r AS (
  SELECT c.part, s.filter_order, s.step, s.own,
         CAST(sum(CASE WHEN c.mask & (s.earlier | s.own) = 0 THEN c.n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN c.mask & s.earlier = 0 AND c.mask & s.own <> 0 THEN c.n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN c.mask & s.earlier <> 0 AND c.mask & s.own <> 0 THEN c.n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN c.mask = s.own THEN c.n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN c.mask & s.earlier = 0 AND c.mask & s.own <> 0 THEN c.good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN c.mask & s.earlier = 0 AND c.mask & s.own <> 0 THEN c.toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM c, s GROUP BY c.part, s.filter_order, s.step, s.own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""
