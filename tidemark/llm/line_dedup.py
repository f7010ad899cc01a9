"""Line dedup by pairwise alignment of overlapping documents.

Documents that share lines are found through line hashes, rare and frequent alike, and every pair of
them is decided: a later document loses the common blocks that its alignment with any earlier one
has. A pair is aligned by patience diff (the lines unique to both sides and in the same order on
both, extended to their neighbours, and again in between; an exact longest common subsequence where
no line is unique). Equal texts are one class; all its documents but the earliest lose every line.

Not every pair has to be aligned for that. Lines that no other class has align with nothing, so a
class is reduced to its order: its stretches of shared lines that can be a block, with breaks
between. Classes of one order are folded, all but the earliest lose the whole order. Orders meet
through units, the shortest runs of neighbouring lines that are evidence; a block consists of units
that both sides have. The holders of a unit are ranked, and in rounds of growing reach each unit
with a place that is not yet deleted meets the next earlier holders, until all its places are
deleted or all earlier holders are tried.

A block is evidence, and deleted, if its lines have at least ``LEAST_CHARS`` code points together; a
single short line between other lines is kept, however many documents have it. Lines are compared
and counted without outer blanks, tabs and carriage returns. Documents are ordered by
doc_id (null first), classes with the same least id by hash of the text. Alignment is judged on
the input: a deletion hides nothing from other pairs.

Defined results: a null text counts as empty and has no lines; an empty text has none to lose; rows
equal in doc_id and text are the same document and are edited alike. Extra columns are kept.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, given_back, text_or_empty

LEAST_CHARS = 20


def aligned(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Pairs of places with equal lines, rising on both sides, by patience diff; stretches without a
    line unique to both sides by a longest common subsequence."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {a[i]: i for i in range(a0, a1) if once_a[a[i]] == 1 and once_b.get(a[i]) == 1}
        anchors = _rising([(place[b[j]], j) for j in range(b0, b1) if b[j] in place])
        if not anchors:
            out += [(a0 + i, b0 + j) for i, j in longest_common(a[a0:a1], b[b0:b1])]
            continue
        ends = [*anchors, (a1, b1)]
        work.append((a0, ends[0][0], b0, ends[0][1]))
        for (i, j), (i2, j2) in zip(ends, ends[1:]):
            work.append((i, i2, j, j2))
    return sorted(out)


def longest_common(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence (Hirschberg: exact, in linear memory)."""
    in_a, in_b = set(a), set(b)
    at_a = [i for i, x in enumerate(a) if x in in_b]
    at_b = [j for j, x in enumerate(b) if x in in_a]
    left = np.array([a[i] for i in at_a], dtype=np.int64)
    right = np.array([b[j] for j in at_b], dtype=np.int64)
    out: list[tuple[int, int]] = []
    work = [(0, len(left), 0, len(right))]
    while work:
        a0, a1, b0, b1 = work.pop()
        if a0 == a1 or b0 == b1:
            continue
        if a1 - a0 == 1:
            hits = np.flatnonzero(right[b0:b1] == left[a0])
            out += [(at_a[a0], at_b[b0 + int(j)]) for j in hits[:1]]
            continue
        mid = (a0 + a1) // 2
        head = _common_lengths(left[a0:mid], right[b0:b1])
        tail = _common_lengths(left[mid:a1][::-1], right[b0:b1][::-1])
        at = b0 + int(np.argmax(head + tail[::-1]))
        work += [(a0, mid, b0, at), (mid, a1, at, b1)]
    return sorted(out)


def _common_lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequence of ``a`` and every prefix of ``b``."""
    row = np.zeros(len(b) + 1, dtype=np.int64)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return row


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs that rises on both sides; ``pairs`` rise on the second."""
    tops: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for n, (i, _) in enumerate(pairs):
        k = bisect_left(tops, i)
        before.append(at[k - 1] if k else -1)
        if k == len(tops):
            tops.append(i)
            at.append(n)
        else:
            tops[k], at[k] = i, n
    out = []
    n = at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def weight(line: int) -> int:
    """What a line adds to the evidence of its block; a block needs ``LEAST_CHARS``."""
    return line & 31


def odd(line: int) -> int:
    return LEAST_CHARS * (line & 1)


def common_blocks(a: Sequence[int], b: Sequence[int], weight: Callable[[int], int] = odd) -> list[int]:
    """Places in ``b`` of the aligned blocks that have evidence; without ``weight`` an odd hash is."""
    pairs = aligned(a, b)
    out: list[int] = []
    start = 0
    for n in range(1, len(pairs) + 1):
        if n == len(pairs) or pairs[n] != (pairs[n - 1][0] + 1, pairs[n - 1][1] + 1):
            block = [j for _, j in pairs[start:n]]
            if sum(weight(b[j]) for j in block) >= LEAST_CHARS:
                out += block
            start = n
    return out


#: Stands between the stretches of an order and equals no line; ``found_in`` makes it differ by side.
BREAK = 0


def order_of(lines: Sequence[int], shared: Iterable[int]) -> tuple[list[int], list[int]]:
    """The stretches of shared lines with evidence, breaks between, and their places in ``lines``."""
    tokens: list[int] = []
    places: list[int] = []
    known = sorted(shared)
    start = 0
    for n in range(1, len(known) + 1):
        if n == len(known) or known[n] != known[n - 1] + 1:
            stretch = known[start:n]
            if sum(weight(lines[i]) for i in stretch) >= LEAST_CHARS:
                if tokens:
                    tokens.append(BREAK)
                    places.append(-1)
                tokens += [lines[i] for i in stretch]
                places += stretch
            start = n
    return tokens, places


def units(tokens: Sequence[int]) -> dict[int, list[tuple[int, int]]]:
    """Hash -> runs (start, end): from each line on and up to each line, the shortest run with
    evidence. The units inside a block cover it."""
    runs = set()
    for step in (1, -1):
        line_at = range(len(tokens)) if step == 1 else range(len(tokens) - 1, -1, -1)
        sums, reach = 0, line_at[0] if tokens else 0
        for first in line_at:
            # the run goes from first up to, not including, reach
            while sums < LEAST_CHARS and 0 <= reach < len(tokens) and tokens[reach] != BREAK:
                sums += weight(tokens[reach])
                reach += step
            if sums >= LEAST_CHARS:
                runs.add((first, reach) if step == 1 else (reach + 1, first + 1))
            if reach != first:
                sums -= weight(tokens[first])
            else:
                reach += step
    out: dict[int, list[tuple[int, int]]] = {}
    for start, end in sorted(runs):
        out.setdefault(hash(tuple(tokens[start:end])), []).append((start, end))
    return out


def found_in(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Places of order ``b`` to delete for order ``a``."""
    return common_blocks(a, [-1 if x == BREAK else x for x in b], weight)


def text_key(text: str = "text") -> Column:
    return F.unhex(F.md5(F.col(text).cast("binary")))


def line_hashes() -> Column:
    """Hashes of the lines; the low five bits are the code points, up to ``LEAST_CHARS``."""

    def one(line: Column) -> Column:
        bare = F.btrim(line, F.lit(" \t\r"))
        chars = F.least(F.length(bare), F.lit(LEAST_CHARS)).cast("bigint")
        return F.xxhash64(bare).bitwiseAND(F.lit(-32)).bitwiseOR(chars)

    return F.when(F.col("text") == "", F.array().cast("array<bigint>")).otherwise(
        F.transform(F.split("text", "\n"), one)
    )


def orders_of(classes: DataFrame) -> DataFrame:
    """key, least_id, tokens, places, order (a hash of the tokens); only classes that share a block."""
    # empty lines are shared by nearly all; they need no search
    blank = F.xxhash64(F.lit("")).bitwiseAND(F.lit(-32))
    each = classes.select("key", F.posexplode("lines").alias("at", "line")).where(F.col("line") != blank)
    shared = (
        classes.select(F.explode(F.array_distinct("lines")).alias("line")).where(F.col("line") != blank)
        .groupBy("line").count().where("count > 1").select("line")
    )
    marked = each.join(shared, "line").groupBy("key").agg(F.collect_list("at").alias("known"))
    empty = F.filter(
        F.transform("lines", lambda x, i: F.when(x == blank, i).otherwise(F.lit(-1))), lambda i: i >= 0
    )
    both = classes.join(marked, "key").select("key", "least_id", "lines", F.concat("known", empty).alias("known"))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids, lines, known = (c.to_pylist() for c in batch.columns)
            found = [order_of(x, y) for x, y in zip(lines, known)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.binary()), pa.array(ids, pa.int64()),
                    pa.array([x for x, _ in found], pa.list_(pa.int64())),
                    pa.array([x for _, x in found], pa.list_(pa.int32())),
                ],
                names=["key", "least_id", "tokens", "places"],
            )

    return (
        both.mapInArrow(given_back(reduce), "key binary, least_id bigint, tokens array<bigint>, places array<int>")
        .where(F.size("tokens") > 0)
        .withColumn("order", F.unhex(F.md5(F.array_join(F.col("tokens").cast("array<string>"), ",").cast("binary"))))
    )


def ranked_units(orders: DataFrame) -> DataFrame:
    """unit, order, rank (among the orders that have the unit, by place); only units of several."""

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for order, at, tokens in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
                found = list(units(tokens))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.int64()), pa.array([order.as_py()] * len(found), pa.binary()),
                     pa.array([at.as_py()] * len(found), at.type)],
                    names=["unit", "order", "place"],
                )

    held = orders.select("order", "place", "tokens").mapInArrow(
        given_back(cover), "unit bigint, order binary, place struct<least_id:bigint,key:binary>"
    )
    # sorted over all tasks and counted by task: a unit with very many holders is spread
    row = cut(
        held.repartitionByRange("unit", "place").sortWithinPartitions("unit", "place")
        .select("unit", "order", F.monotonically_increasing_id().alias("row"))
        .withColumn("part", F.shiftright("row", 33)),
        "units",
    )
    by_part = row.groupBy("unit", "part").agg(F.min("row").alias("least"), F.count("*").alias("n"))
    whole = Window.partitionBy("unit")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = by_part.select(
        "unit", "part", "least", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("all"),
    ).where(F.col("all") > 1)
    return row.join(by_part, ["unit", "part"]).select(
        "unit", "order", (F.col("before") + F.col("row") - F.col("least")).alias("rank")
    )


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units of an order with a place that is not deleted."""
    for batch in batches:
        for order, tokens, gone in zip(*(c.to_pylist() for c in batch.columns)):
            done = set(gone or ())
            left = [u for u, runs in units(tokens).items() if any(i not in done for r in runs for i in range(*r))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array([order] * len(left), pa.binary())], names=["unit", "order"]
            )


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        orders, left, right = (c.to_pylist() for c in batch.columns)
        yield pa.RecordBatch.from_arrays(
            [pa.array(orders, pa.binary()),
             pa.array([found_in(a, b) for a, b in zip(left, right)], pa.list_(pa.int32()))],
            names=["order", "gone"],
        )


#: Each round tries so many times the holders of all rounds before.
REACH = 8


def deleted_tokens(orders: DataFrame) -> DataFrame:
    """order, gone (places in its tokens that some earlier order has in an aligned block)."""
    ranked = cut(ranked_units(orders), "ranked")
    last = ranked.agg(F.max("rank")).first()[0] or 0
    known = orders.select("order", "tokens")
    done = orders.sparkSession.createDataFrame([], "order binary, gone array<int>")
    low, high = 0, 1
    while low < last:
        later = ranked.where(F.col("rank") > low)
        if low:
            left = known.join(done, "order", "left").select("order", "tokens", "gone")
            later = later.join(left.mapInArrow(given_back(_open), "unit bigint, order binary"), ["unit", "order"])
        reach = F.sequence(F.lit(low).cast("bigint"), F.least(F.col("rank"), F.lit(high).cast("bigint")) - 1)
        wanted = later.select("unit", F.col("order").alias("b"), F.explode(reach).alias("rank"))
        pairs = cut(
            wanted.join(ranked.withColumnRenamed("order", "a"), ["unit", "rank"]).select("a", "b").distinct(), "pairs"
        )
        if pairs.isEmpty():
            break
        both = (
            pairs.join(known.toDF("b", "tokens_b"), "b").join(known.toDF("a", "tokens_a"), "a")
            .select("b", "tokens_a", "tokens_b")
        )
        found = both.mapInArrow(given_back(_align), "order binary, gone array<int>").unionByName(done)
        done = cut(
            found.select("order", F.explode("gone").alias("at")).groupBy("order")
            .agg(F.collect_set("at").alias("gone")),
            "gone",
        )
        low, high = high, high * REACH
    return done


def deletions(docs: DataFrame) -> DataFrame:
    """key (of a text), least_id, copies, places (of deleted lines in its earliest document); only
    texts with something to delete."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    lines = rows.select("doc_id", text_key().alias("key"), line_hashes().alias("lines"))
    # one order for classes: by least id, then by key
    classes = cut(
        lines.where(F.size("lines") > 0).groupBy("key").agg(
            F.min("doc_id").alias("known_id"),
            F.bool_or(F.col("doc_id").isNull()).alias("unnamed"),
            F.count("*").alias("copies"),
            F.first("lines").alias("lines"),
        ).withColumn("least_id", F.when(~F.col("unnamed"), F.col("known_id")))
        .select("key", "least_id", "copies", "lines"),
        "classes",
    )
    reduced = cut(orders_of(classes), "reduced")
    place = F.struct("least_id", "key").alias("place")
    # the tokens are those of the earliest class
    orders = cut(
        reduced.groupBy("order").agg(F.min(place).alias("place"), F.first("tokens").alias("tokens")), "orders"
    )
    gone = orders.select("order", F.col("place.key").alias("known")).join(deleted_tokens(orders), "order", "left")
    kept = F.coalesce("gone", F.array().cast("array<int>"))
    places = reduced.select("key", "order", "places").join(gone, "order").select(
        "key",
        F.array_sort(
            F.when(F.col("known") == F.col("key"), F.transform(kept, lambda i: F.get("places", i)))
            .otherwise(F.filter("places", lambda i: i >= 0))
        ).alias("places"),
    ).where(F.size("places") > 0)
    return (
        classes.drop("lines").join(places, "key", "left")
        .where((F.col("copies") > 1) | F.col("places").isNotNull())
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the edited text in ``text``, and ``n_lines``, ``n_removed``."""
    tagged = docs.withColumn("__text", text_or_empty())
    tagged = tagged.withColumn("__key", text_key("__text"))
    found = cut(deletions(docs), "deletions").select(
        F.col("key").alias("__key"), F.col("least_id").alias("__least"), F.col("copies").alias("__copies"),
        F.col("places").alias("__places"),
    )
    joined = tagged.join(found, "__key", "left").withColumn(
        "__whole",
        (F.col("__copies") > 1) & ~F.col("doc_id").cast("bigint").eqNullSafe(F.col("__least")),
    )
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    wanted = joined.select(*names, F.coalesce("__whole", F.lit(False)).alias("__whole"), "__places")
    at = names.index("text")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_removed = batch.column(at).to_pylist(), [], []
            whole, places = (batch.column(len(names) + k).to_pylist() for k in (0, 1))
            for n, text in enumerate(texts):
                count = text.count("\n") + 1 if text else 0
                n_lines.append(count)
                if whole[n] and text:
                    texts[n] = ""
                    n_removed.append(count)
                elif places[n] and text:
                    gone = set(places[n])
                    texts[n] = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
                    n_removed.append(len(gone))
                else:
                    n_removed.append(0)
            columns = list(batch.columns[: len(names)])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())],
                names=[*names, "n_lines", "n_removed"],
            )

    fields = ", ".join(
        f"`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}"
        for f in wanted.schema.fields[: len(names)]
    )
    return wanted.mapInArrow(given_back(edit), f"{fields}, n_lines bigint, n_removed bigint")


def op8(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text")).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def keep_rest(docs: DataFrame) -> DataFrame:
    """``docs`` with edited texts and their lengths; rows that lost every line that has letters or
    digits go, all others stay."""
    edited = dedup_lines(docs)
    left = (F.col("n_removed") == 0) | F.col("text").rlike(r"[\p{L}\p{N}]")
    rows = edited.where(left)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn(
            "n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return rows.select(*docs.columns)
