"""Document fingerprints: SimHash over weighted terms, and a search by permuted block tables.

All of it is DataFrame expressions. Every distinct lower-case word of a text (words are split at
space and the control characters 9 to 13) votes on 64 bits with a weight of its length in code
points, so long and therefore specific words count for more. The 64 counters of a text are kept in
32 whole numbers of two 32-bit lanes each, so that a vote is one shift, one mask and one addition,
and the counting is an ordinary hash aggregation. A bit of the fingerprint is set when more than
half of the weight voted for it.

Defined results: a null text counts as empty; a text without words has the fingerprint zero; equal
texts have equal fingerprints. Documents are ordered by doc_id (null first), then text. The next
document of the last is the first; a single document is its own next. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, text_or_empty

BITS = 64
#: Rows in a range of doc_ids, and the most ranges; beyond that ranges get longer.
RANGE_ROWS, MAX_RANGES = 1024, 16_384
_LANES = 32
_LOW = 0x00000000FFFFFFFF


def terms(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(text), r"[\x20\x09-\x0D]+"))


def votes(term: str) -> list[Column]:
    """The sums to collect: total weight, and the weight for each pair of bits (k, k + 32)."""
    weight = F.length(term).cast("bigint")
    h = F.xxhash64(F.col(term))
    lanes = [
        F.sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit((1 << 32) | 1)) * weight).alias(f"lane{k}")
        for k in range(_LANES)
    ]
    return [F.sum(weight).alias("weight"), *lanes]


def fingerprint() -> Column:
    """The fingerprint from the sums of ``votes`` as a whole number."""
    bits = []
    for k in range(_LANES):
        low = F.col(f"lane{k}").bitwiseAND(F.lit(_LOW))
        high = F.shiftrightunsigned(f"lane{k}", 32)
        for place, count in ((k, low), (k + _LANES, high)):
            bit = 1 << place
            signed = bit - (1 << BITS) if bit >> (BITS - 1) else bit
            bits.append(F.when(count * 2 > F.col("weight"), F.lit(signed)).otherwise(F.lit(0)).cast("bigint"))
    while len(bits) > 1:  # a balanced tree keeps the expression shallow
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2])]
    return bits[0]


def simhash(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row per distinct ``keys`` with the fingerprint of its text."""
    words = df.select(*keys, F.explode(terms(text_or_empty(text))).alias("term"))
    return words.groupBy(*keys).agg(*votes("term")).select(*keys, fingerprint().alias("fingerprint"))


def likeness(a: str, b: str) -> Column:
    return 1 - F.bit_count(F.col(a).bitwiseXOR(F.col(b))) / F.lit(float(BITS))


def as_text(name: str) -> Column:
    return F.lower(F.lpad(F.hex(name), BITS // 4, "0"))


def _ranges(docs: DataFrame) -> tuple[Column, DataFrame]:
    """Which range of doc_ids a row is in, and the first id of each range with the range before it.

    The borders are quantiles, so ranges hold about as many rows whatever the ids look like. Their
    number is bounded by MAX_RANGES; only the borders come to the driver.
    """
    rows = docs.count()
    n = max(1, min(MAX_RANGES, rows // RANGE_ROWS))
    shares = [i / n for i in range(1, n)]
    borders: list[int] = []
    if shares:
        found = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * n))).first()[0]
        borders = sorted(set(found or []))
    place = F.lit(0)
    if borders:
        steps = [1 << k for k in reversed(range(len(borders).bit_length()))]
        held = F.lit(borders)
        place = F.aggregate(
            F.lit(steps),
            F.lit(0),
            lambda at, step: F.when(
                (at + step <= len(borders)) & (F.get(held, at + step - 1) <= F.col("doc_id")), at + step
            ).otherwise(at),
        )
    firsts = (
        docs.select(place.alias("range"), "doc_id").groupBy("range")
        .agg(F.min("doc_id").alias("doc_id"), F.bool_or(F.col("doc_id").isNull()).alias("nulls"))
        .orderBy("range").collect()
    )
    before = [
        (None if r["nulls"] else r["doc_id"], firsts[i - 1]["range"]) for i, r in enumerate(firsts)
    ]
    return place, docs.sparkSession.createDataFrame(before, "first_id bigint, before int")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text, and ``range``, ``at`` as the place of the row; ``guest`` rows are
    copies of the first rows of the following range, to be dropped by the caller."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    place, firsts = _ranges(docs.select("doc_id"))
    seats = F.array(
        F.struct(F.col("home").alias("range"), F.lit(False).alias("guest")),
        F.struct(F.col("before").alias("range"), F.lit(True).alias("guest")),
    )
    dealt = (
        docs.withColumn("home", place)
        .join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("first_id")), "left")
        .select("doc_id", "text", F.inline(seats))
        .where(F.col("range").isNotNull())
    )
    order = Window.partitionBy("range").orderBy("guest", F.asc_nulls_first("doc_id"), "text")
    return dealt.withColumn("at", F.row_number().over(order)).withColumn(
        "next_text", F.lead("text", 1, "").over(order)
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text: the last half of the code points
    replaced by as many of the first ones of the next document.

    One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (whole
    numbers), near_edited, near_next. The text moves once, to its range of doc_ids; all else is
    worked out there.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = (
        with_next(docs)
        .withColumn("n_chars", F.length("text").cast("bigint"))
        .withColumn(
            "edited",
            F.concat(
                F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
                F.substring("next_text", F.lit(1), half),
            ),
        )
        .withColumn("edited_sha256", F.sha2("edited", 256))
    )
    keys = ["range", "at", "guest", "doc_id", "n_chars", "edited_sha256"]
    both = rows.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")),
                F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")),
            )
        ),
    )
    prints = simhash(both, [*keys, "kind"])
    flat = prints.groupBy(*keys).agg(
        F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    order = Window.partitionBy("range").orderBy("at")
    return (
        flat.withColumn("next_fingerprint", F.lead("fingerprint").over(order))
        .where(~F.col("guest"))
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
            likeness("fingerprint", "next_fingerprint").alias("near_next"),
        )
    )


def block_masks(radius: int, extra: int = 1) -> list[int]:
    """Masks of the tables: the 64 bits are cut into ``radius + extra`` blocks; two fingerprints
    within ``radius`` agree in at least ``extra`` whole blocks, so in one table's key."""
    n = radius + extra
    if not 0 <= radius < BITS or n > BITS:
        raise ValueError("radius out of range")
    edges = [BITS * i // n for i in range(n + 1)]
    blocks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(n)]
    return [sum(chosen) for chosen in combinations(blocks, extra)]


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = 3, extra: int = 1) -> DataFrame:
    """All pairs (query, fingerprint) of distinct whole numbers at most ``radius`` bits apart.

    Both frames have a column ``fingerprint``; copies count once. The fingerprints are dealt into
    one table per choice of ``extra`` blocks, keyed by the bits of those blocks, and a query meets
    only what has its key. A pair is reported by the first table in which it meets, so nothing has
    to be made distinct afterwards. Nulls are left out.
    """
    masks = [m - (1 << BITS) if m >> (BITS - 1) else m for m in block_masks(radius, extra)]

    def tables(df: DataFrame, name: str) -> DataFrame:
        one = df.where(F.col("fingerprint").isNotNull()).select(F.col("fingerprint").alias(name)).distinct()
        keys = [F.struct(F.lit(i).alias("number"), F.col(name).bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]
        return one.select(name, F.inline(F.array(*keys)))

    differ = F.col("query").bitwiseXOR(F.col("fingerprint"))
    first = F.coalesce(
        *[F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)]
    )
    met = tables(queries, "query").join(tables(prints, "fingerprint"), ["number", "key"])
    return met.where((F.bit_count(differ) <= radius) & (first == F.col("number"))).select(
        "query", "fingerprint", F.bit_count(differ).alias("distance")
    )


def op10(docs: DataFrame, radius: int = 3) -> DataFrame:
    """``edited_fingerprints`` as text, and for documents whose id divides by 100 the number of
    other documents within ``radius`` bits (null for the rest)."""
    rows = cut(edited_fingerprints(docs), "fingerprints")
    counted = rows.groupBy("fingerprint").agg(F.count("*").alias("copies"))
    asked = rows.where(F.col("doc_id") % 100 == 0)
    near = (
        within_radius(asked, counted, radius)
        .join(counted, "fingerprint")
        .groupBy("query")
        .agg((F.sum("copies") - 1).alias("n_within"))
        .withColumnRenamed("query", "fingerprint")
    )
    found = asked.join(near, "fingerprint", "left")
    rest = rows.where((F.col("doc_id") % 100 != 0) | F.col("doc_id").isNull())
    return found.unionByName(rest, allowMissingColumns=True).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text("fingerprint").alias("fingerprint"),
        as_text("edited_fingerprint").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "n_within",
    )
