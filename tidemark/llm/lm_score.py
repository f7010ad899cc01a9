"""Language-model scores of documents: a smoothed unigram base and a log-bilinear network.

Tokens are the words of a text with A-Z in lower case, and one end. What is learned comes from the
documents that are not held out: the count of every token, and a network (``log_bilinear``) that
predicts the class of a token from the classes of the two tokens before it.

* **Counts** cover every token of every training document, however many different ones there are, and
  stay a table. The most frequent tokens (of the training documents, and of all documents; just under
  ``HEAD`` of each, by a threshold on the counts) are known to every worker; a token of at most ``LONGEST``
  bytes each, longer ones by a 252-bit digest. The counts of all other tokens reach the documents by an
  ordinary join. Such a token is rarer than about ``HEAD`` others, so no key of that join is hot.
* **Classes** are the ``SINGLE`` most frequent training tokens one by one, the rest of the head in
  classes of neighbouring ranks and about equal mass, and one class for all other tokens, known or
  not. Within a class a token has its share of the class's add-one mass, (c+1) / sum of (c+1); all
  unknown tokens share a count of zero. So the probabilities of all V+1 outcomes add up to one, and a
  score is comparable with the base: the network says how much the context tells.
* **Training** sees every training token in ``Plan.rounds`` passes. A task trains on its share from the
  common network, with a random order that depends on the partition's number alone, and the networks
  are averaged, weighted by tokens, in blocks on the workers. Only an averaged network, whose size is
  fixed, meets the driver.

Encoded texts (4 bytes a token) are written once and read by the training passes and by the scorer.

Defined results: a null text counts as empty and has one token, its end. A null id is not held out
(its checksum is that of an empty string). Rows that repeat an id each count and get a row. Without
training documents N and V are 0 and every score is 0. Extra columns are not read, whatever their
names. An empty table gives no rows. A text is held whole within one task, with some 20 bytes a token
beside it; texts are split into words a megabyte at a time.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.log_bilinear import Plan, Scorer, Trainer, contexts, pack, start, stretches, unpack
from tidemark.llm.shared import cut, map_batches, split_batch, text_or_empty
from tidemark.llm.texts import pieces

HEAD, LONGEST = 65_536, 64
SINGLE, CLASSES = 1152, 1536
#: Different tokens that a task counts before it passes them on; values in a block of the network.
COUNTED, BLOCK = 100_000, 16_384

END = ""
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def held_out(key: str = "doc_id") -> Column:
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 7 == 2


def tokens(piece: bytes) -> list[bytes]:
    """The words of a piece of text. One over LONGEST bytes is named by a digest, which starts with
    a blank and so is no word."""
    words = piece.translate(_LOWER).split()
    if words and max(map(len, words)) > LONGEST:
        words = [w if len(w) <= LONGEST else b" " + hashlib.sha256(w).hexdigest()[:63].encode() for w in words]
    return words


# -- counts ----------------------------------------------------------------------------------


def count_tokens(docs: DataFrame) -> DataFrame:
    """(token, c, every): occurrences in training documents and in all. docs: text, held_out."""

    def rows(found: Counter, learn: bool) -> pa.RecordBatch:
        every = pa.array(found.values(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(found.keys(), pa.binary()).cast(pa.string()),
                every if learn else pa.array(np.zeros(len(found), np.int64)),
                every,
            ],
            ["token", "c", "every"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = {True: Counter(), False: Counter()}
        for batch in (part for whole in batches for part in split_batch(whole, "text", 4 << 20)):
            for text, out in zip(batch["text"].cast(pa.binary()).to_pylist(), batch["held_out"].to_pylist()):
                into = counters[not out]
                into[END.encode()] += 1
                for piece in pieces(text):
                    into.update(tokens(piece))
                if sum(map(len, counters.values())) > COUNTED:
                    for learn, found in counters.items():
                        yield rows(found, learn)
                        found.clear()
        for learn, found in counters.items():
            yield rows(found, learn)
            found.clear()
        pa.default_memory_pool().release_unused()

    counted = docs.select("text", "held_out").mapInArrow(run, "token string, c bigint, every bigint")
    return counted.groupBy("token").agg(F.sum("c").alias("c"), F.sum("every").alias("every"))


def _size(count: str) -> Column:
    """Which of some 64 steps to each doubling a count has reached; -1 for none."""
    return F.when(F.col(count) > 0, F.floor(F.log2(count) * 64)).otherwise(F.lit(-1))


def _least(counts: DataFrame, count: str, head: int) -> int:
    """The smallest step that at most ``head`` tokens have reached. A few thousand steps at most."""
    steps = counts.where(F.col(count) > 0).groupBy(_size(count).alias("step")).agg(F.count("*").alias("n")).collect()
    above = 0
    least = max((r.step for r in steps), default=0) + 1
    for row in sorted(steps, key=lambda r: -r.step):
        above += row.n
        if above > head:
            break
        least = row.step
    return least


class Head:
    """The tokens that every worker knows: their counts and classes."""

    def __init__(self, counts: DataFrame, head: int = HEAD, single: int = SINGLE, classes: int = CLASSES):
        self.n, self.v = (int(x or 0) for x in counts.where("c > 0").agg(F.sum("c"), F.count("*")).first())
        least = {name: _least(counts, name, head) for name in ("c", "every")}
        found = counts.where((_size("c") >= least["c"]) | (_size("every") >= least["every"]))
        # fewer than 2 * head rows of at most LONGEST bytes each
        known = sorted(found.withColumn("learned", _size("c") >= least["c"]).collect(), key=lambda r: (-r.c, r.token))
        learned = [r for r in known if r.learned]
        others = [r for r in known if not r.learned]
        self.names = [r.token.encode() for r in [*learned, *others]]
        self.counts = np.array([r.c for r in [*learned, *others]], dtype=np.int64)
        ranked = len(learned)
        shares = self.counts[:ranked] + 1.0
        own = min(single, ranked)
        group = np.arange(ranked)
        if ranked > own:
            upto = np.cumsum(shares[own:])
            bins = min(classes - single - 1, ranked - own)
            group[own:] = own + np.minimum((upto - shares[own:]) * bins // upto[-1], bins - 1).astype(int)
            # equal mass may leave a number unused: close the gaps
            group[own:] = own + np.unique(group[own:], return_inverse=True)[1]
        self.rare = int(group.max()) + 1 if ranked else 0
        #: class of every head token, and last of all other tokens
        self.classes = np.concatenate([group, np.full(len(others) + 1, self.rare)]).astype(np.int32)
        total = self.n + self.v + 1.0
        mass = np.bincount(group, shares, self.rare + 1) if ranked else np.zeros(1)
        mass[self.rare] = total - shares.sum()
        self.mass, self.total = mass, total

    @property
    def log_share(self) -> np.ndarray:
        return np.log(self.mass / self.total)


# -- encoded texts ---------------------------------------------------------------------------


def encode(docs: DataFrame, names: list[bytes]) -> DataFrame:
    """(row, doc_id, held_out, ids, tail): numbers of the head tokens of a text, ``len(names)`` for all
    others, and these others with how often they stand in the text."""
    known = docs.sparkSession.sparkContext.broadcast(names)
    kind = docs.schema["doc_id"].dataType.simpleString()
    cache: dict[str, dict[bytes, int]] = {}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if "ids" not in cache:
            cache["ids"] = {w: i for i, w in enumerate(known.value)}
        numbers, other = cache["ids"], len(known.value)
        end = np.array([numbers.get(END.encode(), other)], np.int32)
        parts, lengths, tails = [], [], []
        for text in batch["text"].cast(pa.binary()).to_pylist():
            tail: Counter = Counter()
            size = 1
            for piece in pieces(text):
                words = tokens(piece)
                ids = np.fromiter(map(numbers.get, words, repeat(other)), np.int32, len(words))
                tail.update(words[i] for i in np.nonzero(ids == other)[0])
                parts.append(ids)
                size += len(ids)
            if end[0] == other:
                tail[END.encode()] += 1
            parts.append(end)
            lengths.append(size)
            tails.append([{"token": w.decode(), "n": n} for w, n in tail.items()])
        ids = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32), np.concatenate(parts))
        tail_type = pa.list_(pa.struct([("token", pa.string()), ("n", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["held_out"], ids, pa.array(tails, tail_type)],
            ["doc_id", "held_out", "ids", "tail"],
        )

    schema = f"doc_id {kind}, held_out boolean, ids array<int>, tail array<struct<token: string, n: bigint>>"
    rows = map_batches(docs.select("doc_id", "held_out", "text"), work, schema, batch_bytes=4 << 20, done=cache.clear)
    return cut(rows.withColumn("row", F.monotonically_increasing_id()), "encoded")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch in one array, and where each text starts."""
    lists = batch["ids"]
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    return lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], ends])[:-1].astype(np.int64)


def _by_tokens(batches: Iterator[pa.RecordBatch], tokens_each: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = np.cumsum(batch["ids"].value_lengths().to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + tokens_each, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


# -- the network -----------------------------------------------------------------------------


def train(encoded: DataFrame, head: Head, plan: Plan = Plan()) -> np.ndarray:
    """The packed network, after ``plan.rounds`` passes over the training texts."""
    spark = encoded.sparkSession
    log_share, of_class = head.log_share, head.classes
    flat = pack(start(log_share, plan))
    blocks = -(-len(flat) // BLOCK)
    texts = encoded.where("not held_out").select("ids")
    for number in range(plan.rounds if len(log_share) > 1 else 0):
        shared = spark.sparkContext.broadcast((flat, log_share, of_class))

        def learn(batches: Iterator[pa.RecordBatch], number: int = number, shared=shared) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            given, share, classes = shared.value
            net = unpack(given, len(share), plan.width)
            trainer = Trainer(net, share, plan, number * 1_000_003 + TaskContext.get().partitionId())
            for batch in _by_tokens(batches):
                ids, starts = _flat(batch)
                mine = classes[ids]
                trainer.learn(*contexts(mine, starts, len(share)), mine)
            if trainer.tokens:
                out = pack(trainer.net).astype(np.float64) * trainer.tokens
                parts = [out[i : i + BLOCK].tobytes() for i in range(0, len(out), BLOCK)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(len(parts)), pa.int32()),
                        pa.array([trainer.tokens] * len(parts), pa.int64()),
                        pa.array(parts, pa.binary()),
                    ],
                    ["block", "tokens", "sums"],
                )

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            seen: Counter = Counter()
            for batch in batches:
                for block, tokens_seen, raw in zip(*(batch[c].to_pylist() for c in ("block", "tokens", "sums"))):
                    part = np.frombuffer(raw, np.float64)
                    sums[block] = sums[block] + part if block in sums else part
                    seen[block] += tokens_seen
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(sums), pa.int32()),
                    pa.array([(sums[k] / seen[k]).tobytes() for k in sums], pa.binary()),
                ],
                ["block", "mean"],
            )

        trained = texts.mapInArrow(learn, "block int, tokens bigint, sums binary")
        means = trained.repartition(blocks, "block").mapInArrow(add, "block int, mean binary").collect()
        if means:
            flat = np.concatenate([np.frombuffer(r.mean, np.float64) for r in sorted(means, key=lambda r: r.block)])
        shared.unpersist()
    return flat


# -- scores ----------------------------------------------------------------------------------

_SCORED = (
    "row bigint, doc_id {id}, held_out boolean, n_tokens bigint, head_known bigint, head_base double, head_score double"
)


def score_heads(encoded: DataFrame, head: Head, network: np.ndarray, width: int) -> DataFrame:
    """Every text with what its head tokens add to both scores; other tokens add their class here."""
    ln10 = math.log(10)
    counts = np.concatenate([head.counts, [0]])
    own = np.concatenate([np.log10(head.counts + 1.0), [0.0]])
    within = own - np.log10(head.mass)[head.classes]
    shared = encoded.sparkSession.sparkContext.broadcast((network, head.classes, counts > 0, own, within))
    n_classes = len(head.mass)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, of_class, known, base, inner = shared.value
        scorer = Scorer(unpack(packed, n_classes, width))
        for batch in _by_tokens(batches):
            ids, starts = _flat(batch)
            classes = of_class[ids]
            first, second = contexts(classes, starts, n_classes)
            logs = np.empty(len(ids))
            for s in stretches(len(ids)):
                logs[s] = scorer.log_probs(first[s], second[s], classes[s]) / ln10 + inner[ids[s]]
            sizes = np.diff(np.append(starts, len(ids)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"],
                    batch["doc_id"],
                    batch["held_out"],
                    pa.array(sizes, pa.int64()),
                    pa.array(np.add.reduceat(known[ids].astype(np.int64), starts)),
                    pa.array(np.add.reduceat(base[ids], starts)),
                    pa.array(np.add.reduceat(logs, starts)),
                ],
                ["row", "doc_id", "held_out", "n_tokens", "head_known", "head_base", "head_score"],
            )
        del scorer
        pa.default_memory_pool().release_unused()  # the worker is used again, by other stages too

    return encoded.select("row", "doc_id", "held_out", "ids").mapInArrow(run, _SCORED.format(id=kind))


def score(docs: DataFrame, learn_from: Column | None = None, head: int = HEAD, single: int = SINGLE,
          classes: int = CLASSES, plan: Plan = Plan()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document; learned
    from those where ``learn_from`` holds, by default all that are not ``held_out()``."""
    out = held_out() if learn_from is None else ~F.coalesce(learn_from, F.lit(False))
    given = docs.select("doc_id", out.alias("held_out"), text_or_empty().alias("text"))
    counts = cut(count_tokens(given), "counts")
    known = Head(counts, head, single, classes)
    encoded = encode(given, known.names)
    network = train(encoded, known, plan)
    scored = score_heads(encoded, known, network, plan.width)
    # the tokens outside the head that the training documents have
    names = encoded.sparkSession.createDataFrame([(n.decode(),) for n in known.names], "token string")
    others = counts.where("c > 0").select("token", "c").join(F.broadcast(names), "token", "left_anti")
    tails = encoded.select("row", F.explode("tail").alias("t")).select("row", "t.token", "t.n")
    found = tails.join(others, "token").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("tail_score"), F.sum("n").alias("tail_known")
    )
    tail = F.coalesce("tail_score", F.lit(0.0))
    return scored.join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(known.n).cast("bigint").alias("train_tokens"),
        (F.col("head_base") + tail - F.col("n_tokens") * F.lit(math.log10(known.total))).alias("base_score"),
        (F.col("head_score") + tail).alias("score"),
    )


def op13(docs: DataFrame) -> DataFrame:
    return score(docs)
