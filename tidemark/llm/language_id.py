"""Language identification by unigram piece models, summed over all segmentations.

The pieces are those of a fixed public vocabulary; each language has its own piece probabilities.
The probability of a word (lower-case letters after a blank) is the sum over all its divisions into
pieces, worked out by a forward pass over its characters. A text's score for a language is the sum
of its words' log probabilities; the predicted language is the one with the highest posterior under
equal priors.

Training is expectation maximisation on word counts per language: a Spark job sums the expected
piece counts of the forward-backward passes over all words, and the bounded table of
pieces x languages comes back between rounds (the number of languages is that of the labels).
Words are counted on a bounded sample of labelled
documents, the ``SAMPLE`` documents of each language with the smallest hash of their id; the whole
texts of these are used. Prediction sees nothing but the text.

Defined results: a null text, or one without a letter, is ``und`` with score 0; with nothing to
learn from every text is ``und``. Ties go to the language that sorts first. Repeated rows are
predicted each. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.pieces import BLANK, default_model, load
from tidemark.llm.sentencepiece_codec import encoder
from tidemark.llm.shared import given_back, map_batches, split_batch, text_or_empty

UNKNOWN = "und"
#: Labelled documents per language that are learned from, rounds of EM, and smoothing.
SAMPLE, ROUNDS, SMOOTHING = 1_000, 2, 0.1
FOLDS = 5
#: Words whose scores a task keeps, words scored together, bytes of text at a time.
MAX_WORDS, WORDS_AT_ONCE, BATCH_BYTES = 250_000, 25_000, 2 << 20
#: Longer words are scored in stretches, so that sums stay inside the range of doubles.
WORD = re.compile(r"[^\W\d_]{1,32}")


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Lattice:
    """The pieces that occur in a word, as edges between places."""

    def __init__(self, model: str):
        vocabulary = load(model)
        self.ids, self.longest, self.size = vocabulary.ids, vocabulary.longest, vocabulary.size

    def edges(self, word: str) -> list[list[tuple[int, int]]]:
        """For each place the pieces that end there, as (start, piece); a character without a piece
        of its own is an edge with the number ``size``."""
        word = BLANK + word
        n, ids = len(word), self.ids
        ending: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            single = False
            for j in range(i + 1, min(n, i + self.longest) + 1):
                piece = ids.get(word[i:j])
                if piece is not None:
                    ending[j].append((i, piece))
                    single |= j == i + 1
            if not single:
                ending[i + 1].append((i, self.size))
        return ending


@lru_cache(maxsize=2)
def lattice(model: str) -> Lattice:
    return Lattice(model)


def forward(ending: list[list[tuple[int, int]]], probs: np.ndarray) -> list[np.ndarray]:
    """Sums over all segmentations of each prefix of one word, for all languages at once; what
    ``word_sums`` works out for many words together."""
    reach = [np.ones(probs.shape[1])]
    for here in ending[1:]:
        total = 0.0
        for start, piece in here:
            total = total + reach[start] * probs[piece]
        reach.append(total)
    return reach


def word_sums(words: list[str], model: str, probs: np.ndarray) -> np.ndarray:
    """The sum over all segmentations of each word, words x languages: one forward pass over the
    lattices of all words in step, by the place where edges end."""
    _, begins, sizes, start, piece, length = encoder(model).lattices([BLANK + w for w in words])
    offset = np.arange(int((sizes + 1).sum())) - np.repeat(begins, sizes + 1)
    to = start + length
    ends = offset[start] + length
    order = np.lexsort((to, ends))
    start, piece, to, ends = start[order], piece[order], to[order], ends[order]
    reach = np.zeros((len(offset), probs.shape[1]))
    reach[begins] = 1.0
    steps = np.flatnonzero(np.diff(ends, prepend=-1, append=-1))
    for a, b in zip(steps[:-1], steps[1:]):
        firsts = np.flatnonzero(np.diff(to[a:b], prepend=-1))
        through = reach[start[a:b]] * probs[piece[a:b]]
        reach[to[a:b][firsts]] = np.add.reduceat(through, firsts, axis=0)
    return reach[begins + sizes]


def expected_counts(ending: list[list[tuple[int, int]]], probs: list[float]) -> dict[int, float]:
    """Expected piece counts of a word in one language, by forward and backward sums."""
    n = len(ending) - 1
    reach = [1.0] + [0.0] * n
    for j in range(1, n + 1):
        reach[j] = sum(reach[i] * probs[p] for i, p in ending[j])
    rest = [0.0] * n + [1.0]
    out: dict[int, float] = {}
    for j in range(n, 0, -1):
        after = rest[j]
        for i, p in ending[j]:
            through = probs[p] * after
            rest[i] += through
            out[p] = out.get(p, 0.0) + reach[i] * through / reach[n]
    return out


def _learning_rows(docs: DataFrame, sample: int) -> DataFrame:
    rows = docs.where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & F.coalesce(~held_out(), F.lit(False))
    ).select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        rows.select("doc_id", "lang").withColumn("at", F.row_number().over(order))
        .where(F.col("at") <= sample).select("doc_id", "lang").distinct()
    )
    return rows.join(F.broadcast(chosen), ["doc_id", "lang"])  # at most sample rows per language


def _word_counts(rows: DataFrame) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: dict[tuple[str, str], int] = {}
        for lang, text in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
            for word in words_of(text):
                counts[lang, word] = counts.get((lang, word), 0) + 1
        langs, words = zip(*counts) if counts else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["lang", "word", "n"],
        )

    counted = map_batches(rows.select("lang", "text"), work, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def learn(
    docs: DataFrame, model: str | None = None, sample: int = SAMPLE, rounds: int = ROUNDS,
    smoothing: float = SMOOTHING,
) -> tuple[list[str], np.ndarray]:
    """The languages and the piece probabilities, (pieces + 1) x languages. The last row is the
    chance of a character outside the vocabulary."""
    model = model or default_model()
    size = load(model).size
    counted = _word_counts(_learning_rows(docs, sample)).cache()
    langs = [r["lang"] for r in counted.select("lang").distinct().orderBy("lang").collect()]
    # start: every piece alike, shorter ones preferred a little less than they would be by chance
    probs = np.full((size + 1, len(langs)), 1.0 / size)
    for _ in range(rounds):
        held = counted.sparkSession.sparkContext.broadcast(probs)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lat = lattice(model)
            by_lang = [column.tolist() for column in held.value.T]
            sums = np.zeros((size + 1, len(langs)))
            for batch in batches:
                for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                    at = langs.index(lang)
                    for piece, expected in expected_counts(lat.edges(word), by_lang[at]).items():
                        sums[piece, at] += n * expected
            piece, at = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(piece, pa.int32()), pa.array(sums[piece, at])],
                names=["lang", "piece", "expected"],
            )

        found = (
            counted.mapInArrow(given_back(expect), "lang int, piece int, expected double")
            .groupBy("lang", "piece").agg(F.sum("expected").alias("expected")).toArrow()
        )
        sums = np.zeros((size + 1, len(langs)))
        sums[found["piece"].to_numpy(), found["lang"].to_numpy()] = found["expected"].to_numpy()
        sums += smoothing
        probs = sums / sums.sum(axis=0)
        held.unpersist()
    counted.unpersist()
    return langs, probs


class Scorer:
    """Scores texts; the log probabilities of words met before are kept, ``MAX_WORDS`` and what one
    batch adds at most."""

    def __init__(self, model: str, probs: np.ndarray):
        self.model, self.probs = model, probs
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}
        self.logs = np.zeros((0, self.probs.shape[1]))

    def learn(self, new: list[str]) -> None:
        at = len(self.words)
        self.words.update(zip(new, range(at, at + len(new))))
        sums = word_sums(new, self.model, self.probs)
        self.logs = np.concatenate([self.logs, np.log(np.maximum(sums, 1e-300))])

    def best(self, texts: list[str]) -> list[tuple[int | None, float]]:
        """The likeliest language of each text and its posterior; None and 0 for a text without a
        letter, and for all if there are no languages."""
        out: list[tuple[int | None, float]] = [(None, 0.0)] * len(texts)
        found = [words_of(t) for t in texts]
        spoken = [n for n, words in enumerate(found) if words]
        if not self.probs.shape[1] or not spoken:
            return out
        if len(self.words) > MAX_WORDS:
            self.forget()
        known = self.words
        new = list({w for words in found for w in words if w not in known})
        for a in range(0, len(new), WORDS_AT_ONCE):
            self.learn(new[a : a + WORDS_AT_ONCE])
        numbers = np.array([known[w] for words in found for w in words], dtype=np.int64)
        sizes = np.array([len(found[n]) for n in spoken], dtype=np.int64)
        logs = np.add.reduceat(self.logs[numbers], np.cumsum(sizes) - sizes, axis=0)
        at = logs.argmax(axis=1)
        gaps = logs - logs[np.arange(len(at)), at][:, None]
        sure = 1.0 / np.exp(np.maximum(gaps, -700.0)).sum(axis=1)
        for n, language, score in zip(spoken, at.tolist(), sure.tolist()):
            out[n] = language, score
        return out


def predict(docs: DataFrame, langs: list[str], probs: np.ndarray, model: str | None = None) -> DataFrame:
    """doc_id, lang_pred and score (posterior of the predicted language), from the text alone."""
    model = model or default_model()
    held = docs.sparkSession.sparkContext.broadcast(probs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model, held.value)
        for whole in batches:
            for batch in split_batch(whole, "text", BATCH_BYTES):
                best = scorer.best(batch.column(1).to_pylist())
                found = [UNKNOWN if at is None else langs[at] for at, _ in best]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(found, pa.string()), pa.array([s for _, s in best], pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(given_back(work), "doc_id bigint, lang_pred string, score double")


def op1(docs: DataFrame, model: str | None = None) -> DataFrame:
    langs, probs = learn(docs, model)
    return predict(docs, langs, probs, model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def keep_identified(docs: DataFrame, least: float = 0.5, model: str | None = None) -> DataFrame:
    """The rows of ``docs`` whose text has an identified language with a score of ``least`` or
    more, all columns unchanged. The decision is made on the text alone, row by row."""
    langs, probs = learn(docs, model)
    model = model or default_model()
    names = docs.columns
    tagged = docs.withColumn("__text", text_or_empty())
    held = docs.sparkSession.sparkContext.broadcast(probs)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model, held.value)
        for whole in batches:
            for batch in split_batch(whole, "__text", BATCH_BYTES):
                best = scorer.best(batch.column(len(names)).to_pylist())
                kept = [at is not None and score >= least for at, score in best]
                yield batch.select(list(range(len(names)))).filter(pa.array(kept, pa.bool_()))

    return tagged.mapInArrow(given_back(keep), docs.schema)
