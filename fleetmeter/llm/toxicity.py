"""Toxicity by class-conditional Kneser-Ney models.

Two word-bigram models, of toxic and of ordinary texts, with interpolated absolute discounting:
a class's bigrams back off to the class's continuation counts (after how many different words a
word is seen in the class), and those to a backoff shared by both classes, again counted by kinds of
context: in how many of the classes a word is seen. Expressions seen rarely in a class thus get nearly the same probability in both. As a toxic text is mostly
ordinary words, its likelihood takes each word from the toxic model with weight ``MIXED`` and else from
the ordinary one: differences of topic or language between the classes weigh little, expressions
that ordinary texts lack weigh much. A text's score compares its length-normalised log-likelihoods
under the two; a logistic curve fitted on further labelled rows makes it a probability.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z, told apart by a 64-bit hash.

The models are fitted on a bounded sample: ``per_class`` labelled rows of each class chosen by a
hash of doc_id, two in three for the models and the rest for the curve, of at most ``TRAIN_CHARS``
characters each. Counts are summed in Spark; the driver gets the sample's words and its frequent bigrams, not all bigrams. Every
text is then scored whole.

Defined cases: texts without words, null or empty, get the curve's value at no difference; without labelled
rows of both classes every score is 0; rows that repeat a doc_id in ``labels`` count each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm import text as t
from fleetmeter.llm.stages import staged

PER_CLASS = 4000
TRAIN_CHARS = 20_000
#: Weight of the toxic model in a toxic text.
MIXED = 0.05
#: Bigrams seen fewer times in all are left to the backoff, and so is every context that fewer
#: different words follow in either class: copied passages would make it look certain there.
LEAST_BIGRAM = 5
LEAST_FOLLOWERS = 10
CLASSES = ("ordinary", "toxic")
START = np.uint64(0x5EED5EED5EED5EED)
PAIR = np.uint64(0x9E3779B97F4A7C15)


def _tokens(piece: t.Slice) -> tuple[np.ndarray, np.ndarray, t.Words]:
    """Word hashes, those of the word before (``START`` at the beginning of a text), and the words."""
    data = t.LOWER[piece.data]
    found = t.words(data, piece.starts, t.ALPHANUMERIC)
    now = t.word_hashes(data, found)
    before = np.r_[START, now[:-1]] if len(now) else now.copy()
    before[found.first[:-1][found.counts > 0]] = START
    return now, before, found


def _pairs(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    return t.mix(before * PAIR + now)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bigrams of each text with their two words and the text's class."""
    for batch in batches:
        label = batch.column("label").to_numpy(zero_copy_only=False)
        for piece in t.slices(batch.column("text")):
            now, before, found = _tokens(piece)
            toxic = label[piece.lo : piece.hi][found.owner()].astype(np.int64)
            key, index, inverse = np.unique(_pairs(before, now), return_index=True, return_inverse=True)
            n = np.bincount(inverse, minlength=len(key))
            n_toxic = np.bincount(inverse, toxic, minlength=len(key)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(v.view(np.int64)) for v in (key, before[index], now[index])),
                    pa.array(n - n_toxic),
                    pa.array(n_toxic),
                ],
                ["pair", "v", "w", "ordinary", "toxic"],
            )


@dataclass
class Model:
    """Log-ratio tables: of a word alone, and of a kept bigram; and the logistic curve."""

    words: np.ndarray  # sorted word hashes
    chance: np.ndarray  # [class, word + unknown]: class probability of a word without context
    kept: np.ndarray  # [class, word + unknown]: weight that is left to it in the context of a word
    pairs: np.ndarray  # sorted bigram hashes
    direct: np.ndarray  # [class, bigram]: discounted share of the bigram in its context
    start: int
    curve: tuple[float, float, float] = (0.0, 0.0, -50.0)

    def places(self, words: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, len(self.words))

    def ratios(self, piece: t.Slice) -> tuple[np.ndarray, np.ndarray]:
        """Sum of log(toxic / ordinary) over the words of each text, and their number."""
        now, before, found = _tokens(piece)
        if not len(now):
            return np.zeros(piece.hi - piece.lo), found.counts
        at = self.places(now)
        context = np.r_[at[0], at[:-1]]
        context[before == START] = self.start
        chances = []
        pair = _pairs(before, now)
        spot = np.minimum(np.searchsorted(self.pairs, pair), max(len(self.pairs) - 1, 0))
        hit = self.pairs[spot] == pair if len(self.pairs) else np.zeros(len(pair), dtype=bool)
        for c in (0, 1):
            p = self.kept[c][context] * self.chance[c][at]
            p[hit] += self.direct[c][spot[hit]]
            chances.append(p)
        logs = np.log(1 - MIXED + MIXED * chances[1] / chances[0])
        sums = np.r_[0.0, np.cumsum(logs)]
        return sums[found.first[1:]] - sums[found.first[:-1]], found.counts

    def score(self, ratio: np.ndarray, n: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_inputs(ratio, n) @ np.array(self.curve), -50, 50)))


def _inputs(ratio: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The two normalisations by length: per word, and per root of the number of words."""
    n = np.maximum(n, 1)
    return np.column_stack([10 * ratio / n, ratio / np.sqrt(n), np.ones(len(n))])


def _discounted(counts: np.ndarray, total) -> tuple[np.ndarray, float]:
    """Shares after the absolute discount n1 / (n1 + 2 n2), and what they leave for the backoff."""
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    discount = min(max(once / max(once + 2 * twice, 1), 0.5), 0.95)
    share = np.maximum(counts - discount, 0) / total
    return share, float(1 - share.sum())


def count_bigrams(sample: DataFrame) -> DataFrame:
    """pair, v, w and how often each class (``ordinary``, ``toxic``) has word w after word v, from text and label."""
    return (
        sample.mapInArrow(_count, "pair bigint, v bigint, w bigint, ordinary bigint, toxic bigint")
        .groupBy("pair", "v", "w")
        .agg(*(F.sum(c).alias(c) for c in CLASSES))
    )


def word_table(counted: DataFrame) -> DataFrame:
    """Each word with, for both classes, after how many different words it is seen (``after``), how many
    different words follow it (``before``) and how many words do in all (``n``)."""
    seen = lambda c: F.count_if(F.col(c) > 0)
    after = counted.groupBy(F.col("w").alias("word")).agg(*(seen(c).alias(f"after_{c}") for c in CLASSES))
    before = counted.groupBy(F.col("v").alias("word")).agg(
        *(seen(c).alias(f"before_{c}") for c in CLASSES), *(F.sum(c).alias(f"n_{c}") for c in CLASSES)
    )
    return after.join(before, "word", "full").na.fill(0)


def kept_bigrams(counted: DataFrame, words: DataFrame) -> DataFrame:
    """Bigrams seen often enough, in contexts varied enough, to be told apart from the backoff."""
    varied = words.where(F.least(*(f"before_{c}" for c in CLASSES)) >= LEAST_FOLLOWERS).select(F.col("word").alias("v"))
    return counted.where(F.col("ordinary") + F.col("toxic") >= LEAST_BIGRAM).join(varied, "v")


def _column(frame: pd.DataFrame, name: str) -> np.ndarray:
    return frame[name].to_numpy(np.int64)


def build(table: pd.DataFrame, bigrams: pd.DataFrame) -> Model:
    """From the rows of ``word_table`` and ``kept_bigrams``."""
    words = _column(table, "word").view(np.uint64)
    by_word = np.argsort(words)
    words, size = words[by_word], len(words)
    after, n = (np.stack([_column(table, f"{x}_{c}")[by_word] for c in CLASSES]).astype(np.float64) for x in ("after", "n"))
    # Shared by both: in how many of the classes a word is seen, half of one for unknown words.
    shared = np.r_[np.maximum((after > 0).sum(axis=0), 0.5), 0.5]
    shared /= shared.sum()
    pairs = _column(bigrams, "pair").view(np.uint64)
    by_pair = np.argsort(pairs)
    context = np.searchsorted(words, _column(bigrams, "v").view(np.uint64)[by_pair])
    chance, kept, direct = [], [], []
    for c, name in enumerate(CLASSES):
        own, left = _discounted(after[c], after[c].sum())
        chance.append(np.r_[own, 0.0] + left * shared)
        share, _ = _discounted(_column(bigrams, name)[by_pair], np.maximum(n[c][context], 1))
        direct.append(share)
        kept.append(np.r_[1 - np.bincount(context, share, minlength=size), 1.0])
    start = int(np.searchsorted(words, START))
    start = start if start < size and words[start] == START else size
    return Model(words, np.array(chance), np.array(kept), pairs[by_pair], np.array(direct), start)


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Weighted logistic regression by Newton's method, with a small ridge."""
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -50, 50)))
        slope = (x * (p * (1 - p) * weight)[:, None]).T @ x + 1e-3 * np.eye(len(b))
        step = np.linalg.solve(slope, x.T @ (weight * (y - p)) - 1e-3 * b)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(b)


def _ratio(model: Broadcast, scored: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in t.slices(batch.column("text")):
                part = batch.slice(piece.lo, piece.hi - piece.lo).drop_columns(["text"])
                ratio, n = model.value.ratios(piece)
                out = {"score": pa.array(model.value.score(ratio, n))}
                if not scored:
                    out = {"ratio": pa.array(ratio), "n": pa.array(n.astype(np.int64))}
                yield pa.RecordBatch.from_arrays([*part.columns, *out.values()], names=[*part.schema.names, *out])

    return run


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, float]]:
    """text, label and fold of about ``per_class`` rows of each class; and the share taken of each."""
    known = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("label").cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = {c: min(1.0, per_class / counts[c]) for c in counts}
    place = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("toxicity")), 11) / float(2**53)
    limit = F.when(F.col("label") == 1, F.lit(share.get(1, 0.0))).otherwise(F.lit(share.get(0, 0.0)))
    # A table of its own: so small that it is broadcast by its size.
    chosen = staged(known.withColumn("place", place).where(F.col("place") < limit))
    fold = F.when(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0, 1).otherwise(0)
    short = docs.where(F.length("text").between(1, TRAIN_CHARS)).select("doc_id", "text")
    return staged(short.join(chosen, "doc_id").select("text", "label", fold.alias("fold"))), share


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    spark = docs.sparkSession
    sample, share = training_sample(docs, labels, per_class)
    counted = staged(count_bigrams(sample.where("fold = 0")))
    words = staged(word_table(counted))
    table = words.toPandas()
    if not (len(table) and all(table[f"after_{c}"].any() for c in CLASSES)):
        return Model(np.zeros(1, np.uint64), np.ones((2, 2)), np.ones((2, 2)), np.zeros(0, np.uint64), np.zeros((2, 0)), 1)
    model = build(table, kept_bigrams(counted, words).toPandas())
    send = spark.sparkContext.broadcast
    rest = sample.where("fold = 1").mapInArrow(_ratio(send(model), False), "label int, fold int, ratio double, n bigint").toPandas()
    x = _inputs(rest["ratio"].to_numpy(), rest["n"].to_numpy())
    y = rest["label"].to_numpy(np.float64)
    # Each row of the sample stands for as many as it was drawn from.
    weight = np.where(y == 1, 1 / share[1], 1 / share[0])
    model.curve = fit_curve(x, y, weight / weight.mean())
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, training: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and score of every document. ``labels`` has doc_id and label;
    ``training`` is the condition on the columns of ``docs`` for rows that may be learned from."""
    model = fit(docs.where(training), labels)
    source = docs.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.drop("text").schema.fields)
    return source.mapInArrow(_ratio(docs.sparkSession.sparkContext.broadcast(model), True), f"{schema}, score double")
