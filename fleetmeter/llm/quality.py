"""Quality scores: random Fourier features over document statistics, ridge, isotonic calibration.

Every text is read whole once and becomes a row of ``STATISTICS``; the rows are written to the
shared folder and all further steps start from there. Statistics are standardised with means and
deviations over the training rows. Random Fourier features of the standardised statistics approximate a Gaussian
kernel. The normal equations of ridge regression are summed within each partition, then over the
partitions row by row of the matrix, so that the driver gets one matrix of fixed size. Isotonic regression
on the raw scores, counted in ``BINS`` bins over all training rows, makes them probabilities.

Defined cases: null and empty texts are rows of zeros and get a score as any other; without
training rows every score is 0.5; rows that repeat a doc_id in ``labels`` count each; null labels
or ids are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm import text as t
from fleetmeter.llm.stages import staged

FEATURES = 256
BANDWIDTH = 1.5
RIDGE = 1e-4
BINS = 4000
SEED = 7

_UPPER, _LOWER, _DIGIT, _BLANK, _LINE, _STOP, _COMMA, _BANG, _BAR, _MARK, _CODE, _SIGN, _OTHER = range(13)
CLASSES = 13
BYTE_CLASS = np.full(256, _OTHER, dtype=np.int64)
for _chars, _kind in (
    (range(65, 91), _UPPER),
    (range(97, 123), _LOWER),
    (range(48, 58), _DIGIT),
    (b" \t\r\v\f", _BLANK),
    (b"\n", _LINE),
    (b".?", _STOP),
    (b",;:", _COMMA),
    (b"!", _BANG),
    (b"|", _BAR),
    (b"#$%&*^~", _MARK),
    (b"<>{}[]()=\\/_", _CODE),
    (b"@+-'\"`", _SIGN),
):
    BYTE_CLASS[list(_chars)] = _kind
STATISTICS = CLASSES + 11


def statistics(piece: t.Slice) -> np.ndarray:
    """One row per text: shares of byte classes, and lengths and repetition of words and lines."""
    data, docs = piece.data, piece.hi - piece.lo
    length = np.diff(piece.starts)
    of = np.repeat(np.arange(docs), length)
    classes = np.bincount(of * CLASSES + BYTE_CLASS[data], minlength=docs * CLASSES).reshape(docs, CLASSES)
    found = t.words(data, piece.starts, t.BLANK_SEPARATED)
    owner, n = found.owner(), np.maximum(found.counts, 1)
    size = (found.end - found.begin).astype(np.float64)
    per_text = lambda weights: np.bincount(owner, weights, minlength=docs) / n
    mean = per_text(size)
    lines = t.words(data, piece.starts, np.arange(256) != 10)

    def distinct(spans: t.Words) -> np.ndarray:
        key = (spans.owner() << 40) | (t.word_hashes(data, spans) >> np.uint64(24)).astype(np.int64)
        return np.bincount(np.unique(key) >> 40, minlength=docs) / np.maximum(spans.counts, 1)

    last = data[found.end - 1]
    out = np.empty((docs, STATISTICS), dtype=np.float32)
    out[:, :CLASSES] = classes / np.maximum(length, 1)[:, None]
    out[:, CLASSES:] = np.stack(
        [
            np.log1p(length),
            np.log1p(found.counts),
            np.log1p(lines.counts),
            mean,
            np.sqrt(np.maximum(per_text(size**2) - mean**2, 0)),
            per_text((size <= 3).astype(float)),
            per_text((size >= 12).astype(float)),
            per_text((BYTE_CLASS[last] == _MARK).astype(float) + (BYTE_CLASS[last] == _BANG)),
            per_text(((data[found.begin] >= 65) & (data[found.begin] <= 90)).astype(float)),
            distinct(found),
            distinct(lines),
        ],
        axis=1,
    )
    return out


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in t.slices(batch.column("text")):
            rows = statistics(piece)
            part = batch.slice(piece.lo, piece.hi - piece.lo).drop_columns(["text"])
            values = pa.ListArray.from_arrays(
                pa.array(np.arange(len(rows) + 1, dtype=np.int32) * STATISTICS), pa.array(rows.ravel())
            )
            yield pa.RecordBatch.from_arrays([*part.columns, values], names=[*part.schema.names, "statistics"])


def measured(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    source = docs.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.drop("text").schema.fields)
    return source.mapInArrow(_measure, f"{schema}, statistics array<float>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: np.ndarray  # raw scores, and the calibrated values there
    values: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        directions = rng.normal(size=(STATISTICS, FEATURES)) / (BANDWIDTH * np.sqrt(STATISTICS))
        phases = rng.uniform(0, 2 * np.pi, FEATURES)
        x = np.clip((rows - self.mean) / self.scale, -5, 5)
        z = np.sqrt(2 / FEATURES) * np.cos(x @ directions + phases)
        return np.hstack([z, np.ones((len(rows), 1))])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.features(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(rows), self.steps, self.values)


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("statistics").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, STATISTICS).astype(np.float64)


def _normal_equations(model: Broadcast):
    """Rows of Z'Z with Z'y as a further column, summed over the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = model.value.features(_rows(batch))
            y = batch.column("label").to_numpy(zero_copy_only=False)
            total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array([r.tobytes() for r in total])], ["i", "sums"]
        )

    return run


def _add(table: pa.Table) -> pa.Table:
    total = np.zeros(FEATURES + 2)
    for row in table.column("sums"):
        total += np.frombuffer(row.as_buffer())
    return pa.table({"i": table.column("i").slice(0, 1), "sums": pa.array([total.tobytes()])})


def _apply(model: Broadcast, of: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = getattr(model.value, of)(_rows(batch))
            part = batch.drop_columns(["statistics"])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values)], names=[*part.schema.names, name])

    return run


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the centres of the blocks of a rising fit, and their values."""
    blocks: list[list[float]] = []
    for a, b, w in zip(x.tolist(), y.tolist(), weight.tolist(), strict=True):
        blocks.append([a * w, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], top, strict=True)]
    sums = np.array(blocks)
    return sums[:, 0] / sums[:, 2], sums[:, 1] / sums[:, 2]


def fit(training: DataFrame) -> Model:
    """From rows of statistics and label (0 or 1)."""
    spark = training.sparkSession
    columns = [F.col("statistics")[k] for k in range(STATISTICS)]
    sums = training.agg(F.count(F.lit(1)), *map(F.avg, columns), *map(F.stddev_pop, columns)).first()
    model = Model(np.zeros(STATISTICS), np.ones(STATISTICS), np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))
    if not sums[0]:
        return model
    model.mean = np.array(sums[1 : 1 + STATISTICS], dtype=np.float64)
    deviation = np.array(sums[1 + STATISTICS :], dtype=np.float64)
    model.scale = np.where(deviation > 1e-9, deviation, 1.0)
    send = spark.sparkContext.broadcast
    partial = training.select("statistics", "label").mapInArrow(_normal_equations(send(model)), "i int, sums binary")
    total = np.zeros((FEATURES + 1, FEATURES + 2))
    for r in partial.groupBy("i").applyInArrow(_add, "i int, sums binary").collect():
        total[r.i] = np.frombuffer(r.sums)
    gram, target = total[:, :-1], total[:, -1]
    model.weights = np.linalg.solve(gram + RIDGE * sums[0] * np.eye(len(gram)), target)
    raw = training.select("statistics", "label").mapInArrow(_apply(send(model), "raw", "raw"), "label double, raw double")
    place = F.round(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), "raw")) * (BINS / 3)).cast("int")
    bins = raw.groupBy(place.alias("place")).agg(F.avg("raw").alias("x"), F.avg("label").alias("y"), F.count(F.lit(1)).alias("n"))
    found = bins.orderBy("place").collect()
    model.steps, model.values = isotonic(*(np.array([r[c] for r in found], dtype=np.float64) for c in ("x", "y", "n")))
    return model


def score_quality(docs: DataFrame, labels: DataFrame, training: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns (doc_id among them) and score of every document. ``labels`` has doc_id
    and label; ``training`` is the condition on the kept columns for rows that may be learned from."""
    spark = docs.sparkSession
    table = staged(measured(docs, keep))
    known = labels.select("doc_id", F.col("label").cast("double").alias("label")).where("label is not null")
    model = fit(staged(table.where(training).select("doc_id", "statistics").join(known, "doc_id").select("statistics", "label")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.drop("statistics").schema.fields)
    return table.mapInArrow(_apply(spark.sparkContext.broadcast(model), "score", "score"), f"{schema}, score double")
