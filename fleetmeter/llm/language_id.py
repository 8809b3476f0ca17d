"""Language identification by a string kernel.

Texts are compared by the blended-spectrum presence kernel: the number of distinct character
1-, 2- and 3-grams that two texts share, normalised by the geometric mean of their own numbers.
Nystroem landmarks approximate it: a text is represented by its kernel values against the
landmarks, transformed by the inverse root of the landmarks' own kernel matrix. On top, one-versus-rest kernel
ridge regression gives a value per language. Scoring is two matrix products for a batch of texts:
presence of n-grams x landmarks, then kernel values x languages.

Characters are folded first: lower case, and everything that is not a letter counts as one
blank. Only n-grams of the landmarks count, so whole texts of any length need a row of fixed size.

The model is fitted on a bounded sample: ``per_language`` labelled rows of each language, chosen by a hash of doc_id,
of at most ``TRAIN_CHARS`` characters each; the first ``landmarks`` of each language serve as landmarks. At most
``LANGUAGES`` languages are learned, the most frequent ones. Every text is then scored whole.

Defined cases: a text that is null or has no letter is ``und`` with score 0; so is every text if
there is nothing to learn from. Ties go to the first language in alphabetical order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from fleetmeter.llm import text as t

PER_LANGUAGE = 400
LANDMARKS = 40
LANGUAGES = 100
TRAIN_CHARS = 20_000
#: Letters told apart: the most frequent of the landmarks; all others share one code.
ALPHABET = 250
RIDGE = 1e-2
UNKNOWN = "und"
#: Bytes of text, and texts, that are scored together.
SLICE = 1 << 20
ROWS = 512


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter, and its lower case if that is one code point."""
    lower = np.arange(0x110000, dtype=np.uint32)
    letter = np.zeros(0x110000, dtype=bool)
    for c in range(0x110000):
        if chr(c).isalpha():
            letter[c] = True
            low = chr(c).lower()
            if len(low) == 1:
                lower[c] = ord(low)
    return letter, lower


def _code_points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode("utf-8").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _folded(codes: np.ndarray) -> np.ndarray:
    """Lower-cased letters, 0 for each run of anything else, one 0 at both ends."""
    letter, lower = _letters()
    plain = np.where(letter[codes], lower[codes], 0)
    plain = np.r_[np.uint32(0), plain, np.uint32(0)]
    return plain[np.r_[True, (plain[1:] != 0) | (plain[:-1] != 0)]]


@dataclass
class Model:
    languages: list[str]
    alphabet: np.ndarray  # letter code of each code point; 0 blank
    pairs: np.ndarray  # [code, code] -> pair number, or the last number if no landmark has it
    grams: np.ndarray  # [pair, code] -> column of the 3-gram, or -1
    pair_column: np.ndarray
    letter_column: np.ndarray
    presence: np.ndarray  # n-grams x landmarks, 0 or 1
    norms: np.ndarray  # root of each landmark's number of n-grams
    weights: np.ndarray  # landmarks x languages

    def kernel(self, texts: list[np.ndarray]) -> np.ndarray:
        """Normalised kernel of folded texts against the landmarks."""
        seen = np.zeros((len(texts), self.presence.shape[0] + 1), dtype=np.float32)
        codes = [self.alphabet[x] for x in texts]
        flat = np.concatenate(codes)
        row = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        seen[row, self.letter_column[flat]] = 1
        same = row[1:] == row[:-1]
        pair = self.pairs[flat[:-1], flat[1:]]
        seen[row[1:][same], self.pair_column[pair[same]]] = 1
        third = same[1:] & same[:-1]
        seen[row[2:][third], self.grams[pair[:-1][third], flat[2:][third]]] = 1
        seen = seen[:, :-1]
        norm = np.sqrt(np.maximum(seen.sum(axis=1), 1))
        return (seen @ self.presence) / norm[:, None] / self.norms

    def values(self, texts: list[np.ndarray]) -> np.ndarray:
        return self.kernel(texts) @ self.weights


def _tables(landmarks: list[np.ndarray]) -> Model:
    """n-gram tables of the landmarks, without weights. The last column is for n-grams none has."""
    letters, n = np.unique(np.concatenate(landmarks), return_counts=True)
    letters, n = letters[letters > 0], n[letters > 0]
    best = np.sort(letters[np.argsort(-n, kind="stable")[:ALPHABET]])
    alphabet = np.where(_letters()[0], ALPHABET + 1, 0).astype(np.int16)
    alphabet[best] = np.arange(1, len(best) + 1)
    size = ALPHABET + 2
    codes = [alphabet[x].astype(np.int64) for x in landmarks]
    grams = [np.unique(np.concatenate([c, size + c[:-1] * size + c[1:], size + size**2 + (c[:-2] * size + c[1:-1]) * size + c[2:]])) for c in codes]
    columns = np.unique(np.concatenate(grams))
    presence = np.zeros((len(columns), len(codes)), dtype=np.float32)
    for k, g in enumerate(grams):
        presence[np.searchsorted(columns, g), k] = 1
    none = len(columns)
    letter_column = np.full(size, none, dtype=np.int32)
    one = columns < size
    letter_column[columns[one]] = np.flatnonzero(one)
    two = (columns >= size) & (columns < size + size**2)
    pair_values = columns[two] - size
    pairs = np.full((size, size), len(pair_values), dtype=np.int32)
    pairs[pair_values // size, pair_values % size] = np.arange(len(pair_values))
    pair_column = np.r_[np.flatnonzero(two), none].astype(np.int32)
    three = columns >= size + size**2
    values = columns[three] - size - size**2
    table = np.full((len(pair_values) + 1, size), none, dtype=np.int32)
    head = values // size
    table[pairs[head // size, head % size], values % size] = np.flatnonzero(three)
    return Model([], alphabet, pairs, table, pair_column, letter_column, presence, np.sqrt(presence.sum(axis=0)), np.zeros(0))


def fit(rows: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """From (language, text) rows in an order that does not depend on their content."""
    texts = [_folded(_code_points(text.encode("utf-8"))) for _, text in rows]
    usable = [k for k, x in enumerate(texts) if x.any()]
    names = sorted({rows[k][0] for k in usable})
    if not names:
        return None
    chosen = [k for name in names for k in [k for k in usable if rows[k][0] == name][:landmarks]]
    model = _tables([texts[k] for k in chosen])
    kernel = np.vstack([model.kernel([texts[k] for k in usable[i : i + ROWS]]) for i in range(0, len(usable), ROWS)]).astype(np.float64)
    own = model.kernel([texts[k] for k in chosen]).astype(np.float64)
    value, vector = np.linalg.eigh((own + own.T) / 2)
    good = value > 1e-6 * value.max()
    root = vector[:, good] / np.sqrt(value[good])
    features = kernel @ root
    target = np.array([[rows[k][0] == name for name in names] for k in usable], dtype=np.float64)
    # Each language weighs the same, however many rows it has.
    weight = (1 / target.sum(axis=0))[target.argmax(axis=1)][:, None] * len(usable) / len(names)
    gram = features.T @ (features * weight) + ridge * len(usable) * np.eye(features.shape[1]) / 100
    model.weights = (root @ np.linalg.solve(gram, features.T @ (target * weight))).astype(np.float32)
    model.languages = names
    return model


def training_sample(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, str]]:
    """About ``per_language`` rows of each language, chosen and ordered by a hash of doc_id."""
    known = labelled.where(F.col("lang").isNotNull() & F.length("text").between(1, TRAIN_CHARS))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return []
    share: Column = F.lit(0.0)
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, per_language / r["n"]))).otherwise(share)
    place = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("language")), 11) / float(2**53)
    rows = known.select("lang", "text", place.alias("place")).where(F.col("place") < share).collect()
    return [(r["lang"], r["text"]) for r in sorted(rows, key=lambda r: (r["place"], r["lang"], r["text"]))]


def _predict(model, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Model | None = model.value
        for batch in batches:
            for piece in t.slices(batch.column("text"), SLICE):
                raw, cut = piece.data.tobytes(), piece.starts.tolist()
                n = piece.hi - piece.lo
                name, score = np.full(n, UNKNOWN, dtype=object), np.zeros(n)
                folded = [_folded(_code_points(raw[b:e])) for b, e in zip(cut[:-1], cut[1:], strict=True)]
                some = [k for k, x in enumerate(folded) if x.any()]
                for i in range(0, len(some) if fitted else 0, ROWS):
                    rows = some[i : i + ROWS]
                    value = fitted.values([folded[k] for k in rows])
                    best = value.argmax(axis=1)
                    name[rows] = np.array(fitted.languages, dtype=object)[best]
                    score[rows] = np.clip(value[np.arange(len(rows)), best], 0, 1)
                part = batch.slice(piece.lo, n)
                part = part if with_text else part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(name, pa.string()), pa.array(score)], names=[*part.schema.names, "_lang", "_score"]
                )

    return run


def identify(docs: DataFrame, model: Model | None, with_text: bool = True) -> DataFrame:
    """All columns of ``docs``, without its text if so asked, with lang_pred and score."""
    names = {c: "text" if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*names.values())
    kept = {c: n for c, n in names.items() if with_text or n != "text"}
    fields = plain.select(*kept.values()).schema.fields
    schema = StructType([*fields, StructField("_lang", StringType()), StructField("_score", DoubleType())])
    found = plain.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model), with_text), schema)
    back = [F.col(n).alias(c) for c, n in kept.items() if c not in ("lang_pred", "score")]
    return found.select(*back, F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))
