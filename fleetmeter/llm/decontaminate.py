"""Benchmark decontamination by suffix arrays over shards of the training documents.

Each shard (a slice of whole documents in one task) gets an array of its word suffixes in
lexicographic order. Every test suffix, that is each run of ``width`` words of an item, or the
whole item if it is shorter, is binary-searched in it. The range found gives the places of the
match in the shard; each is then extended to the longest verbatim match. A suffix whose leading
words cannot start any test suffix cannot match and is left out of the array before sorting.

Test items are split into blocks of bounded size by a hash of their text; one block at a time is
broadcast to the shards, and the documents pass through all blocks without a shuffle. After
``BLOCKS_PER_PASS`` blocks what is known so far is written to the shared folder.

Words: A-Z lower-cased, then [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+. Matches are compared word by
word: ids come from a 64-bit hash of the word, and each matched word is compared byte by byte.

Defined cases: null or empty texts have no words and are clean; items without words match
nothing; a null item_id still marks documents but has no entry in the list of items; rows with
the same doc_id or item_id are separate rows, and an item_id counts once per document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm import text as t
from fleetmeter.llm.stages import staged

#: Bytes of test text in a block, about; blocks broadcast together before results are written.
BLOCK_BYTES = 8 << 20
BLOCKS_PER_PASS = 4


@dataclass
class Tests:
    """A block of test items: vocabulary, and the distinct test suffixes in sorted order."""

    vocabulary: np.ndarray  # sorted word hashes; a word's id is its place here + 1
    spelling: list[bytes]
    keys: np.ndarray  # test suffixes as big-endian ids, padded with zero bytes
    lengths: np.ndarray
    item_words: np.ndarray  # ids of all items one after another, a 0 after each
    places: np.ndarray  # where each distinct test suffix first starts in item_words
    items: list[list[str]]  # ids of the items that hold each test suffix
    firsts: dict[int, np.ndarray]  # by length: flags of the ids that begin such a suffix


def _words_of(texts: list[str | None]):
    column = pa.array(texts, pa.string())
    for piece in t.slices(column):
        data = t.LOWER[piece.data]
        found = t.words(data, piece.starts, t.ALPHANUMERIC)
        yield piece, data, found, t.word_hashes(data, found)


def prepare(rows: list[tuple[str | None, str | None]], width: int) -> Tests:
    sequences: list[np.ndarray] = []
    spelled: dict[int, bytes] = {}
    for _, data, found, hashes in _words_of([text for _, text in rows]):
        raw = data.tobytes()
        for h, b, e in zip(hashes.tolist(), found.begin.tolist(), found.end.tolist(), strict=True):
            if spelled.setdefault(h, raw[b:e]) != raw[b:e]:
                raise ValueError("two words of one block share a hash; use another seed")
        sequences += np.split(hashes, found.first[1:-1])
    vocabulary = np.array(sorted(spelled), dtype=np.uint64)
    spelling = [spelled[h] for h in vocabulary.tolist()]
    joined, places, holders = [np.zeros(0, np.int32)], {}, {}
    at = 0
    for (item, _), hashes in zip(rows, sequences, strict=True):
        ids = (np.searchsorted(vocabulary, hashes) + 1).astype(np.int32)
        size = min(width, len(ids))
        for p in range(len(ids) - size + 1 if size else 0):
            key = ids[p : p + size].astype(">u4").tobytes()
            places.setdefault(key, at + p)
            holders.setdefault(key, set())
            if item is not None:
                holders[key].add(item)
        joined += [ids, np.zeros(1, np.int32)]
        at += len(ids) + 1
    order = sorted(places)
    lengths = np.array([len(k) // 4 for k in order], dtype=np.int64)
    firsts = {}
    for n in np.unique(lengths).tolist():
        flags = np.zeros(len(vocabulary) + 2, dtype=bool)
        flags[[int.from_bytes(k[:4], "big") for k in order if len(k) == 4 * n]] = True
        firsts[n] = flags
    return Tests(
        vocabulary,
        spelling,
        np.array(order, dtype=f"S{4 * width}"),
        lengths,
        np.concatenate(joined),
        np.array([places[k] for k in order], dtype=np.int64),
        [sorted(holders[k]) for k in order],
        firsts,
    )


def _ids(tests: Tests, hashes: np.ndarray) -> np.ndarray:
    """Vocabulary ids; words unknown to the tests get the id after the last."""
    at = np.searchsorted(tests.vocabulary, hashes)
    at[at == len(tests.vocabulary)] = 0
    known = tests.vocabulary[at] == hashes
    return np.where(known, at + 1, len(tests.vocabulary) + 1).astype(np.int32)


def _suffix_array(tests: Tests, ids: np.ndarray, first: np.ndarray, width: int):
    """Starts of the shard's suffixes that can match, in lexicographic order, and their leading words."""
    n = len(ids)
    known = ids <= len(tests.vocabulary)
    unknown_before = np.r_[0, np.cumsum(~known)]
    text_end = np.repeat(first[1:], np.diff(first))
    can = np.zeros(n, dtype=bool)
    for size, flags in tests.firsts.items():
        at = np.flatnonzero(flags[ids])
        at = at[at + size <= text_end[at]]
        can[at[unknown_before[at + size] == unknown_before[at]]] = True
    starts = np.flatnonzero(can)
    reach = starts[:, None] + np.arange(width)
    leading = np.where(reach < text_end[starts][:, None], ids[np.minimum(reach, n - 1)], 0)
    keys = np.ascontiguousarray(leading.astype(">u4")).view(f"S{4 * width}").ravel()
    order = np.argsort(keys, kind="stable")
    return starts[order], keys[order], text_end


def _search(tests: Tests, keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Range of the suffix array that begins with each test suffix.

    Each leading word of a suffix is 4 bytes, so the upper end is found with the padding at its highest.
    """
    lo = np.searchsorted(keys, tests.keys, side="left")
    upper = np.frombuffer(tests.keys.tobytes(), np.uint8).reshape(-1, 4 * width).copy()
    upper[np.arange(4 * width) >= 4 * tests.lengths[:, None]] = 255
    hi = np.searchsorted(keys, upper.view(f"S{4 * width}").ravel(), side="right")
    return lo, hi


def _longest(tests: Tests, ids: np.ndarray, text_end: np.ndarray, at: np.ndarray, test: np.ndarray) -> np.ndarray:
    """Words that match from each place on, beyond the test suffix as far as they go."""
    length = tests.lengths[test].copy()
    open_ = np.arange(len(at))
    while len(open_):
        p, q = at[open_] + length[open_], tests.places[test[open_]] + length[open_]
        inside = p < text_end[at[open_]]
        open_, p, q = open_[inside], p[inside], q[inside]
        open_ = open_[ids[p] == tests.item_words[q]]
        length[open_] += 1
    return length


def _verify(tests: Tests, data: np.ndarray, found: t.Words, ids: np.ndarray, words: np.ndarray) -> None:
    raw = data.tobytes()
    for w, b, e in zip(ids[words].tolist(), found.begin[words].tolist(), found.end[words].tolist(), strict=True):
        if raw[b:e] != tests.spelling[w - 1]:
            raise ValueError("a document's word has the hash of another test word; use another seed")


def _match(blocks: list[Broadcast], width: int):
    state = pa.schema(
        [
            ("n_words", pa.int64()),
            ("longest", pa.int64()),
            ("hits", pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())]))),
            ("items", pa.list_(pa.string())),
            ("touched", pa.bool_()),
        ]
    )

    def shard(piece: t.Slice, old: list[dict]) -> list[dict]:
        data = t.LOWER[piece.data]
        found = t.words(data, piece.starts, t.ALPHANUMERIC)
        hashes = t.word_hashes(data, found)
        rows = [
            {"n_words": n, "longest": o["longest"] or 0, "hits": o["hits"] or [], "items": o["items"] or []}
            for n, o in zip(found.counts.tolist(), old, strict=True)
        ]
        for block in blocks:
            tests = block.value
            if not len(tests.keys) or not len(hashes):
                continue
            ids = _ids(tests, hashes)
            starts, keys, text_end = _suffix_array(tests, ids, found.first, width)
            lo, hi = _search(tests, keys, width)
            n = np.maximum(hi - lo, 0)
            test = np.repeat(np.arange(len(n)), n)
            at = starts[np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(len(test))]
            if not len(at):
                continue
            longest = _longest(tests, ids, text_end, at, test)
            hit = t.covered(at, at + tests.lengths[test], len(ids))
            _verify(tests, data, found, ids, np.flatnonzero(hit))
            # Hit words as maximal runs within one document.
            owner = found.owner()
            edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
            for b, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                while b < e:
                    d = owner[b]
                    stop = min(e, int(found.first[d + 1]))
                    rows[d]["hits"].append({"start": b - int(found.first[d]), "n": stop - b})
                    b = stop
            doc = owner[at]
            top = np.zeros(len(rows), np.int64)
            np.maximum.at(top, doc, longest)
            for d, w in zip(*np.unique(np.stack([doc, test]), axis=1), strict=True) if len(doc) else ():
                rows[d].setdefault("_tests", []).append(int(w))
            for d in np.unique(doc).tolist():
                mine = {i for w in rows[d].pop("_tests") for i in tests.items[w]}
                rows[d]["items"] = sorted({*rows[d]["items"], *mine})
                rows[d]["longest"] = max(rows[d]["longest"], int(top[d]))
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n not in state.names]
            for piece in t.slices(batch.column("text")):
                part = batch.slice(piece.lo, piece.hi - piece.lo)
                rows = shard(piece, part.select(["longest", "hits", "items"]).to_pylist())
                for r in rows:
                    r["touched"] = bool(r["hits"])
                found = pa.RecordBatch.from_pylist(rows, schema=state)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *found.columns], names=[*names, *state.names])

    return run


def test_blocks(items: DataFrame, width: int, block_bytes: int = BLOCK_BYTES) -> Iterator[Tests]:
    """The test items, a block of bounded size at a time."""
    known = items.select(F.col("item_id").cast("string").alias("item"), "text").where("text is not null")
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    block = F.pmod(F.xxhash64("text"), F.lit(n))
    for k in range(n):
        yield prepare([tuple(r) for r in known.where(block == k).collect()], width)


def find_matches(docs: DataFrame, items: DataFrame, width: int = 10, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and text of each document with n_words, longest (words of the longest
    verbatim match), hits (runs of hit words), items (ids of matching items) and touched."""
    spark = docs.sparkSession
    out = docs.select(
        *keep,
        "text",
        F.lit(0).cast("bigint").alias("n_words"),
        F.lit(0).cast("bigint").alias("longest"),
        F.array().cast("array<struct<start:int,n:int>>").alias("hits"),
        F.array().cast("array<string>").alias("items"),
        F.lit(False).alias("touched"),
    )
    waiting: list[Broadcast] = []
    for tests in test_blocks(items, width):
        if len(waiting) == BLOCKS_PER_PASS:
            out, waiting = staged(out.mapInArrow(_match(waiting, width), out.schema)), []
        waiting.append(spark.sparkContext.broadcast(tests))
    return out.mapInArrow(_match(waiting, width), out.schema)


def hit_words(hits: str = "hits") -> Column:
    """Number of words in the union of the runs."""
    places = F.transform(hits, lambda h: F.sequence(h["start"], h["start"] + h["n"] - 1))
    return F.size(F.array_distinct(F.flatten(places))).cast("bigint")


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """Documents without any match, with all their columns."""
    names = {c: "text" if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*names.values())
    clean = find_matches(plain, items, width, tuple(n for n in plain.columns if n != "text")).where("not touched")
    return clean.select(*(F.col(n).alias(c) for c, n in names.items()))
