"""Removal of long word sequences that repeat across documents, by De Bruijn compaction.

Edges of the graph are k-mers of ``width`` words, each going from its first to its last
``width`` - 1 words. Only edges that can repeat are built: every edge has an anchor (the smallest
of the hashes of the ``anchor``-word runs in it, the same wherever the edge occurs), and an edge counts only
if its anchor occurs in two documents. Consecutive edges of a document with one anchor form a path, known by
the hash of all words it spans.

Joins compact the repeated paths: a path that recurs whole, its edges always together, is nonbranching
and is settled at once by its source, the smallest doc_id (with the start there) that holds it.
Where paths of one anchor branch, that is where a path has no smaller source as a whole though its anchor
has, the edges of the paths of that anchor are looked up one by one. A path settled
before need not take part: its source holds the same edges under a smaller doc_id.

A document with a smaller doc_id keeps the text; words of later spans go. Anchors of all documents
are counted in Spark; what the driver gets of them is a bit map of fixed size, a filter that
only saves work: an edge that passes it by chance has a single document and is not repeated.

Defined cases: a null text has no words; a null doc_id neither removes nor loses words; rows with
the same doc_id do not remove one another; texts shorter than ``width`` words stay whole.
Paths are compared by 64 + 32 bits of two hashes, single edges by 64.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm import text as t
from fleetmeter.llm.stages import staged

#: Smallest and largest size of the anchor filter, as a power of two in bits: 128 KB to 64 MB.
FILTER_BITS = (20, 29)
CHUNK_BITS = 8


def _edges(piece: t.Slice, width: int, anchor: int):
    """Words, word hashes, for each position the anchor of its edge, and which edges lie in one text."""
    found = t.words(piece.data, piece.starts, t.BLANK_SEPARATED)
    hashes = t.word_hashes(piece.data, found)
    whole = t.whole_windows(found.first, width)
    runs = t.window_hashes(hashes, anchor, seed=31)
    anchors = t.sliding_min(runs, width - anchor + 1) if len(whole) else np.zeros(0, np.uint64)
    return found, hashes, anchors, whole


def _anchors(width: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for piece in t.slices(batch.column("text")):
                found, _, anchors, whole = _edges(piece, width, anchor)
                owner = found.owner()[: len(whole)]
                at = np.flatnonzero(whole)
                # An anchor serves a run of edges: one row for the run is enough.
                value, doc = anchors[at], owner[at]
                new = np.ones(len(at), dtype=bool)
                new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[new].view(np.int64)), pa.array(ids[piece.lo + doc[new]].astype(np.int64))],
                    ["anchor", "doc_id"],
                )

    return run


def _chunk_maps(bits: int):
    """One bit map for each chunk of the hash range, from the anchors of that chunk."""
    low = bits - CHUNK_BITS

    def run(table: pa.Table) -> pa.Table:
        index = table.column("slot").combine_chunks().to_numpy(zero_copy_only=False)
        flags = np.zeros(1 << low, dtype=bool)
        flags[index & ((1 << low) - 1)] = True
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "map": pa.array([np.packbits(flags).tobytes()])})

    return run


def _filter_of(keys: DataFrame, column: str) -> tuple:
    """A bit map, broadcast, in which the keys (hashes) are marked; and its size as a power of two."""
    bits = min(max(FILTER_BITS[0], math.ceil(math.log2(8 * keys.count() + 1))), FILTER_BITS[1])
    # The low bits: an anchor is the smallest of several hashes, so its high ones are mostly 0.
    slot = F.col(column).bitwiseAND((1 << bits) - 1)
    chunk = F.shiftright(slot, bits - CHUNK_BITS).cast("int")
    # Distinct slots first: at most 2^bits of them, whatever the number of keys.
    maps = (
        keys.select(chunk.alias("chunk"), slot.alias("slot"))
        .distinct()
        .groupBy("chunk")
        .applyInArrow(_chunk_maps(bits), "chunk int, map binary")
    )
    flags = np.zeros(1 << bits, dtype=np.uint8)
    size = len(flags) >> CHUNK_BITS
    for row in maps.toLocalIterator():
        flags[row.chunk * size : (row.chunk + 1) * size] = np.unpackbits(np.frombuffer(row.map, np.uint8))
    return keys.sparkSession.sparkContext.broadcast(np.packbits(flags)), bits


def _marked(packed: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    slot = (keys & t.U64((1 << bits) - 1)).astype(np.int64)
    return ((packed[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1) > 0


def _repeated_anchors(docs: DataFrame, width: int, anchor: int) -> DataFrame:
    """Anchors that occur in two documents."""
    found = docs.mapInArrow(_anchors(width, anchor), "anchor bigint, doc_id bigint")
    ranges = found.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    return staged(ranges.where("lo < hi").select("anchor"))


def _candidate_paths(width: int, anchor: int, filter_bits, bits: int):
    """Paths of each text whose anchor passes the filter, with the hashes of their edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = filter_bits.value
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            rows = batch.column("row").to_numpy(zero_copy_only=False)
            for piece in t.slices(batch.column("text")):
                found, hashes, anchors, whole = _edges(piece, width, anchor)
                at = np.flatnonzero(whole & _marked(packed, bits, anchors))
                doc = found.owner()[at]
                new = np.ones(len(at), dtype=bool)
                new[1:] = (np.diff(at) != 1) | (np.diff(doc) != 0) | (anchors[at[1:]] != anchors[at[:-1]])
                first = np.flatnonzero(new)
                begin, doc = at[first], doc[first]
                size = np.diff(np.r_[first, len(at)])
                end = begin + size + width - 1
                path = t.span_hashes(hashes, begin, end)
                proof = (t.span_hashes(hashes, begin, end, seed=47) >> t.U64(32)).astype(np.uint32)
                edges = t.window_hashes(hashes, width)[at].view(np.int64)
                number = ids[piece.lo + doc].astype(np.int64).view(np.uint64)
                label = t.mix(t.mix(path + number) + begin.astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(label.view(np.int64)),
                        pa.array(anchors[begin].view(np.int64)),
                        pa.array(path.view(np.int64)),
                        pa.array(proof.view(np.int32)),
                        pa.array(ids[piece.lo + doc].astype(np.int64)),
                        pa.array(rows[piece.lo + doc]),
                        pa.array((begin - found.first[doc]).astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.r_[first, len(at)].astype(np.int32)), pa.array(edges)),
                    ],
                    ["label", "anchor", "path", "proof", "doc_id", "row", "start", "edges"],
                )

    return run


def _edges_of(chosen, bits: int):
    """The edges, one by one, of the paths whose label is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("label").to_numpy().view(np.uint64)
            part = batch.filter(pa.array(_marked(chosen.value, bits, keys)))
            edges = part.column("edges")
            of = edges.value_parent_indices().to_numpy(zero_copy_only=False)
            size = np.bincount(of, minlength=len(part))
            k = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
            rows = part.select(["doc_id", "row"]).take(pa.array(of))
            start = part.column("start").to_numpy(zero_copy_only=False)[of] + k
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(start.astype(np.int32)), edges.flatten()], ["doc_id", "row", "start", "edge"]
            )

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with one doc_id and several texts are told apart by a hash of the text."""
    return docs.select("doc_id", "text", F.hash("text").alias("row"))


def repeated_spans(docs: DataFrame, width: int = 50, anchor: int = 20) -> DataFrame:
    """Spans of edges to remove: doc_id, row (a hash of the text), start, n_edges, and the
    document they repeat, source_id."""
    known = _keyed(docs).where("doc_id is not null and text is not null")
    found, bits = _filter_of(_repeated_anchors(known, width, anchor), "anchor")
    paths = staged(
        known.mapInArrow(
            _candidate_paths(width, anchor, found, bits),
            "label bigint, anchor bigint, path bigint, proof int, doc_id bigint, row int, start int, edges array<bigint>",
        )
    )
    key = ["path", "proof"]
    light = paths.select("label", "anchor", *key, "doc_id", "row", "start", F.size("edges").alias("n_edges"))
    sources = light.groupBy(*key).agg(F.min("doc_id").alias("source_id"), F.max("doc_id").alias("_last"))
    sources = sources.where("source_id < _last").drop("_last")
    placed = staged(light.join(sources, key, "left").drop(*key))
    whole = placed.where("source_id < doc_id").select("doc_id", "row", "start", "n_edges", "source_id")
    # Anchors at which paths branch: a path without a smaller source, though its anchor has one.
    own = placed.where("source_id is null or source_id = doc_id").select("label", "anchor", "doc_id")
    least = placed.groupBy("anchor").agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most"))
    branches = own.join(least.where("_least < _most"), "anchor").where("doc_id > _least").select("anchor").distinct()
    chosen, chosen_bits = _filter_of(staged(own.join(branches, "anchor", "left_semi").select("label")), "label")
    edges = paths.select("label", "doc_id", "row", "start", "edges").mapInArrow(
        _edges_of(chosen, chosen_bits), "doc_id bigint, row int, start int, edge bigint"
    )
    owners = edges.groupBy("edge").agg(F.min("doc_id").alias("source_id"), F.max("doc_id").alias("_last"))
    owners = owners.where("source_id < _last").drop("_last")
    single = edges.join(owners, "edge").where("source_id < doc_id")
    single = single.select("doc_id", "row", "start", F.lit(1).alias("n_edges"), "source_id")
    return whole.unionByName(single)


def _drop_spans(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans")
            for piece in t.slices(batch.column("text")):
                found = t.words(piece.data, piece.starts, t.BLANK_SEPARATED)
                part = spans.slice(piece.lo, piece.hi - piece.lo)
                of = part.value_parent_indices().to_numpy(zero_copy_only=False)
                flat = part.flatten()
                start = found.first[of] + flat.field("start").to_numpy(zero_copy_only=False)
                end = start + flat.field("n_edges").to_numpy(zero_copy_only=False) + width - 1
                gone = t.covered(start, end, len(found.begin))
                kept = t.joined(piece.data, found, ~gone)
                removed = np.add.reduceat(np.r_[gone, False].astype(np.int64), found.first[:-1]) * (found.counts > 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(piece.lo, piece.hi - piece.lo),
                        pa.array(found.counts.astype(np.int64)),
                        pa.array(removed.astype(np.int64)),
                        pa.array([k.decode("utf-8") for k in kept]),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    return run


def remove_repeats(docs: DataFrame, width: int = 50, anchor: int = 20) -> DataFrame:
    """Documents without repeated sequences: doc_id, n_words, n_removed, kept text."""
    spans = (
        repeated_spans(docs, width, anchor)
        .groupBy("doc_id", "row")
        .agg(F.collect_list(F.struct("start", "n_edges")).alias("spans"))
    )
    none = F.array().cast("array<struct<start:int,n_edges:int>>")
    joined = _keyed(docs).join(spans, ["doc_id", "row"], "left").select("doc_id", "text", F.coalesce("spans", none).alias("spans"))
    return joined.mapInArrow(_drop_spans(width), "doc_id bigint, n_words bigint, n_removed bigint, kept string")
