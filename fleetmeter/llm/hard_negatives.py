"""Hard negatives by exact search over Hilbert-ordered blocks with zone maps.

Candidates are quantised to integers and written as Parquet blocks: one label each, in the order of
a Hilbert curve over their components, up to ``BLOCK`` rows. A block carries the smallest and
largest value of each dimension. For an anchor, interval arithmetic over these gives the least and
greatest inner product any row of the block can have; only blocks whose interval meets one of
the anchor's score windows are read, and all of their rows are scored.

A search runs twice. First each window reads the ``SEEDS`` blocks that look best; the score its k-th
row has by then narrows the window, and then every other block that may still hold a row of the
answer is read. So the answer is exact. Anchors are searched in groups that lie together on
the curve, blocks in chunks: a task has the anchors of one group and the zone maps of one page, or
the blocks of one chunk that its group needs. Neither side is ever in one place.

Defined cases: rows without a vec_id, label or vector, or with a null or non-finite component, take
no part. Components count as floor(scale * x), within 2^24 either way; shorter vectors have zeros at
their end. Of rows with the same vec_id the smallest (label, components) counts. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.llm.stages import partitions, staged

BLOCK = 256
SEEDS = 2
#: Bits of the curve in a dimension, and dimensions of the curve, those that vary most.
BITS, CURVE_DIMS = 2, 64
#: Anchors of a group, zone maps of a page and blocks of a chunk, on average.
GROUP, PAGE, CHUNK = 8192, 4096, 64
#: Anchors scored at once.
ROWS = 512
LIMIT = 1 << 24
LEAST, MOST = -(1 << 62), 1 << 62


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label and integer components ``q`` of the rows that take part."""
    value = F.col("embedding")
    finite = F.forall(value, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    whole = F.transform(
        value, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))).cast("int")
    )
    kept = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & value.isNotNull() & finite)
    each = kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.struct(F.col("label").cast("bigint").alias("label"), whole.alias("q")).alias("row"))
    return each.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.q")


def _matrix(column: pa.Array, dims: int, kind=np.int64, fill: int = 0) -> np.ndarray:
    """A row for each list, ``fill`` at its end."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(offsets)
    out = np.full((len(sizes), dims), fill, dtype=kind)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    out[row, at] = column.flatten().to_numpy()
    return out


def _moments(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, dims))
        for batch in batches:
            x = _matrix(batch.column("q"), dims, np.float64)
            sums += [x.sum(axis=0), (x * x).sum(axis=0)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(sums[0]), pa.array(sums[1])], ["dim", "total", "squares"])

    return run


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of rows of cell numbers below 2^bits, as bytes in big-endian order.

    The cells' axes are turned into the curve's transposed index by exchanging and inverting low
    bits from the highest bit down, then Gray-coded; the index takes one bit of each axis in turn.
    """
    x = cells.astype(np.uint32).copy()
    dims = x.shape[1]
    for bit in range(bits - 1, 0, -1):
        low = np.uint32((1 << bit) - 1)
        for d in range(dims):
            on = ((x[:, d] >> bit) & 1).astype(bool)
            x[on, 0] ^= low
            swap = np.where(on, 0, (x[:, 0] ^ x[:, d]) & low).astype(np.uint32)
            x[:, 0] ^= swap
            x[:, d] ^= swap
    x = np.bitwise_xor.accumulate(x, axis=1)
    flip = np.zeros(len(x), dtype=np.uint32)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[:, -1] >> bit) & 1, np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= flip[:, None]
    planes = [((x >> bit) & 1).astype(np.uint8) for bit in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1), axis=1)


def _curve(dims: int, axes: list[int], mean: np.ndarray, spread: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = 1 << (BITS - 1)
        for batch in batches:
            x = _matrix(batch.column("q"), dims, np.float64)[:, axes]
            cells = np.clip(np.floor((x - mean[axes]) / spread[axes] * half / 1.5) + half, 0, 2 * half - 1)
            index = hilbert_index(cells, BITS)
            raw = index.tobytes()
            width = index.shape[1]
            keys = pa.array([raw[i * width : (i + 1) * width] for i in range(len(index))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*batch.schema.names, "place"])

    return run


BLOCKS = "block bigint, label bigint, least_id bigint, ids array<bigint>, vectors binary, low array<int>, high array<int>"


def _cut(dims: int):
    """Blocks of the sorted rows of a task."""

    def block(table: pa.Table, number: int) -> pa.RecordBatch:
        x = _matrix(table.column("q"), dims)
        ids = table.column("vec_id").to_numpy()
        # Rows of a block go by id, which settles equal scores.
        by = np.argsort(ids)
        x, ids = x[by], ids[by]
        kind = np.int16 if np.abs(x).max(initial=0) < 1 << 15 else np.int32
        one = lambda values, kind: pa.array([values], kind)
        return pa.RecordBatch.from_arrays(
            [
                one((TaskContext.get().partitionId() << 32) | number, pa.int64()), one(table.column("label")[0].as_py(), pa.int64()),
                one(int(ids[0]), pa.int64()), one(ids, pa.list_(pa.int64())), one(x.astype(kind).tobytes(), pa.binary()),
                one(x.min(axis=0).astype(np.int32), pa.list_(pa.int32())), one(x.max(axis=0).astype(np.int32), pa.list_(pa.int32())),
            ],
            names=[c.split()[0] for c in BLOCKS.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = None, 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            while len(held):
                labels = held.column("label").to_numpy()
                run_length = int(np.argmax(labels != labels[0])) or len(labels)
                if run_length == len(labels) and run_length < BLOCK:
                    break
                n = min(run_length, BLOCK)
                yield block(held.slice(0, n), number)
                held, number = held.slice(n), number + 1
        if held is not None and len(held):
            yield block(held, number)

    return run


def zoned_blocks(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` as Parquet blocks in order of label and curve, and the number of dimensions."""
    dims = rows.agg(F.max(F.size("q"))).first()[0] or 1
    sums = rows.select("q").mapInArrow(_moments(dims), "dim int, total double, squares double")
    found = sums.groupBy("dim").agg(F.sum("total").alias("total"), F.sum("squares").alias("squares")).orderBy("dim").collect()
    n = max(rows.count(), 1)
    mean = np.array([r.total for r in found] or [0.0] * dims) / n
    spread = np.sqrt(np.maximum(np.array([r.squares for r in found] or [0.0] * dims) / n - mean**2, 0))
    axes = sorted(np.argsort(-spread, kind="stable")[:CURVE_DIMS].tolist())
    spread = np.maximum(spread, 1e-9)
    placed = rows.mapInArrow(_curve(dims, axes, mean, spread), "vec_id bigint, label bigint, q array<int>, place binary")
    ranged = placed.repartitionByRange(partitions(rows.sparkSession), "label", "place", "vec_id")
    ordered = ranged.sortWithinPartitions("label", "place", "vec_id").drop("place")
    return staged(ordered.mapInArrow(_cut(dims), BLOCKS)), dims


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of a with all of b, as whole numbers."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class _Anchors:
    """Anchors of a group in one table: their components, labels, and windows by slot."""

    def __init__(self, table: pa.Table, dims: int):
        self.ids = table.column("anchor_id").to_numpy()
        self.labels = table.column("label").to_numpy()
        self.q = _matrix(table.column("q"), dims)
        slots = int(np.max(np.diff(table.column("low").combine_chunks().offsets.to_numpy()), initial=0))
        # An anchor with fewer windows has empty ones at its end.
        self.low, self.high, self.last = (_matrix(table.column(c), slots, fill=f) for c, f in (("low", 1), ("high", 0), ("last", 0)))


def _intervals(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of q with any point between low and high."""
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    return _products(plus, low) + _products(minus, high), _products(plus, high) + _products(minus, low)


def _bounds(dims: int, same: bool, seeds: int):
    """For a group's anchors and a page of zone maps: block and anchors that need it. With ``seeds``, only
    the best so many blocks of each window, and for each how good it looks."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if len(left) and len(right):
            a = _Anchors(left, dims)
            blocks, labels, least = (right.column(c).to_numpy() for c in ("block", "label", "least_id"))
            low, high = (_matrix(right.column(c), dims) for c in ("low", "high"))
            for lo in range(0, len(a.ids), ROWS):
                part = slice(lo, lo + ROWS)
                least_score, most_score = _intervals(a.q[part], low, high)
                fits = (a.labels[part, None] == labels) == same
                need = np.zeros_like(fits)
                for s in range(a.low.shape[1]):
                    bottom, top, last = (x[part, s, None] for x in (a.low, a.high, a.last))
                    # A row with the window's lowest score only counts if its id is below the last one's.
                    meets = fits & (bottom <= top) & (least_score <= top) & ((most_score > bottom) | ((most_score == bottom) & (least < last)))
                    if not seeds:
                        need |= meets
                        continue
                    open_top = top >= MOST
                    looks = np.where(open_top, most_score, -np.abs((most_score + least_score) // 2 - top))
                    looks = np.where(meets, looks, LEAST)
                    best = np.lexsort((np.broadcast_to(least, looks.shape), -looks), axis=1)[:, :seeds]
                    at = np.arange(len(best))
                    for column in best.T:
                        good = looks[at, column] > LEAST
                        rows += [(b, [i], s, v) for b, i, v in zip(blocks[column[good]].tolist(), a.ids[part][good].tolist(), looks[at, column][good].tolist(), strict=True)]
                if not seeds:
                    rows += [(int(blocks[j]), a.ids[part][need[:, j]], 0, 0) for j in np.flatnonzero(need.any(axis=0))]
        block, anchors, slot, looks = zip(*rows, strict=True) if rows else ([], [], [], [])
        return pa.table(
            {
                "group": pa.array([key[0].as_py()] * len(rows), pa.int32()), "block": pa.array(block, pa.int64()),
                "anchors": pa.array(anchors, pa.list_(pa.int64())), "slot": pa.array(slot, pa.int32()), "looks": pa.array(looks, pa.int64()),
            }
        )

    return run


def _read(dims: int, k: int):
    """Of a group's anchors and the blocks they need: the best k rows of each window."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        best = [np.zeros(0, np.int64)] * 4
        if len(left) and len(right):
            a = _Anchors(left, dims)
            order = np.argsort(a.ids)
            floor = a.low.copy()
            for i in range(len(right)):
                ids = np.asarray(right.column("ids")[i].values)
                raw = right.column("vectors")[i].as_py()
                kind = np.int16 if len(raw) == 2 * len(ids) * dims else np.int32
                x = np.frombuffer(raw, dtype=kind).reshape(len(ids), dims).astype(np.int64)
                wanted = order[np.searchsorted(a.ids[order], np.asarray(right.column("anchors")[i].values))]
                for lo in range(0, len(wanted), ROWS):
                    part = wanted[lo : lo + ROWS]
                    score = _products(a.q[part], x)
                    other = a.ids[part, None] != ids
                    found = [best]
                    for s in range(a.low.shape[1]):
                        row, at = np.nonzero(other & (score >= floor[part, s, None]) & (score <= a.high[part, s, None]))
                        found.append([part[row], np.full(len(row), s), score[row, at], ids[at]])
                    best = [np.concatenate(c) for c in zip(*found, strict=True)]
                    by = np.lexsort((best[3], -best[2], best[1], best[0]))
                    best = [c[by] for c in best]
                    change = np.r_[True, (np.diff(best[0]) != 0) | (np.diff(best[1]) != 0)][: len(by)]
                    place = np.arange(len(by)) - np.maximum.accumulate(np.where(change, np.arange(len(by)), 0))
                    best = [c[place < k] for c in best]
                    full = place[place < k] == k - 1
                    floor[best[0][full], best[1][full]] = best[2][full]
            best[0] = a.ids[best[0]]
        return pa.table(
            {"anchor_id": pa.array(best[0], pa.int64()), "slot": pa.array(best[1], pa.int32()), "score": pa.array(best[2], pa.int64()), "vec_id": pa.array(best[3], pa.int64())}
        )

    return run


class ZonedSearch:
    """Exact best rows of score windows, over blocks of ``zoned_blocks``."""

    def __init__(self, rows: DataFrame):
        self.blocks, self.dims = zoned_blocks(rows)
        self.zones = self.blocks.select("block", "label", "least_id", "low", "high")
        self.n_blocks = self.blocks.count()
        self.parts = partitions(rows.sparkSession)

    def windows(self, anchors: DataFrame, k: int, same_label: bool) -> DataFrame:
        """anchor_id, slot, score and vec_id: of each window the first ``k`` rows (all if fewer) by
        falling score, then rising vec_id, among rows of the anchor's label or of all others.

        ``anchors``: anchor_id, label, q, and arrays ``low`` and ``high``, the bounds of the windows.
        """
        n = anchors.count()
        groups = max(-(-n // GROUP), min(self.parts, n // 128), 1)
        last = F.transform("low", lambda x: F.lit(MOST))
        grouped = staged(anchors.withColumn("last", last).withColumn("group", F.pmod(F.xxhash64("near"), F.lit(groups)).cast("int")).drop("near"))
        looked = self._bounds(grouped, groups, same_label, SEEDS)
        window = Window.partitionBy("anchor", "slot").orderBy(F.desc("looks"), "block")
        seeds = looked.select("group", "block", "slot", "looks", F.element_at("anchors", 1).alias("anchor"))
        seeds = seeds.withColumn("place", F.row_number().over(window)).where(F.col("place") <= SEEDS)
        seeds = staged(seeds.groupBy("group", "block").agg(F.collect_set("anchor").alias("anchors")))
        first = staged(self._read(grouped, seeds, k))
        ranked = _best(first, k)
        kth = ranked.where(F.col("place") == k).groupBy("anchor_id").agg(
            F.map_from_entries(F.collect_list(F.struct("slot", F.struct("score", "vec_id").alias("end")))).alias("ends")
        )
        end = lambda i: F.element_at("ends", i.cast("int"))
        narrowed = grouped.join(kth, "anchor_id", "left").select(
            "anchor_id", "label", "q", "high", "group",
            F.transform("low", lambda x, i: F.coalesce(end(i)["score"], x)).alias("low"),
            F.transform("low", lambda x, i: F.coalesce(end(i)["vec_id"], F.lit(MOST))).alias("last"),
        )
        narrowed = staged(narrowed)
        rest = self._bounds(narrowed, groups, same_label, 0).select("group", "block", "anchors")
        done = seeds.select("group", "block", F.col("anchors").alias("done"))
        # A block reads the anchors that it was not a seed of.
        left = F.coalesce(F.array_except("anchors", "done"), F.col("anchors"))
        rest = rest.join(done, ["group", "block"], "left").select("group", "block", left.alias("anchors")).where(F.size("anchors") > 0)
        second = self._read(narrowed, rest, k)
        return _best(first.unionByName(second), k).where(F.col("place") <= k)

    def _bounds(self, anchors: DataFrame, groups: int, same: bool, seeds: int) -> DataFrame:
        """A group meets a page of zone maps in a task of their own."""
        pages = max(1, -(-self.n_blocks // PAGE))
        left = anchors.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))))
        page = F.pmod(F.xxhash64("block"), F.lit(pages)).cast("int")
        right = self.zones.select("*", page.alias("page"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
        met = left.groupBy("group", "page").cogroup(right.groupBy("group", "page"))
        found = met.applyInArrow(_bounds(self.dims, same, seeds), "group int, block bigint, anchors array<bigint>, slot int, looks bigint")
        if seeds:
            return found
        # The anchors of a group came in slices.
        return found.groupBy("group", "block").agg(F.flatten(F.collect_list("anchors")).alias("anchors"))

    def _read(self, anchors: DataFrame, needed: DataFrame, k: int) -> DataFrame:
        chunks = max(1, -(-self.n_blocks // CHUNK))
        needed = staged(needed.withColumn("chunk", F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int")))
        pairs = needed.select(F.col("group").alias("in_group"), F.col("chunk").alias("in_chunk")).distinct()
        left = anchors.join(pairs, F.col("group") == F.col("in_group"))
        right = needed.join(self.blocks.select("block", "ids", "vectors"), "block")
        met = left.groupBy("in_group", "in_chunk").cogroup(right.groupBy("group", "chunk"))
        return met.applyInArrow(_read(self.dims, k), "anchor_id bigint, slot int, score bigint, vec_id bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(window)).where(F.col("place") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, positive_rank, rank, negative_id, positive_score and negative_score.

    An anchor's positives are its best other rows of the same label; for each, the negatives are the best rows
    of other labels whose score is ``low`` to ``high`` hundredths of the positive's.
    """
    rows = staged(quantised(vectors, scale))
    search = ZonedSearch(rows)
    # Anchors that lie together share a group: the stretch of the curve they are cut into.
    share = max(1, rows.count() // max(1, rows.where(is_anchor).count()))
    span = max(1, min(GROUP, 128) * share // BLOCK)
    place = search.blocks.select(F.explode("ids").alias("anchor_id"), F.expr(f"block div {span}").alias("near"))
    anchors = rows.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "q")
    anchors = staged(anchors.join(place, "anchor_id"))
    bound = lambda value: F.array(F.lit(value).cast("bigint"))
    found = search.windows(anchors.select("*", bound(LEAST).alias("low"), bound(MOST).alias("high")), positives, True)
    # Below zero no score is both low and high hundredths of the positive's.
    chosen = staged(found.where("score >= 0").select("anchor_id", F.col("place").alias("positive_rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    bounds = F.struct("positive_rank", F.expr(f"(positive_score * {low} + 99) div 100").alias("low"), F.expr(f"positive_score * {high} div 100").alias("high"))
    ranges = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list(bounds)).alias("w"))
    windows = anchors.join(ranges, "anchor_id").select("anchor_id", "label", "q", "near", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    hard = search.windows(windows, negatives, False)
    # Slots are numbered as the positives are ranked.
    hard = hard.select("anchor_id", (F.col("slot") + 1).alias("positive_rank"), F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return chosen.join(hard, ["anchor_id", "positive_rank"])
