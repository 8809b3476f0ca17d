"""The prefix trie of conversations, from padded turn-id matrices in range shards.

A conversation is one row: its turns' ids (128-bit digests of role and text) and text sizes. Spark
deals the rows by range of (ids, conv_id), so that a node's members lie together, in one shard or
in neighbouring ones. In a shard the ids become ranks in padded matrices of ``WIDTH`` columns, taken
from the last columns to the first; numpy's lexsort orders the rows, column change masks are
OR-accumulated from left to right and mark where the nodes of each depth start, and reduceat
aggregates the rows of each node. Sums over subtrees go from the deepest nodes up.

A node that may go on in another shard holds the shard's first or last row, so it lies on one of two
paths. Those boundary paths, two a shard at most, carry partial sums of what hangs off them and
are recombined by the same kernel. Nodes below a boundary node get their parent's id by a join on
(shard, path, depth), which spreads a common parent over the shards.

Rows of a shard are bounded by the number of shards, which grows with the turns; one conversation
(28 bytes a turn) is held whole.

Defined cases: rows without a conv_id belong to no conversation. A null role or text is empty. Turns
go by turn, null first, then by role, then by digest, so repeated rows are turns of their
own. No conversations give no nodes, not even the root. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.llm.stages import partitions, staged

WIDTH = 16
#: Turns of a shard, on average.
SHARD_TURNS = 250_000
#: Members of one row of ``Trie.ends`` at most.
ENDS = 4096
NEVER = np.iinfo(np.int64).max


def conversations(turns: DataFrame, head: Callable | None = None, base: Callable | None = None) -> DataFrame:
    """conv_id, ids and sizes of each conversation, in order of turns.

    With ``base`` and ``head``, both from the conv_id column to a column, a conversation's first
    ``head`` turns are replaced by as many of conversation ``base``; ``head`` is at most ``HEAD``.
    Conversations of one base are few: they share its task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    key = base(F.col("conv_id")) if base else F.col("conv_id")
    size = F.octet_length(text).alias("size")
    turn = F.struct(F.col("turn").cast("bigint").alias("turn"), role.alias("role"), digest.alias("id"), size)
    each = turns.where("conv_id is not null").select(
        key.cast("bigint").alias("base"), F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t")
    )
    whole = each.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    if base:
        of_base = F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, HEAD))
        lead = F.coalesce(F.max(of_base).over(Window.partitionBy("base")), F.slice("own", 1, 0))
        n = head(F.col("conv_id")).cast("int")
        rest = F.filter("own", lambda t, i: i >= F.col("n"))
        whole = whole.select("*", n.alias("n"), lead.alias("lead")).select(
            "conv_id", F.concat(F.slice("lead", F.lit(1), F.col("n")), rest).alias("own")
        )
    return whole.select("conv_id", F.col("own.id").alias("ids"), F.col("own.size").alias("sizes"))


#: Turns that ``head`` can ask for.
HEAD = 8


@dataclass
class Paths:
    """Rows of turns: ``first`` has where each begins (one more entry than rows); ``rank`` and
    ``size`` have the turn's number, from 1, and its bytes of text."""

    first: np.ndarray
    rank: np.ndarray
    size: np.ndarray

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.first)

    def padded(self, rows: np.ndarray, lo: int) -> np.ndarray:
        """Columns lo..lo + WIDTH of the rows, 0 beyond a row's end."""
        at = self.first[rows][:, None] + lo + np.arange(WIDTH)
        inside = at < self.first[rows + 1][:, None]
        return np.where(inside, self.rank[np.where(inside, at, 0)], 0)

    def order(self, then: np.ndarray) -> np.ndarray:
        """Rows in order of their turns, shorter ones first, and of ``then``."""
        tail = np.zeros(len(self.lengths), dtype=np.int64)
        deepest = int(self.lengths.max(initial=0))
        for lo in range((deepest - 1) // WIDTH * WIDTH, -1, -WIDTH) if deepest else ():
            rows = np.flatnonzero(self.lengths > lo)
            matrix = self.padded(rows, lo)
            by = np.lexsort((tail[rows], *matrix.T[::-1]))
            change = np.r_[True, (np.diff(matrix[by], axis=0) != 0).any(axis=1) | (np.diff(tail[rows][by]) != 0)]
            tail[rows[by]] = np.cumsum(change)
        return np.lexsort((then, tail))

    def layers(self, order: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each depth from 1: positions in ``order`` of the rows that are so long, and which of them start a node."""
        position = np.arange(len(order))
        lengths = self.lengths[order]
        before = np.zeros(len(order), dtype=bool)
        for lo in range(0, int(lengths.max(initial=0)), WIDTH):
            active = position[lengths > lo]
            matrix = self.padded(order[active], lo)
            # A row above that is no longer active differs from this one already.
            beside = np.r_[False, np.diff(active) == 1]
            differs = np.ones(matrix.shape, dtype=bool)
            differs[1:][beside[1:]] = (matrix[1:] != matrix[:-1])[beside[1:]]
            differs[:, 0] |= before[active]
            changed = np.logical_or.accumulate(differs, axis=1)
            before = np.zeros(len(order), dtype=bool)
            before[active] = changed[:, -1]
            for k in range(min(WIDTH, int(lengths.max()) - lo)):
                here = lengths[active] > lo + k
                yield active[here], changed[here, k]


def paths_of(ids: pa.Array, sizes: pa.Array) -> Paths:
    first = ids.offsets.to_numpy().astype(np.int64)
    flat = ids.values
    raw = flat.buffers()[2]
    digests = np.frombuffer(raw, dtype=">u8").reshape(-1, 2) if len(flat) else np.zeros((0, 2), dtype=">u8")
    digests = digests[flat.offset : flat.offset + len(flat)].astype(np.uint64)
    by = np.lexsort((digests[:, 1], digests[:, 0]))
    change = np.r_[True, (np.diff(digests[by], axis=0) != 0).any(axis=1)] if len(by) else np.zeros(0, bool)
    rank = np.zeros(len(by), dtype=np.int64)
    rank[by] = np.cumsum(change)
    return Paths(first, rank, sizes.values.to_numpy().astype(np.int64))


@dataclass
class Layer:
    """Nodes of one depth in order; ``start`` is the position of a node's first row."""

    start: np.ndarray
    parent: np.ndarray
    size: np.ndarray
    n: np.ndarray
    least: np.ndarray
    kids: np.ndarray
    leaves: np.ndarray
    saved: np.ndarray
    boundary: np.ndarray


def _add(target: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    np.add.at(target, at, values)


def aggregate(paths: Paths, order: np.ndarray, values: Callable, bounded: bool) -> list[Layer]:
    """Nodes by depth. ``values(depth, rows)`` are what rows bring to their node of this depth: members,
    smallest id, children, leaves and saved tokens. With ``bounded``, nodes on the path of
    the first or last row get only what comes from nodes off these paths, as partial sums."""
    lengths, layers = paths.lengths[order], []
    everything = np.arange(len(order))
    for depth, (active, starts) in enumerate([(everything, everything == 0), *paths.layers(order)]):
        begin = np.flatnonzero(starts)
        start = active[begin]
        n, least, kids, leaves, saved = values(depth, order[active])
        total = lambda x: np.add.reduceat(x, begin)  # noqa: B023, E731
        boundary = np.zeros(len(start), dtype=bool)
        if bounded:
            boundary[0] = start[0] == 0 and lengths[0] >= depth
            boundary[-1] |= active[-1] == len(order) - 1
        parent = np.searchsorted(layers[-1].start, start, side="right") - 1 if depth else np.full(1, -1)
        size = paths.size[paths.first[order[start]] + depth - 1] if depth else np.zeros(1, np.int64)
        layers.append(
            Layer(start, parent, size, total(n), np.minimum.reduceat(least, begin), total(kids), total(leaves), total(saved), boundary)
        )
    for depth in range(len(layers) - 1, -1, -1):
        here = layers[depth]
        own = ~here.boundary
        here.leaves[own] += here.kids[own] == 0
        here.saved[own] += (here.n[own] - 1) * here.size[own]
        if depth:
            up = layers[depth - 1]
            _add(up.kids, here.parent[own], np.ones(int(own.sum()), np.int64))
            _add(up.leaves, here.parent[own], here.leaves[own])
            _add(up.saved, here.parent[own], here.saved[own])
    return layers


NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
SHARD = f"kind byte, shard int, side byte, {NODE}, members array<bigint>, ids array<binary>, sizes array<int>, sums array<bigint>"
IS_NODE, IS_ENDS, IS_PATH = 0, 1, 2
NAMES = [x.split()[0] for x in SHARD.split(", ")]
TYPES = {"kind": pa.int8(), "shard": pa.int32(), "side": pa.int8(), "members": pa.list_(pa.int64()), "ids": pa.list_(pa.binary()), "sizes": pa.list_(pa.int32()), "sums": pa.list_(pa.int64())}


def _rows(n: int, **columns) -> pa.RecordBatch:
    arrays = []
    for name in NAMES:
        kind, value = TYPES.get(name, pa.int64()), columns.get(name)
        if value is None:
            arrays.append(pa.nulls(n, kind))
        elif np.isscalar(value):
            arrays.append(pa.array(np.full(n, value), kind))
        else:
            arrays.append(value if isinstance(value, pa.Array) else pa.array(value, kind))
    return pa.RecordBatch.from_arrays(arrays, names=NAMES)


def _side(layer: Layer, index: np.ndarray) -> pa.Array:
    """On which of the shard's two paths a node lies; null off them."""
    side = np.where(layer.start[index] == 0, 0, 1).astype(np.int8)
    return pa.array(side, mask=~layer.boundary[index])


def _members(order: np.ndarray, conv: np.ndarray, lengths: np.ndarray, layer: Layer, depth: int, active_end: np.ndarray):
    """Runs of at most ENDS rows that end at a node: node, first row and number of rows."""
    # Rows that end here are the first of their node.
    ending = np.r_[0, np.cumsum(lengths[order] == depth)]
    count = ending[active_end] - ending[layer.start]
    node = np.repeat(np.arange(len(count)), -(-count // ENDS))
    within = np.arange(len(node)) - np.searchsorted(node, node)
    begin = layer.start[node] + within * ENDS
    return node, begin, np.minimum(count[node] - within * ENDS, ENDS)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if len(b)]) else None
    if table is None:
        return
    table = table.combine_chunks()
    ids, sizes = table.column("ids").chunk(0), table.column("sizes").chunk(0)
    conv = table.column("conv_id").to_numpy()
    shard = TaskContext.get().partitionId()
    paths = paths_of(ids, sizes)
    order = paths.order(conv)
    lengths, sorted_conv = paths.lengths, conv[order]
    zero = np.zeros(len(conv), dtype=np.int64)

    def values(depth: int, rows: np.ndarray):
        none = zero[: len(rows)]
        return np.ones(len(rows), np.int64), conv[rows], none, none, none

    layers = aggregate(paths, order, values, bounded=True)
    for depth, layer in enumerate(layers):
        inner = np.flatnonzero(~layer.boundary)
        if len(inner):
            up, at = layers[depth - 1], layer.parent[inner]
            yield _rows(
                len(inner), kind=IS_NODE, shard=shard, side=_side(up, at), conv_id=layer.least[inner], depth=depth,
                parent_conv_id=pa.array(up.least[at], mask=up.boundary[at]), n_convs=layer.n[inner],
                n_children=layer.kids[inner], n_leaves=layer.leaves[inner], saved_tokens=layer.saved[inner],
            )
        ends = np.r_[layer.start[1:], len(order)]
        node, begin, n = _members(order, conv, lengths, layer, depth, ends)
        if len(node):
            # Runs of ids, one after another.
            flat = np.repeat(begin - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))
            members = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(sorted_conv[flat]))
            known = pa.array(layer.least[node], mask=layer.boundary[node])
            yield _rows(len(node), kind=IS_ENDS, shard=shard, side=_side(layer, node), conv_id=known, depth=depth, members=members)
    yield from _boundary(layers, order, lengths, ids, sizes, shard)


SUMS = ("n", "least", "kids", "leaves", "saved")


def _boundary(layers: list[Layer], order: np.ndarray, lengths: np.ndarray, ids: pa.Array, sizes: pa.Array, shard: int):
    """The paths of the first and last row. What both share counts on the first."""
    for side, row in ((0, order[0]), (1, order[-1])):
        if side and len(order) == 1:
            return
        sums = []
        for depth in range(int(lengths[row]) + 1):
            layer = layers[depth]
            node = 0 if side == 0 else len(layer.start) - 1
            shared = side == 1 and layer.start[node] == 0
            sums += [0, NEVER, 0, 0, 0] if shared else [int(getattr(layer, name)[node]) for name in SUMS]
        one = slice(int(row), int(row) + 1)
        yield _rows(1, kind=IS_PATH, shard=shard, side=side, ids=ids[one], sizes=sizes[one], sums=pa.array([sums], pa.list_(pa.int64())))


def _recombine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Boundary nodes for each path and depth; ``kind`` is IS_NODE for the first mention of a node."""
    table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if len(b)]) else None
    if table is None:
        return
    table = table.combine_chunks()
    paths = paths_of(table.column("ids").chunk(0), table.column("sizes").chunk(0))
    sums = table.column("sums").chunk(0)
    flat, at = sums.values.to_numpy().reshape(-1, len(SUMS)), sums.offsets.to_numpy().astype(np.int64) // len(SUMS)
    shard, side = table.column("shard").to_numpy(), table.column("side").to_numpy()
    order = paths.order(shard * 2 + side)
    lengths = paths.lengths[order]
    layers = aggregate(paths, order, lambda depth, rows: flat[at[rows] + depth].T, bounded=False)
    everything = np.arange(len(order))
    for depth, layer in enumerate(layers):
        rows = everything[lengths >= depth]
        node = np.searchsorted(layer.start, rows, side="right") - 1
        first = np.r_[True, np.diff(node) != 0]
        up = pa.array(layers[depth - 1].least[layer.parent[node]]) if depth else None
        yield _rows(
            len(rows), kind=np.where(first, IS_NODE, IS_PATH).astype(np.int8), shard=shard[order[rows]], side=side[order[rows]],
            conv_id=layer.least[node], depth=depth, parent_conv_id=up, n_convs=layer.n[node], n_children=layer.kids[node],
            n_leaves=layer.leaves[node], saved_tokens=layer.saved[node],
        )


@dataclass
class Trie:
    """nodes: ``NODE``, one row a node, known by conv_id (its smallest member) and depth.
    ends: conv_id and depth of a node, and in ``members`` ascending runs of the conversations that end there."""

    nodes: DataFrame
    ends: DataFrame


def prefix_trie(convs: DataFrame) -> Trie:
    """The trie of ``conversations``."""
    convs = staged(convs)
    spark = convs.sparkSession
    turns = convs.agg(F.sum(F.size("ids").cast("bigint") + 1)).first()[0] or 0
    shards = max(partitions(spark), -(-turns // SHARD_TURNS))
    ranged = convs.select("conv_id", "ids", F.col("sizes").cast("array<int>")).repartitionByRange(shards, "ids", "conv_id")
    parts = staged(ranged.mapInArrow(_shard, SHARD))
    found = staged(parts.where(F.col("kind") == IS_PATH).repartition(1).mapInArrow(_recombine, SHARD))
    columns = [x.split()[0] for x in NODE.split(", ")]
    boundary = found.select("shard", "side", F.col("depth").alias("at"), F.col("conv_id").alias("owner"))

    def resolved(rows: DataFrame, depth, column: str, *keep: str) -> DataFrame:
        on = [F.col("shard") == F.col("b_shard"), F.col("side") == F.col("b_side"), depth == F.col("at")]
        lookup = boundary.select(F.col("shard").alias("b_shard"), F.col("side").alias("b_side"), "at", "owner")
        joined = rows.where("side is not null").join(lookup, on)
        return joined.withColumn(column, F.col("owner")).select(*keep).unionByName(rows.where("side is null").select(*keep))

    inner = resolved(parts.where(F.col("kind") == IS_NODE), F.col("depth") - 1, "parent_conv_id", *columns)
    nodes = inner.unionByName(found.where(F.col("kind") == IS_NODE).select(columns))
    ends = resolved(parts.where(F.col("kind") == IS_ENDS), F.col("depth"), "conv_id", "conv_id", "depth", "members")
    return Trie(nodes, ends)


def _hash_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's runs, one after another; only the state of one node is held."""
    key, state = None, None
    done: list[tuple] = []
    for batch in batches:
        for conv, depth, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "text")), strict=True):
            if (conv, depth) == key:
                state.update(b",")
            else:
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (conv, depth), hashlib.sha256()
            state.update(text.encode())
        if len(done) > 10_000:
            yield _digests(done)
            done = []
    if key:
        yield _digests([*done, (*key, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    conv, depth, digest = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(depth, pa.int64()), pa.array(digest)], ["conv_id", "depth", "ends_sha256"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """conv_id, depth and SHA-256 of the comma-joined members, for nodes where a conversation ends.

    Runs are written out in all tasks; one node's texts then stream through one task in order, as the
    digest needs, a run at a time.
    """
    runs = ends.select("conv_id", "depth", F.element_at("members", 1).alias("first"), F.array_join("members", ",").alias("text"))
    dealt = runs.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
    return dealt.mapInArrow(_hash_members, "conv_id bigint, depth bigint, ends_sha256 string")
