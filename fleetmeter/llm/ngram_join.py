"""Jaccard join of word n-gram sets by a size-aware heavy-light split.

Two sets of n and m shingles are similar when they share at least need(n, m) = ceil(4 (n + m) / 9)
of them, that is at Jaccard 4/5 or more. Documents with equal sets are one node. The boundary between small and
large sets is the size of least cost, of subset rows against list rows, over the sizes that occur.

Small sets: for each size a partner can have, a set enumerates its subsets of need(n, m) shingles, as
sums of shingle hashes less those left out. Sets of n and m shingles with a subset in common are similar
as they stand; they are linked in a star, to the smallest node of the other size.

Large sets, and the small ones they may be similar to, go by inverted lists. Shingles are counted in hash
buckets; those of one document only can link nothing and are just counted. The others make up the
``sets`` table, in order of frequency, rarest first. A similar pair has a shingle in common among the first
n - need + 1 of each set, so only these go into lists, often none. Lists are scanned for links that connect,
not for all pairs:

1. Every member of a list is tested against one of them, the list's hub, by turns another, while that
   finds links. Lists whose members are connected are done.
2. What is left is compared inside tasks, in blocks of a list, by bounds that never exclude a similar pair: sizes,
   positions in the list's order, and parity sketches of the sets. Each member gives its nearest few
   members of other components; more are asked for until no candidate is left out.

Every candidate is tested on the whole sets. Between turns, links give sets common roots, which need not be
as few as the components; these are found once, over all links. Hot shingles are folded in each slice of documents before they are counted, and long lists
are split into pairs of blocks.

Defined cases: a null text has no words; texts without words are alone, each row its own component. Fewer words
than ``WIDTH`` are one shingle. A null doc_id takes part, but is the smallest of a component only if all
are null; rows of one doc_id are separate rows. Shingles are told apart by 64-bit hashes, equal sets by
128 bits. Extra columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm import text as t
from fleetmeter.llm.simhash import components
from fleetmeter.llm.stages import partitions, staged

WIDTH = 5
#: Sizes among which the boundary is chosen: beyond, subsets cost more whatever the sizes.
LIGHT = range(0, 31)
#: Cost of a subset row, of a shingle that is counted, and of an entry in a list.
SUBSET, COUNTED, ENTRY = 3.0, 0.5, 3.0
#: Shingles of one hash bucket on average, and text of one slice.
BUCKET, SLICE = 1_000_000, 2 << 20
#: Hubs are tried while so large a share of their candidates is similar.
WORTHWHILE = 1 / 2
#: Members of a block of a list, bits of a sketch, and the first number of candidates a member gives.
BLOCK, SKETCH, NEAREST = 2048, 512, 2
U64 = np.uint64


def need(n: int, m: int) -> int:
    return -(-4 * (n + m) // 9)


def partner_sizes(n: int) -> range:
    return range(-(-4 * n // 5), 5 * n // 4 + 1)


def subset_rows(n: int, boundary: int) -> int:
    """Subsets that a set of n shingles enumerates for partners up to the boundary."""
    return sum(math.comb(n, need(n, m)) for m in partner_sizes(n) if m <= boundary and (m != n or need(n, n) < n))


def choose_boundary(sizes: dict[int, int]) -> int:
    """The boundary of least cost, from how many nodes there are of each size in ``LIGHT``."""

    def cost(b: int) -> float:
        light = sum(c * subset_rows(n, b) for n, c in sizes.items() if n <= b)
        listed = ((n, c) for n, c in sizes.items() if 5 * n > 4 * b)
        return SUBSET * light + sum(c * (COUNTED * n + ENTRY * (n - need(n, -(-4 * n // 5)) + 1)) for n, c in listed)

    return min(LIGHT, key=cost)


class _Sets:
    """Distinct shingles of each text of a slice: ``tokens`` in order of owner and value, ``n`` of each
    text, and two sums over mixed shingles that stand for the set."""

    def __init__(self, piece: t.Slice):
        data = t.LOWER[piece.data]
        found = t.words(data, piece.starts, t.BLANK_SEPARATED)
        hashes = t.word_hashes(data, found)
        at = np.flatnonzero(t.whole_windows(found.first, WIDTH))
        counts = found.counts
        short = np.flatnonzero((counts > 0) & (counts < WIDTH))
        whole = t.span_hashes(hashes, found.first[short], found.first[short + 1]) if len(short) else np.zeros(0, U64)
        tokens = np.concatenate([t.window_hashes(hashes, WIDTH)[at] if len(at) else np.zeros(0, U64), whole])
        owner = np.concatenate([found.owner()[at], short])
        by = np.lexsort((tokens, owner))
        tokens, owner = tokens[by], owner[by]
        new = np.r_[True, (np.diff(owner) != 0) | (tokens[1:] != tokens[:-1])][: len(tokens)]
        self.tokens, self.owner = tokens[new], owner[new]
        self.n = np.bincount(self.owner, minlength=len(counts))
        self.first = np.r_[0, np.cumsum(self.n)]
        self.digests = np.zeros((len(counts), 2), dtype=U64)
        full = np.flatnonzero(self.n)
        if len(full):
            for i, salt in enumerate((U64(0x9E3779B97F4A7C15), U64(0xD1B54A32D192ED03))):
                self.digests[full, i] = np.add.reduceat(t.mix(self.tokens ^ salt), self.first[full])


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), values)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and digest of each document's set, and the set itself if small."""
    for batch in batches:
        for piece in t.slices(batch.column("text"), SLICE):
            sets = _Sets(piece)
            small = np.where((sets.n > 0) & (sets.n <= LIGHT[-1]), sets.n, 0)
            tokens = sets.tokens[small[sets.owner] > 0].view(np.int64)
            rest = batch.slice(piece.lo, piece.hi - piece.lo).drop_columns(["text"])
            more = [pa.array(sets.n), *(pa.array(sets.digests[:, i].view(np.int64)) for i in (0, 1)), _lists(small, pa.array(tokens))]
            yield pa.RecordBatch.from_arrays([*rest.columns, *more], names=[*rest.schema.names, "n", "hi", "lo", "small"])


# --- small sets ---

#: Subsets of a batch.
SUBSETS = 1 << 18


def _subsets(boundary: int):
    """Subsets of each node for each size of partner, known by both sizes and two sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy()
            sizes = batch.column("n").to_numpy()
            flat = batch.column("small").flatten().to_numpy().view(U64)
            first = np.r_[0, np.cumsum(sizes)]
            for n in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == n)
                tokens = flat[first[rows][:, None] + np.arange(n)]
                mixed = [t.mix(tokens ^ salt) for salt in (U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB))]
                for m in partner_sizes(n):
                    out = n - need(n, m)
                    if m > boundary or (m == n and not out):
                        continue
                    each = math.comb(n, out)
                    left_out = np.array(list(itertools.combinations(range(n), out)), dtype=np.int64).reshape(each, out)
                    step = max(1, SUBSETS // each)
                    for lo in range(0, len(rows), step):
                        keys = [x.sum(axis=1, dtype=U64)[:, None] - x[:, left_out].sum(axis=2, dtype=U64) for x in (y[lo : lo + step] for y in mixed)]
                        count = keys[0].size
                        arrays = [
                            pa.array(np.full(count, min(n, m)), pa.int32()), pa.array(np.full(count, max(n, m)), pa.int32()),
                            *(pa.array(k.reshape(-1).view(np.int64)) for k in keys), pa.array(np.repeat(node[rows[lo : lo + step]], each)), pa.array(np.full(count, n > m)),
                        ]
                        yield pa.RecordBatch.from_arrays(arrays, ["low", "high", "k1", "k2", "node", "upper"])

    return run


def light_links(small: DataFrame, boundary: int) -> DataFrame:
    """Links a, b of all nodes up to the boundary that are similar, in stars over common subsets."""
    rows = staged(small.where(F.col("n") <= boundary).mapInArrow(_subsets(boundary), "low int, high int, k1 bigint, k2 bigint, node bigint, upper boolean"))
    key = ["low", "high", "k1", "k2"]
    groups = rows.groupBy(key).agg(F.min(F.when(~F.col("upper"), F.col("node"))).alias("below"), F.min(F.when(F.col("upper"), F.col("node"))).alias("above"), F.count(F.lit(1)).alias("members"))
    shared = groups.where((F.col("members") > 1) & ((F.col("low") == F.col("high")) | (F.col("below").isNotNull() & F.col("above").isNotNull())))
    other = F.when(F.col("upper") | (F.col("low") == F.col("high")), F.col("below")).otherwise(F.col("above"))
    return rows.join(shared, key).select(F.col("node").alias("a"), other.alias("b")).where("a != b").distinct()


# --- counting the shingles of large sets ---


def _packed(tokens: np.ndarray) -> bytes:
    """The low 48 bits of each token; a bucket holds tokens of few other high bits."""
    return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8").astype(U64, copy=False)


def _token_id(low: np.ndarray, bucket: int) -> np.ndarray:
    return low ^ (U64(bucket & 0xFFFF) << U64(48))


POSTINGS = "slice bigint, bucket int, tokens binary, owners binary, folded binary, levels binary, counts binary, header binary"
POSTING_NAMES = [c.split()[0] for c in POSTINGS.split(", ")]


def _posting(**columns) -> list:
    return [columns.get(c) for c in POSTING_NAMES]


def _posting_batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], POSTING_NAMES)


def _postings(buckets: int, boundary: int):
    """Shingles of each slice by bucket. One that several documents of the slice hold is sent once, with
    their number; who holds it stays in the slice's header, with digests and sizes of its sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 18
        for batch in batches:
            for piece in t.slices(batch.column("text"), SLICE):
                sets = _Sets(piece)
                # Equal sets of a slice are one; sets that only have small partners take no part.
                _, once = np.unique(sets.digests, axis=0, return_index=True)
                listed = np.zeros(len(sets.n), dtype=bool)
                listed[once] = True
                listed &= 5 * sets.n > 4 * boundary
                keep = listed[sets.owner]
                if not keep.any():
                    continue
                renumbered = np.cumsum(listed) - 1
                tokens, owner = sets.tokens[keep], renumbered[sets.owner[keep]]
                by = np.argsort(tokens, kind="stable")
                tokens, owner = tokens[by], owner[by]
                begin = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
                count = np.diff(np.r_[begin, len(tokens)])
                distinct = tokens[begin]
                bucket = (((distinct >> U64(32)) * U64(buckets)) >> U64(32)).astype(np.int64)
                single = count == 1
                cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                small = np.uint16 if int(listed.sum()) < 1 << 16 else np.uint32
                rows = []
                for b in np.flatnonzero(np.diff(cuts)).tolist():
                    here = slice(cuts[b], cuts[b + 1])
                    one = single[here]
                    rows.append(_posting(slice=number, bucket=b, tokens=_packed(distinct[here][one]), owners=owner[begin[here][one]].astype(small).tobytes(), folded=_packed(distinct[here][~one]), counts=count[here][~one].astype(np.uint32).tobytes()))
                many = ~np.repeat(single, count)
                ids = _token_id(tokens[many] & U64((1 << 48) - 1), 0) ^ (np.repeat(bucket, count)[many].astype(U64) & U64(0xFFFF)) << U64(48)
                rows.append(
                    _posting(
                        slice=number, bucket=number % buckets, folded=ids.tobytes(), counts=owner[many].astype(np.uint32).tobytes(),
                        header=sets.digests[listed].tobytes(), levels=sets.n[listed].astype(np.uint32).tobytes(), owners=small().tobytes(),
                    )
                )
                for i in range(0, len(rows), 256):
                    yield _posting_batch(rows[i : i + 256])
                number += 1

    return run


def _count_bucket(key, table):
    """To each slice: its shingles that another document holds too, and how frequent they are. Headers pass through."""
    rows = table.to_pylist()
    lists = [r for r in rows if r["header"] is None]
    single = [_unpacked(r["tokens"]) for r in lists]
    folded = [_unpacked(r["folded"]) for r in lists]
    counts = [np.frombuffer(r["counts"], np.uint32) for r in lists]
    both = np.concatenate([np.zeros(0, U64), *single, *folded])
    times = np.concatenate([np.zeros(0, np.int64), *(np.ones(len(x), np.int64) for x in single), *(c.astype(np.int64) for c in counts)])
    by = np.argsort(both, kind="stable")
    begin = np.flatnonzero(np.r_[True, both[by][1:] != both[by][:-1]])[: len(both)]
    total = np.add.reduceat(times[by], begin) if len(both) else times
    frequency = np.empty(len(both), dtype=np.int64)
    frequency[by] = np.repeat(total, np.diff(np.r_[begin, len(both)]))
    level = np.minimum(8 * np.log2(np.maximum(frequency, 1)), 255).astype(np.uint8)
    out, at, fold = [r for r in rows if r["header"] is not None], 0, sum(map(len, single))
    for r, mine, group in zip(lists, single, folded, strict=True):
        here, there = slice(at, at + len(mine)), slice(fold, fold + len(group))
        at, fold = here.stop, there.stop
        shared = frequency[here] > 1
        width = len(r["owners"]) // max(len(mine), 1)
        owners = np.frombuffer(r["owners"], np.uint16 if width == 2 else np.uint32)[shared]
        if shared.any() or len(group):
            out.append({**r, "tokens": _packed(mine[shared]), "owners": owners.tobytes(), "levels": level[here][shared].tobytes(), "counts": level[there].tobytes()})
    return pa.Table.from_batches([_posting_batch([[r[c] for c in POSTING_NAMES] for r in out])]) if out else table.slice(0, 0)


SETS = "ref bigint, hi bigint, lo bigint, n int, listed int, tokens array<bigint>"


def _collect_slice(key, table):
    """The sets of a slice that have a shingle to list: shingles held by others, rarest first."""
    rows = table.to_pylist()
    header = next(r for r in rows if r["header"] is not None)
    small = np.uint16 if len(header["owners"]) == 2 else np.uint32
    owner, token, level, folded, folded_level = [], [], [], [], []
    for r in rows:
        if r["header"] is None:
            owner.append(np.frombuffer(r["owners"], small).astype(np.int64))
            token.append(_token_id(_unpacked(r["tokens"]), r["bucket"]))
            level.append(np.frombuffer(r["levels"], np.uint8))
            folded.append(_token_id(_unpacked(r["folded"]), r["bucket"]))
            folded_level.append(np.frombuffer(r["counts"], np.uint8))
    held, holder = np.frombuffer(header["folded"], U64), np.frombuffer(header["counts"], np.uint32).astype(np.int64)
    if len(held):
        known, its = np.concatenate(folded), np.concatenate(folded_level)
        by = np.argsort(known)
        level.append(its[by][np.searchsorted(known[by], held)])
        owner.append(holder)
        token.append(held)
    n = np.frombuffer(header["levels"], np.uint32).astype(np.int64)
    digests = np.frombuffer(header["header"], U64).reshape(-1, 2)
    owner = np.concatenate([np.zeros(0, np.int64), *owner])
    shared = np.bincount(owner, minlength=len(n))
    # First n - ceil(4n / 5) + 1 shingles, less those nobody else holds.
    listed = n - -(-4 * n // 5) + 1 - (n - shared)
    take = np.flatnonzero(listed > 0)
    keep = (listed > 0)[owner]
    owner, token, level = owner[keep], np.concatenate([np.zeros(0, U64), *token])[keep], np.concatenate([np.zeros(0, np.uint8), *level])[keep]
    by = np.lexsort((token, level, owner))
    return pa.table(
        {
            "ref": pa.array((key[0].as_py() << 24) | take, pa.int64()), "hi": pa.array(digests[take, 0].view(np.int64)), "lo": pa.array(digests[take, 1].view(np.int64)),
            "n": pa.array(n[take], pa.int32()), "listed": pa.array(listed[take], pa.int32()), "tokens": _lists(shared[take], pa.array(token[by].view(np.int64))),
        }
    )


def shared_sets(texts: DataFrame, total: int, boundary: int) -> DataFrame:
    """``SETS`` of the documents that take part in lists, one for each slice that holds a set."""
    buckets = max(partitions(texts.sparkSession), -(-total // BUCKET))
    posted = texts.select("text").mapInArrow(_postings(buckets, boundary), POSTINGS)
    counted = posted.groupBy("bucket").applyInArrow(_count_bucket, POSTINGS)
    return staged(counted.groupBy("slice").applyInArrow(_collect_slice, SETS))


# --- lists of large sets ---


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b whose whole sets are similar."""
    of = lambda c: sets.select(F.col("ref").alias(c), F.col("n").alias(f"n_{c}"), F.col("tokens").alias(f"t_{c}"))
    joined = pairs.join(of("a"), "a").join(of("b"), "b")
    common = F.size(F.array_intersect("t_a", "t_b"))
    return joined.where(9 * common >= 4 * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _may_be_similar(n, m, left_n, left_m):
    """Whether two members of a list can be similar if the list's shingle is the first they share; ``left``
    is how many of its shingles a set has from there on."""
    return 9 * F.least(left_n, left_m) >= 4 * (n + m)


def _nearer_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (ref, root) after more links: each old root goes to the smallest one it is linked to, and
    on to where that one goes. Sets with one root are connected; connected sets may still have several,
    which costs candidates, not results."""
    of = lambda c: roots.select(F.col("ref").alias(c), F.col("root").alias(f"r_{c}"))
    low = F.least("r_a", "r_b").alias("low")
    between = links.join(of("a"), "a").join(of("b"), "b").select(F.explode(F.array("r_a", "r_b")).alias("old"), low)
    moves = staged(between.groupBy("old").agg(F.min("low").alias("low")).where("old != low"))
    further = moves.select(F.col("old").alias("low"), F.col("low").alias("lower"))
    moves = moves.join(further, "low", "left").select("old", F.coalesce("lower", "low").alias("new"))
    return staged(roots.join(moves, roots["root"] == moves["old"], "left").select("ref", F.coalesce("new", "root").alias("root")))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parity of the number of listed shingles of each hash class: sets that differ in d shingles differ in at most d bits."""
    for batch in batches:
        tokens = batch.column("tokens")
        sizes = np.diff(tokens.offsets.to_numpy())
        at = t.mix(tokens.flatten().to_numpy().view(U64)) % U64(SKETCH)
        row = np.repeat(np.arange(len(sizes)), sizes)
        bits = np.bincount(row * SKETCH + at.astype(np.int64), minlength=len(sizes) * SKETCH) & 1
        raw = np.packbits(bits.astype(np.uint8).reshape(len(sizes), SKETCH), axis=1).tobytes()
        width = SKETCH // 8
        out = pa.array([raw[i * width : (i + 1) * width] for i in range(len(sizes))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("ref"), pa.array(sizes.astype(np.int32)), out], ["ref", "shared", "sketch"])


class _Members:
    def __init__(self, table: pa.Table):
        take = lambda c: table.column(c).to_numpy()
        self.ref, self.root, self.n, self.left = take("ref"), take("root"), take("n").astype(np.int64), take("left").astype(np.int64)
        self.alone = self.n - take("shared")
        self.sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), U64).reshape(-1, SKETCH // 64)

    def near(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs that bounds leave, and by how many shingles they differ at least."""
        fits = (self.root[i] != self.root[j]) & (9 * np.minimum(self.left[i], self.left[j]) >= 4 * (self.n[i] + self.n[j]))
        i, j = i[fits], j[fits]
        apart = self.alone[i] + self.alone[j] + np.bitwise_count(self.sketch[i] ^ self.sketch[j]).sum(axis=1, dtype=np.int64)
        close = 9 * apart <= self.n[i] + self.n[j]
        return i[close], j[close], apart[close]


#: Pairs compared at once.
PAIRS = 1 << 17


def _nearest(limit: int):
    """For each member of a block pair, up to ``limit`` candidates of other components, nearest first;
    ``more`` if there are others."""

    def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
        members = _Members(table)
        token, pair = table.column("token").to_numpy(), table.column("pair").to_numpy()
        begin = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (pair[1:] != pair[:-1])])
        end = np.r_[begin[1:], len(token)]
        # A member meets those after it in its block pair.
        after = np.repeat(end, end - begin) - np.arange(len(token)) - 1
        cuts = np.cumsum(after)
        lo = 0
        while lo < len(token):
            hi = max(lo + 1, int(np.searchsorted(cuts, (cuts[lo - 1] if lo else 0) + PAIRS, side="right")))
            count = after[lo:hi]
            i = np.repeat(np.arange(lo, hi), count)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
            i, j, apart = members.near(i, j)
            by = np.lexsort((members.ref[j], apart, i))
            i, j = i[by], j[by]
            first = np.maximum.accumulate(np.where(np.r_[True, np.diff(i) != 0][: len(i)], np.arange(len(i)), 0))
            place = np.arange(len(i)) - first
            size = np.bincount(i, minlength=hi)[i] if len(i) else i
            taken = place < limit
            a, b = members.ref[i[taken]], members.ref[j[taken]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(size[taken] > limit)], ["a", "b", "more"])
            lo = hi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([*held, batch])
            token, pair = table.column("token").to_numpy(), table.column("pair").to_numpy()
            last = (token == token[-1]) & (pair == pair[-1])
            end = len(table) - int(last.sum())
            if end:
                yield from flush(table.slice(0, end).combine_chunks())
            held = table.slice(end).to_batches()
        if held:
            yield from flush(pa.Table.from_batches(held).combine_chunks())

    return run


def _open(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """Entries with their roots, of the lists that still have two."""
    labelled = entries.join(roots, "ref")
    ends = labelled.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("members"))
    return labelled.join(ends.where("low != high").select("token", "members"), "token")


def list_links(sets: DataFrame, entries: DataFrame) -> DataFrame:
    """Links a, b (refs) between similar sets, enough of them to connect all that are connected."""
    roots = staged(entries.select("ref").distinct().select("ref", F.col("ref").alias("root")))
    links, turn = None, 0
    while True:
        opened = staged(_open(entries, roots))
        # At first the smallest: one step then gives all it is similar to one root.
        order = (F.xxhash64("ref", F.lit(turn)) if turn else F.col("ref")).alias("order")
        hubs = opened.groupBy("token").agg(F.min(F.struct(order, "ref", "root", "n", "left")).alias("hub"))
        facing = opened.join(hubs, "token").where(
            (F.col("root") != F.col("hub.root")) & _may_be_similar(F.col("n"), F.col("hub.n"), F.col("left"), F.col("hub.left"))
        )
        # Hubs go by one order, so those of a set's lists are mostly the same: the first is enough.
        pairs = staged(facing.groupBy("ref").agg(F.min("hub").alias("hub")).select(F.col("ref").alias("a"), F.col("hub.ref").alias("b")))
        found = staged(_similar(pairs, sets))
        tested, similar = pairs.count(), found.count()
        links = found if links is None else links.unionByName(found)
        if similar:
            roots = _nearer_roots(roots, found)
        if not tested or similar < WORTHWHILE * tested:
            break
        turn += 1
    marked, limit, done = None, NEAREST, None
    while True:
        opened = _open(entries, roots)
        if marked is None:
            opened = staged(opened)
            marked = staged(sets.join(opened.select("ref").distinct(), "ref", "left_semi").select("ref", "tokens").mapInArrow(_sketches, "ref bigint, shared int, sketch binary"))
        blocks = F.ceil(F.col("members") / BLOCK).cast("int")
        block = F.pmod(F.xxhash64("ref"), blocks).cast("int")
        # A member of block b meets those of block o in the pair (smaller, larger).
        dealt = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.least(o, block) * blocks + F.greatest(o, block))
        rows = opened.select("token", "ref", "root", "n", "left", F.explode(dealt).alias("pair")).join(marked, "ref")
        sorted_rows = rows.repartition("token", "pair").sortWithinPartitions("token", "pair")
        near = staged(sorted_rows.mapInArrow(_nearest(limit), "a bigint, b bigint, more boolean").groupBy("a", "b").agg(F.max("more").alias("more")))
        fresh = near if done is None else near.join(done, ["a", "b"], "left_anti")
        found = staged(_similar(fresh.select("a", "b"), sets))
        links = links.unionByName(found)
        if not near.where("more").limit(1).count():
            return links
        if found.count():
            roots = _nearer_roots(roots, found)
        tested = near.select("a", "b")
        done = staged(tested if done is None else done.unionByName(tested).distinct())
        limit *= 8


def heavy_links(texts: DataFrame, nodes: DataFrame, total: int, boundary: int) -> DataFrame:
    """Links a, b of nodes over inverted lists."""
    sets = shared_sets(texts, total, boundary)
    # A set that several slices hold counts once; a light one below four fifths of the boundary is not there.
    kept = staged(sets.groupBy("hi", "lo").agg(F.min("ref").alias("ref")))
    prefix = sets.select("ref", "n", (F.col("n") - F.size("tokens")).alias("alone"), F.slice("tokens", F.lit(1), F.col("listed")).alias("prefix"))
    entries = prefix.join(kept.select("ref"), "ref", "left_semi").select("ref", "n", "alone", F.posexplode("prefix").alias("at", "token"))
    entries = entries.select("token", "ref", "n", (F.col("n") - F.col("alone") - F.col("at")).alias("left"))
    lists = entries.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("token")
    entries = staged(entries.join(lists, "token", "left_semi"))
    links = list_links(sets, entries)
    names = kept.join(nodes.select("hi", "lo", "node"), ["hi", "lo"]).select("ref", "node")
    of = lambda c: names.select(F.col("ref").alias(c), F.col("node").alias(f"n_{c}"))
    return links.join(of("a"), "a").join(of("b"), "b").select(F.col("n_a").alias("a"), F.col("n_b").alias("b"))


def similar_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id that is reached over similar sets."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    marked = staged(source.mapInArrow(_documents, "doc_id bigint, n bigint, hi bigint, lo bigint, small array<bigint>"))
    key = ["hi", "lo"]
    grouped = marked.where("n > 0").groupBy(key).agg(F.min("doc_id").alias("least"), F.max("n").alias("n"))
    nodes = staged(grouped.withColumn("node", F.monotonically_increasing_id()))
    sizes = nodes.where(F.col("n") <= LIGHT[-1]).groupBy("n").count().collect()
    boundary = choose_boundary({r["n"]: r["count"] for r in sizes})
    total = marked.agg(F.sum("n")).first()[0] or 0
    small = marked.where((F.col("n") > 0) & (F.col("n") <= boundary)).groupBy(key).agg(F.any_value("small").alias("small"))
    light = light_links(small.join(nodes, key).select("node", F.col("n").cast("int").alias("n"), "small"), boundary)
    links = staged(light.unionByName(heavy_links(source, nodes, total, boundary)))
    roots = components(links)
    labelled = nodes.join(roots, "node", "left").select(*key, "least", F.coalesce("root", "node").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    found = labelled.join(smallest, "root").select(*key, "component_id")
    joined = marked.join(found, key, "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
