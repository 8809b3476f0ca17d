"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: 64 bits, each set if over half of the document's word-shingle hashes set it.
Distinct fingerprints are the nodes; copies share one and are never expanded into pairs.

The 64 bits are grouped into parts so that correlated bits share a part. If two fingerprints
differ in at most ``tau`` bits and the parts have thresholds e_1 + ... + e_m = tau - m + 1, with
-1 for a part that is not probed, then some part differs in at most its e_i bits. The thresholds are unequal:
dynamic programming takes those of the least cost, of probe rows written and of candidates expected
from the bits' shares over all nodes. A node is entered under its
part values and probes all values within e_i flips; what meets in a bucket is verified on all
64 bits. A bucket yields a link of each member to the first of its connected members, so dense
buckets give as many links as members, not all pairs. Buckets above ``BLOCK`` members are split
into pairs of blocks, dealt to different tasks.

Components are found in Spark by alternating minimum-label stars over the links.

Defined cases: null text or no words give fingerprint zero; fewer words than a shingle are one
shingle; a null doc_id takes part but is never the smallest id of a component unless all are null.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm import text as t
from fleetmeter.llm.stages import staged

BITS = 64
BLOCK = 2048
PARTS = range(1, 6)
#: Cost of one verified candidate against one probe row that is written, shuffled and read.
CANDIDATE_COST = 0.05
LANES = np.uint64(0x0101010101010101)


def fingerprints_of(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Majority bits of each document's hashes; documents without hashes get zero.

    Bits are counted in the byte lanes of 64-bit words, over blocks of at most 255 hashes.
    """
    counts = np.diff(first)
    out = np.zeros(len(counts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    blocks = -(-counts[full] // 255)
    of = np.repeat(np.arange(len(full)), blocks)
    within = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = first[:-1][full][of] + 255 * within
    doc_begin = np.cumsum(blocks) - blocks
    half = counts[full][:, None]
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & LANES, begin)
        ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), doc_begin, axis=0)
        bits = (2 * ones > half).astype(np.uint64)
        for lane in range(8):
            out[full] |= bits[:, lane] << np.uint64(8 * lane + shift)
    return out


def _shingles(piece: t.Slice, width: int) -> list[list[int]]:
    """Hashes of the word shingles of each text of a slice, in order."""

    def of(raw: bytes) -> list[int]:
        words = raw.lower().split()
        if not words:
            return []
        line = b" ".join(words)
        ends = list(itertools.accumulate(map(len, words), lambda a, n: a + 1 + n))
        begins = [0, *(e + 1 for e in ends[:-1])]
        digest = xxhash.xxh64_intdigest
        return [digest(line[b:e], 42) for b, e in zip(begins, ends[width - 1 :] or ends[-1:], strict=False)]

    raw, cut = piece.data.tobytes(), piece.starts.tolist()
    return [of(raw[b:e]) for b, e in zip(cut[:-1], cut[1:], strict=True)]


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in t.slices(batch.column("text")):
                each = _shingles(piece, width)
                first = np.r_[0, np.cumsum([len(h) for h in each])].astype(np.int64)
                hashes = np.fromiter(itertools.chain.from_iterable(each), dtype=np.uint64, count=int(first[-1]))
                fp = fingerprints_of(hashes, first).view(np.int64)
                rest = batch.slice(piece.lo, piece.hi - piece.lo).drop_columns(["text"])
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(fp)], names=[*rest.schema.names, "fp"])

    return run


def with_fingerprint(docs: DataFrame, width: int = 4, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``fp``, the fingerprint as a signed long."""
    source = docs.select(*keep, "text")
    schema = source.drop("text").schema.add("fp", "long")
    return source.mapInArrow(_fingerprints(width), schema)


def _bit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many nodes set both bits i and j, for each i and j."""
    both = np.zeros((BITS, BITS))
    for batch in batches:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        bits = ((fp[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
        both += bits.T @ bits
    yield pa.RecordBatch.from_arrays([pa.array(range(BITS), pa.int32()), pa.array(list(both))], ["bit", "counts"])


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of nodes, share of nodes with each bit, and correlation of the bits, over all nodes."""
    rows = (
        nodes.select("fp")
        .mapInArrow(_bit_counts, "bit int, counts array<double>")
        .select("bit", F.posexplode("counts").alias("other", "n"))
        .groupBy("bit", "other")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    both = np.zeros((BITS, BITS))
    for r in rows:
        both[r.bit, r.other] = r.n
    n = nodes.count()
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    correlation = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    return n, share, correlation


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """``parts`` groups of equal size, each grown by the bit most correlated with it so far."""
    free = set(range(BITS))
    out = []
    for k in range(parts):
        size = len(free) // (parts - k)
        seed = max(sorted(free), key=lambda b: sum(correlation[b, o] for o in free if o != b))
        group = [seed]
        free.remove(seed)
        while len(group) < size:
            best = max(sorted(free), key=lambda b: float(correlation[b, group].sum()))
            group.append(best)
            free.remove(best)
        out.append(sorted(group))
    return out


def expected_candidates(n: int, share: np.ndarray, group: list[int], radius: int) -> float:
    """Expected pairs of nodes within ``radius`` on the group's bits, from the bits' shares."""
    distances = np.array([1.0])
    for b in group:
        p = 2 * share[b] * (1 - share[b])
        distances = np.convolve(distances, [1 - p, p])
    return n * (n - 1) / 2 * float(distances[: radius + 1].sum())


def allocate(n: int, share: np.ndarray, groups: list[list[int]], tau: int) -> tuple[float, list[int]]:
    """Thresholds of least cost whose sum is tau - m + 1, by dynamic programming over the groups."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for e in range(-1, tau - used + 1):
                probes = sum(math.comb(len(group), k) for k in range(1, e + 1)) if e > 0 else 0
                own = 0.0 if e < 0 else n * (1 + probes) + CANDIDATE_COST * expected_candidates(n, share, group, e)
                key = used + e + 1
                if key <= tau + 1 and (key not in step or cost + own < step[key][0]):
                    step[key] = (cost + own, [*chosen, e])
        best = step
    return best[tau + 1]


def plan_parts(n: int, share: np.ndarray, correlation: np.ndarray, tau: int) -> list[tuple[list[int], int]]:
    """Groups of bits and their thresholds: the cheapest over several numbers of parts."""
    options = []
    for m in PARTS:
        groups = group_bits(correlation, m)
        cost, thresholds = allocate(n, share, groups, tau)
        options.append((cost, [(g, e) for g, e in zip(groups, thresholds, strict=True) if e >= 0]))
    return min(options, key=lambda o: o[0])[1]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _bucket(part: int, own: Column):
    return lambda m: F.struct(F.lit(part).alias("part"), own.bitwiseXOR(m).alias("value"), (m != 0).alias("probe"))


def _probe_rows(parts: list[tuple[list[int], int]]) -> Column:
    """Buckets of a node: its own values of each part, and as probes the values within the threshold."""
    each = []
    for k, (group, threshold) in enumerate(parts):
        own = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in group))))
        flips = [_signed(sum(1 << b for b in c)) for r in range(1, threshold + 1) for c in itertools.combinations(group, r)]
        masks = F.transform(F.split(F.lit(",".join(map(str, [0, *flips]))), ","), lambda x: x.cast("bigint"))
        each.append(F.transform(masks, _bucket(k, own)))
    return F.flatten(F.array(*each))


def _connect(fp: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one bucket: each member and the one from which it was reached first."""
    free = np.arange(len(fp))
    a, b = [], []
    while len(free):
        reached, free = [int(free[0])], free[1:]
        start = reached[0]
        while reached and len(free):
            near = np.bitwise_count(fp[free] ^ fp[reached.pop()]) <= tau
            new = free[near]
            a.append(new)
            b.append(np.full(len(new), start))
            reached += new.tolist()
            free = free[~near]
    none = np.zeros(0, dtype=np.int64)
    return fp[np.concatenate([none, *a])], fp[np.concatenate([none, *b])]


#: Buckets of up to so many pairs are compared all at once; if that finds more than two
#: links for each member, and in larger buckets, links are taken along a search instead.
SMALL = 4096


def _links(fp: np.ndarray, probe: np.ndarray, cuts: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each bucket, rows cuts[k]:cuts[k + 1], entered members before probing ones."""
    size = np.diff(cuts)
    entered = np.add.reduceat((~probe).astype(np.int64), cuts[:-1])
    small = (entered * size <= SMALL) & (entered > 0) & (size > 1)
    k = np.flatnonzero(small)
    # Two probes need not be compared: the pair also meets where one of the two is entered.
    first = np.repeat(cuts[:-1][k], entered[k]) + _count_up(entered[k])
    bucket = np.repeat(k, entered[k])
    i = np.repeat(first, size[bucket])
    j = np.repeat(cuts[:-1][bucket], size[bucket]) + _count_up(size[bucket])
    near = (i < j) & (np.bitwise_count(fp[i] ^ fp[j]) <= tau)
    of = np.repeat(bucket, size[bucket])[near]
    dense = np.bincount(of, minlength=len(size)) > 2 * size
    plain = ~dense[of]
    a, b = [fp[i[near][plain]]], [fp[j[near][plain]]]
    for m in np.flatnonzero(dense | (~small & (entered > 0) & (size > 1))).tolist():
        x, y = _connect(fp[cuts[m] : cuts[m + 1]], tau)
        a.append(x)
        b.append(y)
    return np.concatenate(a), np.concatenate(b)


def _count_up(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the sizes, one after another."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _bucket_links(tau: int):
    keys = ("part", "value", "pair")

    def flush(table: pa.Table) -> pa.RecordBatch:
        fp = table.column("fp").to_numpy().view(np.uint64)
        change = np.zeros(len(fp) - 1, dtype=bool)
        for c in keys:
            k = table.column(c).to_numpy()
            change |= k[1:] != k[:-1]
        cuts = np.r_[0, np.flatnonzero(change) + 1, len(fp)]
        a, b = _links(fp, table.column("probe").to_numpy(), cuts, tau)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        # What goes together ends where a bucket ends; a bucket has at most two blocks.
        for batch in batches:
            table = pa.Table.from_batches([*held, batch])
            same = np.ones(len(table), dtype=bool)
            for c in keys:
                values = table.column(c).to_numpy()
                same &= values == values[-1]
            end = len(table) - int(same.sum())
            if end:
                yield flush(table.slice(0, end))
            held = table.slice(end).to_batches()
        if held:
            yield flush(pa.Table.from_batches(held))

    return run


def near_links(nodes: DataFrame, tau: int = 4) -> DataFrame:
    """Links a, b of distinct fingerprints within ``tau`` bits: enough of them to connect
    whatever is connected, and at most one for each row of a bucket."""
    n, share, correlation = bit_statistics(nodes)
    parts = plan_parts(n, share, correlation, tau)
    rows = nodes.select("fp", F.explode(_probe_rows(parts)).alias("_b")).select("fp", "_b.*")
    members = rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("members"))
    large = staged(members.where(F.col("members") > BLOCK))
    rows = rows.join(large, ["part", "value"], "left")
    blocks = F.ceil(F.coalesce("members", F.lit(1)) / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    # A member of block b meets those of block o in the pair (smaller, larger).
    pairs = F.when(blocks == 1, F.array(F.lit(0))).otherwise(
        F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.least(o, block) * blocks + F.greatest(o, block))
    )
    dealt = rows.select("fp", "part", "value", "probe", F.explode(pairs).alias("pair"))
    grouped = dealt.repartition("part", "value", "pair").sortWithinPartitions("part", "value", "pair", "probe")
    return grouped.mapInArrow(_bucket_links(tau), "a bigint, b bigint").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node of its component, for the nodes that have a link.

    Large and small stars alternate until the links do not change; each round is written to the
    shared folder. Links of a hub are spread by AQE's skew handling of the joins.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a != b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(down, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        edges = staged(small.where("a != b").distinct())
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def _labelled(fingerprints: DataFrame, tau: int) -> DataFrame:
    """fp, least (its smallest doc_id) and root, the same for all fingerprints that can be reached."""
    nodes = staged(fingerprints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(nodes, tau))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )


def near_components(fingerprints: DataFrame, tau: int = 4) -> DataFrame:
    """fp, component_id: the smallest doc_id among all fingerprints that can be reached."""
    labelled = _labelled(fingerprints, tau)
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    return labelled.join(smallest, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, width: int = 4, tau: int = 4) -> DataFrame:
    """doc_id, fp and component_id of every document."""
    fingerprints = staged(with_fingerprint(docs, width))
    found = near_components(fingerprints, tau)
    return fingerprints.join(found, "fp", "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, width: int = 4, tau: int = 4) -> DataFrame:
    """One document of each component, that of the smallest doc_id, with all columns.

    A doc_id goes before null; of texts with the same doc_id in a component, one by hash of the text stays.
    Rows that repeat the doc_id and the text that stay are one document, and all stay.
    """
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    fingerprints = staged(with_fingerprint(named, width, ("doc_id", "hash")))
    root = _labelled(fingerprints, tau).select("fp", "root")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("first")
    stays = fingerprints.join(root, "fp").groupBy("root").agg(first).select(
        F.col("first.doc_id").alias("stays_id"), F.col("first.hash").alias("stays_hash")
    )
    # The row as one struct: its names cannot clash with those of the operator.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("stays_id")) & (F.xxhash64("row.text") == F.col("stays_hash"))
    return rows.join(stays, same, "left_semi").select("row.*")
