"""Language-model scores of whole texts: context-tree weighting over bytes.

A text is coded as its tokens: A-Z lower-cased words [^\\x20\\x09-\\x0D]+, each followed by a
space, then one end byte (a line feed, which no word holds). Each byte is eight binary decisions;
each decision has its own context tree over the preceding bytes. Every context keeps
Krichevsky-Trofimov counts of the decision's outcomes in the training texts, and context-tree
weighting mixes the estimates of all depths by how well each predicted the training texts:
    P_w(context) = 1/2 P_kt(context) + 1/2 product of P_w over the context's extensions.
The mixture is frozen after training, so a text's code length is a sum over its bytes.

Counts cover all training texts and are summed in Spark, and every context seen in them counts,
however rarely. A key is a context of full depth, nearest byte first, with the byte that follows.
Keys of one context of depth ``TOP`` + 1 lie together in one task, which weighs and mixes the contexts
from there on; the contexts of up to ``TOP`` bytes (65,793 at most, whatever the corpus) are built on the
driver from the sums of the tasks. Keys that only the scored texts have are there with a count of zero.
So each key has its log-probability. Keys seen ``least_count`` / ``HELD`` times are sent to the scoring
tasks, all others are joined. Token counts for the base score stay in Spark: tokens of at least 2^-21 of
all (so at most 2^21) are sent to the scoring tasks, all others are joined.

Defined cases: null or empty texts are the end token alone; documents with equal or null ids are
separate rows. Tokens are told apart by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from fleetmeter.llm import text as t
from fleetmeter.llm.stages import staged

END = 10
SPACE = 32
#: Contexts up to so many bytes are built on the driver.
TOP = 2
#: ``least_count`` is seen by so many contexts of one depth, at most, for the cube root of the bytes, of which so many
#: count as if seen before; scoring tasks hold the keys seen a HELDth as often.
CONTEXTS, PRIOR_BYTES, HELD = 128, 1 << 27, 256
HEAVY = 2.0**-21
#: Text counted at once, and scored at once: scoring takes about 50 bytes of memory for each byte of text.
SLICE, SCORED = 4 << 20, 1 << 20
#: Keys weighed at once, at least; the keys of one context of depth TOP + 1 stay together.
WEIGHED = 1 << 18


def _stream(data: np.ndarray, found: t.Words, depth: int):
    """Coded bytes of all texts, the stream position after each text, and which bytes count.

    ``depth`` end bytes come before each text, so that no context reaches into another one.
    """
    docs = len(found.first) - 1
    # Tokens in order: the words of a text, then its end.
    n = len(found.begin) + docs
    is_end = np.zeros(n, dtype=bool)
    is_end[found.first[1:] + np.arange(docs)] = True
    begin = np.zeros(n, dtype=np.int64)
    size = np.full(n, depth - 1, dtype=np.int64)
    begin[~is_end] = found.begin
    size[~is_end] = found.end - found.begin
    out_begin = np.cumsum(size + 1) - (size + 1) + depth
    total = int((size + 1).sum()) + depth
    out = np.full(total, END, dtype=np.uint8)
    word_size, word_out = size[~is_end], out_begin[~is_end]
    flat = np.arange(int(word_size.sum())) - np.repeat(np.cumsum(word_size) - word_size, word_size)
    out[np.repeat(word_out, word_size) + flat] = data[np.repeat(found.begin, word_size) + flat]
    out[word_out + word_size] = SPACE
    counts = np.ones(total, dtype=bool)
    counts[:depth] = False
    for k in range(1, depth):
        counts[out_begin[is_end] + k] = False
    return out, out_begin[is_end] + 1, counts


def _context_keys(stream: np.ndarray, counts: np.ndarray, depth: int) -> np.ndarray:
    """Context bytes, nearest first, then the byte itself, packed for each counted byte."""
    at = np.flatnonzero(counts)
    key = np.zeros(len(at), dtype=np.int64)
    for k in range(1, depth + 1):
        key = (key << 8) | stream[at - k]
    return (key << 8) | stream[at]


def _coded(ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Where the counted bytes of each text begin among all counted bytes (one more entry than texts)."""
    return np.r_[0, np.cumsum(counts)][np.r_[0, ends]]


def _count(depth: int):
    """Counts of each slice: of its tokens (kind 0; the end is token 0) and of its keys (kind 1), in the
    texts to learn from (n) and, of keys, in all texts (seen)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            learned = batch.column("learn").to_numpy(zero_copy_only=False)
            for piece in t.slices(batch.column("text"), SLICE):
                data = t.LOWER[piece.data]
                learn = learned[piece.lo : piece.hi]
                found = t.words(data, piece.starts, t.BLANK_SEPARATED)
                hashes = t.word_hashes(data, found).view(np.int64)[np.repeat(learn, found.counts)]
                words, times = np.unique(hashes, return_counts=True)
                stream, ends, counts = _stream(data, found, depth)
                coded = np.diff(_coded(ends, counts))
                marked = _context_keys(stream, counts, depth) << 1 | np.repeat(learn, coded)
                marked, seen = np.unique(marked, return_counts=True)
                keys = marked >> 1
                begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                of_keys = np.add.reduceat(seen * (marked & 1), begin), np.add.reduceat(seen, begin)
                of_words = np.r_[times, learn.sum()]
                for kind, key, n, in_all in ((0, np.r_[words, 0], of_words, of_words), (1, keys[begin], *of_keys)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), kind, np.int8)), *(pa.array(x.astype(np.int64)) for x in (key, n, in_all))],
                        ["kind", "key", "n", "seen"],
                    )

    return run


@dataclass
class ContextTree:
    """child[node, byte]: where the context goes when extended by a byte (a leaf keeps itself).
    log10[leaf, byte]: the mixture's log-probability of the next byte, by leaf number.
    mixed and left[context, decision], for the contexts of full depth, which are the nodes from ``deepest``
    on: the chance of a one mixed so far, and the weight left for contexts that are deeper than the tree."""

    depth: int
    child: np.ndarray
    leaf: np.ndarray
    log10: np.ndarray
    deepest: int
    mixed: np.ndarray
    left: np.ndarray

    def score(self, stream: np.ndarray, counts: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(counts)
        node = np.zeros(len(at), dtype=np.int32)
        for k in range(1, self.depth + 1):
            node = self.child[node, stream[at - k]]
        out = np.zeros(len(stream))
        out[at] = self.log10[self.leaf[node], stream[at]]
        return out

    def deeper(self, keys: np.ndarray, chances: np.ndarray, depth: int) -> np.ndarray:
        """log10 of the probability of each key from the chances that deeper contexts give its eight decisions."""
        node = np.zeros(len(keys), dtype=np.int32)
        for k in range(self.depth):
            node = self.child[node, keys >> 8 * (depth - k) & 255]
        node -= self.deepest
        out = np.zeros(len(keys))
        for bits in range(8):
            decision = 1 << bits | (keys & 255) >> (8 - bits)
            mixed, left = self.mixed[node, decision], self.left[node, decision]
            so_far = np.where(keys >> (7 - bits) & 1, mixed, 1 - left - mixed)
            out += np.log10(np.clip(so_far + left * chances[:, bits], 1e-12, 1))
        return out


def _binary_counts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones of the 255 decisions of a byte, decisions numbered as in a heap from 1."""
    zeros, ones = np.zeros((len(counts), 256)), np.zeros((len(counts), 256))
    level = counts
    for bits in range(7, -1, -1):
        zeros[:, 1 << bits : 2 << bits] = level[:, 0::2]
        ones[:, 1 << bits : 2 << bits] = level[:, 1::2]
        level = level[:, 0::2] + level[:, 1::2]
    return zeros, ones


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma(x) for x > 0: Stirling's series, small x shifted up first."""
    shift = np.where(x < 8, 8.0, 0.0)
    y = x + shift
    out = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    for k in range(8):
        out -= np.where(shift > 0, np.log(x + k), 0.0)
    return out


@lru_cache(maxsize=2)
def _small(shift: float) -> np.ndarray:
    return _lgamma(np.arange(1 << 16) + shift)


def _log_gammas(n: np.ndarray, shift: float) -> np.ndarray:
    """log gamma(n + shift) of whole numbers, small ones looked up."""
    table = _small(shift)
    out = table[np.minimum(n, len(table) - 1).astype(np.int64)]
    large = n >= len(table)
    out[large] = _lgamma(n[large] + shift)
    return out


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log-probability that the Krichevsky-Trofimov estimator gives so many zeros and ones."""
    out = _log_gammas(zeros, 0.5) + _log_gammas(ones, 0.5) - math.log(math.pi) - _log_gammas(zeros + ones, 1.0)
    return np.where(zeros + ones == 0, 0.0, out)


#: Contexts handled together while the tree is built.
CHUNK = 2048


def _children_sums(values: np.ndarray, begin: np.ndarray, parents: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of each parent's extensions, which lie together; zero without any."""
    out = np.zeros((n, values.shape[1]))
    if len(values):
        out[parents] = np.add.reduceat(values, begin, axis=0, dtype=np.float64)
    return out


def build_tree(
    rows: list[tuple[int, int, dict[int, int]]], depth: int, deeper: tuple[np.ndarray, np.ndarray] | None = None
) -> ContextTree:
    """From (context depth, packed context, counts by byte) of the contexts that are kept.

    ``deeper`` has the sums of the extensions of the contexts of full depth, where those are weighted elsewhere:
    the context and decision (packed) and the log of the product of their weighted probabilities."""
    kept = sorted(rows, key=lambda r: (r[0], r[1])) or [(0, 0, {})]
    of_depth = np.array([r[0] for r in kept])
    context = np.array([r[1] for r in kept], dtype=np.int64)
    n = len(kept)
    counts = np.zeros((n, 256))
    for i, (_, _, c) in enumerate(kept):
        counts[i, list(c)] = list(c.values())
    level = np.searchsorted(of_depth, np.arange(depth + 2))
    parent = np.full(n, -1, dtype=np.int64)
    for d in range(1, depth + 1):
        lo, hi = level[d], level[d + 1]
        parent[lo:hi] = level[d - 1] + np.searchsorted(context[level[d - 1] : lo], context[lo:hi] >> 8)
    inner = np.unique(parent[1:])
    others = np.full(n, -1, dtype=np.int64)
    # Inner nodes get one leaf more, "other", for the extensions that are not kept.
    others[inner] = n + np.arange(len(inner))
    total = n + len(inner)
    child = np.repeat(np.arange(total, dtype=np.int32)[:, None], 256, axis=1)
    child[inner] = others[inner][:, None]
    child[parent[1:], context[1:] & 255] = np.arange(1, n)

    # Only the level below is needed of the weighted probabilities, and of the mixture the level above.
    below_level = np.zeros((0, 256))
    if deeper:
        further = np.zeros((level[depth + 1] - level[depth], 256))
        further[np.searchsorted(context[level[depth] :], deeper[0] >> 8), deeper[0] & 255] = deeper[1]
    stop = np.ones((n, 256))
    pooled = np.zeros((len(inner), 256), dtype=np.float32)
    for d in range(depth, -1, -1):
        weighted = np.zeros((level[d + 1] - level[d], 256))
        for lo in range(level[d], level[d + 1], CHUNK):
            hi = min(lo + CHUNK, level[d + 1])
            own = _log_kt(*_binary_counts(counts[lo:hi].astype(np.float64)))
            if deeper and d == depth:
                both = np.logaddexp(own, further[lo - level[d] : hi - level[d]]) - math.log(2)
                stop[lo:hi] = np.exp(own - math.log(2) - both)
                own = both
            weighted[lo - level[d] : hi - level[d]] = own
            first, last = np.searchsorted(parent, [lo, hi]) if d < depth else (0, 0)
            if first == last:
                continue
            mine, begin = np.unique(parent[first:last], return_index=True)
            here = mine - lo
            rest = counts[lo:hi] - _children_sums(counts[first:last], begin, here, hi - lo)
            rest = np.maximum(rest[here], 0)
            pooled[others[mine] - n] = rest
            children = below_level[first - level[d + 1] : last - level[d + 1]]
            below = _children_sums(children, begin, here, hi - lo)[here] + _log_kt(*_binary_counts(rest))
            both = np.logaddexp(own[here], below) - math.log(2)
            weighted[mine - level[d]] = both
            stop[mine] = np.exp(own[here] - math.log(2) - both)
        below_level = weighted

    # Root first: the chance of a one mixed so far, and the weight left for deeper contexts.
    logs = np.zeros((0 if deeper else total, 256), dtype=np.float32)
    above: tuple[np.ndarray, np.ndarray] | None = None
    for d in range(depth + 1):
        mixed = np.zeros((level[d + 1] - level[d], 256))
        left = np.ones_like(mixed)
        for lo in range(level[d], level[d + 1], CHUNK):
            at = np.arange(lo, min(lo + CHUNK, level[d + 1]))
            i = at - level[d]
            zeros, ones = _binary_counts(counts[at].astype(np.float64))
            if above:
                up = parent[at] - level[d - 1]
                mixed[i], left[i] = above[0][up], above[1][up]
            mixed[i] += left[i] * stop[at] * (ones + 0.5) / (zeros + ones + 1)
            left[i] *= 1 - stop[at]
            if deeper:
                continue
            logs[at] = _byte_logs(mixed[i])
            more = at[others[at] >= 0]
            zeros, ones = _binary_counts(pooled[others[more] - n].astype(np.float64))
            j = more - level[d]
            logs[others[more]] = _byte_logs(mixed[j] + left[j] * (ones + 0.5) / (zeros + ones + 1))
        above = mixed, left
    ends = np.flatnonzero(child[:, 0] == np.arange(total))
    leaf = np.full(total, -1, dtype=np.int32)
    leaf[ends] = np.arange(len(ends))
    return ContextTree(depth, child, leaf, logs if deeper else logs[ends], int(level[depth]), *above)


def _byte_logs(one: np.ndarray) -> np.ndarray:
    """log10 of the probability of each byte from the chances of a one at its decisions."""
    logs = np.zeros((len(one), 1))
    for bits in range(8):
        p = np.clip(one[:, 1 << bits : 2 << bits].astype(np.float64), 1e-12, 1 - 1e-12)
        logs = np.stack([logs + np.log10(1 - p), logs + np.log10(p)], axis=2).reshape(len(one), 2 << bits)
    return logs


def least_count(total: int) -> float:
    """How often, of ``total`` bytes, at most CONTEXTS * cbrt(total + PRIOR_BYTES) contexts of one depth can be seen."""
    return total / (CONTEXTS * (total + PRIOR_BYTES) ** (1 / 3))


def _top_contexts(contexts: DataFrame, depth: int, top: int) -> list[tuple[int, int, dict[int, int]]]:
    """All contexts of up to ``top`` bytes, with their counts by byte."""
    levels = F.explode(F.sequence(F.lit(0), F.lit(top))).alias("depth")
    counted = (
        contexts.groupBy(F.expr(f"shiftright(key, {8 * (depth - top) + 8})").alias("context"), F.col("key").bitwiseAND(255).alias("byte"))
        .agg(F.sum("n").alias("n"))
        .select(levels, "context", "byte", "n")
        .withColumn("context", F.expr(f"shiftright(context, cast(8 * ({top} - depth) as int))"))
        .groupBy("depth", "context", "byte")
        .agg(F.sum("n").alias("n"))
    )
    rows = counted.groupBy("depth", "context").agg(F.collect_list(F.struct("byte", "n")).alias("next")).collect()
    return [(r.depth, r.context, {c.byte: c.n for c in r.next}) for r in rows]


def _subtrees(keys: np.ndarray, n: np.ndarray, depth: int, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the contexts of more than ``top`` bytes give for sorted keys that are seen n times.

    The chance of each of a key's eight decisions; and for each context of ``top`` bytes and decision (packed) the
    sum of the logs of the weighted probabilities of its extensions. Only decisions that the keys take are looked
    at: any other has no counts, so its probability is 1 in all contexts.
    """
    # Depth by depth, the deepest first: context and byte (packed), their count, and where they are a depth above.
    packed, counts, up = [keys], [n.astype(np.float64)], []
    for _ in range(top + 1, depth):
        shorter, where = np.unique(packed[-1] >> 16 << 8 | packed[-1] & 255, return_inverse=True)
        up.append(where)
        counts.append(np.bincount(where, counts[-1]))
        packed.append(shorter)
    chances = np.zeros((len(keys), 8), dtype=np.float32)
    sums = []
    for bits in range(8):
        begins, groups, owns, ones_next = [], [], [], []
        for code, seen in zip(packed, counts, strict=True):
            decision = code >> (8 - bits)
            first = np.r_[True, decision[1:] != decision[:-1]]
            begin = np.flatnonzero(first)
            total = np.add.reduceat(seen, begin)
            ones = np.add.reduceat(seen * (code >> (7 - bits) & 1), begin)
            begins.append(begin)
            groups.append(np.cumsum(first) - 1)
            owns.append(_log_kt(total - ones, ones))
            ones_next.append((ones + 0.5) / (total + 1))
        weighted = owns[0]
        chance, at = ones_next[0], np.arange(len(owns[0]))
        for k, where in enumerate(up):
            parent = groups[k + 1][where[begins[k]]]
            own = owns[k + 1]
            weighted = np.logaddexp(own, np.bincount(parent, weighted, len(own))) - math.log(2)
            stop = np.exp(own - math.log(2) - weighted)
            at = parent[at]
            # Of all decisions of the deepest contexts at once: what is mixed from this depth on.
            chance = stop[at] * ones_next[k + 1][at] + (1 - stop[at]) * chance
        taken = chance[groups[0]]
        chances[:, bits] = np.where(keys >> (7 - bits) & 1, taken, 1 - taken)
        code = packed[-1][begins[-1]]
        context, where = np.unique(code >> 16 << 8 | 1 << bits | (code & 255) >> (8 - bits), return_inverse=True)
        sums.append((context, np.bincount(where, weighted)))
    return chances, np.concatenate([c for c, _ in sums]), np.concatenate([w for _, w in sums])


def _weigh(depth: int, top: int):
    """Of sorted keys, where those of a context of ``top`` + 1 bytes lie together: the chances of each key, and rows
    without chances with the sums for the contexts of ``top`` bytes."""

    def rows(keys: np.ndarray, n: np.ndarray, seen: np.ndarray) -> Iterator[pa.RecordBatch]:
        chances, decisions, sums = _subtrees(keys, n, depth, top)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, chances.size + 1, 8, dtype=np.int32)), pa.array(chances.ravel()))
        names = ["key", "seen", "chances", "weighted"]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(seen), lists, pa.nulls(len(keys), pa.float64())], names)
        empty = pa.nulls(len(sums), pa.int64()), pa.nulls(len(sums), lists.type)
        yield pa.RecordBatch.from_arrays([pa.array(decisions), *empty, pa.array(sums)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, enough = [], WEIGHED
        for batch in batches:
            waiting.append([batch.column(c).to_numpy() for c in ("key", "n", "seen")])
            if sum(len(k) for k, _, _ in waiting) < enough:
                continue
            whole = [np.concatenate(c) for c in zip(*waiting, strict=True)]
            context = whole[0] >> 8 * (depth - top)
            # The last context may go on in the next batch.
            cut = int(np.searchsorted(context, context[-1]))
            if cut:
                yield from rows(*(c[:cut] for c in whole))
            waiting = [[c[cut:] for c in whole]]
            enough = max(WEIGHED, 2 * (len(whole[0]) - cut))
        if any(len(k) for k, _, _ in waiting):
            yield from rows(*(np.concatenate(c) for c in zip(*waiting, strict=True)))

    return run


def _finish(tree, depth: int):
    """The log-probability of each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: ContextTree = tree.value
        for batch in batches:
            key = batch.column("key")
            chances = batch.column("chances").flatten().to_numpy().reshape(-1, 8)
            log10 = top.deeper(key.to_numpy(), chances, depth).astype(np.float32)
            yield pa.RecordBatch.from_arrays([key, batch.column("seen"), pa.array(log10)], ["key", "seen", "log10"])

    return run


def _by_key(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The keys in order, and the other column. As Arrow, which takes the driver far less memory than rows."""
    key, other = (c.to_numpy() for c in df.toArrow().columns)
    order = np.argsort(key)
    return key[order], other[order]


def key_figures(contexts: DataFrame, depth: int) -> DataFrame:
    """key, seen, log10: the log-probability of each key in the mixture of all contexts, from key, n and seen."""
    spark = contexts.sparkSession
    top = min(TOP, depth - 1)
    together = contexts.repartition(F.expr(f"shiftright(key, {8 * (depth - top)})")).sortWithinPartitions("key")
    weighed = staged(together.mapInArrow(_weigh(depth, top), "key bigint, seen bigint, chances array<float>, weighted double"))
    deeper = _by_key(weighed.where("chances is null").groupBy("key").agg(F.sum("weighted").alias("weighted")))
    tree = spark.sparkContext.broadcast(build_tree(_top_contexts(contexts, depth, top), top, deeper))
    own = weighed.where("chances is not null").select("key", "seen", "chances")
    return staged(own.mapInArrow(_finish(tree, depth), "key bigint, seen bigint, log10 float"))


def _score(depth: int, held, heavy):
    """Of each text, the model score of the keys that are held and its other keys, and the base-score terms of its
    frequent tokens and its other tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row = TaskContext.get().partitionId(), 0
        held_keys, held_logs = held.value
        hashes, logs = heavy.value
        for batch in batches:
            for piece in t.slices(batch.column("text"), SCORED):
                data = t.LOWER[piece.data]
                found = t.words(data, piece.starts, t.BLANK_SEPARATED)
                stream, ends, counts = _stream(data, found, depth)
                coded = _coded(ends, counts)
                keys, where = np.unique(_context_keys(stream, counts, depth), return_inverse=True)
                at = np.minimum(np.searchsorted(held_keys, keys), max(len(held_keys) - 1, 0))
                is_held = held_keys[at] == keys if len(held_keys) else np.zeros(len(keys), bool)
                values = np.where(is_held, held_logs[at], 0.0) if len(held_keys) else np.zeros(len(keys))
                running = np.r_[0.0, np.cumsum(values[where], dtype=np.float64)]
                far = ~is_held[where]
                others = np.r_[0, np.cumsum(far)][coded]
                tokens = t.word_hashes(data, found).view(np.int64)
                at = np.minimum(np.searchsorted(hashes, tokens), max(len(hashes) - 1, 0))
                known = hashes[at] == tokens if len(hashes) else np.zeros(len(tokens), bool)
                term = np.r_[0.0, np.cumsum(np.where(known, logs[at], 0.0) if len(hashes) else np.zeros(len(tokens)))]
                number = np.r_[0, np.cumsum(known)]
                rest = np.r_[0, np.cumsum(~known)][found.first]
                n = piece.hi - piece.lo
                part = batch.slice(piece.lo, n).drop_columns(["text"])
                ids = (np.int64(task) << 40) + row + np.arange(n)
                row += n
                columns = {
                    "_row": pa.array(ids),
                    "n_words": pa.array(found.counts.astype(np.int64)),
                    "n_bytes": pa.array(np.diff(coded).astype(np.int64)),
                    "_score": pa.array(np.diff(running[coded])),
                    "_far": pa.ListArray.from_arrays(pa.array(others.astype(np.int32)), pa.array(keys[where[far]])),
                    "_known": pa.array(np.diff(number[found.first]).astype(np.int64)),
                    "_base": pa.array(np.diff(term[found.first])),
                    "_rare": pa.ListArray.from_arrays(pa.array(rest.astype(np.int32)), pa.array(tokens[~known])),
                }
                yield pa.RecordBatch.from_arrays([*part.columns, *columns.values()], names=[*part.schema.names, *columns])

    return run


def score_texts(
    docs: DataFrame, training: DataFrame | str, keep: tuple[str, ...] = ("doc_id",), depth: int = 5
) -> DataFrame:
    """The ``keep`` columns with n_tokens, n_known, train_tokens, base_score (log10 of the add-half
    unigram model), score (log10 of the context-tree model) and bits_per_byte, the code length.

    ``training`` is a table with a text column, or a condition on ``docs``; both models learn from all of its rows.
    """
    spark = docs.sparkSession
    if isinstance(training, str):
        texts = docs.select("text", F.coalesce(F.expr(training), F.lit(False)).alias("learn"))
    else:
        texts = training.select("text", F.lit(True).alias("learn")).unionByName(docs.select("text", F.lit(False).alias("learn")))
    counts = texts.mapInArrow(_count(depth), "kind byte, key bigint, n bigint, seen bigint")
    counts = staged(counts.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")))
    # An empty training set still has the row of the end token in no slice: it counts nothing.
    tokens = counts.where("kind = 0 and n > 0").select("key", "n")
    sums = tokens.agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("V"), F.max(F.when(F.col("key") == 0, F.col("n"))).alias("ends")).first()
    N, V, ends = sums["N"] or 0, sums["V"], sums["ends"] or 0
    contexts = counts.where("kind = 1").select("key", "n", "seen")
    figures = key_figures(contexts, depth)
    often = F.col("seen") >= least_count(contexts.agg(F.sum("seen")).first()[0] or 0) / HELD
    held = _by_key(figures.where(often).select("key", "log10"))
    hashes, times = _by_key(tokens.where((F.col("n") >= HEAVY * N) & (F.col("key") != 0)))
    heavy = hashes, np.log10(times + 0.5)
    source = docs.select(*keep, "text")
    schema = source.drop("text").schema
    for name, kind in (("_row", "long"), ("n_words", "long"), ("n_bytes", "long"), ("_score", "double"), ("_far", ArrayType(LongType())), ("_known", "long"), ("_base", "double"), ("_rare", ArrayType(LongType()))):
        schema = schema.add(name, kind)
    broadcast = spark.sparkContext.broadcast
    scored = staged(source.mapInArrow(_score(depth, broadcast(held), broadcast(heavy)), schema))
    far = scored.select("_row", F.explode("_far").alias("key")).join(figures.where(~often).select("key", "log10"), "key")
    far = far.groupBy("_row").agg(F.sum("log10").alias("_more_score"))
    rare = scored.select("_row", F.explode("_rare").alias("key")).groupBy("_row", "key").agg(F.count(F.lit(1)).alias("times"))
    terms = (
        rare.join(tokens, "key", "left")
        .groupBy("_row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("_more_base"),
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("_more_known"),
        )
    )
    n_tokens = F.col("n_words") + 1
    end_term = math.log10(ends + 0.5)
    scale = math.log10(N + 0.5 * (V + 1))
    score = F.col("_score") + F.coalesce("_more_score", F.lit(0.0))
    return scored.join(terms, "_row", "left").join(far, "_row", "left").select(
        *keep,
        n_tokens.alias("n_tokens"),
        (F.col("_known") + F.coalesce("_more_known", F.lit(0)) + (1 if ends else 0)).alias("n_known"),
        F.lit(N).cast("bigint").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_more_base", F.lit(0.0)) + end_term - n_tokens * scale).alias("base_score"),
        score.alias("score"),
        (-score / math.log10(2) / F.col("n_bytes")).alias("bits_per_byte"),
    )
