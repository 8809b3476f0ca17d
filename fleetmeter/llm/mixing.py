"""Interleaving sources by target weights: Pfair scheduling of blocks.

Each source's documents, in the order of a hash of their id, are cut into blocks of ``block_chars`` characters.
Weights are whole shares n of a period of Q slots. Block j (from 0) of a source with
share n is released at slot floor(j Q / n) and due at ceil((j + 1) Q / n); slots are given to
released blocks, earliest deadline first. As the shares add up to Q every slot is used and every
deadline met, so after t slots each source has had more than t n / Q - 1 and less than
t n / Q + 1 blocks. The schedule repeats after Q slots: it is worked out once for a period, by an
``aggregate`` over its slots, and joined to the blocks. Q is ``period`` for up to so many sources; for more
it is the multiple of ``period`` that leaves at least ``period`` slots to be dealt by weight besides one for each source.
Sources of equal share have the same windows and take turns, so a slot is chosen among the different
shares, of which there are at most the root of 2 Q, not among all sources.

A document's place in its source is the running sum within a slice of the hash plus the total of
the slices before, so a source that holds most rows is spread over ``SLICES`` sorts. Everything is DataFrame code,
and no document is dropped or repeated: ``in_mix`` tells the slots up to which no
source has run out, and documents beyond come in the same order without the sources that have.

Target weights: ``weights`` by source name, or else the root of each source's characters. Every
source gets at least one slot of a period. Defined cases: a null source is the source named "";
null or empty texts have no characters and lie in the block at which they start; rows equal in
id and length are ordered by their text's hash; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PERIOD = 1000
BLOCK_CHARS = 16384
SLICES = 4096
SEED = "mix"


def source_shares(totals: DataFrame, period: int, weights: dict[str, float] | None = None) -> DataFrame:
    """source, chars, n: whole shares that add up to the period, by largest remainders.

    With more sources than ``period`` they add up to a multiple of it, see above."""
    if weights is None:
        weight = F.sqrt(F.col("chars").cast("double")) + 1
    else:
        given = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair))
        weight = F.coalesce(given[F.col("source")].cast("double"), F.lit(0.0))
    # A table of one row for each source.
    every = Window.partitionBy()
    count = F.count(F.lit(1)).over(every)
    free = F.when(count <= period, period).otherwise(period * (F.ceil(count / period) + 1)) - count
    shared = totals.withColumn("_w", weight).withColumn("_sum", F.sum("_w").over(every)).withColumn("_free", free)
    exact = F.when(F.col("_sum") > 0, F.col("_w") / F.col("_sum")).otherwise(0) * F.col("_free")
    cut = shared.withColumn("_exact", exact).withColumn("_floor", F.floor("_exact"))
    left = F.col("_free") - F.sum("_floor").over(every)
    by_rest = Window.partitionBy().orderBy(F.desc(F.col("_exact") - F.col("_floor")), "source")
    ranked = cut.withColumns({"_left": left, "_rank": F.row_number().over(by_rest)})
    more = F.when(F.col("_rank") <= F.col("_left"), 1).otherwise(0)
    return ranked.select("source", "chars", (F.col("_floor") + 1 + more).cast("bigint").alias("n"))


def period_schedule(shares: DataFrame, period: int) -> DataFrame:
    """source, n, k, at: the slot of the k-th block of each source in a period, which is as long as
    the shares add up to and at least ``period``."""
    numbered = shares.select("source", "n", (F.row_number().over(Window.partitionBy().orderBy("source")) - 1).alias("i"))
    # Members of a class, the sources of one share, are served in turn: block d of the class is block d div c of one of c.
    classes = numbered.groupBy("n").agg(F.array_sort(F.collect_list("i")).alias("members"))
    listed = classes.agg(
        F.collect_list(F.struct("n", "members")).alias("g"), F.greatest(F.sum(F.col("n") * F.size("members")), F.lit(period)).alias("q")
    ).where("size(g) > 0")
    turn = "(a.done[c] div size(g[c].members))"
    released = f"filter(sequence(0, size(g) - 1), c -> {turn} * q div g[c].n <= t)"
    deadline = f"ceil(({turn} + 1) * q / g[c].n)"
    member = "g[c].members[cast(a.done[c] % size(g[c].members) as int)]"
    first = f"array_min(transform({released}, c -> struct({deadline} as due, {member} as i, c as c)))"
    step = (
        f"transform(array({first}), f -> named_struct("
        "'done', transform(a.done, (d, c) -> if(c = f.c, d + 1L, d)), 'picks', concat(a.picks, array(f.i))))[0]"
    )
    start = "named_struct('done', array_repeat(0L, size(g)), 'picks', cast(array() as array<int>))"
    picks = F.expr(f"aggregate(sequence(0L, q - 1), {start}, (a, t) -> {step}, a -> a.picks)")
    slots = listed.select(F.posexplode(picks).alias("at", "i")).join(numbered, "i").select("source", "n", "at")
    order = Window.partitionBy("source").orderBy("at")
    return slots.withColumn("k", F.row_number().over(order) - 1)


def interleave(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    period: int = PERIOD,
    block_chars: int = BLOCK_CHARS,
    carry: bool = False,
) -> DataFrame:
    """doc_id, source, chars, block, slot and in_mix of every document; reading them by slot is the
    mix. With ``carry`` all columns of ``docs`` come along as struct ``row``."""
    rows = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("chars"),
        F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")).alias("_order"),
        F.xxhash64("text").alias("_tie"),
        *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []),
    ).withColumn("_slice", F.conv(F.substring("_order", 1, 3), 16, 10).cast("int"))
    slices = rows.groupBy("source", "_slice").agg(F.sum("chars").alias("_chars"))
    earlier = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.withColumn("_offset", F.coalesce(F.sum("_chars").over(earlier), F.lit(0)))
    shares = source_shares(slices.groupBy("source").agg(F.sum("_chars").alias("chars")), period, weights)
    schedule = period_schedule(shares, period)
    # The last block of each source, and the first slot at which one of them is used up.
    whole = F.greatest(F.sum("n").over(Window.partitionBy()), F.lit(period))
    last = shares.withColumn("_last", F.greatest(F.ceil(F.col("chars") / block_chars) - 1, F.lit(0))).withColumn("_period", whole)
    ends = last.withColumn("k", (F.col("_last") % F.col("n")).cast("int")).join(schedule.drop("n"), ["source", "k"])
    used_up = F.floor(F.col("_last") / F.col("n")) * F.col("_period") + F.col("at")
    sources = ends.select("source", "n", "_period", F.min(used_up).over(Window.partitionBy()).alias("_end"))
    by_source = offsets.drop("_chars").join(sources, "source")
    inside = Window.partitionBy("source", "_slice").orderBy("_order", "doc_id", "chars", "_tie")
    before = F.coalesce(F.sum("chars").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("_before", before).join(by_source, ["source", "_slice"])
    block = F.floor((F.col("_offset") + F.col("_before")) / block_chars)
    cut = placed.withColumn("block", block).withColumn("k", (F.col("block") % F.col("n")).cast("int"))
    slot = F.floor(F.col("block") / F.col("n")) * F.col("_period") + F.col("at")
    out = cut.join(schedule.drop("n"), ["source", "k"]).withColumn("slot", slot.cast("bigint"))
    carried = ["row"] if carry else []
    return out.select("doc_id", "source", "chars", "block", "slot", (F.col("slot") <= F.col("_end")).alias("in_mix"), *carried)
