"""Line deduplication with levelled sorted runs of line hashes.

A run is a table of line hashes, each with the number of documents that hold the line, bucketed
and sorted by hash. Every batch of documents adds one run to level 0. When a level
has ``fanout`` runs they are compacted into one run of the next level by merge joins of their buckets, which
need no shuffle. Cleaning a batch takes the hashes that reach ``min_docs`` documents in the
runs and removes the batch's lines that match them: the batch's distinct hashes meet the frequent ones in a
join, and each document keeps the lines that found no partner.

Everything is DataFrame code. A line that very many documents hold is folded before the shuffle
when it is counted; in the join the frequent side is broadcast while small, else AQE splits it.

A line's key is the line without [\\x20\\x09-\\x0D] at both ends, A-Z lower-cased, known by 128 bits
of hash. Defined cases: a null text is one empty line; empty keys are never dropped; a text all of
whose lines go is empty; rows with equal or null doc_id are separate documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.llm.stages import partitions, staged

BLANKS = " \t\n\v\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_DOCS = 10
BATCHES = 4
HASH = ["h1", "h2"]


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; plain ASCII, the common case, takes the fast function."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_key(line: Column) -> Column:
    return F.btrim(ascii_lower(line), F.lit(BLANKS))


def line_hash(line: Column) -> Column:
    """Hash of the line's key; null for an empty key."""
    key = line_key(line)
    return F.when(F.length(key) > 0, F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")))


def text_lines(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def distinct_hashes(docs: DataFrame, *keep: Column) -> DataFrame:
    """One row for each distinct line of each document."""
    hashes = F.array_distinct(F.transform(text_lines(), line_hash))
    return docs.select(*keep, F.explode(hashes).alias("_h")).where("_h is not null").select("*", "_h.*").drop("_h")


class LineRuns:
    """The runs of one corpus. ``add`` takes a batch in, ``clean`` removes frequent lines from one."""

    def __init__(self, spark: SparkSession, fanout: int = 2) -> None:
        self.spark, self.fanout = spark, fanout
        self.buckets = partitions(spark)
        self.levels: list[list[str]] = [[]]

    def _write(self, counts: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        counts = counts.repartition(self.buckets, *HASH)
        counts.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).format("parquet").saveAsTable(name)
        return name

    def _merged(self, names: list[str]) -> DataFrame:
        out = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).withColumnRenamed("n", "m")
            total = F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))
            out = out.join(other, HASH, "full").select(*HASH, total.alias("n"))
        return out

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"drop table {name}")

    def add(self, docs: DataFrame) -> None:
        self.levels[0].append(self._write(distinct_hashes(docs).groupBy(*HASH).agg(F.count(F.lit(1)).alias("n"))))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._write(self._merged(full)))
            self._drop(full)
            level += 1

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def close(self) -> None:
        self._drop(self.runs())
        self.levels = [[]]

    def frequent(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """Hashes that reach ``min_docs`` over all runs, as a table of its own."""
        return staged(self._merged(self.runs()).where(F.col("n") >= min_docs).select(*HASH))

    def clean(self, docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
        """All columns of ``docs`` as struct ``row``, with n_lines, n_dropped and kept, the text that stays."""
        row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
        # Rows that share this key may share their found lines too: all of them are frequent.
        key = F.coalesce(F.col("row.doc_id").cast("bigint"), F.xxhash64("row.text"))
        keyed = row.select("row", F.col("row.text").alias("text"), key.alias("_key"))
        found = (
            distinct_hashes(keyed, F.col("_key"))
            .join(self.frequent(min_docs), HASH, "left_semi")
            .groupBy("_key")
            .agg(F.collect_set(F.struct(*HASH)).alias("_found"))
        )
        stays = F.filter(text_lines(), lambda l: ~F.coalesce(F.array_contains("_found", line_hash(l)), F.lit(False)))
        joined = keyed.join(found, "_key", "left")
        # One evaluation of the lines that stay: the row goes through an array of one element.
        some = joined.select("row", "text", F.when(F.col("_found").isNotNull(), stays).alias("_stay"))
        whole = F.coalesce("text", F.lit(""))
        n_lines = F.size(text_lines()).cast("bigint")
        n_kept = F.when(F.col("_stay").isNull(), n_lines).otherwise(F.size("_stay").cast("bigint"))
        kept = F.when(F.col("_stay").isNull(), whole).otherwise(F.array_join("_stay", "\n"))
        return some.select("row", n_lines.alias("n_lines"), (n_lines - n_kept).alias("n_dropped"), kept.alias("kept"))


def drop_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``docs`` as ``LineRuns.clean`` gives them, after all of them were added in ``batches``."""
    runs = LineRuns(docs.sparkSession)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for b in range(batches):
        runs.add(docs.where(part == b))
    cleaned = runs.clean(docs, min_docs)
    runs.close()
    return cleaned
