"""Merging newly fetched run days into the usage history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.functions.dates import as_date
from fleetmeter.schemas import RUN_DAY_COLUMNS, RUN_DAYS
from fleetmeter.session import cut_lineage
from fleetmeter.sources.tables import read_history, table_exists, write_history_days

KEY = ["date", "company_name", "project", "run_id"]


def set_schema(df: DataFrame) -> DataFrame:
    """Cast to the history's columns. A value that cannot be cast is an error."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_DAYS.fields])


def merge_history(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """One record per run and day: the last logged, new before old on a tie.

    Full ties are settled by the other columns. The winner is the maximum of one
    struct, which folds copies of a record before they are shuffled. Without an old
    history the new rows are returned as they are.
    """
    if old is None:
        return new
    both = set_schema(new).withColumn("_is_new", F.lit(1)).unionByName(
        set_schema(old).withColumn("_is_new", F.lit(0))
    )
    rest = [c for c in RUN_DAY_COLUMNS if c not in KEY and c != "logged_at"]
    newest = F.max(F.struct("logged_at", "_is_new", *rest)).alias("_newest")
    return both.groupBy(*KEY).agg(newest).select(*KEY, "_newest.*").select(RUN_DAY_COLUMNS)


#: New rows up to which they are broadcast: about ten megabytes.
FEW_ROWS = 20_000


def merge_unique(new: DataFrame, old: DataFrame, few: bool = False) -> DataFrame:
    """``merge_history`` for an ``old`` history that has one record per run and day, as stored.

    Only the new rows are folded. Then each side loses the rows that the other one
    beats, by joins on the key. With ``few``, which the caller has to have
    counted (``FEW_ROWS``), the new ones are broadcast, and the old ones stay where they were
    read, neither shuffled nor sorted.
    """
    new, old = set_schema(new), set_schema(old)
    rest = [c for c in RUN_DAY_COLUMNS if c not in KEY and c != "logged_at"]
    newest = F.max(F.struct("logged_at", *rest)).alias("_newest")
    folded = new.groupBy(*KEY).agg(newest).select(*KEY, "_newest.*").select(RUN_DAY_COLUMNS)

    def met(rows: DataFrame, other: DataFrame, how: str, wins: Column) -> DataFrame:
        """Rows with or without one of ``other`` that has the same key and wins."""
        named = other.select([F.col(c).alias(f"_{c}") for c in (*KEY, "logged_at")])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEY]
        return rows.join(F.broadcast(named) if few else named, [*same, wins], how)

    # A time goes before none, and new before old on a tie.
    other, own = F.col("_logged_at"), F.col("logged_at")
    kept = met(old, folded, "left_anti", own.isNull() | F.coalesce(other >= own, F.lit(False)))
    # Of the old rows, those with a key of the new ones: no more than there are new ones.
    rivals = met(old.select(*KEY, "logged_at"), folded, "left_semi", F.lit(True))
    added = met(folded, rivals, "left_anti", other.isNotNull() & F.coalesce(other > own, F.lit(True)))
    return kept.unionByName(added)


def order_history(history: DataFrame) -> DataFrame:
    """Listing order: company, newest day first, run, project."""
    return history.orderBy("company_name", F.desc("date"), "run_id", "project")


def update_history(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    shared: str | None = None,
) -> DataFrame:
    """Merge ``new`` into the history table at ``path`` and return the whole history.

    New rows lie between ``start`` and ``end`` (one that does not is an error). Only the
    dates they have are read, merged and replaced: the scan of the history is pruned by
    them, and the partitions of all other dates stay as they are. New and merged
    rows are materialised in the shared folder first, as the merged ones come from the
    partitions about to be replaced.
    """
    between = F.col("date").between(F.lit(as_date(start)), F.lit(as_date(end)))
    in_range = F.coalesce(between, F.lit(False))
    day = F.coalesce(F.col("date").cast("string"), F.lit("none"))
    outside = F.raise_error(F.concat(F.lit("run day outside the range: "), day))
    new = new.where(F.when(in_range, F.lit(True)).otherwise(outside.cast("boolean")))
    if table_exists(spark, path):
        new = cut_lineage(set_schema(new), shared)
        few = new.limit(FEW_ROWS + 1).count() <= FEW_ROWS
        merged = merge_unique(new, touched_days(read_history(spark, path), new, between), few)
    else:
        merged = merge_unique(new, spark.createDataFrame([], RUN_DAYS))
    write_history_days(cut_lineage(merged, shared), path)
    return read_history(spark, path)


def touched_days(history: DataFrame, new: DataFrame, between: Column) -> DataFrame:
    """The history of the dates that ``new`` has; partitions of others are pruned at run time."""
    days = new.select("date").where(between).distinct()
    return history.where(between).join(days, "date", "left_semi").select(RUN_DAY_COLUMNS)


def company_row_counts(history: DataFrame) -> DataFrame:
    """Rows per company, and the grand total in the row whose company is null."""
    counts = history.groupBy("company_name").agg(F.count(F.lit(1)).alias("n"))
    return counts.rollup("company_name").agg(F.sum("n").alias("n_rows"))
