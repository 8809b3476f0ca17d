"""Daily usage facts, which every report is built from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.functions.columns import (
    nan_to_null,
    shifted_week,
    sunday_week,
    whole_minutes,
)


def with_company(run_days: DataFrame, teams: DataFrame) -> DataFrame:
    """Replace the team id in ``company_name`` by ``company``, null for unknown teams."""
    return (
        run_days.join(teams, F.col("company_name") == F.col("team"), "left")
        .drop("company_name", "team")
    )


def usage_facts(run_days: DataFrame, teams: DataFrame) -> DataFrame:
    """Additive usage per company and day, for the reports of all periods.

    Sums are kept in minutes, where they are exact. Runs are counted where they
    appear first (see ``first_days``), so that the distinct runs of any period are
    sums too. Only the run counts need a shuffle by run, of three columns; without
    them, as for GPU hours, that part drops out of the plan.
    """
    rows = with_company(run_days, teams).where(F.col("company").isNotNull())
    return day_sums(rows).join(first_days(rows), ["company", "date"], "left")


def day_sums(rows: DataFrame) -> DataFrame:
    """Minutes and metrics per company and day."""
    minutes = whole_minutes(F.col("duration_hour"))
    utilization, memory = F.col("average_gpu_utilization"), F.col("average_gpu_memory")
    return rows.groupBy("company", "date").agg(
        F.sum(minutes * F.col("gpu_count")).alias("gpu_minutes"),
        F.sum(F.when(utilization.isNotNull(), minutes)).alias("metric_minutes"),
        F.sum(utilization * minutes).alias("utilization_minutes"),
        F.sum(memory * minutes).alias("memory_minutes"),
        F.max(nan_to_null(F.col("max_gpu_utilization"))).alias("max_gpu_utilization"),
        F.max(nan_to_null(F.col("max_gpu_memory"))).alias("max_gpu_memory"),
    )


def first_days(rows: DataFrame) -> DataFrame:
    """Runs per company and day: ``day_runs`` counts a run on each of its days,
    ``week_runs`` on its first day in a week only, and so on up to ``all_runs``.

    A null run id is a run of its own.
    """
    before = F.lag("date").over(Window.partitionBy("company", "run_id").orderBy("date"))
    return (
        rows.select("company", "date", "run_id")
        .withColumn("_before", before)
        .groupBy("company", "date")
        .agg(
            _first_in(lambda d: d).alias("day_runs"),
            _first_in(shifted_week).alias("week_runs"),
            _first_in(sunday_week).alias("aligned_week_runs"),
            _first_in(lambda d: F.trunc(d, "MM")).alias("month_runs"),
            F.count_if(F.col("_before").isNull()).alias("all_runs"),
        )
    )


def _first_in(bucket) -> Column:
    before = F.col("_before")
    return F.count_if(before.isNull() | (bucket(before) != bucket(F.col("date"))))
