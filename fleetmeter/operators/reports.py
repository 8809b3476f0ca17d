"""Use against allocation: GPU hours and the daily, weekly, monthly and overall reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.functions.columns import fill_round, month_key, shifted_week, sunday_week
from fleetmeter.functions.dates import as_date, last_complete_week_end

# Hours a node offers in a day (8 GPUs, 24 hours) and the rate's ceiling.
GPU_HOURS_PER_NODE_DAY = 8 * 24
MAX_RATE = 100.0

# Japanese labels of the published tables.
LABELS_JA = {
    "company": "企業名",
    "date": "日付",
    "week_start": "週開始日",
    "year_month": "年月",
    "total_gpu_hour": "合計GPU使用時間(h)",
    "utilization_rate": "GPU稼働率(%)",
    "average_gpu_utilization": "平均GPUパフォーマンス率(%)",
    "max_gpu_utilization": "最大GPUパフォーマンス率(%)",
    "average_gpu_memory": "平均GPUメモリ利用率(%)",
    "max_gpu_memory": "最大GPUメモリ利用率(%)",
}

MEASURES = [
    "total_gpu_hour",
    "utilization_rate",
    "average_gpu_utilization",
    "max_gpu_utilization",
    "average_gpu_memory",
    "max_gpu_memory",
    "n_runs",
    "assigned_gpu_node",
    "assigned_gpu_hour",
    "_total_gpu_hour",
    "total_metrics_hour",
]


def capped_hours(days: DataFrame) -> DataFrame:
    """Add a day's GPU hours, rounded, as ``_total_gpu_hour`` and capped at the
    allocation as ``total_gpu_hour``. Both are null on days without allocation."""
    allocated = (F.col("assigned_gpu_node") * GPU_HOURS_PER_NODE_DAY).cast("double")
    hours = F.when(allocated.isNotNull(), fill_round(F.col("gpu_minutes") / 60))
    return days.withColumns(
        {
            "_total_gpu_hour": hours,
            "total_gpu_hour": F.when(hours > allocated, allocated).otherwise(hours),
        }
    )


def _sum_of_tenths(column: str | Column) -> Column:
    """Sum of day totals, which have one decimal; rounding takes the noise of adding off."""
    return F.round(F.sum(column), 1)


def gpu_hours(facts: DataFrame, calendar: DataFrame, period: str = "date") -> DataFrame:
    """Capped and uncapped GPU hours per company and ``period``: ``date``, ``week_start``,
    ``year_month`` or, over all time, ``company``."""
    hours = capped_hours(
        calendar.join(facts.select("company", "date", "gpu_minutes"), ["company", "date"], "left")
    )
    if period == "date":
        return hours.select("company", "date", "total_gpu_hour", "_total_gpu_hour")
    buckets = {
        "week_start": [sunday_week(F.col("date")).alias("week_start")],
        "year_month": [month_key(F.col("date")).alias("year_month")],
        "company": [],
    }
    return hours.groupBy("company", *buckets[period]).agg(
        _sum_of_tenths("total_gpu_hour").alias("total_gpu_hour"),
        _sum_of_tenths("_total_gpu_hour").alias("_total_gpu_hour"),
    )


def _measures(usage: DataFrame, keys: list[str], empty_is_zero: bool) -> DataFrame:
    """Rates and weighted averages of one row per company and period."""
    node_hours = F.col("assigned_gpu_node") * GPU_HOURS_PER_NODE_DAY
    total, weight = F.col("total_gpu_hour"), F.col("metric_minutes")
    rate = F.when(total > node_hours, F.lit(MAX_RATE)).otherwise(
        F.try_divide(total, node_hours) * MAX_RATE
    )
    # A period without run days holds one null run id, which counts as one run.
    runs = F.coalesce(F.col("n_runs"), F.lit(0 if empty_is_zero else 1))
    return usage.select(
        *keys,
        fill_round(total).alias("total_gpu_hour"),
        fill_round(rate).alias("utilization_rate"),
        fill_round(F.try_divide("utilization_minutes", weight)).alias("average_gpu_utilization"),
        fill_round(F.col("max_gpu_utilization")).alias("max_gpu_utilization"),
        fill_round(F.try_divide("memory_minutes", weight)).alias("average_gpu_memory"),
        fill_round(F.col("max_gpu_memory")).alias("max_gpu_memory"),
        runs.cast("bigint").alias("n_runs"),
        "assigned_gpu_node",
        node_hours.cast("bigint").alias("assigned_gpu_hour"),
        "_total_gpu_hour",
        (F.coalesce(weight, F.lit(0.0)) / 60).alias("total_metrics_hour"),
    )


def _period_report(
    facts: DataFrame,
    calendar: DataFrame,
    runs_column: str,
    hours_period: list[Column],
    metrics_period: list[Column],
    complete: Column,
    empty_is_zero: bool,
) -> DataFrame:
    """Report over periods longer than a day.

    Calendar and facts meet once per company-day. Hours and nodes come from the
    allocated days, metrics and runs from all days, and both fold into the same
    period rows. Only periods with ``complete`` allocated days are reported.
    """
    days = capped_hours(
        calendar.where(complete).join(facts, ["company", "date"], "full_outer")
    )
    hours = ["total_gpu_hour", "_total_gpu_hour", "assigned_gpu_node"]
    metrics = [
        "metric_minutes",
        "utilization_minutes",
        "memory_minutes",
        "max_gpu_utilization",
        "max_gpu_memory",
        runs_column,
    ]
    if metrics_period is hours_period:
        split = days.select("company", *hours_period, *hours, *metrics)
    else:
        # Hours and metrics of a day may fall into different periods: one entry for each.
        def absent(columns: list[str]) -> list[Column]:
            return [F.lit(None).cast(days.schema[c].dataType).alias(c) for c in columns]

        hours_entry = F.struct(*hours_period, *hours, *absent(metrics))
        metrics_entry = F.struct(*metrics_period, *absent(hours), *metrics)
        split = days.select("company", F.inline(F.array(hours_entry, metrics_entry)))
    keys = [c for c in split.columns if c not in hours + metrics]
    usage = split.groupBy(*keys).agg(
        *[_sum_of_tenths(h).alias(h) for h in hours[:2]],
        F.sum("assigned_gpu_node").alias("assigned_gpu_node"),
        *[F.sum(m).alias(m) for m in metrics[:3]],
        *[F.max(m).alias(m) for m in metrics[3:5]],
        F.sum(runs_column).alias("n_runs"),
    )
    return _measures(usage.where(F.col("assigned_gpu_node").isNotNull()), keys, empty_is_zero)


def report_daily(
    facts: DataFrame, calendar: DataFrame, empty_is_zero: bool = False
) -> DataFrame:
    """Each allocated company-day."""
    days = capped_hours(calendar.join(facts, ["company", "date"], "left"))
    return _measures(
        days.withColumnRenamed("day_runs", "n_runs"), ["company", "date"], empty_is_zero
    )


def report_weekly(
    facts: DataFrame,
    calendar: DataFrame,
    target: str | dt.date,
    aligned_weeks: bool = False,
    empty_is_zero: bool = False,
) -> DataFrame:
    """Complete weeks before the week of ``target``.

    By default a Sunday's hours open a week while its metrics and runs close the
    week before; with ``aligned_weeks`` both open the week.
    """
    day = F.col("date")
    hours_week = [sunday_week(day).alias("week_start")]
    metrics_week = hours_week if aligned_weeks else [shifted_week(day).alias("week_start")]
    return _period_report(
        facts,
        calendar,
        "aligned_week_runs" if aligned_weeks else "week_runs",
        hours_week,
        metrics_week,
        day <= F.lit(last_complete_week_end(target)),
        empty_is_zero,
    )


def report_monthly(
    facts: DataFrame,
    calendar: DataFrame,
    target: str | dt.date,
    empty_is_zero: bool = False,
) -> DataFrame:
    """Months before the month of ``target``."""
    day = F.col("date")
    month = [month_key(day).alias("year_month")]
    before = day < F.lit(as_date(target).replace(day=1))
    return _period_report(facts, calendar, "month_runs", month, month, before, empty_is_zero)


def report_overall(
    facts: DataFrame, calendar: DataFrame, empty_is_zero: bool = False
) -> DataFrame:
    """All time."""
    every: list[Column] = []
    return _period_report(facts, calendar, "all_runs", every, every, F.lit(True), empty_is_zero)


def order_report(report: DataFrame) -> DataFrame:
    """Listing order: company, newest period first."""
    return report.orderBy(*report_order(report))


def report_order(report: DataFrame) -> list[Column]:
    periods = [c for c in ("date", "week_start", "year_month") if c in report.columns]
    return [F.asc("company"), *[F.desc(p) for p in periods]]


def with_labels(report: DataFrame, language: str = "ja") -> DataFrame:
    """Published column names; dates become text."""
    if language != "ja":
        raise ValueError(f"no labels for language {language!r}")
    dates = {"date", "week_start"} & set(report.columns)
    return report.select(
        [
            (F.col(c).cast("string") if c in dates else F.col(c)).alias(LABELS_JA.get(c, c))
            for c in report.columns
        ]
    )


def latest_periods(report: DataFrame, period: str, n: int) -> DataFrame:
    """The ``n`` newest periods of each company."""
    newest = Window.partitionBy("company").orderBy(F.desc(period))
    return (
        report.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= n)
        .drop("_rank")
    )
