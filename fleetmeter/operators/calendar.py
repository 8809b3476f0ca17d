"""Allocation calendars: company by day, week, month and all time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.functions.columns import month_key, sunday_week
from fleetmeter.functions.dates import as_date, last_complete_week_end


def daily_calendar(
    schedule: DataFrame, target: str | dt.date, open_end: bool = False
) -> DataFrame:
    """Nodes allocated to each company on each day up to ``target``.

    Each schedule row holds until the day before the next one. The last row holds
    for its own day only, or up to ``target`` with ``open_end``. Days without
    nodes are left out.
    """
    stop = F.lit(as_date(target))
    by_date = Window.partitionBy("company").orderBy("date")
    spans = schedule.select(
        "company",
        F.col("date").alias("_from"),
        F.last("assigned_gpu_node", ignorenulls=True).over(by_date).alias("assigned_gpu_node"),
        F.lead("date").over(by_date).alias("_next"),
    ).where((F.col("assigned_gpu_node") > 0) & (F.col("_from") <= stop))
    last_day = stop if open_end else F.col("_from")
    until = F.least(F.coalesce(F.date_sub("_next", 1), last_day), stop)
    days = F.when(F.col("_from") <= until, F.sequence("_from", until))
    return spans.select("company", F.explode(days).alias("date"), "assigned_gpu_node")


def weekly_calendar(daily: DataFrame, target: str | dt.date) -> DataFrame:
    """Node-days per Sunday-to-Saturday week, complete weeks only."""
    return (
        daily.where(F.col("date") <= F.lit(last_complete_week_end(target)))
        .groupBy("company", sunday_week(F.col("date")).alias("week_start"))
        .agg(F.sum("assigned_gpu_node").alias("assigned_gpu_node"))
    )


def monthly_calendar(daily: DataFrame, target: str | dt.date) -> DataFrame:
    """Node-days per month before the month of ``target``."""
    return (
        daily.where(F.col("date") < F.lit(as_date(target).replace(day=1)))
        .groupBy("company", month_key(F.col("date")).alias("year_month"))
        .agg(F.sum("assigned_gpu_node").alias("assigned_gpu_node"))
    )


def overall_calendar(daily: DataFrame) -> DataFrame:
    return daily.groupBy("company").agg(F.sum("assigned_gpu_node").alias("assigned_gpu_node"))


def order_calendar(calendar: DataFrame) -> DataFrame:
    """Listing order: oldest period first, then company."""
    return calendar.orderBy(*calendar_order(calendar))


def calendar_order(calendar: DataFrame) -> list[str]:
    return [c for c in ("date", "week_start", "year_month", "company") if c in calendar.columns]
