"""From exported run nodes to one row per run and day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions.columns import (
    DAY,
    MINUTE,
    lower_tags_overlap,
    micros_between,
    micros_of_day,
    tags_to_json,
    utc_text_to_local,
    whole_div,
)
from fleetmeter.functions.dates import REPORT_TZ, as_date, utc_midnight
from fleetmeter.schemas import RUN_DAY_COLUMNS


def project_matches(project: Column, include: Column, ignore: Column) -> Column:
    """An include pattern decides alone; otherwise the ignore pattern must not match."""
    return F.when(include.isNotNull(), F.rlike(project, include)).otherwise(
        ignore.isNull() | ~F.rlike(project, ignore)
    )


def active_windows(windows: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Teams whose allocation window meets the report range."""
    return windows.where(
        (F.col("start_date") <= F.lit(as_date(end)))
        & (F.col("end_date") >= F.lit(as_date(start)))
    )


def select_projects(
    projects: DataFrame, windows: DataFrame, start: str | dt.date, end: str | dt.date
) -> DataFrame:
    return (
        projects.join(active_windows(windows, start, end), "team")
        .where(project_matches(F.col("project"), F.col("include_regex"), F.col("ignore_regex")))
        .select("team", "project")
    )


def normalise_runs(nodes: DataFrame, tz: str = REPORT_TZ) -> DataFrame:
    """Run columns under their own names, with local times."""
    return nodes.select(
        "team",
        "project",
        F.col("name").alias("run_id"),
        F.concat_ws("/", "team", "project", "name").alias("run_path"),
        utc_text_to_local(F.col("createdAt"), tz).alias("created_at"),
        utc_text_to_local(F.col("heartbeatAt"), tz).alias("updated_at"),
        "state",
        "tags",
        F.col("host").alias("host_name"),
        F.col("runInfo.gpu").alias("gpu_name"),
        F.when(F.col("runInfo").isNull(), F.lit(0))
        .otherwise(F.col("runInfo.gpuCount"))
        .cast("bigint")
        .alias("gpu_count"),
        "config",
    )


def valid_runs(
    nodes: DataFrame,
    windows: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    ignore_tags: Sequence[str],
    tz: str = REPORT_TZ,
    validate: bool = True,
) -> DataFrame:
    """Runs of the configured teams that count as usage in the report range.

    A run needs a device, no ignored tag, a length above zero, and days in common
    with both the report range and its team's window. ``validate=False`` keeps
    every run of the selected projects.
    """
    first, last = as_date(start), as_date(end)
    if validate:
        begins = utc_midnight(first, tz)
        stops = utc_midnight(last + dt.timedelta(days=1), tz)
        created, updated = F.to_timestamp_ntz("createdAt"), F.to_timestamp_ntz("heartbeatAt")
        nodes = nodes.where(
            # ISO text sorts by time. These two tests, a day wider than the exact ones
            # below, are left to the scan, which skips files and row groups by them.
            (F.col("heartbeatAt") >= (begins - dt.timedelta(days=1)).date().isoformat())
            & (F.col("createdAt") < (stops + dt.timedelta(days=1)).date().isoformat())
            & (updated >= F.lit(str(begins)).cast("timestamp_ntz"))
            & (created < F.lit(str(stops)).cast("timestamp_ntz"))
            & (created != updated)
            & (F.length("runInfo.gpu") > 0)
            & ~lower_tags_overlap(F.col("tags"), ignore_tags)
        )
    runs = (
        normalise_runs(nodes, tz)
        .join(active_windows(windows, first, last), "team")
        .where(project_matches(F.col("project"), F.col("include_regex"), F.col("ignore_regex")))
    )
    if validate:
        runs = runs.where(
            (F.to_date("updated_at") >= F.col("start_date"))
            & (F.to_date("created_at") <= F.col("end_date"))
        )
    return runs.drop("start_date", "end_date", "ignore_regex", "include_regex")


def run_counts(runs: DataFrame) -> DataFrame:
    """Valid runs per team and project."""
    return runs.groupBy("team", "project").agg(F.count(F.lit(1)).alias("n_runs"))


def spread_over_days(runs: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Add ``date`` and ``duration_hour``: one row per run and calendar day in the range.

    A run ticks at its start and every full minute after, up to and including its
    end; a day's hours are its ticks over 60. The ticks of a day are counted from
    its bounds, so the work grows with the days of a run, not with its minutes.
    """
    created, updated = F.col("created_at"), F.col("updated_at")
    from_day = F.greatest(F.to_date(created), F.lit(as_date(start)))
    to_day = F.least(F.to_date(updated), F.lit(as_date(end)))
    days = F.when((created <= updated) & (from_day <= to_day), F.sequence(from_day, to_day))
    # Microseconds from the run's start to the midnights before and after each day.
    nth_day = F.date_diff("date", F.to_date(created)).cast("bigint")
    day_start = nth_day * DAY - F.col("_start")
    first_tick = F.when(nth_day == 0, F.lit(0)).otherwise(_minutes_up(day_start))
    last_tick = F.least(whole_div(F.col("_length"), MINUTE), _minutes_up(day_start + DAY) - 1)
    return (
        runs.withColumns(
            {"_start": micros_of_day(created), "_length": micros_between(created, updated)}
        )
        .select("*", F.explode(days).alias("date"))
        .withColumn("_ticks", last_tick - first_tick + 1)
        .where(F.col("_ticks") > 0)
        .withColumn("duration_hour", F.col("_ticks") / F.lit(60.0))
        .drop("_start", "_length", "_ticks")
    )


def _minutes_up(micros: Column) -> Column:
    return whole_div(micros + (MINUTE - 1), MINUTE)


def split_run_path(df: DataFrame) -> DataFrame:
    """``run_path`` as its three parts."""
    parts = F.split("run_path", "/")
    return df.withColumns(
        {"company_name": parts[0], "project": parts[1], "run_id": parts[2]}
    )


def build_run_days(
    runs: DataFrame,
    metrics: DataFrame | None,
    start: str | dt.date,
    end: str | dt.date,
    logged_at: str | dt.datetime,
) -> DataFrame:
    """The canonical table: run days with the day's device metrics, null where none."""
    days = spread_over_days(runs, start, end)
    names = [
        "average_gpu_utilization",
        "average_gpu_memory",
        "max_gpu_utilization",
        "max_gpu_memory",
    ]
    if metrics is None:
        days = days.withColumns({n: F.lit(None).cast("double") for n in names})
    else:
        days = days.join(metrics.select("run_path", "date", *names), ["run_path", "date"], "left")
    return days.select(
        "date",
        F.col("team").alias("company_name"),
        "project",
        "run_id",
        tags_to_json(F.col("tags")).alias("tags"),
        "created_at",
        "updated_at",
        "state",
        "duration_hour",
        F.col("gpu_count").cast("bigint").alias("gpu_count"),
        *names,
        "host_name",
        F.lit(str(logged_at)).cast("timestamp_ntz").alias("logged_at"),
    ).select(RUN_DAY_COLUMNS)
