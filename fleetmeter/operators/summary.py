"""Project summaries of the previous week, and runs that overlap on one host."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.functions.columns import (
    json_tags_overlap,
    minute_number,
    whole_div,
    whole_minutes,
)
from fleetmeter.functions.dates import previous_week

# Fixed value: from this GPU count on, a run spans several nodes.
MULTI_NODE_GPUS = 9

PROJECT = ["company_name", "project"]


def with_previous_update(
    rows: DataFrame, keys: Sequence[str], ties: Sequence[str], slice_minutes: int = 1
) -> DataFrame:
    """Add ``prev_updated_at``: ``updated_at`` of the row before, by ``created_at`` and
    ``ties``, among the rows with equal ``keys``. Null keys are equal.

    A plain window would put all rows of a busy host into one task. Here the rows of
    a key are only ordered within slices of their start time. Each slice's last row,
    of two columns, is then ordered across slices, and handed on to the next slice that has
    rows by a join on the distribution the first window has made: the whole
    rows are shuffled once. So a task holds one slice, or one row per slice of a key.
    """
    key = F.struct(*keys, "_slice")
    sliced = rows.withColumn(
        "_slice", whole_div(minute_number(F.col("created_at")), slice_minutes)
    ).withColumn("_key", key)
    in_slice = Window.partitionBy("_key").orderBy("created_at", *ties)
    placed = sliced.withColumns(
        {
            "_before": F.lag("updated_at").over(in_slice),
            "_first": F.row_number().over(in_slice) == 1,
        }
    )
    ends = sliced.groupBy("_key").agg(
        F.max_by("updated_at", F.struct("created_at", *ties)).alias("_end")
    )
    across = Window.partitionBy(*[f"_key.{k}" for k in keys]).orderBy("_key._slice")
    handed = ends.select(F.col("_key").alias("_of"), F.lag("_end").over(across).alias("_handed"))
    joined = placed.join(handed, F.col("_key") == F.col("_of"))
    return joined.withColumn(
        "prev_updated_at", F.when(F.col("_first"), F.col("_handed")).otherwise(F.col("_before"))
    ).drop("_slice", "_key", "_of", "_before", "_first", "_handed")


def _overlaps() -> Column:
    return F.coalesce(F.col("created_at") < F.col("prev_updated_at"), F.lit(False))


def in_previous_week(run_days: DataFrame, end: str | dt.date) -> DataFrame:
    first, stop = previous_week(end)
    return run_days.where((F.col("date") >= F.lit(first)) & (F.col("date") < F.lit(stop)))


def runs_of(run_days: DataFrame, ignore_tags: Sequence[str]) -> DataFrame:
    """Run days folded to one row per run. The host is that of the newest day,
    which the history lists first."""
    return (
        run_days.withColumns(
            {
                "_gpu_minutes": whole_minutes(F.col("duration_hour")) * F.col("gpu_count"),
                "_multi_node": F.col("gpu_count") >= MULTI_NODE_GPUS,
                "_ignored": json_tags_overlap(F.col("tags"), ignore_tags),
            }
        )
        .groupBy(*PROJECT, "run_id")
        .agg(
            F.sum("_gpu_minutes").alias("gpu_minutes"),
            F.max("_multi_node").alias("multi_node"),
            F.max("_ignored").alias("ignored"),
            F.min("created_at").alias("created_at"),
            F.max("updated_at").alias("updated_at"),
            F.max_by("host_name", "date").alias("host_name"),
        )
    )


def project_summary(
    run_days: DataFrame, end: str | dt.date, ignore_tags: Sequence[str]
) -> DataFrame:
    """Hours, runs, multi-node runs, overlapping runs and ignored runs per project in the
    week before ``end``'s. A run overlaps when it starts before the end of the run
    started just before it on the same host."""
    runs = runs_of(in_previous_week(run_days, end), ignore_tags)
    flagged = with_previous_update(runs, [*PROJECT, "host_name"], ["run_id"])
    return flagged.groupBy(*PROJECT).agg(
        F.round(F.coalesce(F.sum("gpu_minutes"), F.lit(0.0)) / 60, 2).alias("Total hours"),
        F.count("run_id").alias("Total runs"),
        F.count_if("multi_node").alias("master_node_runs"),
        F.count_if(_overlaps()).alias("overlap_runs"),
        F.count_if("ignored").alias("ignore_runs"),
    )


def weekly_project_report(
    run_days: DataFrame, target: str | dt.date, ignore_tags: Sequence[str]
) -> DataFrame:
    """The week before ``target``'s, with overlaps taken between run days.

    Days of one run can overlap each other here, run days without a host never do,
    and every count is of distinct runs.
    """
    week = in_previous_week(run_days, target)
    flagged = with_previous_update(week, [*PROJECT, "host_name"], ["run_id", "date"])
    overlap = F.col("host_name").isNotNull() & _overlaps()
    runs = (
        flagged.groupBy(*PROJECT, "run_id")
        .agg(
            F.sum(whole_minutes(F.col("duration_hour")) * F.col("gpu_count")).alias("gpu_minutes"),
            F.max(F.col("gpu_count") >= MULTI_NODE_GPUS).alias("multi_node"),
            F.max(overlap).alias("overlap"),
            F.max(json_tags_overlap(F.col("tags"), ignore_tags)).alias("ignored"),
        )
    )
    named = F.col("run_id").isNotNull()
    return runs.groupBy(*PROJECT).agg(
        (F.coalesce(F.sum("gpu_minutes"), F.lit(0.0)) / 60).alias("Total hours"),
        F.count("run_id").alias("Total runs"),
        F.count_if(named & F.col("multi_node")).alias("master_node_runs"),
        F.count_if(named & F.col("overlap")).alias("overlap_runs"),
        F.count_if(named & F.col("ignored")).alias("ignore_runs"),
    )


def overlapping_runs(run_days: DataFrame, ignore_tags: Sequence[str] = ()) -> DataFrame:
    """Runs that start before the run started just before them on their host has ended."""
    flagged = with_previous_update(
        runs_of(run_days, ignore_tags), [*PROJECT, "host_name"], ["run_id"]
    )
    return flagged.where(_overlaps()).select(
        *PROJECT, "host_name", "run_id", "created_at", "updated_at", "prev_updated_at"
    )


def order_projects(summary: DataFrame) -> DataFrame:
    """Listing order of project summaries: team, project."""
    return summary.orderBy(*PROJECT)
