"""Sampled device metrics reduced to one row per run and day."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.functions.columns import local_day, nan_to_null
from fleetmeter.functions.dates import REPORT_TZ, as_date, utc_midnight

# Names of the device metrics in a wide export.
GPU_PATTERN = r"`system\.gpu\.\d+\.gpu`"
MEMORY_PATTERN = r"`system\.gpu\.\d+\.memory`"


def metric_columns(samples: DataFrame, pattern: str) -> list[str]:
    return samples.select(samples.colRegex(pattern)).columns


def unpivot_metrics(wide: DataFrame) -> DataFrame:
    """Wide samples in long form: run_path, _timestamp, gpu_index, metric, value.

    A sample without a reading keeps its row: it counts as a sample.
    """
    names = metric_columns(wide, GPU_PATTERN) + metric_columns(wide, MEMORY_PATTERN)
    long = wide.unpivot(
        ["run_path", "_timestamp"], [F.col(f"`{n}`") for n in names], "_name", "value"
    )
    parts = F.split("_name", r"\.")
    return long.select(
        "run_path",
        "_timestamp",
        parts[2].cast("int").alias("gpu_index"),
        F.element_at(parts, -1).alias("metric"),
        nan_to_null(F.col("value")).alias("value"),
    )


def _across(samples: DataFrame, pattern: str) -> dict[str, Column]:
    """Count, sum and maximum over the devices of one sample, in one expression each."""
    values = [
        nan_to_null(F.col(f"`{n}`").cast("double")) for n in metric_columns(samples, pattern)
    ]
    if not values:
        return {
            "n": F.lit(0).cast("bigint"),
            "sum": F.lit(0.0),
            "max": F.lit(None).cast("double"),
        }
    return {
        "n": reduce(add, [v.isNotNull().cast("bigint") for v in values]),
        "sum": reduce(add, [F.coalesce(v, F.lit(0.0)) for v in values]),
        "max": F.greatest(*values) if len(values) > 1 else values[0],
    }


def _wide_partials(samples: DataFrame) -> DataFrame:
    gpu, memory = _across(samples, GPU_PATTERN), _across(samples, MEMORY_PATTERN)
    return samples.select(
        "run_path",
        "_timestamp",
        *[gpu[k].alias(f"gpu_{k}") for k in gpu],
        *[memory[k].alias(f"memory_{k}") for k in memory],
    )


def _long_partials(samples: DataFrame) -> DataFrame:
    value = nan_to_null(F.col("value"))

    def of(metric: str) -> list[Column]:
        mine = F.when(F.col("metric") == metric, value)
        return [
            mine.isNotNull().cast("bigint").alias(f"{metric}_n"),
            F.coalesce(mine, F.lit(0.0)).alias(f"{metric}_sum"),
            mine.alias(f"{metric}_max"),
        ]

    return samples.select("run_path", "_timestamp", "gpu_index", "metric", *of("gpu"), *of("memory"))


def _per_day(
    samples: DataFrame, start: str | dt.date, end: str | dt.date, tz: str
) -> DataFrame:
    """Samples folded per run and local day; those out of the range are in the null date of their run.

    Samples are folded before they are shuffled, so a run with very many samples costs
    no more than any other there; long ones are folded per device and metric first,
    which takes one more shuffle.
    """
    wide = "metric" not in samples.columns
    partials = _wide_partials(samples) if wide else _long_partials(samples)
    day = local_day(F.col("_timestamp"), as_date(start), as_date(end), tz)
    dated = partials.withColumn("date", day)
    samples_of_day = F.count(F.lit(1))
    folds = [
        F.min(F.col("first_ts")).alias("first_ts"),
        F.max(F.col("last_ts")).alias("last_ts"),
        *[
            f(f"{m}_{k}").alias(f"{m}_{k}")
            for m in ("gpu", "memory")
            for k, f in (("n", F.sum), ("sum", F.sum), ("max", F.max))
        ],
    ]
    dated = dated.withColumns({"first_ts": F.col("_timestamp"), "last_ts": F.col("_timestamp")})
    if not wide:
        # A long sample is a row for each device and metric: the one with most rows counts them.
        dated = dated.groupBy("run_path", "date", "gpu_index", "metric").agg(
            F.count(F.lit(1)).alias("rows"), *folds
        )
        samples_of_day = F.max("rows")
    return dated.groupBy("run_path", "date").agg(samples_of_day.alias("samples"), *folds)


def _with_totals(per_day: DataFrame) -> DataFrame:
    """Add the run's samples and readings, over all of its rows."""
    run = Window.partitionBy("run_path")
    return per_day.withColumns(
        {
            "_samples": F.sum("samples").over(run),
            "_readings": F.sum(F.col("gpu_n") + F.col("memory_n")).over(run),
        }
    )


def _daily_measures(per_day: DataFrame, with_span: bool) -> DataFrame:
    """Rows of the range, of runs with several samples and any reading."""
    kept = per_day.where(
        (F.col("_samples") > 1) & (F.col("_readings") > 0) & F.col("date").isNotNull()
    )
    columns = [
        F.try_divide("gpu_sum", "gpu_n").alias("average_gpu_utilization"),
        F.col("gpu_max").alias("max_gpu_utilization"),
        F.try_divide("memory_sum", "memory_n").alias("average_gpu_memory"),
        F.col("memory_max").alias("max_gpu_memory"),
    ]
    if with_span:
        columns.append(((F.col("last_ts") - F.col("first_ts")) / 3600).alias("metrics_hours"))
    return kept.select("run_path", "date", *columns)


def metrics_daily(
    samples: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    tz: str = REPORT_TZ,
    with_span: bool = False,
) -> DataFrame:
    """Mean and maximum of GPU use and GPU memory per run and local day.

    Readings of all devices are pooled. Runs with a single sample, counted over
    all days, and runs without any device reading give no row. ``samples`` may be
    wide or long.
    """
    return _daily_measures(_with_totals(_per_day(samples, start, end, tz)), with_span)


def metrics_of_runs(
    samples: DataFrame,
    runs: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    tz: str = REPORT_TZ,
    with_span: bool = False,
) -> DataFrame:
    """The rows of ``metrics_daily`` that belong to ``runs`` (by run_path), from few of the samples.

    First only samples in the range are read: the scan skips row groups by the range's
    epoch bounds, and a semi-join keeps the runs' own. That settles every run with two
    samples and a reading there. Samples before and after the range are then looked up
    for the other runs only, those that may owe their rows to samples outside.
    """
    first, last = as_date(start), as_date(end)
    low, high = (
        day.replace(tzinfo=dt.UTC).timestamp()
        for day in (utc_midnight(first, tz), utc_midnight(last + dt.timedelta(days=1), tz))
    )
    # A second wider than the range, whose bounds are exact to the microsecond.
    time = F.col("_timestamp")
    near = (time >= low - 1) & (time < high + 1)
    mine = runs.select("run_path").distinct()
    inside = _per_day(samples.where(near).join(mine, "run_path", "left_semi"), first, last, tz)
    settled = _with_totals(inside)
    doubtful = (
        inside.groupBy("run_path")
        .agg(
            F.sum("samples").alias("n"),
            F.sum(F.col("gpu_n") + F.col("memory_n")).alias("readings"),
        )
        .where((F.col("n") <= 1) | (F.col("readings") == 0))
        .select("run_path")
    )
    beyond = samples.where((time < low - 1) | (time >= high + 1) | time.isNull())
    outside = (
        _per_day(beyond.join(doubtful, "run_path", "left_semi"), first, last, tz)
        .groupBy("run_path")
        .agg(
            F.sum("samples").alias("_more"),
            F.sum(F.col("gpu_n") + F.col("memory_n")).alias("_more_readings"),
        )
    )
    whole = settled.join(outside, "run_path", "left").withColumns(
        {
            "_samples": F.col("_samples") + F.coalesce("_more", F.lit(0)),
            "_readings": F.col("_readings") + F.coalesce("_more_readings", F.lit(0)),
        }
    )
    return _daily_measures(whole, with_span)
