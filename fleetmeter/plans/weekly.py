"""The weekly project files: one folder per week end, one part per team."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from fleetmeter.functions.dates import previous_week
from fleetmeter.operators.summary import weekly_project_report
from fleetmeter.sources.tables import spread_writers, write_csv


def write_weekly_files(
    run_days: DataFrame,
    target: str | dt.date,
    ignore_tags: Sequence[str],
    root: str,
) -> str:
    """CSV under ``root/week_end=<Monday>/company_name=<team>``."""
    week_end = previous_week(target)[1]
    report = weekly_project_report(run_days, target, ignore_tags)
    path = f"{root.rstrip('/')}/week_end={week_end}"
    write_csv(
        spread_writers(report, "company_name").sortWithinPartitions("company_name", "project"),
        path,
        mode="overwrite",
        partition_by=("company_name",),
    )
    return path

