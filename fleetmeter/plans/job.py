"""The whole scheduled job, from a settings file and optional dates."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession

from fleetmeter.functions.dates import REPORT_TZ, report_range, yesterday
from fleetmeter.plans.daily import Counters, Places, daily_update
from fleetmeter.plans.health import record_health
from fleetmeter.plans.reports import UsageReports
from fleetmeter.sources import config, tables
from fleetmeter.sources.samples import layouts, read_landed_samples


@dataclass(frozen=True)
class Landing:
    """Where exports land: run nodes as JSON lines, samples by layout or as plain Parquet, or none."""

    nodes: str
    samples: str | None = None


def read_landing(spark: SparkSession, landing: Landing) -> tuple[DataFrame, DataFrame | None]:
    nodes = tables.read_run_nodes(spark, landing.nodes)
    if landing.samples is None:
        return nodes, None
    if layouts(spark, landing.samples):
        return nodes, read_landed_samples(spark, landing.samples)
    return nodes, tables.read_metrics(spark, landing.samples)


def run_job(
    spark: SparkSession,
    settings_file: str,
    landing: Landing,
    places: Places,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    now: dt.datetime | None = None,
    csv_history: str | None = None,
    tz: str = REPORT_TZ,
    counters: Counters | None = None,
) -> UsageReports:
    """Collect, merge, report, publish, check, and write a CSV version of the history.

    Without dates the job covers yesterday in ``tz``; see ``dates.report_range`` for one
    date. ``now`` is an aware time, by default the clock's. A settings file that is missing and
    a range that ends before it starts are errors, raised before anything is written.
    """
    settings = config.load_settings(settings_file)
    now = now or dt.datetime.now(dt.UTC)
    first, last = report_range(start, end, yesterday(now, tz))
    companies = config.company_table(spark, settings)
    nodes, samples = read_landing(spark, landing)
    logged_at = now.astimezone(ZoneInfo(tz)).replace(tzinfo=None)
    reports = daily_update(
        spark, nodes, samples, companies, config.team_windows(companies), config.rules_table(spark, settings),
        places, first, last, logged_at, settings.ignore_tags, settings.tag_for_latest, settings.enable_alert, tz, counters,
    )
    if csv_history:
        tables.write_history_csv(tables.read_history(spark, places.history), csv_history, last)
    record_health(companies, tables.read_registry(spark, places.registry), last, places.alerts, settings.tag_for_latest)
    return reports
