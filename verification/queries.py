"""One query per operator, on the views of ``verification.views``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.operators import (
    calendar,
    facts,
    history,
    metrics,
    quality,
    registry,
    reports,
    runs,
    summary,
)
from fleetmeter.operators.gpu_count import with_gpu_count
from fleetmeter.operators.usage import usage_facts, with_company
from fleetmeter.plans.daily import alerts_of, overall_tables, publish, update_registry
from fleetmeter.plans.reports import UsageReports
from fleetmeter.plans.weekly import write_weekly_files
from fleetmeter.session import shared_folder
from fleetmeter.sources import config, samples, tables
from verification import views as v

Query = Callable[[SparkSession, str], DataFrame]


def _reports(spark: SparkSession, sf_dir: str) -> UsageReports:
    return UsageReports.of(v.run_days(spark, sf_dir), v.companies(spark, sf_dir), v.TARGET)


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.daily_calendar(config.schedule_table(v.companies(spark, sf_dir)), v.TARGET)


def team_dim(spark, sf_dir):
    return config.team_table(v.companies(spark, sf_dir))


def team_windows(spark, sf_dir):
    return config.team_windows(v.companies(spark, sf_dir)).select("team", "start_date", "end_date")


def daily_calendar(spark, sf_dir):
    return _calendar(spark, sf_dir)


def daily_calendar_open_end(spark, sf_dir):
    schedule = config.schedule_table(v.companies(spark, sf_dir))
    return calendar.daily_calendar(schedule, v.TARGET, open_end=True)


def weekly_calendar(spark, sf_dir):
    return calendar.weekly_calendar(_calendar(spark, sf_dir), v.TARGET)


def monthly_calendar(spark, sf_dir):
    return calendar.monthly_calendar(_calendar(spark, sf_dir), v.TARGET)


def overall_calendar(spark, sf_dir):
    return calendar.overall_calendar(_calendar(spark, sf_dir))


def project_filter(spark, sf_dir):
    windows = config.team_windows(v.companies(spark, sf_dir))
    return runs.select_projects(v.projects(spark, sf_dir), windows, v.START, v.TARGET)


def _valid_runs(spark, sf_dir):
    windows = config.team_windows(v.companies(spark, sf_dir))
    return runs.valid_runs(
        v.nodes(spark, sf_dir), windows, v.START, v.TARGET, v.IGNORE_TAGS
    )


def valid_runs(spark, sf_dir):
    return _valid_runs(spark, sf_dir).select(
        "run_path",
        "created_at",
        "updated_at",
        "state",
        F.array_join("tags", ",").alias("tags"),
        "host_name",
        "gpu_name",
        "gpu_count",
    )


def valid_run_counts(spark, sf_dir):
    return runs.run_counts(_valid_runs(spark, sf_dir))


def gpu_count(spark, sf_dir):
    counted = with_gpu_count(
        runs.normalise_runs(v.nodes(spark, sf_dir)), v.gpu_rules(spark, sf_dir)
    )
    return counted.select("team", "run_id", "gpu_count")


def run_days(spark, sf_dir):
    return v.run_days(spark, sf_dir)


def metrics_daily(spark, sf_dir):
    return metrics.metrics_daily(v.wide_metrics(spark, sf_dir), v.START, v.TARGET)


def metrics_daily_long(spark, sf_dir):
    long = metrics.unpivot_metrics(v.wide_metrics(spark, sf_dir))
    return metrics.metrics_daily(long, v.START, v.TARGET)


def metrics_long(spark, sf_dir):
    return metrics.unpivot_metrics(v.wide_metrics(spark, sf_dir)).where(F.col("value").isNotNull())


def metrics_long_all(spark, sf_dir):
    return metrics.unpivot_metrics(v.wide_metrics(spark, sf_dir))


def metrics_daily_span(spark, sf_dir):
    return metrics.metrics_daily(v.wide_metrics(spark, sf_dir), v.START, v.TARGET, with_span=True)


def metrics_daily_sparse(spark, sf_dir):
    return metrics.metrics_daily(v.sparse_metrics(spark, sf_dir), v.START, v.TARGET)


def metrics_of_runs(spark, sf_dir):
    runs_ = _valid_runs(spark, sf_dir)
    return metrics.metrics_of_runs(v.sparse_metrics(spark, sf_dir), runs_, v.START, v.TARGET)


def run_days_with_metrics(spark, sf_dir):
    counted = with_gpu_count(_valid_runs(spark, sf_dir), v.gpu_rules(spark, sf_dir))
    daily = metrics.metrics_of_runs(v.wide_metrics(spark, sf_dir), counted, v.START, v.TARGET)
    return runs.build_run_days(counted, daily, v.START, v.TARGET, "2024-02-07 00:15:00")


def merge_history(spark, sf_dir):
    return history.merge_history(v.new_history(spark, sf_dir), v.old_history(spark, sf_dir))


def with_company_query(spark, sf_dir):
    return with_company(v.run_days(spark, sf_dir), team_dim(spark, sf_dir)).select(
        "company", "date", "project", "run_id", "duration_hour", "gpu_count"
    )


def daily_usage_facts(spark, sf_dir):
    return usage_facts(v.run_days(spark, sf_dir), team_dim(spark, sf_dir))


def gpu_hours_daily(spark, sf_dir):
    return _reports(spark, sf_dir).hours("date")


def gpu_hours_weekly(spark, sf_dir):
    return _reports(spark, sf_dir).hours("week_start")


def gpu_hours_monthly(spark, sf_dir):
    return _reports(spark, sf_dir).hours("year_month")


def gpu_hours_overall(spark, sf_dir):
    return _reports(spark, sf_dir).hours("company")


def report_daily(spark, sf_dir):
    return reports.order_report(_reports(spark, sf_dir).daily())


def report_weekly(spark, sf_dir):
    return reports.order_report(_reports(spark, sf_dir).weekly())


def report_weekly_aligned(spark, sf_dir):
    return reports.order_report(_reports(spark, sf_dir).weekly(aligned_weeks=True))


def report_monthly(spark, sf_dir):
    return reports.order_report(_reports(spark, sf_dir).monthly())


def report_overall(spark, sf_dir):
    return reports.order_report(_reports(spark, sf_dir).overall())


def report_recent_daily(spark, sf_dir):
    return reports.latest_periods(_reports(spark, sf_dir).daily(), "date", 30)


def report_recent_weekly(spark, sf_dir):
    return reports.latest_periods(_reports(spark, sf_dir).weekly(), "week_start", 4)


def report_daily_labelled(spark, sf_dir):
    return reports.with_labels(_reports(spark, sf_dir).daily())


def low_utilization_alerts(spark, sf_dir):
    return quality.low_utilization_alerts(_reports(spark, sf_dir).daily())


def project_summary(spark, sf_dir):
    return summary.project_summary(v.run_days(spark, sf_dir), v.SUMMARY_END, v.IGNORE_TAGS)


def weekly_project_report(spark, sf_dir):
    return summary.weekly_project_report(v.run_days(spark, sf_dir), v.SUMMARY_END, v.IGNORE_TAGS)


def overlapping_runs(spark, sf_dir):
    return summary.overlapping_runs(v.run_days(spark, sf_dir))


def company_row_counts(spark, sf_dir):
    return history.company_row_counts(v.run_days(spark, sf_dir))


def retag_latest(spark, sf_dir):
    tagged = registry.retag_latest(
        v.registry(spark, sf_dir), v.companies(spark, sf_dir), v.LATEST
    )
    return tagged.withColumn("tags", F.array_join("tags", ","))


def untagged_count(spark, sf_dir):
    tagged = registry.retag_latest(
        v.registry(spark, sf_dir), v.companies(spark, sf_dir), v.LATEST
    )
    return registry.untagged_count(tagged)


def latest_tables(spark, sf_dir):
    published = (
        _reports(spark, sf_dir)
        .daily()
        .withColumn("published_by", F.replace("company", F.lit("company-"), F.lit("p-")))
    )
    return registry.latest_tables(v.registry(spark, sf_dir), published, v.LATEST)


def _findings(spark, sf_dir, day):
    spans = config.schedule_spans(v.companies(spark, sf_dir))
    return quality.health_checks(spans, v.registry(spark, sf_dir), day, v.LATEST)


def in_progress_companies(spark, sf_dir):
    spans = config.schedule_spans(v.companies(spark, sf_dir))
    return quality.in_progress_companies(spans, v.HEALTH_DAY)


def health_checks(spark, sf_dir):
    return _findings(spark, sf_dir, v.HEALTH_DAY)


def health_checks_inactive(spark, sf_dir):
    return _findings(spark, sf_dir, "2025-01-01")


def health_message(spark, sf_dir):
    return quality.health_message(_findings(spark, sf_dir, v.HEALTH_DAY))


def missing_companies(spark, sf_dir):
    return quality.companies_without_rows(
        v.companies(spark, sf_dir), _reports(spark, sf_dir).daily()
    )


# Sinks, read back. Each run writes to its own place in the shared folder.


def _place(spark: SparkSession, name: str) -> str:
    """A new folder in the folder that all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def csv_round_trip(spark, sf_dir):
    path = tables.write_history_csv(v.run_days(spark, sf_dir), _place(spark, "csv"), v.TARGET)
    return tables.read_history_csv(spark, path)


def history_update(spark, sf_dir):
    """The first fetch and a later one, merged into a table partitioned by date."""
    place = _place(spark, "history")
    path, shared = f"{place}/table", f"{place}/checkpoints"
    history.update_history(
        spark, path, v.old_history(spark, sf_dir), v.START, "2024-01-20", shared
    )
    return history.update_history(
        spark, path, v.new_history(spark, sf_dir), "2024-01-15", v.TARGET, shared
    )


def history_update_late(spark, sf_dir):
    """Late rows of two days, merged into a history that holds all days between."""
    place = _place(spark, "history")
    path, shared = f"{place}/table", f"{place}/checkpoints"
    history.update_history(spark, path, v.run_days(spark, sf_dir), v.START, v.TARGET, shared)
    return history.update_history(
        spark, path, v.late_history(spark, sf_dir), v.START, v.TARGET, shared
    )


def csv_round_trip_text(spark, sf_dir):
    path = tables.write_history_csv(v.awkward_run_days(spark, sf_dir), _place(spark, "csv"), v.TARGET)
    return tables.read_history_csv(spark, path)


def latest_history_version(spark, sf_dir):
    """Two versions of one end date and one of an earlier end, written last: the last written counts."""
    root = _place(spark, "versions")
    for days, end in (
        (v.new_history(spark, sf_dir), v.TARGET),
        (v.run_days(spark, sf_dir), v.TARGET),
        (v.old_history(spark, sf_dir), "2024-01-20"),
    ):
        tables.write_history_csv(days, root, end)
    return tables.latest_history_csv(spark, root)


def registry_update(spark, sf_dir):
    """The registry after publications of two days, the second one twice."""
    path = _place(spark, "registry")
    tables.write_registry(v.registry(spark, sf_dir), path)
    for end in ("2024-02-05", v.TARGET, v.TARGET):
        entered = update_registry(spark, path, v.companies(spark, sf_dir), end, v.LATEST)
    return entered.withColumn("tags", F.array_join("tags", ","))


def latest_published(spark, sf_dir):
    """The published rows of the latest of two runs, found through the registry."""
    place, daily = _place(spark, "published"), _reports(spark, sf_dir).daily()
    for end in ("2024-02-05", v.TARGET):
        publish({"daily": daily}, place, f"Tables_{end}", by_company=True)
        entered = update_registry(spark, f"{place}/registry", v.companies(spark, sf_dir), end, v.LATEST)
    published = tables.read_published(spark, place, "daily", daily.schema, by_company=True)
    return registry.latest_tables(entered, published, v.LATEST)


def _published(spark, sf_dir, name):
    place, tables_of = _place(spark, "published"), overall_tables(_reports(spark, sf_dir))
    publish({name: tables_of[name]}, place, "Tables", by_company=False)
    return tables.read_published(spark, place, name, tables_of[name].schema, by_company=False).drop("run", "published_by")


def published_overall(spark, sf_dir):
    return _published(spark, sf_dir, "overall_gpu_usage")


def published_monthly(spark, sf_dir):
    return _published(spark, sf_dir, "monthly_gpu_usage")


def published_weekly(spark, sf_dir):
    return _published(spark, sf_dir, "weekly_gpu_usage")


def alerts_table(spark, sf_dir):
    """Alerts of a job that ran twice for its day, read back."""
    root = _place(spark, "alerts")
    found = alerts_of(_reports(spark, sf_dir), v.companies(spark, sf_dir))
    for _ in range(2):
        tables.record_alerts(found, "daily_update", v.TARGET, root)
    return spark.read.parquet(root).select("title", "text", "source", F.col("raised_for").cast("string"))


def usage_facts_kept(spark, sf_dir):
    """Facts kept as a table: built from the first days, then updated twice by the later ones."""
    root, days = _place(spark, "facts"), v.run_days(spark, sf_dir)
    teams = team_dim(spark, sf_dir)
    known = days.where("date < '2024-01-21'")
    facts.update_usage_facts(known, teams, known.select("date"), root)
    for first in ("2024-01-21", "2024-01-20"):
        facts.update_usage_facts(days, teams, days.where(F.col("date") >= first).select("date"), root)
    return facts.read_usage_facts(spark, root)


def landed_samples(spark, sf_dir):
    """Samples that landed in two layouts, one of both devices and one of the first only."""
    place, wide = _place(spark, "landed"), v.wide_metrics(spark, sf_dir)
    names = list(v.METRIC_NAMES.values())
    second = F.col(f"`{names[2]}`").isNotNull()
    samples.land_samples(wide.where(second), place, "a")
    samples.land_samples(wide.where(~second).drop(*names[2:]), place, "b")
    return samples.read_landed_samples(spark, place).where(F.col("value").isNotNull())


def weekly_files(spark, sf_dir):
    path = write_weekly_files(
        v.run_days(spark, sf_dir), v.SUMMARY_END, v.IGNORE_TAGS, _place(spark, "weekly")
    )
    columns = "project string, `Total hours` double, `Total runs` bigint, "
    counts = "master_node_runs bigint, overlap_runs bigint, ignore_runs bigint"
    return (
        spark.read.schema(columns + counts + ", company_name string")
        .option("header", True)
        .option("basePath", path)
        .csv(path)
    )


def published_daily(spark, sf_dir):
    root = _place(spark, "published")
    publish({"daily": _reports(spark, sf_dir).daily()}, root, "Tables", by_company=True)
    return spark.read.parquet(f"{root}/daily").drop("run", "published_by")


QUERIES: dict[str, Query] = {
    "team_dim": team_dim,
    "team_windows": team_windows,
    "daily_calendar": daily_calendar,
    "daily_calendar_open_end": daily_calendar_open_end,
    "weekly_calendar": weekly_calendar,
    "monthly_calendar": monthly_calendar,
    "overall_calendar": overall_calendar,
    "project_filter": project_filter,
    "valid_runs": valid_runs,
    "valid_run_counts": valid_run_counts,
    "gpu_count": gpu_count,
    "run_days": run_days,
    "metrics_long": metrics_long,
    "metrics_daily": metrics_daily,
    "metrics_daily_long": metrics_daily_long,
    "metrics_long_all": metrics_long_all,
    "metrics_daily_span": metrics_daily_span,
    "metrics_daily_sparse": metrics_daily_sparse,
    "metrics_of_runs": metrics_of_runs,
    "run_days_with_metrics": run_days_with_metrics,
    "merge_history": merge_history,
    "with_company": with_company_query,
    "usage_facts": daily_usage_facts,
    "gpu_hours_daily": gpu_hours_daily,
    "gpu_hours_weekly": gpu_hours_weekly,
    "gpu_hours_monthly": gpu_hours_monthly,
    "gpu_hours_overall": gpu_hours_overall,
    "report_daily": report_daily,
    "report_weekly": report_weekly,
    "report_weekly_aligned": report_weekly_aligned,
    "report_monthly": report_monthly,
    "report_overall": report_overall,
    "report_recent_daily": report_recent_daily,
    "report_recent_weekly": report_recent_weekly,
    "report_daily_labelled": report_daily_labelled,
    "low_utilization_alerts": low_utilization_alerts,
    "project_summary": project_summary,
    "weekly_project_report": weekly_project_report,
    "overlapping_runs": overlapping_runs,
    "company_row_counts": company_row_counts,
    "retag_latest": retag_latest,
    "untagged_count": untagged_count,
    "latest_tables": latest_tables,
    "in_progress_companies": in_progress_companies,
    "health_checks": health_checks,
    "health_checks_inactive": health_checks_inactive,
    "health_message": health_message,
    "missing_companies": missing_companies,
    "csv_round_trip": csv_round_trip,
    "history_update": history_update,
    "weekly_files": weekly_files,
    "published_daily": published_daily,
    "history_update_late": history_update_late,
    "csv_round_trip_text": csv_round_trip_text,
    "latest_history_version": latest_history_version,
    "registry_update": registry_update,
    "latest_published": latest_published,
    "published_overall": published_overall,
    "published_monthly": published_monthly,
    "published_weekly": published_weekly,
    "alerts_table": alerts_table,
    "usage_facts_kept": usage_facts_kept,
    "landed_samples": landed_samples,
}
