"""Alerts and health checks. Every finding is a row ``(title, text)``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions.columns import list_text
from fleetmeter.functions.dates import as_date

# Titles and texts of the findings, and the alert's threshold in percent.
LOW_RATE_TITLE = "Too low utilization rate found."
LOW_RATE = 10
NO_ACTIVE_TITLE = "No active companies"
NO_ACTIVE_TEXT = "There are no companies currently active."
TAG_COUNT_TITLE = "Error of number of tags"
TARGET_DATE_TITLE = "Error of target date"
RUN_COUNT_TITLE = "Error of number of latest runs"
COMPANIES_TITLE = "Error of companies"
HEALTH_TITLE = "Dashboard health check"
HEALTHY_TEXT = "No errors found. All active companies are reporting as expected."
NO_DATA_TITLE = "warning"
NO_DATA_TEXT = "No data available for company: "
OVERALL = "overall"


def in_progress_companies(spans: DataFrame, target: str | dt.date) -> DataFrame:
    """Companies whose schedule has begun and whose last entry is still ahead, and
    ``overall`` when there is any."""
    day = F.lit(as_date(target))
    companies = spans.where((F.col("start_date") <= day) & (day < F.col("end_date"))).select(
        "company"
    )
    overall = (
        companies.agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 0)
        .select(F.lit(OVERALL).alias("company"))
    )
    return companies.distinct().unionByName(overall)


def health_checks(
    spans: DataFrame, registry: DataFrame, target: str | dt.date, latest: str
) -> DataFrame:
    """Findings on the published runs that carry the ``latest`` tag.

    Each must have exactly one other tag and a name ending in the target date, and
    the other tags together must be the companies in progress. With no company in
    progress that is the only finding.
    """
    day = as_date(target).isoformat()
    expected = in_progress_companies(spans, target)
    others = F.filter("tags", lambda t: t != latest)
    runs = registry.where(F.array_contains("tags", latest))

    wrong_tags = runs.where(F.size(others) != 1).select(
        F.lit(TAG_COUNT_TITLE).alias("title"), list_text(F.col("tags")).alias("text")
    )
    wrong_date = runs.where(F.element_at(F.split("name", "_"), -1) != day).select(
        F.lit(TARGET_DATE_TITLE).alias("title"),
        F.concat(F.lit(f"{day}, "), "name").alias("text"),
    )

    found = runs.where(F.size(others) == 1).select(F.get(others, 0).alias("company"))
    # Expected and found companies, matched by name: no set has to be held in one place.
    matched = (
        expected.select("company", F.lit(1).alias("expected"), F.lit(0).alias("found"))
        .unionByName(found.select("company", F.lit(0).alias("expected"), F.lit(1).alias("found")))
        .groupBy("company")
        .agg(F.max("expected").alias("expected"), F.sum("found").alias("found"))
    )
    totals = matched.agg(
        F.sum("expected").alias("expected"),
        F.sum("found").alias("found"),
        F.max((F.col("expected") > 0) != (F.col("found") > 0)).alias("differ"),
        # The message lists the found companies: one name per company, repeated as found.
        F.array_sort(
            F.flatten(F.collect_list(F.array_repeat("company", F.col("found").cast("int"))))
        ).alias("names"),
    )
    in_totals = (
        totals.select(
            F.inline(
                F.array(
                    F.struct(
                        F.lit(RUN_COUNT_TITLE).alias("title"),
                        F.lit("").alias("text"),
                        (F.col("expected") != F.col("found")).alias("raised"),
                    ),
                    F.struct(
                        F.lit(COMPANIES_TITLE).alias("title"),
                        list_text(F.col("names")).alias("text"),
                        F.col("differ").alias("raised"),
                    ),
                )
            )
        )
        .where("raised")
        .select("title", "text")
    )
    findings = wrong_tags.unionByName(wrong_date).unionByName(in_totals)
    none_active = (
        expected.agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == 0)
        .select(F.lit(NO_ACTIVE_TITLE).alias("title"), F.lit(NO_ACTIVE_TEXT).alias("text"))
    )
    return findings.where(expected.exists()).unionByName(none_active)


def health_message(findings: DataFrame) -> DataFrame:
    """All findings as the text of one alert, one line each, in text order."""
    return (
        findings.select(F.concat("title", F.lit(": "), "text").alias("line"))
        .agg(F.expr("listagg(line, '\\n') within group (order by line)").alias("text"))
        .select(
            F.lit(HEALTH_TITLE).alias("title"),
            F.coalesce("text", F.lit(HEALTHY_TEXT)).alias("text"),
        )
    )


def companies_without_rows(companies: DataFrame, report: DataFrame) -> DataFrame:
    """A warning for each company that a report has no row for."""
    return (
        companies.select("company")
        .join(report.select("company"), "company", "left_anti")
        .select(
            F.lit(NO_DATA_TITLE).alias("title"),
            F.concat(F.lit(NO_DATA_TEXT), "company").alias("text"),
        )
    )


def low_utilization_alerts(daily: DataFrame, threshold: float = LOW_RATE) -> DataFrame:
    """An alert for each company whose newest day is used less than ``threshold`` percent."""
    newest = daily.groupBy("company").agg(F.max_by("utilization_rate", "date").alias("rate"))
    return newest.where(F.col("rate") < threshold).select(
        F.lit(LOW_RATE_TITLE).alias("title"), F.col("company").alias("text")
    )
