"""Settings, companies, schedules and GPU-count rules.

The settings file is small and read on the driver; its tables become DataFrames
so that every operator also works on a company table kept elsewhere.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter import schemas
from fleetmeter.functions.columns import glob_to_regex

# Fixed value: the end of a team's window when its last schedule entry still has nodes.
OPEN_END = "2100-01-01"


@dataclass(frozen=True)
class Settings:
    companies: list[dict]
    ignore_tags: list[str] = field(default_factory=list)
    tag_for_latest: str = "latest"
    enable_alert: bool = True
    gpu_count_rules: list[dict] = field(default_factory=list)


def load_settings(path: str) -> Settings:
    """Read a YAML or JSON settings file. A missing file is an error."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        raw = json.loads(text)
    else:
        import yaml

        raw = yaml.safe_load(text)
    return Settings(
        companies=raw["companies"],
        ignore_tags=raw.get("ignore_tags", []),
        tag_for_latest=raw.get("dashboard", {}).get("tag_for_latest", "latest"),
        enable_alert=raw.get("enable_alert", True),
        gpu_count_rules=raw.get("gpu_count_rules", []),
    )


def company_table(spark: SparkSession, settings: Settings) -> DataFrame:
    rows = [
        (
            c["company"],
            c["teams"],
            [(str(s["date"]), s["assigned_gpu_node"]) for s in c["schedule"]],
            c.get("ignore_project_pattern"),
            c.get("include_project_pattern"),
        )
        for c in settings.companies
    ]
    return spark.createDataFrame(rows, schemas.COMPANY_CONFIG)


def rules_table(spark: SparkSession, settings: Settings) -> DataFrame:
    rows = [
        (r["team"], r["node_keys"], r.get("gpu_key"), r.get("multiplier", 1))
        for r in settings.gpu_count_rules
    ]
    return spark.createDataFrame(rows, schemas.GPU_COUNT_RULES)


def team_table(companies: DataFrame) -> DataFrame:
    return companies.select("company", F.explode("teams").alias("team"))


def schedule_table(companies: DataFrame) -> DataFrame:
    """One row per change of a company's allocation."""
    return companies.select("company", F.explode("schedule").alias("entry")).select(
        "company",
        F.to_date("entry.date").alias("date"),
        F.col("entry.assigned_gpu_node").cast("bigint").alias("assigned_gpu_node"),
    )


def _ordered_schedule(companies: DataFrame) -> DataFrame:
    """Companies with first, last and final allocation read off their own schedule array."""
    entries = F.array_sort(
        F.transform(
            "schedule",
            lambda s: F.struct(
                F.to_date(s["date"]).alias("date"), s["assigned_gpu_node"].alias("node")
            ),
        )
    )
    return companies.withColumn("_entries", entries)


def team_windows(companies: DataFrame) -> DataFrame:
    """Allocation window of each team, with its project patterns as regular expressions.

    An empty pattern is none.
    """
    last = F.element_at("_entries", -1)
    return (
        _ordered_schedule(companies)
        .where(F.size("_entries") > 0)
        .select(
            F.explode("teams").alias("team"),
            F.element_at("_entries", 1)["date"].alias("start_date"),
            F.when(last["node"] == 0, last["date"])
            .otherwise(F.lit(OPEN_END).cast("date"))
            .alias("end_date"),
            glob_to_regex(F.nullif("ignore_project_pattern", F.lit(""))).alias("ignore_regex"),
            glob_to_regex(F.nullif("include_project_pattern", F.lit(""))).alias("include_regex"),
        )
    )


def schedule_spans(companies: DataFrame) -> DataFrame:
    """First and last schedule date of each company, whatever the last allocation is."""
    return _ordered_schedule(companies).select(
        "company",
        F.element_at("_entries", 1)["date"].alias("start_date"),
        F.element_at("_entries", -1)["date"].alias("end_date"),
    )
