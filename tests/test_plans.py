"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from fleetmeter.operators import runs
from fleetmeter.operators.summary import with_previous_update
from fleetmeter.operators.usage import usage_facts
from fleetmeter.plans.reports import UsageReports
from fleetmeter.sources import config
from verification import views as v
from verification.queries import QUERIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cross_join(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_small_sides_are_broadcast_only_while_small(spark, sf_dir):
    def valid():
        windows = config.team_windows(v.companies(spark, sf_dir))
        return plan_of(
            runs.valid_runs(v.nodes(spark, sf_dir), windows, v.START, v.TARGET, v.IGNORE_TAGS)
        )

    assert "BroadcastHashJoin" in valid()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in valid()
        assert "SortMergeJoin" in valid()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_gpu_hours_do_not_shuffle_by_run(spark, sf_dir):
    reports = UsageReports.of(v.run_days(spark, sf_dir), v.companies(spark, sf_dir), v.TARGET)
    plan = plan_of(reports.hours("week_start"))
    assert "run_id" not in plan


def test_reports_read_few_columns_of_the_history(spark, sf_dir, tmp_path):
    """One scan for the sums, and one of three columns for the runs."""
    path = str(tmp_path / "history")
    v.run_days(spark, sf_dir).write.parquet(path)
    history = spark.read.parquet(path)
    reports = UsageReports.of(history, v.companies(spark, sf_dir), v.TARGET)
    for report in (reports.daily(), reports.weekly(), reports.monthly(), reports.overall()):
        plan = plan_of(report)
        scans = [line for line in plan.splitlines() if "FileScan parquet [date" in line]
        assert len(scans) == 2
        assert any(
            "ReadSchema: struct<date:date,company_name:string,run_id:string>" in s for s in scans
        )
        assert "host_name" not in plan and "logged_at" not in plan


def test_history_filters_reach_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "history")
    v.run_days(spark, sf_dir).write.partitionBy("date").parquet(path)
    from fleetmeter.operators.summary import project_summary

    plan = plan_of(project_summary(spark.read.parquet(path), v.SUMMARY_END, v.IGNORE_TAGS))
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "average_gpu_utilization" not in plan


def test_run_filters_reach_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "nodes")
    v.nodes(spark, sf_dir).write.parquet(path)
    windows = config.team_windows(v.companies(spark, sf_dir))
    plan = plan_of(
        runs.valid_runs(spark.read.parquet(path), windows, v.START, v.TARGET, v.IGNORE_TAGS)
    )
    assert "GreaterThanOrEqual(heartbeatAt,2023-12-30)" in plan
    assert "LessThan(createdAt,2024-02-07)" in plan


def test_facts_of_one_hot_company(spark, sf_dir):
    """A company with nearly all rows is folded before it meets in one task."""
    teams = spark.createDataFrame([("all", f"team-{i}") for i in range(200)], "company string, team string")
    plan = plan_of(usage_facts(v.run_days(spark, sf_dir), teams))
    assert "hashpartitioning(company" in plan and "partial_sum" in plan
    facts = usage_facts(v.run_days(spark, sf_dir), teams)
    distinct = v.run_days(spark, sf_dir).where("company_name <> 'guest'")
    assert facts.agg(F.sum("all_runs")).first()[0] == distinct.select("run_id").distinct().count()


def test_whole_rows_are_shuffled_once_for_overlaps(spark, sf_dir):
    """The payload takes part in one exchange; what crosses slices are their last rows."""
    rows = v.run_days(spark, sf_dir).withColumn("payload", F.concat("run_id", "tags"))
    flagged = with_previous_update(rows, ["company_name", "project", "host_name"], ["run_id", "date"])
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = flagged._jdf.queryExecution().explainString(mode)
    inputs = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan)
    assert len(inputs) >= 3
    assert sum("payload" in names for names in inputs) == 1
