"""Sources, sinks and whole jobs, written and read back."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetmeter import schemas
from fleetmeter.operators.history import merge_history, order_history, update_history
from fleetmeter.operators.metrics import metrics_daily
from fleetmeter.operators.registry import latest_tables
from fleetmeter.plans.daily import Places, collect_run_days, daily_update
from fleetmeter.plans.health import check_health
from fleetmeter.plans.weekly import write_weekly_files
from fleetmeter.session import shared_folder
from fleetmeter.sources import config, tables
from fleetmeter.streaming.history import stream_into_history
from verification import queries as q
from verification import views as v


def same(a, b) -> bool:
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


SETTINGS = """
enable_alert: true
ignore_tags: ["other_gpu"]
dashboard:
  tag_for_latest: newest
gpu_count_rules:
  - {team: a1, node_keys: [num_nodes], gpu_key: num_gpus}
  - {team: a2, node_keys: [NNODES], multiplier: 8}
companies:
  - company: a
    teams: [a1, a2]
    schedule:
      - {date: "2024-11-01", assigned_gpu_node: 6}
      - {date: "2024-11-05", assigned_gpu_node: 0}
    include_project_pattern: "gpu-*"
  - company: b
    teams: [b1]
    schedule:
      - {date: 2024-11-02, assigned_gpu_node: 1}
"""


def test_settings(spark, tmp_path):
    file = tmp_path / "settings.yaml"
    file.write_text(SETTINGS)
    settings = config.load_settings(str(file))
    assert (settings.tag_for_latest, settings.ignore_tags) == ("newest", ["other_gpu"])
    table = config.company_table(spark, settings)
    assert rows(config.team_table(table), "team") == [("a", "a1"), ("a", "a2"), ("b", "b1")]
    assert config.schedule_table(table).count() == 3
    assert rows(config.rules_table(spark, settings), "team") == [
        ("a1", ["num_nodes"], "num_gpus", 1),
        ("a2", ["NNODES"], None, 8),
    ]
    as_json = tmp_path / "settings.json"
    as_json.write_text(json.dumps({"companies": settings.companies}, default=str))
    assert same(config.company_table(spark, config.load_settings(str(as_json))), table)
    with pytest.raises(FileNotFoundError):
        config.load_settings(str(tmp_path / "none.yaml"))


def test_csv_round_trip(spark, sf_dir, tmp_path):
    days = v.run_days(spark, sf_dir).withColumn(
        "tags", F.when(F.col("gpu_count") == 1, F.lit('["a, b", "c\\"d"]')).otherwise(F.col("tags"))
    )
    path = tables.write_history_csv(days, str(tmp_path), v.TARGET)
    assert path.endswith(f"version={v.TARGET}")
    back = tables.read_history_csv(spark, path)
    assert back.schema == schemas.RUN_DAYS
    assert same(back, days)


def test_broken_csv_is_an_error(spark, tmp_path):
    header = ",".join(schemas.RUN_DAY_COLUMNS)
    (tmp_path / "bad.csv").write_text(f"{header}\n2024-01-01,t,p,r,[],x,y,s,many,1,,,,,h,z\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILED_READ_FILE"):
        tables.read_history_csv(spark, str(tmp_path)).collect()


def test_missing_history_is_empty(spark, tmp_path):
    got = tables.read_history(spark, str(tmp_path / "none"))
    assert got.schema == schemas.RUN_DAYS and got.count() == 0


def test_landed_json(spark, sf_dir, tmp_path):
    path = str(tmp_path / "nodes")
    v.nodes(spark, sf_dir).write.json(path)
    assert same(
        tables.read_run_nodes(spark, path).withColumn("tags", F.to_json("tags")),
        v.nodes(spark, sf_dir).withColumn("tags", F.to_json("tags")),
    )


def test_metric_files_with_different_devices(spark, tmp_path):
    path = str(tmp_path / "metrics")
    start = dt.datetime(2024, 11, 1, tzinfo=dt.UTC).timestamp()
    for name, device in (("a", 0), ("b", 3)):
        spark.createDataFrame(
            [(name, start, 10.0 + device), (name, start + 60, 20.0 + device)],
            f"run_path string, _timestamp double, `system.gpu.{device}.gpu` double",
        ).write.mode("append").parquet(path)
    got = metrics_daily(tables.read_metrics(spark, path), "2024-11-01", "2024-11-01")
    shown = got.select("run_path", "average_gpu_utilization", "max_gpu_utilization")
    assert rows(shown, "run_path") == [("a", 15.0, 20.0), ("b", 18.0, 23.0)]


def test_history_replaces_only_its_dates(spark, sf_dir, tmp_path, shared):
    path = str(tmp_path / "history")
    old, new = v.old_history(spark, sf_dir), v.new_history(spark, sf_dir)
    update_history(spark, path, old, v.START, "2024-01-20", shared)
    untouched = sorted((tmp_path / "history" / "date=2024-01-10").iterdir())
    got = update_history(spark, path, new, "2024-01-15", v.TARGET, shared)
    assert same(got, merge_history(new, old))
    assert sorted((tmp_path / "history" / "date=2024-01-10").iterdir()) == untouched
    again = update_history(spark, path, new, "2024-01-15", v.TARGET, shared)
    assert same(again, merge_history(new, old))
    listed = order_history(again).select("company_name", "date", "run_id", "project").collect()
    assert listed == sorted(
        listed, key=lambda r: (r[0], -r[1].toordinal(), r[2], r[3])
    )


def test_history_refuses_rows_outside_the_range(spark, sf_dir, tmp_path, shared):
    with pytest.raises(Exception, match="outside the range"):
        update_history(
            spark, str(tmp_path / "h"), v.run_days(spark, sf_dir), "2024-01-15", v.TARGET, shared
        )


def test_empty_fetch_keeps_history(spark, sf_dir, tmp_path, shared):
    path = str(tmp_path / "history")
    old = v.old_history(spark, sf_dir)
    update_history(spark, path, old, v.START, v.TARGET, shared)
    empty = spark.createDataFrame([], schemas.RUN_DAYS)
    assert same(update_history(spark, path, empty, v.START, v.TARGET, shared), old)


def test_stream_merges_landed_files_once(spark, sf_dir, tmp_path, shared):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "history")
    old, new = v.old_history(spark, sf_dir), v.new_history(spark, sf_dir)
    for batch in (old, new):
        batch.write.mode("append").parquet(landing)
        stream_into_history(spark, landing, path, str(tmp_path / "state"), shared).awaitTermination()
    stream_into_history(spark, landing, path, str(tmp_path / "state"), shared).awaitTermination()
    assert same(tables.read_history(spark, path), merge_history(new, old))


def test_weekly_files(spark, sf_dir, tmp_path):
    path = write_weekly_files(v.run_days(spark, sf_dir), v.SUMMARY_END, v.IGNORE_TAGS, str(tmp_path))
    assert path.endswith("week_end=2024-01-22")
    expected = q.weekly_project_report(spark, sf_dir)
    back = spark.read.option("header", True).option("basePath", path).schema(
        expected.drop("company_name").schema.add("company_name", "string")
    ).csv(path)
    assert same(back.select(expected.columns), expected)


@pytest.fixture
def places(tmp_path, shared):
    return Places(*[str(tmp_path / n) for n in ("history", "published", "registry", "alerts")], shared)


def test_daily_job(spark, sf_dir, places):
    companies = v.companies(spark, sf_dir)
    windows, rules = config.team_windows(companies), v.gpu_rules(spark, sf_dir)
    nodes, samples = v.nodes(spark, sf_dir), v.wide_metrics(spark, sf_dir)
    for end in ("2024-01-19", "2024-01-20"):
        reports = daily_update(
            spark, nodes, samples, companies, windows, rules, places,
            v.START, end, f"{end} 23:59:00", v.IGNORE_TAGS, v.LATEST,
        )
    history = tables.read_history(spark, places.history)
    expected = collect_run_days(
        nodes, samples, windows, rules, v.START, "2024-01-20", "2024-01-20 23:59:00", v.IGNORE_TAGS
    )
    assert same(history, expected)

    published = spark.read.parquet(f"{places.published}/company_daily_gpu_usage")
    registry = tables.read_registry(spark, places.registry)
    assert published.select("run").distinct().count() == 2
    newest = latest_tables(registry, published, v.LATEST)
    assert [r.run for r in newest.select("run").distinct().collect()] == ["Tables_2024-01-20"]
    columns = reports.daily().columns
    assert same(newest.select(columns), reports.daily())
    for table in ("overall_gpu_usage", "monthly_gpu_usage", "weekly_gpu_usage", "company_summary",
                  "company_daily_gpu_usage_within_30days", "company_weekly_gpu_usage",
                  "company_weekly_gpu_usage_within_4weeks"):
        assert spark.read.parquet(f"{places.published}/{table}").columns

    assert tables.with_tag(registry, v.LATEST).count() == companies.count() + 1
    assert tables.with_tag(registry).count() == 2 * (companies.count() + 1)
    message = check_health(companies, registry, "2024-01-20", v.LATEST).first().text
    assert message.startswith("No errors found.")
    late = check_health(companies, registry, "2024-01-21", v.LATEST).first().text
    assert "Error of target date: 2024-01-21, Tables_2024-01-20" in late
    alerts = spark.read.parquet(places.alerts)
    assert {str(r.raised_for) for r in alerts.collect()} == {"2024-01-19", "2024-01-20"}


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark, "/tmp/only-in-tests") == named.rstrip("/")
    else:
        assert shared_folder(spark, "/tmp/only-in-tests/") == "/tmp/only-in-tests"
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(spark)
