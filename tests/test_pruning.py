"""Pruned reads and writes: same results as the plain operators, from fewer rows and files."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_plans import plan_of

from fleetmeter import schemas
from fleetmeter.operators.history import merge_history, merge_unique, touched_days, update_history
from fleetmeter.operators.metrics import metrics_daily, metrics_of_runs, unpivot_metrics
from fleetmeter.operators.registry import latest_tables
from fleetmeter.plans.daily import publish
from fleetmeter.sources import tables
from fleetmeter.streaming.history import stream_into_history
from verification import queries as q
from verification import views as v


def same(a, b) -> bool:
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("samples", [v.wide_metrics, v.sparse_metrics])
@pytest.mark.parametrize("long", [False, True])
@pytest.mark.parametrize("start, end, tz", [(v.START, v.TARGET, "Asia/Tokyo"), ("2024-01-09", "2024-01-10", "Europe/Paris")])
def test_metrics_of_runs_are_those_of_all_samples(spark, sf_dir, samples, long, start, end, tz):
    given = samples(spark, sf_dir)
    given = unpivot_metrics(given) if long else given
    runs = q.valid_runs(spark, sf_dir)
    whole = metrics_daily(given, start, end, tz, with_span=True).join(runs.select("run_path"), "run_path", "left_semi")
    assert same(metrics_of_runs(given, runs, start, end, tz, with_span=True), whole)
    assert whole.count() > 0


def test_metrics_of_runs_with_missing_times_and_repeated_runs(spark):
    day = dt.datetime(2024, 11, 1, 3, tzinfo=dt.UTC).timestamp()
    given = [("a", day, 1.0), ("a", None, 2.0), ("b", day, 3.0), ("b", float("nan"), None), ("c", day, 4.0), ("d", day, 5.0), ("d", day, 7.0)]
    samples = spark.createDataFrame(given, "run_path string, _timestamp double, `system.gpu.0.gpu` double")
    runs = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "run_path string")
    got = metrics_of_runs(samples, runs, "2024-11-01", "2024-11-01")
    # One sample of a and b has no time: it counts, but belongs to no day.
    assert rows(got.select("run_path", "max_gpu_utilization"), "run_path") == [("a", 1.0), ("b", 3.0)]


def test_samples_are_read_by_time_and_run(spark, sf_dir, tmp_path):
    path = str(tmp_path / "samples")
    v.wide_metrics(spark, sf_dir).sortWithinPartitions("_timestamp").write.parquet(path)
    runs = q.valid_runs(spark, sf_dir).cache()
    plan = plan_of(metrics_of_runs(tables.read_metrics(spark, path), runs, v.START, v.TARGET))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "run_path" in line]
    bounds = [s for s in scans if "GreaterThanOrEqual(_timestamp" in s and "LessThan(_timestamp" in s]
    assert bounds and all("PushedFilters: []" not in s for s in scans)
    assert plan.count("LeftSemi") >= 2


def history_rows(spark, seed: int, unique: bool):
    """Records with ties, null keys and null times; without repeated keys if ``unique``."""
    made = []
    for i in range(240):
        k = (i * 7 + seed * 13) % 61
        logged = None if k % 5 == 0 else dt.datetime(2024, 1, 1 + (i * seed) % 3)
        made.append((dt.date(2024, 1, 1 + k % 4), None if k % 7 == 0 else f"c{k % 3}", "p", None if k % 11 == 0 else f"r{k}", i, logged))
    df = spark.createDataFrame(made, "date date, company_name string, project string, run_id string, gpu_count bigint, logged_at timestamp_ntz")
    for f in schemas.RUN_DAYS.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    df = df.select(schemas.RUN_DAY_COLUMNS)
    return merge_history(df, df.limit(0)) if unique else df


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_unique_is_merge_history(spark, seed):
    new, old = history_rows(spark, seed, unique=False), history_rows(spark, seed + 1, unique=True)
    for few in (False, True):
        assert same(merge_unique(new, old, few), merge_history(new, old))
    assert same(merge_unique(old, new.limit(0)), merge_history(old, new.limit(0)))
    assert same(merge_unique(new.limit(0), old), old)


def test_old_history_is_neither_shuffled_nor_sorted(spark, sf_dir, tmp_path):
    path = str(tmp_path / "old")
    v.old_history(spark, sf_dir).write.parquet(path)
    old = spark.read.schema(schemas.RUN_DAYS).parquet(path)
    plan = plan_of(merge_unique(history_rows(spark, 1, False), old, few=True))
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3
    scan = next(i for i, line in enumerate(plan.splitlines()) if "FileScan parquet" in line)
    assert "Exchange" not in "".join(plan.splitlines()[:scan])


def file_times(folder) -> dict[str, list]:
    return {d: sorted((f, os.stat(folder / d / f).st_mtime_ns) for f in os.listdir(folder / d)) for d in os.listdir(folder) if "=" in d}


@pytest.mark.parametrize("by_stream", [False, True])
def test_a_late_row_leaves_the_days_between_alone(spark, sf_dir, tmp_path, shared, by_stream):
    path = str(tmp_path / "history")
    days = v.run_days(spark, sf_dir)
    update_history(spark, path, days, v.START, v.TARGET, shared)
    before = file_times(tmp_path / "history")
    late = v.late_history(spark, sf_dir)
    if by_stream:
        late.write.parquet(str(tmp_path / "landing"))
        stream_into_history(spark, str(tmp_path / "landing"), path, str(tmp_path / "state"), shared).awaitTermination()
    else:
        update_history(spark, path, late, v.START, v.TARGET, shared)
    after = file_times(tmp_path / "history")
    changed = {d for d in before if before[d] != after[d]}
    assert changed == {"date=2024-01-04", "date=2024-01-18"} and before.keys() == after.keys()
    assert same(tables.read_history(spark, path), merge_history(late, days))


def test_history_scan_is_pruned_by_the_new_days(spark, sf_dir, tmp_path):
    path = str(tmp_path / "history")
    tables.write_history_days(v.run_days(spark, sf_dir), path)
    history = tables.read_history(spark, path)
    between = F.col("date").between(F.lit("2024-01-01").cast("date"), F.lit("2024-02-06").cast("date"))
    new = v.late_history(spark, sf_dir)
    touched = touched_days(history, new, between)
    assert "dynamicpruning" in plan_of(touched).lower()
    assert same(touched, history.where("date in ('2024-01-04', '2024-01-18')"))


def test_published_runs_are_pruned_and_text_stays_text(spark, tmp_path):
    table = spark.createDataFrame([("12", 1.5), ("007", 2.5)], "company string, rate double")
    for name in ("Tables_2024-01-01", "Tables_2024-01-02"):
        publish({"t": table}, str(tmp_path), name, by_company=True)
    entries = [(f"{n}/{c}", n, [c, "latest"] if n.endswith("2") else [c]) for n in ("Tables_2024-01-01", "Tables_2024-01-02") for c in ("12", "007")]
    registry = spark.createDataFrame(entries, schemas.REGISTRY)
    published = tables.read_published(spark, str(tmp_path), "t", table.schema, by_company=True)
    newest = latest_tables(registry, published, "latest")
    assert "dynamicpruning" in plan_of(newest).lower()
    assert rows(newest.select("company", "rate", "run"), "company") == [("007", 2.5, "Tables_2024-01-02"), ("12", 1.5, "Tables_2024-01-02")]
    assert published.count() == 4


def test_published_files_do_not_grow_with_the_companies(spark, tmp_path):
    names = [*[f"c{i}" for i in range(300)], "", None]
    table = spark.createDataFrame([(c, d) for c in names for d in range(3)], "company string, d int")
    publish({"t": table}, str(tmp_path), "Tables_1", by_company=True)
    assert 0 < len(list((tmp_path / "t" / "run=Tables_1").rglob("*.parquet"))) <= 4
    published = tables.read_published(spark, str(tmp_path), "t", table.schema, by_company=True)
    assert same(published.select(table.columns), table)
    assert {tuple(r) for r in published.where("company = 'c7'").collect()} == {(d, "Tables_1/c7", "c7", "Tables_1") for d in range(3)}
    # A company's rows lie together in one file.
    files_of = spark.read.parquet(f"{tmp_path}/t").select("company", F.input_file_name()).distinct()
    assert files_of.count() == len(names)
