"""Facts kept by date, samples landed by layout, ordered files, and the whole job from a settings file."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_plans import plan_of

from fleetmeter import schemas
from fleetmeter.operators import calendar, facts, registry, reports, runs, summary
from fleetmeter.operators.metrics import metrics_daily
from fleetmeter.operators.usage import usage_facts
from fleetmeter.plans.daily import Counters, Places
from fleetmeter.plans.job import Landing, run_job
from fleetmeter.plans.reports import UsageReports
from fleetmeter.sources import config, samples, tables
from verification import queries as q
from verification import views as v


def same(a, b) -> bool:
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def days_of(spark, seed: int):
    """Run days over ten weeks with null ids, unknown teams, missing metrics, and copies of a run in projects."""
    rng, made = random.Random(seed), {}
    for _ in range(300):
        day = dt.date(2024, 1, 25) + dt.timedelta(days=rng.randrange(70))
        run = None if rng.random() < 0.1 else f"r{rng.randrange(25)}"
        key = (day, rng.choice(["a1", "a2", "b1", "zz", None]), rng.choice("pq"), run)
        made[key] = (rng.randrange(1, 1440) / 60, rng.randrange(1, 17), rng.choice([None, 10.0, 50.0]))
    table = [(*k, *x) for k, x in made.items()]
    df = spark.createDataFrame(table, "date date, company_name string, project string, run_id string, duration_hour double, gpu_count bigint, average_gpu_utilization double")
    for f in schemas.RUN_DAYS.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.select(schemas.RUN_DAY_COLUMNS)


@pytest.mark.parametrize("seed", [1, 2])
def test_facts_by_day_are_those_of_a_rebuild(spark, tmp_path, seed):
    teams = spark.createDataFrame([("a", "a1"), ("a", "a2"), ("b", "b1")], "company string, team string")
    days, root = days_of(spark, seed).cache(), str(tmp_path / "facts")
    assert facts.read_usage_facts(spark, root).count() == 0
    # Days come in no order: a later batch may hold an earlier day of a run that is known.
    batch = F.pmod(F.xxhash64("date", F.lit(seed)), F.lit(3))
    for n in range(3):
        so_far = days.where(batch <= n)
        facts.update_usage_facts(so_far, teams, days.where(batch == n).select("date"), root)
        assert same(facts.read_usage_facts(spark, root), usage_facts(so_far, teams))
    one = days.where(F.col("date") == F.lit(days.agg(F.max("date")).first()[0]))
    facts.update_usage_facts(days, teams, one.select("date"), root)
    assert same(facts.read_usage_facts(spark, root), usage_facts(days, teams))


def test_a_day_of_facts_reads_that_day(spark, sf_dir, tmp_path, monkeypatch):
    path, root = str(tmp_path / "history"), str(tmp_path / "facts")
    tables.write_history_days(v.run_days(spark, sf_dir), path)
    history, teams = tables.read_history(spark, path), q.team_dim(spark, sf_dir)
    facts.update_usage_facts(history, teams, history.select("date"), root)
    # The files of all other days are broken now: reading one would fail.
    for folder in (tmp_path / "history").glob("date=*"):
        if folder.name != "date=2024-01-18":
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"broken")
    day = spark.createDataFrame([(dt.date(2024, 1, 18),)], "date date")
    before = facts.read_usage_facts(spark, root).where("date = '2024-01-18'").collect()
    facts.update_usage_facts(history, teams, day, root)
    assert sorted(facts.read_usage_facts(spark, root).where("date = '2024-01-18'").collect()) == sorted(before)


@pytest.mark.parametrize("layout, names", [("g_m", 0), ("g0_m", 1), ("g0-15_m0-15", 32), ("g0-1,5_m3", 4)])
def test_layouts(spark, layout, names):
    schema = samples.schema_of(layout)
    assert len(schema) == 2 + names
    assert samples.layout_of(spark.createDataFrame([], schema)) == layout


def test_batches_of_one_and_sixteen_devices(spark, tmp_path):
    start = dt.datetime(2024, 11, 1, 3, tzinfo=dt.UTC).timestamp()
    for name, devices in (("one", 1), ("many", 16), ("one again", 1)):
        made = spark.createDataFrame([(name, start + 60 * k, 1) for k in range(3)], "run_path string, _timestamp double, extra int")
        for d in range(devices):
            made = made.withColumn(f"system.gpu.{d}.gpu", F.lit(10.0 + d)).withColumn(f"system.gpu.{d}.memory", F.lit(20.0))
        samples.land_samples(made, str(tmp_path), name.replace(" ", "-"))
        samples.land_samples(made, str(tmp_path), name.replace(" ", "-"))
    long = samples.read_landed_samples(spark, str(tmp_path))
    assert long.columns == [f.name for f in schemas.METRICS_LONG.fields]
    assert long.count() == 3 * 2 * (1 + 16 + 1)
    first = long.where("gpu_index = 0").groupBy("run_path").agg(F.sum("value").alias("s"), F.count("value").alias("n"))
    assert rows(first, "run_path") == [("many", 90.0, 6), ("one", 90.0, 6), ("one again", 90.0, 6)]
    daily = metrics_daily(long, "2024-11-01", "2024-11-01").select("run_path", "average_gpu_utilization")
    assert rows(daily, "run_path") == [("many", 17.5), ("one", 10.0), ("one again", 10.0)]
    assert samples.read_landed_samples(spark, str(tmp_path / "none")).count() == 0


def test_files_hold_the_listing_order(spark, sf_dir, tmp_path):
    report = q.report_daily(spark, sf_dir)
    daily = q.daily_calendar(spark, sf_dir)
    path = str(tmp_path / "t")
    for table, order, whole in (
        (report, reports.report_order(report), reports.order_report(report)),
        (daily, calendar.calendar_order(daily), calendar.order_calendar(daily)),
        (q.weekly_calendar(spark, sf_dir), ["week_start", "company"], calendar.order_calendar(q.weekly_calendar(spark, sf_dir))),
        (q.project_summary(spark, sf_dir), summary.PROJECT, summary.order_projects(q.project_summary(spark, sf_dir))),
    ):
        tables.write_ordered(table, path, *order)
        assert "RangePartitioning" in plan_of(table.repartitionByRange(*order)) or "rangepartitioning" in plan_of(table.repartitionByRange(*order))
        files = sorted((tmp_path / "t").glob("*.parquet"))
        listed = [tuple(r) for f in files for r in spark.read.parquet(str(f)).collect()]
        assert listed == [tuple(r) for r in whole.collect()]


def whole_facts(spark, history, companies) -> int:
    return usage_facts(history, config.team_table(companies)).count()


def test_job_from_settings(spark, sf_dir, tmp_path, shared):
    companies = v.companies(spark, sf_dir)
    settings = {
        "ignore_tags": v.IGNORE_TAGS,
        "companies": [
            {"company": c.company, "teams": c.teams, "schedule": [s.asDict() for s in c.schedule], "include_project_pattern": c.include_project_pattern, "ignore_project_pattern": c.ignore_project_pattern}
            for c in companies.collect()
        ],
    }
    file = tmp_path / "settings.json"
    file.write_text(json.dumps(settings))
    landing = Landing(str(tmp_path / "nodes"), str(tmp_path / "samples"))
    v.nodes(spark, sf_dir).write.json(landing.nodes)
    samples.land_samples(v.wide_metrics(spark, sf_dir), landing.samples, "first")
    places = Places(*[str(tmp_path / n) for n in ("history", "published", "registry", "alerts")], shared, str(tmp_path / "facts"))
    csv = str(tmp_path / "csv")
    now = dt.datetime(2024, 1, 20, 20, tzinfo=dt.UTC)
    with pytest.raises(ValueError, match="range"):
        run_job(spark, str(file), landing, places, "2024-01-21", "2024-01-02", now)
    assert not (tmp_path / "history").exists()
    run_job(spark, str(file), landing, places, v.START, "2024-01-19", now, csv)
    # No dates: yesterday in the reporting zone, where it is the 21st already.
    counters = Counters()
    registry_before = tables.read_registry(spark, places.registry)
    result = run_job(spark, str(file), landing, places, now=now, csv_history=csv, counters=counters)
    valid = runs.valid_runs(v.nodes(spark, sf_dir), config.team_windows(companies), "2024-01-20", "2024-01-20", v.IGNORE_TAGS)
    untagged = registry.untagged_count(registry.retag_latest(registry_before, companies, "latest")).first().removed
    assert counters.values() == {"valid_runs": valid.count(), "untagged_runs": untagged}
    assert untagged == companies.count() + 1
    history = tables.read_history(spark, places.history)
    # The first schedules begin on the 3rd.
    assert {str(r[0]) for r in history.select("date").distinct().collect()} == {f"2024-01-{d:02}" for d in range(3, 21)}
    assert {str(r[0]) for r in history.select("logged_at").distinct().collect()} == {"2024-01-21 05:00:00"}
    assert (places.facts, result.facts.count()) == (str(tmp_path / "facts"), whole_facts(spark, history, companies))
    whole = UsageReports.of(history, companies, "2024-01-20")
    assert same(result.daily(), whole.daily()) and same(result.overall(), whole.overall())
    assert same(tables.latest_history_csv(spark, csv), history)
    health = spark.read.parquet(places.alerts).where("source = 'record_health'")
    assert {str(r.raised_for) for r in health.collect()} == {"2024-01-19", "2024-01-20"}
    assert config.load_settings(str(file)).tag_for_latest == "latest"
