"""Laws that hold for any input, checked against brute force."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetmeter.functions.columns import epoch_to_local, local_day
from fleetmeter.functions.dates import utc_midnight
from fleetmeter.operators import history, metrics, runs, summary
from fleetmeter.schemas import METRICS_LONG
from fleetmeter.sources import tables
from verification import queries as q
from verification import views as v

BASE = dt.datetime(2024, 11, 1)


def test_hours_equal_counted_minutes(spark):
    chance = random.Random(1)
    spans = []
    for i in range(300):
        start = BASE + dt.timedelta(microseconds=chance.randrange(3 * 86_400_000_000))
        length = chance.choice([0, 1, 59_999_999, 60_000_000, chance.randrange(4 * 86_400_000_000)])
        spans.append((i, start, start + dt.timedelta(microseconds=length)))
    expected = {}
    for i, start, stop in spans:
        ticks, at = Counter(), start
        while at <= stop:
            ticks[at.date()] += 1
            at += dt.timedelta(minutes=1)
        expected.update({(i, d): n / 60 for d, n in ticks.items() if str(d) <= "2024-11-05"})
    df = spark.createDataFrame(spans, "i int, created_at timestamp_ntz, updated_at timestamp_ntz")
    got = runs.spread_over_days(df, "2024-11-01", "2024-11-05").collect()
    assert {(r.i, r.date): r.duration_hour for r in got} == expected
    assert len(got) == len(expected)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_hours_do_not_depend_on_the_session_zone(spark, zone):
    spans = [(dt.datetime(2024, 3, 9, 12), dt.datetime(2024, 3, 11, 12))]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(spans, "created_at timestamp_ntz, updated_at timestamp_ntz")
        got = rows(runs.spread_over_days(df, "2024-03-01", "2024-03-31").select("duration_hour"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert sorted(got) == [(12.0,), (721 / 60,), (24.0,)]


@pytest.mark.parametrize("tz", ["Asia/Tokyo", "America/New_York"])
def test_local_day_equals_converted_time(spark, tz):
    start, end = dt.date(2024, 3, 9), dt.date(2024, 3, 12)
    origin = dt.datetime(2024, 3, 8, tzinfo=dt.UTC).timestamp()
    stamps = [(origin + n * 1800.0 + 0.25,) for n in range(6 * 48)]
    df = spark.createDataFrame(stamps, "ts double")
    plain = F.to_date(epoch_to_local(F.col("ts"), tz))
    got = df.select(
        local_day(F.col("ts"), start, end, tz).alias("quick"),
        F.when(plain.between(F.lit(start), F.lit(end)), plain).alias("slow"),
    )
    assert got.where(~F.equal_null("quick", "slow")).count() == 0
    assert got.where("quick is not null").count() in (191 + 1, 190)


def test_utc_midnight():
    assert utc_midnight(dt.date(2024, 11, 1)) == dt.datetime(2024, 10, 31, 15)
    assert utc_midnight(dt.date(2024, 11, 1), "America/New_York") == dt.datetime(2024, 11, 1, 4)


def previous_by_brute_force(table):
    groups = defaultdict(list)
    for row in table:
        groups[row[1]].append(row)
    found = {}
    for members in groups.values():
        members.sort(key=lambda r: (r[2], r[0]))
        for before, row in zip([None, *members], members, strict=False):
            found[row[0]] = before[3] if before else None
    return found


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["hot", "hot", "hot", "cold", None]),
            st.integers(0, 400),
            st.integers(0, 600),
        ),
        max_size=60,
    ),
    st.sampled_from([1, 5]),
)
def test_previous_update_equals_one_window(spark, parts, minutes):
    table = [
        (i, host, BASE + dt.timedelta(seconds=a), BASE + dt.timedelta(seconds=a + b))
        for i, (host, a, b) in enumerate(parts)
    ]
    df = spark.createDataFrame(
        table, "id int, host string, created_at timestamp_ntz, updated_at timestamp_ntz"
    )
    got = summary.with_previous_update(df, ["host"], ["id"], minutes)
    assert {r.id: r.prev_updated_at for r in got.collect()} == previous_by_brute_force(table)


def test_metrics_of_a_run_with_most_samples(spark):
    """One run holds most samples; the shuffle still carries a row per run, day and task."""
    start = dt.datetime(2024, 11, 1, tzinfo=dt.UTC).timestamp()
    hot = spark.range(40_000).select(
        F.lit("t/p/hot").alias("run_path"),
        (F.lit(start) + F.col("id")).alias("_timestamp"),
        (F.col("id") % 7).cast("double").alias("system.gpu.0.gpu"),
        F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(4.0).alias("system.gpu.1.gpu"),
        F.lit(3.0).alias("system.gpu.0.memory"),
    )
    once = spark.createDataFrame(
        [("t/p/single", start, 1.0, 1.0, 1.0), ("t/p/early", start - 1e6, 1.0, 1.0, 1.0),
         ("t/p/early", start - 2e6, 1.0, 1.0, 1.0), ("t/p/late", start - 1e6, 1.0, 1.0, 1.0),
         ("t/p/late", start, 5.0, None, 2.0), ("t/p/bare", start, None, None, None),
         ("t/p/bare", start + 1, None, None, None)],
        "run_path string, _timestamp double, `system.gpu.0.gpu` double,"
        "`system.gpu.1.gpu` double, `system.gpu.0.memory` double",
    )
    samples = hot.unionByName(once).repartition(8)
    got = rows(metrics.metrics_daily(samples, "2024-11-01", "2024-11-02"), "run_path", "date")
    values = [i % 7 for i in range(40_000)] + [4.0] * 20_000
    assert [r[0] for r in got] == ["t/p/hot", "t/p/late"]
    assert got[0][2] == pytest.approx(sum(values) / len(values), rel=1e-12)
    assert got[0][3:] == (6.0, 3.0, 3.0)
    assert got[1][2:] == (5.0, 5.0, 2.0, 2.0)


def test_wide_and_long_metrics_agree(spark, sf_dir):
    wide = v.wide_metrics(spark, sf_dir)
    long = metrics.unpivot_metrics(wide)
    assert {f.name: f.dataType for f in long.schema} == {f.name: f.dataType for f in METRICS_LONG}
    a = metrics.metrics_daily(wide, v.START, v.TARGET)
    b = metrics.metrics_daily(long, v.START, v.TARGET)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_metrics_without_memory_columns(spark):
    samples = spark.createDataFrame(
        [("r", 1730419200.0, 5.0), ("r", 1730419201.0, 7.0)],
        "run_path string, _timestamp double, `system.gpu.0.gpu` double",
    )
    got = metrics.metrics_daily(samples, "2024-11-01", "2024-11-01", with_span=True)
    assert rows(got) == [("r", dt.date(2024, 11, 1), 6.0, 7.0, None, None, 1 / 3600)]


def test_merge_is_idempotent_and_ignores_input_order(spark, sf_dir):
    new, old = v.new_history(spark, sf_dir), v.old_history(spark, sf_dir)
    once = history.merge_history(new, old)
    again = history.merge_history(new, once)
    assert once.exceptAll(again).count() == 0 and again.exceptAll(once).count() == 0
    tied = new.withColumn("logged_at", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    merged = history.merge_history(tied.unionAll(tied).repartition(7), old)
    wanted = history.merge_history(new, old).drop("logged_at")
    assert merged.drop("logged_at").exceptAll(wanted).count() == 0
    assert merged.count() == wanted.count()


def test_report_laws(spark, sf_dir):
    daily = q.report_daily(spark, sf_dir).persist()
    assert daily.where("total_gpu_hour > assigned_gpu_hour").count() == 0
    assert daily.where("utilization_rate < 0 or utilization_rate > 100").count() == 0
    assert daily.where("_total_gpu_hour > assigned_gpu_hour").count() > 0
    by_month = daily.groupBy("company", F.date_format("date", "yyyy-MM").alias("year_month")).agg(
        F.round(F.sum("_total_gpu_hour"), 1).alias("_total_gpu_hour")
    )
    monthly = q.report_monthly(spark, sf_dir).select("company", "year_month", "_total_gpu_hour")
    assert monthly.exceptAll(by_month).count() == 0
    columns = ["company", "week_start", "total_gpu_hour", "assigned_gpu_node"]
    usual, aligned = q.report_weekly(spark, sf_dir), q.report_weekly_aligned(spark, sf_dir)
    assert usual.select(columns).exceptAll(aligned.select(columns)).count() == 0
    daily.unpersist()


def test_long_samples_count_as_wide_ones(spark):
    """A sample without readings and two samples at one instant count in both forms."""
    schema = "run_path string, _timestamp double, `system.gpu.0.gpu` double, `system.gpu.0.memory` double"
    noon = 1730430000.0
    wide = spark.createDataFrame(
        [
            ("empty second", noon, 10.0, 20.0), ("empty second", noon + 60, None, None),
            ("one instant", noon, 10.0, 20.0), ("one instant", noon, 30.0, 40.0),
            ("single", noon, 10.0, 20.0),
            ("one in range", noon, 10.0, 20.0), ("one in range", noon - 9e6, 30.0, 40.0),
            ("no reading", noon, None, None), ("no reading", noon + 60, None, None),
        ],
        schema,
    )
    a = metrics.metrics_daily(wide, "2024-11-01", "2024-11-02", with_span=True)
    b = metrics.metrics_daily(metrics.unpivot_metrics(wide), "2024-11-01", "2024-11-02", with_span=True)
    assert {r.run_path for r in a.collect()} == {"empty second", "one instant", "one in range"}
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_repeated_alerts_replace_those_of_the_day(spark, tmp_path):
    alerts = spark.createDataFrame([("t", "x")], "title string, text string")
    for _ in range(2):
        tables.record_alerts(alerts, "job", "2024-11-01", str(tmp_path / "a"))
    tables.record_alerts(alerts, "job", "2024-11-02", str(tmp_path / "a"))
    tables.record_alerts(alerts.limit(0), "job", "2024-11-02", str(tmp_path / "a"))
    got = spark.read.parquet(str(tmp_path / "a")).collect()
    assert [(r.title, str(r.raised_for), r.source) for r in got] == [("t", "2024-11-01", "job")]
