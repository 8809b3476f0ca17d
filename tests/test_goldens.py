"""Small tables worked out by hand, one per rule."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetmeter.functions import columns as c
from fleetmeter.functions import dates
from fleetmeter.operators import calendar, quality, reports, runs, summary
from fleetmeter.operators.gpu_count import with_gpu_count
from fleetmeter.operators.usage import usage_facts
from fleetmeter.plans.reports import UsageReports
from fleetmeter.schemas import COMPANY_CONFIG, GPU_COUNT_RULES, REGISTRY, RUN_DAYS, RUN_NODES
from fleetmeter.sources import config

D = dt.date.fromisoformat
TS = dt.datetime.fromisoformat


@pytest.mark.parametrize(
    ("created", "updated", "expected"),
    [
        ("2024-11-01 23:30:00", "2024-11-02 00:30:00", {"2024-11-01": 30, "2024-11-02": 31}),
        ("2024-11-01 10:00:00", "2024-11-01 11:00:00", {"2024-11-01": 61}),
        ("2024-11-01 10:00:00", "2024-11-01 10:00:30", {"2024-11-01": 1}),
        ("2024-11-01 23:59:30", "2024-11-02 00:00:29", {"2024-11-01": 1}),
        ("2024-11-01 10:00:00", "2024-11-01 10:00:00", {"2024-11-01": 1}),
        ("2024-11-02 10:00:00", "2024-11-01 10:00:00", {}),
        ("2024-10-31 23:00:00", "2024-11-01 01:00:00", {"2024-11-01": 61}),
        ("2024-11-05 23:00:00", "2024-11-07 01:00:00", {"2024-11-05": 60}),
    ],
)
def test_run_hours(spark, created, updated, expected):
    one = spark.createDataFrame(
        [(TS(created), TS(updated))], "created_at timestamp_ntz, updated_at timestamp_ntz"
    )
    got = runs.spread_over_days(one, "2024-11-01", "2024-11-05")
    assert {str(r.date): r.duration_hour for r in got.collect()} == {
        day: ticks / 60 for day, ticks in expected.items()
    }


def test_run_path_parts(spark):
    paths = spark.createDataFrame([("team/some project/r1",)], "run_path string")
    got = runs.split_run_path(paths).select("company_name", "project", "run_id")
    assert rows(got) == [("team", "some project", "r1")]


def node(name, **more):
    values = {
        "team": "t",
        "project": "p",
        "name": name,
        "createdAt": "2024-11-01T00:00:00Z",
        "updatedAt": None,
        "heartbeatAt": "2024-11-01T01:00:00",
        "state": "running",
        "tags": ["x"],
        "host": "h",
        "runInfo": (8, "A100"),
        "config": "{}",
        **more,
    }
    return tuple(values[n] for n in RUN_NODES.fieldNames())


def test_valid_runs(spark):
    nodes = [
        node("kept"),
        node("no info", runInfo=None),
        node("no device", runInfo=(8, None)),
        node("empty device", runInfo=(8, "")),
        node("ignored", tags=["x", "OTHER_gpu"]),
        node("null tags", tags=None),
        node("null tag", tags=[None, "x"]),
        node("no length", heartbeatAt="2024-11-01T00:00:00.000Z"),
        node("other team", team="u"),
        # 15:00 UTC is midnight in Tokyo.
        node("ends before", createdAt="2024-10-31T01:00:00Z", heartbeatAt="2024-10-31T14:59:59Z"),
        node("ends at start", createdAt="2024-10-31T01:00:00Z", heartbeatAt="2024-10-31T15:00:00Z"),
        node("begins at end", createdAt="2024-11-03T14:59:59Z", heartbeatAt="2024-11-09T00:00:00Z"),
        node("begins after", createdAt="2024-11-03T15:00:00Z", heartbeatAt="2024-11-09T00:00:00Z"),
    ]
    df = spark.createDataFrame(nodes, RUN_NODES)
    table = companies(spark, ("a", ["t"], [("2024-10-01", 1)]))
    windows = config.team_windows(table)

    def names(start="2024-11-01", end="2024-11-03", **more):
        got = runs.valid_runs(df, windows, start, end, ["other_gpu"], **more)
        return {r.run_id for r in got.collect()}

    kept = {"kept", "null tags", "null tag", "ends at start", "begins at end"}
    assert names() == kept
    assert names(validate=False) == {n[2] for n in nodes} - {"other team"}
    assert names("2024-09-01", "2024-09-30") == set()
    ended = companies(spark, ("a", ["t"], [("2024-10-01", 1), ("2024-10-31", 0)]))
    windows = config.team_windows(ended)
    assert names("2024-10-20", "2024-11-03") == {"ends before", "ends at start"}


def test_local_times(spark):
    df = spark.createDataFrame([node("r", createdAt="2024-11-01T00:00:00.123456Z")], RUN_NODES)
    row = runs.normalise_runs(df).first()
    assert row.created_at == TS("2024-11-01 09:00:00.123456")
    assert row.updated_at == TS("2024-11-01 10:00:00")
    assert (row.run_path, row.gpu_count, row.gpu_name) == ("t/p/r", 8, "A100")


def test_week_buckets(spark):
    days = spark.createDataFrame([(D("2024-10-26"),), (D("2024-10-27"),), (D("2024-10-28"),)], "d date")
    got = days.select("d", c.sunday_week(F.col("d")), c.shifted_week(F.col("d")))
    assert [tuple(map(str, r)) for r in rows(got, "d")] == [
        ("2024-10-26", "2024-10-20", "2024-10-20"),
        ("2024-10-27", "2024-10-27", "2024-10-20"),
        ("2024-10-28", "2024-10-27", "2024-10-27"),
    ]


def test_driver_dates():
    assert dates.last_complete_week_end("2024-11-06") == D("2024-11-02")
    assert dates.last_complete_week_end("2024-11-10") == D("2024-11-02")
    assert dates.previous_week("2024-11-06") == (D("2024-10-28"), D("2024-11-04"))
    late = dt.datetime(2024, 11, 5, 15, 15, tzinfo=dt.UTC)
    assert dates.yesterday(late) == D("2024-11-05")
    assert dates.yesterday(late - dt.timedelta(minutes=16)) == D("2024-11-04")


def test_report_range():
    last = D("2024-11-05")
    assert dates.report_range(None, None, last) == (last, last)
    assert dates.report_range(None, "2024-11-02", last) == (D("2024-10-25"), D("2024-11-02"))
    assert dates.report_range("2024-11-01", None, last) == (D("2024-11-01"), last)
    assert dates.report_range("2024-11-01", "2024-11-01", last) == (D("2024-11-01"),) * 2
    with pytest.raises(ValueError):
        dates.report_range("2024-11-02", "2024-11-01", last)


GPU_CASES = [
    ("free", "{}", 4),
    ("unknown", '{"num_nodes":{"value":2}}', 4),
    ("pair", '{"num_nodes":{"value":2},"num_gpus":{"value":"8"}}', 16),
    ("world", '{"world size":{"value":16}}', 16),
    ("several", '{"trainer.num_nodes":{"value":3}}', 24),
    ("several", '{"NUM_NODES":{"value":2},"trainer.num_nodes":5}', 16),
    ("several", '{"NUM_NODES":{"value":0},"trainer.num_nodes":5}', 4),
    ("eight", "{}", 0),
    ("pair", '{"num_nodes":{"value":"8.5"},"num_gpus":{"value":8}}', 0),
    ("pair", '{"num_nodes":{"value":8.9},"num_gpus":{"value":1}}', 8),
    ("pair", '{"num_nodes":{"value":true},"num_gpus":{"value":" 3 "}}', 3),
    ("pair", '{"num_nodes":{"value":null},"num_gpus":{"value":1}}', 0),
    ("pair", '{"num_nodes":{"value":[1]},"num_gpus":{"value":1}}', 0),
    ("pair", '{"num_nodes":{},"num_gpus":{"value":1}}', 0),
    ("pair", '{"num_nodes":5}', 4),
    ("pair", '{"num_nodes":null}', 4),
    ("pair", '{"num_nodes":{"value":2},"num_gpus":7}', 4),
    ("pair", '{"num_nodes":"{}"}', 4),
    ("pair", '{"num_nodes":{"value":3},"num_gpus":{"value":1},"other":[{"a":1}, null]}', 3),
    ("pair", "[1]", 4),
    ("pair", "not json", 4),
    ("pair", None, 4),
]


def gpu_rules(spark):
    return spark.createDataFrame(
        [
            ("free", None, None, 1),
            ("pair", ["num_nodes"], "num_gpus", 1),
            ("world", ["world size"], None, None),
            ("several", ["NUM_NODES", "trainer.num_nodes"], None, 8),
            ("eight", ["NNODES"], None, 8),
        ],
        GPU_COUNT_RULES,
    )


def test_gpu_count(spark):
    cases = spark.createDataFrame(
        [(i, team, text, 4) for i, (team, text, _) in enumerate(GPU_CASES)],
        "i int, team string, config string, gpu_count bigint",
    )
    got = with_gpu_count(cases, gpu_rules(spark)).select("i", "gpu_count")
    assert rows(got, "i") == [(i, want) for i, (_, _, want) in enumerate(GPU_CASES)]


def companies(spark, *schedules, **patterns):
    return spark.createDataFrame(
        [
            (name, teams, schedule, patterns.get("ignore"), patterns.get("include"))
            for name, teams, schedule in schedules
        ],
        COMPANY_CONFIG,
    )


@pytest.mark.parametrize(
    ("schedule", "open_end", "expected"),
    [
        ([("2024-11-01", 6), ("2024-11-03", 10), ("2024-11-05", 0)], False, [6, 6, 10, 10]),
        ([("2024-11-05", 0), ("2024-11-01", 6), ("2024-11-03", 10)], False, [6, 6, 10, 10]),
        ([("2024-11-01", 6)], False, [6]),
        ([("2024-11-01", 6)], True, [6, 6, 6, 6, 6, 6]),
        ([("2024-11-01", 6), ("2024-11-04", 0)], True, [6, 6, 6]),
        ([("2024-11-10", 6), ("2024-12-01", 0)], False, []),
        ([("2024-11-05", 6), ("2024-11-20", 0)], False, [6, 6]),
        ([("2024-11-01", 6), ("2024-11-02", None), ("2024-11-04", 0)], False, [6, 6, 6]),
    ],
)
def test_calendar(spark, schedule, open_end, expected):
    table = config.schedule_table(companies(spark, ("a", ["t"], schedule)))
    got = rows(calendar.daily_calendar(table, "2024-11-06", open_end), "date")
    assert [r[2] for r in got] == expected
    days = [r[1] for r in got]
    assert days == [days[0] + dt.timedelta(days=i) for i in range(len(days))]


def test_team_windows(spark):
    table = companies(
        spark,
        ("a", ["a1", "a2"], [("2024-11-05", 0), ("2024-11-01", 6)]),
        ("b", ["b1"], [("2024-11-02", 6)]),
    )
    got = config.team_windows(table).select("team", "start_date", "end_date")
    assert [tuple(map(str, r)) for r in rows(got, "team")] == [
        ("a1", "2024-11-01", "2024-11-05"),
        ("a2", "2024-11-01", "2024-11-05"),
        ("b1", "2024-11-02", "2100-01-01"),
    ]


def run_day(day, run, hours, gpus, util=None, team="t", **more):
    values = {
        "date": D(day),
        "company_name": team,
        "project": "p",
        "run_id": run,
        "tags": "[]",
        "created_at": TS(f"{day} 00:00:00"),
        "updated_at": TS(f"{day} 01:00:00"),
        "state": "finished",
        "duration_hour": float(hours),
        "gpu_count": gpus,
        "average_gpu_utilization": util,
        "average_gpu_memory": util,
        "max_gpu_utilization": util,
        "max_gpu_memory": util,
        "host_name": "h",
        "logged_at": TS("2024-12-01 00:00:00"),
        **more,
    }
    return tuple(values[n] for n in RUN_DAYS.fieldNames())


DAYS = [
    run_day("2024-11-01", "x", 10, 16, 50.0),
    run_day("2024-11-01", "y", 5, 8),
    run_day("2024-11-02", "x", 6, 8, 30.0),
    run_day("2024-11-02", "y", 2, 8, 70.0),
]


@pytest.mark.parametrize("empty_is_zero", [False, True])
def test_daily_report(spark, empty_is_zero):
    table = companies(spark, ("a", ["t"], [("2024-11-01", 1), ("2024-11-04", 0)]))
    got = UsageReports.of(
        spark.createDataFrame(DAYS, RUN_DAYS), table, "2024-11-06", empty_is_zero=empty_is_zero
    ).daily()
    shown = got.select(
        "total_gpu_hour",
        "_total_gpu_hour",
        "utilization_rate",
        "total_metrics_hour",
        "average_gpu_utilization",
        "n_runs",
        "date",
    )
    assert [r[:-1] for r in rows(shown, "date")] == [
        (192.0, 200.0, 100.0, 10.0, 50.0, 2),
        (64.0, 64.0, 33.3, 8.0, 40.0, 2),
        (0.0, 0.0, 0.0, 0.0, 0.0, 0 if empty_is_zero else 1),
    ]


def test_reports_of_no_runs_keep_the_calendar(spark):
    table = companies(spark, ("a", ["t"], [("2024-10-01", 1), ("2024-11-04", 0)]))
    empty = UsageReports.of(spark.createDataFrame([], RUN_DAYS), table, "2024-11-06")
    assert [r.n_runs for r in empty.overall().collect()] == [1]
    assert empty.daily().count() == 34
    assert empty.weekly().schema["week_start"].dataType.simpleString() == "date"


def test_sunday_hours_open_the_week_and_its_runs_close_it(spark):
    table = companies(spark, ("a", ["t"], [("2024-10-20", 1), ("2024-11-10", 0)]))
    sunday = spark.createDataFrame([run_day("2024-10-27", "x", 4, 8, 50.0)], RUN_DAYS)
    reports_of = UsageReports.of(sunday, table, "2024-11-13", empty_is_zero=True)
    columns = ["week_start", "total_gpu_hour", "n_runs", "total_metrics_hour", "assigned_gpu_node"]

    def weeks(aligned):
        got = rows(reports_of.weekly(aligned).select(columns), "week_start")
        return [(str(r[0]), *r[1:]) for r in got]

    assert weeks(False) == [
        ("2024-10-20", 0.0, 1, 4.0, 7),
        ("2024-10-27", 32.0, 0, 0.0, 7),
        ("2024-11-03", 0.0, 0, 0.0, 7),
    ]
    assert weeks(True) == [
        ("2024-10-20", 0.0, 0, 0.0, 7),
        ("2024-10-27", 32.0, 1, 4.0, 7),
        ("2024-11-03", 0.0, 0, 0.0, 7),
    ]


def test_metrics_count_days_without_allocation_but_hours_do_not(spark):
    table = companies(spark, ("a", ["t"], [("2024-10-10", 1), ("2024-10-12", 0)]))
    days = [run_day("2024-10-11", "x", 2, 8, 50.0), run_day("2024-10-20", "y", 2, 8, 70.0)]
    month = UsageReports.of(spark.createDataFrame(days, RUN_DAYS), table, "2024-11-06").monthly()
    row = month.first()
    assert (row.total_gpu_hour, row.total_metrics_hour, row.n_runs) == (16.0, 4.0, 2)
    assert (row.average_gpu_utilization, row.assigned_gpu_node) == (60.0, 2)


def test_rounding_before_the_cap(spark):
    """Each day is rounded to one decimal before the days are added."""
    table = companies(spark, ("a", ["t"], [("2024-10-10", 1), ("2024-10-13", 0)]))
    days = [run_day(f"2024-10-1{i}", "x", 1 / 60, 2, None) for i in (0, 1, 2)]
    month = UsageReports.of(spark.createDataFrame(days, RUN_DAYS), table, "2024-11-06").monthly()
    assert month.first().total_gpu_hour == 0.0


def test_facts_count_runs_at_their_first_day(spark):
    days = [
        run_day(d, r, 1, 1)
        for d, r in [("2024-10-26", "x"), ("2024-10-27", "x"), ("2024-10-28", "x"), ("2024-11-01", "x")]
    ] + [run_day("2024-10-28", None, 1, 1), run_day("2024-10-28", None, 1, 1, project="q")]
    teams = spark.createDataFrame([("a", "t")], "company string, team string")
    got = usage_facts(spark.createDataFrame(days, RUN_DAYS), teams).select(
        "date", "day_runs", "week_runs", "aligned_week_runs", "month_runs", "all_runs"
    )
    assert [(str(r[0]), *r[1:]) for r in rows(got, "date")] == [
        ("2024-10-26", 1, 1, 1, 1, 1),
        ("2024-10-27", 1, 0, 1, 0, 0),
        ("2024-10-28", 2, 2, 1, 1, 1),
        ("2024-11-01", 1, 0, 0, 1, 0),
    ]


def overlapping(spark, spans, host="h"):
    table = [
        run_day(
            "2024-10-29",
            name,
            1,
            1,
            created_at=TS(f"2024-10-29 {start}:00"),
            updated_at=TS(f"2024-10-29 {stop}:00"),
            host_name=host,
        )
        for name, start, stop in spans
    ]
    return spark.createDataFrame(table, RUN_DAYS)


CHAIN = [("A", "00:00", "02:00"), ("B", "01:00", "03:00"), ("C", "02:30", "04:00")]
COVER = [("A", "00:00", "10:00"), ("B", "01:00", "02:00"), ("C", "03:00", "04:00")]


@pytest.mark.parametrize(("spans", "expected"), [(CHAIN, 2), (COVER, 1)])
def test_overlap_looks_at_the_run_before(spark, spans, expected):
    table = overlapping(spark, spans)
    row = summary.project_summary(table, "2024-11-06", []).first()
    assert row.overlap_runs == expected
    weekly = summary.weekly_project_report(table, "2024-11-06", []).first()
    assert weekly.overlap_runs == expected


def test_runs_without_host(spark):
    table = overlapping(spark, CHAIN, host=None)
    assert summary.project_summary(table, "2024-11-06", []).first().overlap_runs == 2
    assert summary.weekly_project_report(table, "2024-11-06", []).first().overlap_runs == 0


def test_host_of_a_run_is_that_of_its_newest_day(spark):
    times = {"created_at": TS("2024-10-29 10:00:00"), "updated_at": TS("2024-10-30 10:00:00")}
    days = [
        run_day("2024-10-30", "x", 1, 1, host_name="new", **times),
        run_day("2024-10-29", "x", 1, 1, host_name="old", **times),
        run_day("2024-10-29", "y", 1, 1, host_name="new", created_at=TS("2024-10-29 11:00:00")),
        run_day("2024-10-29", "z", 1, 1, host_name="old", created_at=TS("2024-10-29 12:00:00")),
    ]
    got = summary.overlapping_runs(spark.createDataFrame(days, RUN_DAYS))
    assert rows(got.select("run_id", "host_name")) == [("y", "new")]


def test_run_days_of_one_run_overlap_in_the_weekly_files(spark):
    span = {"created_at": TS("2024-10-29 12:00:00"), "updated_at": TS("2024-10-30 12:00:00")}
    days = [run_day(d, "x", 12, 9, **span) for d in ("2024-10-29", "2024-10-30")]
    table = spark.createDataFrame(days, RUN_DAYS)
    assert summary.project_summary(table, "2024-11-06", []).first().overlap_runs == 0
    weekly = summary.weekly_project_report(table, "2024-11-06", []).first()
    assert (weekly["overlap_runs"], weekly["Total runs"], weekly["master_node_runs"]) == (1, 1, 1)


def test_ignored_tags(spark):
    texts = {
        '["other_gpu"]': 1,
        '["Other_GPU"]': 0,
        '["a", "[other_gpu]"]': 1,
        "['others_gpu']": 1,
        "not a list": 0,
        "[]": 0,
        "[null]": 0,
    }
    days = [
        run_day("2024-10-29", f"r{i}", 1, 1, project=f"p{i}", tags=text)
        for i, text in enumerate(texts)
    ]
    got = summary.project_summary(
        spark.createDataFrame(days, RUN_DAYS), "2024-11-06", ["other_gpu", "others_gpu"]
    ).select("project", "ignore_runs")
    assert rows(got, "project") == [(f"p{i}", n) for i, n in enumerate(texts.values())]


@pytest.mark.parametrize(
    ("include", "ignore", "kept"),
    [
        ("gpu-info", None, ["gpu-info"]),
        (None, "test-*", ["gpu-info", "x[1]", "prod_1"]),
        ("t*", "test-*", ["test-1"]),
        (None, None, ["gpu-info", "test-1", "x[1]", "prod_1"]),
        ("x[[]1]", None, ["x[1]"]),
        ("*[!0-9]", None, ["gpu-info", "x[1]"]),
        ("prod?1", None, ["prod_1"]),
        ("x[1", None, []),
        ("*.*", None, []),
    ],
)
def test_project_filter(spark, include, ignore, kept):
    table = companies(
        spark, ("a", ["t"], [("2024-11-01", 1)]), include=include, ignore=ignore
    )
    projects = spark.createDataFrame(
        [("t", p) for p in ("gpu-info", "test-1", "x[1]", "prod_1")], "team string, project string"
    )
    got = runs.select_projects(projects, config.team_windows(table), "2024-11-01", "2024-11-02")
    assert sorted(r.project for r in got.collect()) == sorted(kept)
    early = runs.select_projects(projects, config.team_windows(table), "2024-10-01", "2024-10-31")
    assert early.count() == 0


def test_health_findings(spark):
    spans = config.schedule_spans(
        companies(
            spark,
            *[(f"company-0{i}", [f"t{i}"], [("2024-01-01", 1), ("2024-02-01", 0)]) for i in range(8)],
        )
    )
    tagged = {
        0: ["company-00", "latest"],
        1: ["company-01", "extra", "latest"],
        2: ["company-02", "latest"],
        3: ["company-03"],
        8: ["overall", "latest"],
        **{i: [f"company-0{i}", "latest"] for i in (4, 5, 6, 7)},
    }
    registry = spark.createDataFrame(
        [(f"p{i}", f"Tables_2024-01-{19 if i == 2 else 20}", tags) for i, tags in tagged.items()],
        REGISTRY,
    )
    got = quality.health_checks(spans, registry, "2024-01-20", "latest")
    found = [f"company-0{i}" for i in (0, 2, 4, 5, 6, 7)] + ["overall"]
    assert sorted(rows(got)) == [
        ("Error of companies", str(found)),
        ("Error of number of latest runs", ""),
        ("Error of number of tags", "['company-01', 'extra', 'latest']"),
        ("Error of target date", "2024-01-20, Tables_2024-01-19"),
    ]
    ended = quality.health_checks(spans, registry, "2024-02-01", "latest")
    assert rows(ended) == [("No active companies", "There are no companies currently active.")]


def test_health_without_findings(spark):
    spans = config.schedule_spans(companies(spark, ("a", ["t"], [("2024-01-01", 1), ("2024-02-01", 0)])))
    registry = spark.createDataFrame(
        [("1", "Tables_2024-01-20", ["a", "latest"]), ("2", "Tables_2024-01-20", ["overall", "latest"])],
        REGISTRY,
    )
    got = quality.health_message(quality.health_checks(spans, registry, "2024-01-20", "latest"))
    assert rows(got) == [
        (
            "Dashboard health check",
            "No errors found. All active companies are reporting as expected.",
        )
    ]


def test_tag_text(spark):
    tags = [["a", "b"], [], [","], ['q"', "\\"], [None, "x"]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tags)], "i int, tags array<string>")
    import json

    got = df.select("i", c.tags_to_json(F.col("tags")).alias("text")).orderBy("i").collect()
    assert [r.text for r in got] == [json.dumps(t) for t in tags]
    lists = df.where("i < 4").select("i", c.list_text(F.col("tags")).alias("text")).orderBy("i")
    assert [r.text for r in lists.collect()] == [str(t) for t in tags[:4]]


def test_labels(spark):
    table = companies(spark, ("a", ["t"], [("2024-11-01", 1), ("2024-11-02", 0)]))
    report = UsageReports.of(spark.createDataFrame(DAYS, RUN_DAYS), table, "2024-11-06").daily()
    labelled = reports.with_labels(report)
    assert labelled.columns[:4] == ["企業名", "日付", "合計GPU使用時間(h)", "GPU稼働率(%)"]
    assert labelled.first()["日付"] == "2024-11-01"
    with pytest.raises(ValueError):
        reports.with_labels(report, "fr")


def test_low_utilization_looks_at_the_newest_day(spark):
    daily = spark.createDataFrame(
        [
            ("a", D("2024-11-01"), 50.0),
            ("a", D("2024-11-02"), 9.9),
            ("b", D("2024-11-01"), 1.0),
            ("b", D("2024-11-02"), 10.0),
        ],
        "company string, date date, utilization_rate double",
    )
    assert rows(quality.low_utilization_alerts(daily)) == [("Too low utilization rate found.", "a")]
