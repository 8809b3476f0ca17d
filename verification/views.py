"""Inputs of every operator, derived by Spark from the test tables.

``events`` gives the runs and their samples, ``supplier`` the companies with their
teams, schedules and published runs. All rows of both tables are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.operators.runs import spread_over_days
from fleetmeter.schemas import RUN_DAY_COLUMNS

START = "2024-01-01"
TARGET = "2024-02-06"
SUMMARY_END = "2024-01-24"
HEALTH_DAY = "2024-01-20"
IGNORE_TAGS = ["other_gpu", "others_gpu"]
LATEST = "latest"
METRIC_NAMES = {
    "g0": "system.gpu.0.gpu",
    "m0": "system.gpu.0.memory",
    "g1": "system.gpu.1.gpu",
    "m1": "system.gpu.1.memory",
}

TEAM = "case when event_id % 40 = 7 then 'guest' else concat('team-', user_id) end"
MINUTES = "cast(floor(case when event_id % 20 = 0 then value * 60 else value end) as int)"
TAGS = """case event_id % 20 when 0 then array('Other_GPU') when 1 then array('ablation', 'baseline')
  when 2 then array('others_gpu') else cast(array() as array<string>) end"""
TAGS_TEXT = """case event_id % 20 when 0 then '["Other_GPU"]' when 1 then '["ablation", "baseline"]'
  when 2 then '["others_gpu"]' else '[]' end"""
STATE = "case event_id % 3 when 0 then 'finished' when 1 then 'running' else 'crashed' end"
HOST = "case when event_id % 23 = 0 then null else concat('host-', user_id % 7) end"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second company owns two teams, so company and team differ."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('company-', s_suppkey) as company",
        """transform(sequence((3 * s_suppkey + 1) div 2, (3 * s_suppkey + 1) div 2 + 1 - s_suppkey % 2),
             t -> concat('team-', t)) as teams""",
        """case when s_suppkey % 11 = 10 then array(
             named_struct('date', '2024-03-01', 'assigned_gpu_node', 2L),
             named_struct('date', '2024-05-01', 'assigned_gpu_node', 0L))
           else array(
             named_struct('date', concat('2024-01-0', 3 + s_suppkey % 5),
                          'assigned_gpu_node', 1 + s_suppkey % 3),
             named_struct('date', '2024-01-15', 'assigned_gpu_node', 2 + s_suppkey % 4),
             named_struct('date', '2024-01-29', 'assigned_gpu_node',
                          case when s_suppkey % 7 = 3 then 3L else 0L end)) end as schedule""",
        """case s_suppkey % 5 when 2 then 'e*r' when 3 then 'view' when 4 then '?i[!e]*' end
           as ignore_project_pattern""",
        "case s_suppkey % 5 when 1 then 'click' when 3 then 'v*' end as include_project_pattern",
    )


def gpu_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        companies(spark, sf_dir)
        .select(F.explode("teams").alias("team"))
        .selectExpr(
            "team",
            """case cast(split(team, '-')[1] as int) % 7
                 when 1 then array('num_nodes') when 2 then array('world size')
                 when 3 then array('NUM_NODES', 'trainer.num_nodes') when 4 then array('NNODES')
               end as node_keys""",
            "case when cast(split(team, '-')[1] as int) % 7 = 1 then 'num_gpus' end as gpu_key",
            """case when cast(split(team, '-')[1] as int) % 7 in (3, 4) then 8L else 1L end
               as multiplier""",
        )
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    def iso(ts: str) -> str:
        return f"concat(replace(cast({ts} as string), ' ', 'T'), 'Z')"

    stop = f"timestampadd(MINUTE, {MINUTES}, ts)"
    k = "get_json_object(props, '$.k')"
    return table(spark, sf_dir, "events").selectExpr(
        f"{TEAM} as team",
        "event_type as project",
        "concat('r', event_id) as name",
        f"{iso('ts')} as createdAt",
        f"{iso(stop)} as updatedAt",
        f"{iso(stop)} as heartbeatAt",
        f"{STATE} as state",
        f"{TAGS} as tags",
        f"{HOST} as host",
        """case when event_id % 17 = 0 then null else named_struct(
             'gpuCount', event_id % 16, 'gpu', case when event_id % 19 = 0 then '' else 'A100' end)
           end as runInfo""",
        f"""case event_id % 6 when 0 then '{{}}' when 1 then '{{"num_nodes":5}}'
             when 2 then '{{"num_nodes":{{"value":"x"}},"num_gpus":{{"value":8}}}}'
             else concat('{{"num_nodes":{{"value":', {k}, '}},"num_gpus":{{"value":"8"}},',
               '"world size":{{"value":16}},"trainer.num_nodes":{{"value":3}}}}') end as config""",
    )


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(f"{TEAM} as team", "event_type as project").distinct()


def wide_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly samples of two devices: four per run, or a single one."""
    samples = table(spark, sf_dir, "events").selectExpr(
        f"concat_ws('/', {TEAM}, event_type, concat('r', event_id)) as run_path",
        "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) / 1000000.0D as _start",
        "event_id",
        "explode(sequence(0L, case when event_id % 13 = 0 then 0L else 3L end)) as k",
    )

    def reading(factor: int, step: int, absent: str) -> str:
        value = f"cast((event_id * {factor} + k * {step}) % 101 as double)"
        return f"case when {absent} then null else {value} end"

    return samples.selectExpr(
        "run_path",
        "_start + k * 3600.0D as _timestamp",
        f"{reading(31, 17, 'event_id % 29 = 0')} as `{METRIC_NAMES['g0']}`",
        f"{reading(41, 13, 'event_id % 29 = 0')} as `{METRIC_NAMES['m0']}`",
        f"{reading(29, 7, 'event_id % 2 = 0 or event_id % 29 = 0')} as `{METRIC_NAMES['g1']}`",
        f"{reading(23, 5, 'event_id % 2 = 0 or event_id % 29 = 0')} as `{METRIC_NAMES['m1']}`",
    )


#: Samples of a run by event_id % 6: seconds after its start, and whether there is a reading.
SPARSE = [
    (0, 0, 1), (0, -5184000, 1), (1, 0, 1), (2, 0, 0), (2, 3600, 0), (2, 5184000, 1),
    (3, 0, 0), (3, 3600, 0), (3, 5184000, 0), (4, 0, 1), (4, 3600, 1), (5, -5184000, 1), (5, 5184000, 1),
]


def sparse_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with a single sample or no reading in the range, with and without others 60 days away."""
    return table(spark, sf_dir, "events").selectExpr(
        f"concat_ws('/', {TEAM}, event_type, concat('r', event_id)) as run_path",
        "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) / 1000000.0D as _start",
        "event_id",
        f"""explode(filter(array({", ".join(f"named_struct('m', {m}, 'off', {o}L, 'has', {h})" for m, o, h in SPARSE)}),
              x -> x.m = event_id % 6)) as at""",
    ).selectExpr(
        "run_path",
        "_start + at.off as _timestamp",
        f"case when at.has = 1 then cast((event_id * 31 + at.off) % 101 + 101 as double) end as `{METRIC_NAMES['g0']}`",
        f"case when at.has = 1 then cast((event_id * 41 + at.off) % 101 + 101 as double) end as `{METRIC_NAMES['m0']}`",
    )


def plain_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with their daily metrics given, null for every eleventh run."""

    def metric(expr: str, name: str) -> str:
        return f"case when event_id % 11 = 0 then null else cast({expr} as double) end as {name}"

    return table(spark, sf_dir, "events").selectExpr(
        f"{TEAM} as company_name",
        "event_type as project",
        "concat('r', event_id) as run_id",
        f"{TAGS_TEXT} as tags",
        "ts + interval 9 hours as created_at",
        f"timestampadd(MINUTE, {MINUTES}, ts + interval 9 hours) as updated_at",
        f"{STATE} as state",
        "1 + event_id % 16 as gpu_count",
        metric("(event_id * 37) % 101", "average_gpu_utilization"),
        metric("(event_id * 53) % 101", "average_gpu_memory"),
        metric("least(100, (event_id * 37) % 101 + 10)", "max_gpu_utilization"),
        metric("least(100, (event_id * 53) % 101 + 10)", "max_gpu_memory"),
        f"{HOST} as host_name",
    )


def run_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        spread_over_days(plain_runs(spark, sf_dir), START, TARGET)
        .withColumn("logged_at", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
        .select(RUN_DAY_COLUMNS)
    )


def awkward_run_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run days whose text holds line breaks, quotes, backslashes, edge spaces, or nothing."""
    host = """case event_id_of % 9 when 0 then 'a\\nb' when 1 then 'c\\r\\n,"d"' when 2 then ''
      when 3 then ' e ' when 4 then 'f\\\\ng' when 5 then '\\\\' when 6 then '"' when 7 then null else '\\\\e' end"""
    days = run_days(spark, sf_dir).withColumn("event_id_of", F.substring("run_id", 2, 20).cast("bigint"))
    return days.withColumn("host_name", F.expr(host)).withColumn(
        "tags", F.when(F.col("event_id_of") % 5 == 0, F.lit("")).otherwise(F.col("tags"))
    ).select(RUN_DAY_COLUMNS)


def late_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two far-apart days that come late: an update, an older record and a new run."""
    days = run_days(spark, sf_dir).where(F.col("date").isin("2024-01-04", "2024-01-18"))
    logged = F.when(F.col("gpu_count") % 3 == 0, "2024-01-01 00:00:00").otherwise("2024-02-03 00:00:00")
    late = days.withColumn("logged_at", logged.cast("timestamp_ntz")).withColumn("gpu_count", F.col("gpu_count") + 100)
    return late.unionByName(late.where("gpu_count = 101").withColumn("run_id", F.concat("run_id", F.lit("-late"))))


def old_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was known on 1 February of the days before the 21st."""
    return run_days(spark, sf_dir).where(F.col("date") < F.lit("2024-01-21").cast("date"))


def new_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later fetch of the days from the 15th on, with another GPU count."""
    return (
        run_days(spark, sf_dir)
        .where(F.col("date") >= F.lit("2024-01-15").cast("date"))
        .withColumn("gpu_count", F.col("gpu_count") + 1)
        .withColumn("logged_at", F.lit("2024-02-02 00:00:00").cast("timestamp_ntz"))
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('p-', s_suppkey) as run_id",
        "concat('Tables_2024-01-', case when s_suppkey % 10 = 2 then '19' else '20' end) as name",
        """case when s_suppkey = 8 then array('overall', 'latest')
                when s_suppkey % 9 = 1 then array(concat('company-', s_suppkey), 'extra', 'latest')
                when s_suppkey % 9 = 3 then array(concat('company-', s_suppkey))
                when s_suppkey % 9 = 5 then array('someone', 'latest')
                else array(concat('company-', s_suppkey), 'latest') end as tags""",
    )
