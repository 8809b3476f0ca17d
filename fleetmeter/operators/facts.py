"""Usage facts kept as a table and updated by date.

Two tables under one root. ``sums`` holds the additive facts, partitioned by date; an update
replaces the dates that changed. ``firsts`` holds the first day of each run in each period it
appears in, partitioned by kind of period and by period; an update adds the runs that are new to a
period or appear in it earlier than known. So an update reads the changed dates of the
history and the touched periods of ``firsts``, whatever the length of the history.

A history only gains run days, and replaces them; it never loses one. After a change of
the teams' companies the tables have to be built anew, from all dates in an empty folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.functions.columns import shifted_week, sunday_week
from fleetmeter.operators.usage import day_sums, with_company
from fleetmeter.sources.tables import table_exists

SUMS = """company string, gpu_minutes double, metric_minutes double, utilization_minutes double,
  memory_minutes double, max_gpu_utilization double, max_gpu_memory double, day_runs bigint, date date"""
FIRSTS = "company string, run_id string, first_day date, kind string, period date"

#: Kinds of periods and the period of a day; all time is one period.
PERIODS = {
    "week_runs": shifted_week,
    "aligned_week_runs": sunday_week,
    "month_runs": lambda d: F.trunc(d, "MM"),
    "all_runs": lambda d: F.lit("1970-01-01").cast("date"),
}
RUN = ["company", "run_id", "kind", "period"]


def _periods_of(date: Column) -> Column:
    kinds = [F.struct(F.lit(k).alias("kind"), of(date).alias("period")) for k, of in PERIODS.items()]
    return F.inline(F.array(*kinds))


def _firsts(rows: DataFrame) -> DataFrame:
    """First day of each run in each of its periods, among ``rows``."""
    days = rows.select("company", "run_id", "date").distinct()
    each = days.select("company", "run_id", "date", _periods_of(F.col("date")))
    return each.groupBy(*RUN).agg(F.min("date").alias("first_day"))


def _known_firsts(spark: SparkSession, root: str) -> DataFrame:
    if not table_exists(spark, f"{root}/firsts"):
        return spark.createDataFrame([], FIRSTS)
    return spark.read.schema(FIRSTS).parquet(f"{root}/firsts")


def update_usage_facts(history: DataFrame, teams: DataFrame, days: DataFrame, root: str) -> None:
    """Bring the tables under ``root`` up to date with the dates in ``days`` (column date).

    ``history`` is partitioned by date: only the partitions of these dates are read. The dates
    are named in the plan, as there are no more of them than days in a calendar. A repeated
    update changes nothing.
    """
    spark = history.sparkSession
    touched = days.select("date").where("date is not null").distinct()
    dates = [r["date"] for r in touched.collect()]
    if not dates:
        return
    touched = spark.createDataFrame([(d,) for d in sorted(dates)], "date date")
    changed = history.where(F.col("date").isin(dates))
    rows = with_company(changed, teams).where(F.col("company").isNotNull())
    # A null run id is a run of its own.
    runs = rows.groupBy("company", "date").agg(F.count_distinct(F.struct("run_id")).alias("day_runs"))
    sums = day_sums(rows).join(runs, ["company", "date"])
    sums.repartition("date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(f"{root}/sums")
    found = _firsts(rows)
    periods = touched.select(_periods_of(F.col("date"))).distinct()
    known = _known_firsts(spark, root).join(periods, ["kind", "period"], "left_semi")
    named = known.select(*[F.col(c).alias(f"_{c}") for c in (*RUN, "first_day")])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in RUN]
    fresh = found.join(named, [*same, F.col("_first_day") <= F.col("first_day")], "left_anti")
    fresh.repartition("kind", "period").write.mode("append").partitionBy("kind", "period").parquet(f"{root}/firsts")


def read_usage_facts(spark: SparkSession, root: str) -> DataFrame:
    """The table of ``usage.usage_facts`` from the kept tables."""
    sums = spark.read.schema(SUMS).parquet(f"{root}/sums") if table_exists(spark, f"{root}/sums") else spark.createDataFrame([], SUMS)
    # A run that turned up earlier than known has both days here.
    firsts = _known_firsts(spark, root).groupBy(*RUN).agg(F.min("first_day").alias("date"))
    counts = firsts.groupBy("company", "date").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in PERIODS])
    joined = sums.join(counts, ["company", "date"], "left")
    zero = [F.coalesce(F.col(k), F.lit(0)).alias(k) for k in PERIODS]
    names = [f.strip().split()[0] for f in SUMS.split(",")]
    return joined.select("company", "date", *[n for n in names if n not in ("company", "date")], *zero)
