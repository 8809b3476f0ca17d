"""Readers and writers for landed exports, the usage history and published tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from fleetmeter import schemas
from fleetmeter.sources.versions import Versions

# Date and timestamp text in the CSV files.
CSV_DATE = "yyyy-MM-dd"
CSV_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def read_run_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Landed run exports, one JSON object per line. A broken line fails the read."""
    return spark.read.schema(schemas.RUN_NODES).option("mode", "FAILFAST").json(path)


def read_projects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PROJECTS).option("mode", "FAILFAST").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Sampled device metrics: wide (``system.gpu.<i>.gpu``) or long Parquet files.

    Wide files may have different device columns, so their schemas are merged.
    """
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("dateFormat", CSV_DATE)
        .option("timestampNTZFormat", CSV_TIMESTAMP)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("multiLine", False)
        .csv(path)
    )


def write_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", partition_by: tuple[str, ...] = ()
) -> None:
    writer = (
        df.write.mode(mode)
        .option("header", True)
        .option("dateFormat", CSV_DATE)
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a Parquet table; lists names only, reads no rows."""
    try:
        spark.read.format("parquet").schema("probe INT").load(path)
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Usage history partitioned by date. No table yet gives an empty one; any other
    failure is raised, so that history is never lost to a bad read."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schemas.RUN_DAYS)
    return spark.read.schema(schemas.RUN_DAYS).parquet(path).select(schemas.RUN_DAY_COLUMNS)


# Text in CSV files of the history: line breaks never appear in a file as they are, so a file can
# be read in splits, and empty text is not taken for null.
ESCAPES = {"\n": "\\n", "\r": "\\r"}
EMPTY = "\\e"


def _replaced(c: Column, texts: dict[str, str]) -> Column:
    for text, by in texts.items():
        c = F.replace(c, F.lit(text), F.lit(by))
    return c


def escape_text(c: Column) -> Column:
    return F.when(c == "", F.lit(EMPTY)).otherwise(_replaced(c, {"\\": "\\\\"} | ESCAPES))


def unescape_text(c: Column) -> Column:
    # What stands between doubled backslashes holds single ones only, so each part is undone by itself.
    undone = {escaped: plain for plain, escaped in ESCAPES.items()}
    parts = F.transform(F.split(c, r"\\\\"), lambda part: _replaced(part, undone))
    return F.when(c == EMPTY, F.lit("")).otherwise(F.array_join(parts, "\\"))


def _on_text(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return df.select(
        [
            change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def read_history_csv(spark: SparkSession, path: str) -> DataFrame:
    return _on_text(read_csv(spark, path, schemas.RUN_DAYS), unescape_text)


def latest_history_csv(spark: SparkSession, root: str) -> DataFrame:
    """The newest version of the CSV history; an empty one if there is none."""
    newest = Versions(spark, root).current()
    if newest is None:
        return spark.createDataFrame([], schemas.RUN_DAYS)
    return read_history_csv(spark, f"{newest}/*")


def write_history_days(df: DataFrame, path: str) -> None:
    """Replace exactly the dates ``df`` holds.

    Rows are rebalanced by date: AQE splits a date with very many rows over many
    writers, by size, and lets small dates share one.
    """
    (
        df.hint("rebalance", "date")
        .sortWithinPartitions("date", "company_name", "project", "run_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def spread_writers(df: DataFrame, column: str) -> DataFrame:
    """One writer per value of ``column``, for tables of many small partitions.

    The number of partitions is fixed: AQE would merge such tables into one task,
    which would then write all files one by one.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), column)


def clustered(df: DataFrame, column: str) -> DataFrame:
    """Rows of one value of ``column`` together, many values to a file.

    AQE lets small values share a writer and splits a value with very many rows, by size.
    """
    return df.hint("rebalance", column).sortWithinPartitions(column)


def write_ordered(df: DataFrame, path: str, *order: str | Column) -> None:
    """Parquet whose files, taken by name, hold the rows in ``order``.

    Each file is a range of the order, sorted by its own task: no task sees all rows.
    """
    ranged = df.repartitionByRange(*order) if order else df
    ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def write_history_csv(df: DataFrame, root: str, end: str | dt.date) -> str:
    """A full CSV copy of the history as a new version under ``root``; an end date may have several."""
    label = f"version={end}"
    text = _on_text(df, escape_text)
    folder = Versions(df.sparkSession, root).commit(lambda path: write_csv(text, f"{path}/{label}"))
    return f"{folder}/{label}"


def record_alerts(alerts: DataFrame, source: str, raised_for: str | dt.date, root: str) -> None:
    """Write the alerts of one job for one day, in place of those of an earlier run of it.

    ``raised_for`` and ``source`` are partitions, so a repeated run doubles nothing and a
    repeated run without alerts takes the old ones away.
    """
    alerts.write.mode("overwrite").parquet(f"{root.rstrip('/')}/raised_for={raised_for}/source={source}")


def registry_exists(spark: SparkSession, path: str) -> bool:
    return Versions(spark, path).current() is not None


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the registry of published runs."""
    newest = Versions(spark, path).current()
    if newest is None:
        return spark.createDataFrame([], schemas.REGISTRY)
    return spark.read.schema(schemas.REGISTRY).parquet(newest)


def write_registry(df: DataFrame, path: str, keep: int = 10) -> None:
    """A new version of the registry. Earlier ones stay readable, the ``keep`` newest for good."""
    versions = Versions(df.sparkSession, path)
    versions.commit(lambda folder: df.write.parquet(folder))
    versions.keep(keep)


def read_published(spark: SparkSession, root: str, table: str, schema: StructType, by_company: bool) -> DataFrame:
    """A published table with its owners as text: ``run``, and ``company`` if it is written by
    company. A run or company named 12 stays text."""
    names = ["run", *(["company"] if by_company else [])]
    stated = StructType([f for f in schema.fields if f.name not in (*names, "published_by")])
    for name in ("published_by", *names):
        stated = stated.add(name, StringType())
    return spark.read.schema(stated).option("basePath", f"{root}/{table}").parquet(f"{root}/{table}")


def with_tag(registry: DataFrame, tag: str | None = None) -> DataFrame:
    """Published runs, all or those carrying ``tag``."""
    return registry if tag is None else registry.where(F.array_contains("tags", tag))
