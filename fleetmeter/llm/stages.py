"""Intermediate tables in the cluster's shared folder, and small helpers of the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.session import shared_folder


def folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/llm-{spark.sparkContext.applicationId}"


def staged(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder.

    It cuts lineage: what follows reads the files, whatever executors are lost.
    """
    path = f"{folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete the stages of this application, once the results that read them are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(divisor: int, remainder: int, key: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id counts as not held out."""
    part = F.crc32(F.col(key).cast("string").cast("binary")) % divisor
    return F.coalesce(part == remainder, F.lit(False))


def clean(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra ones cannot clash with the operator's own."""
    return df.select(*columns)
