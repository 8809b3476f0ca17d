"""Landed metric samples of differing devices, read as long rows.

A batch of wide samples lands in a folder named after its layout, the devices it has columns for.
The folder names are the catalogue of schemas: a read states each layout's schema and opens no footer
to learn it, however many files there are.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fleetmeter import schemas
from fleetmeter.operators.metrics import GPU_PATTERN, MEMORY_PATTERN, metric_columns, unpivot_metrics

#: Metric of a column name, and its letter in a layout.
LETTERS = {"gpu": "g", "memory": "m"}


def _ranges(devices: list[int]) -> str:
    """0, 1, 2, 5 as 0-2,5."""
    parts: list[list[int]] = []
    for d in sorted(devices):
        if parts and parts[-1][-1] == d - 1:
            parts[-1][-1:] = [d] if len(parts[-1]) > 1 else [parts[-1][0], d]
        else:
            parts.append([d])
    return ",".join("-".join(map(str, p)) for p in parts)


def layout_of(samples: DataFrame) -> str:
    """Devices with a GPU column and with a memory column, such as g0-7_m0-7."""
    columns = {"gpu": metric_columns(samples, GPU_PATTERN), "memory": metric_columns(samples, MEMORY_PATTERN)}
    devices = {m: [int(c.split(".")[2]) for c in names] for m, names in columns.items()}
    return "_".join(f"{LETTERS[m]}{_ranges(d)}" for m, d in devices.items())


def schema_of(layout: str) -> T.StructType:
    schema = T.StructType().add("run_path", "string").add("_timestamp", "double")
    for metric, part in zip(LETTERS, layout.split("_"), strict=True):
        for low, high in re.findall(r"(\d+)(?:-(\d+))?", part):
            for device in range(int(low), int(high or low) + 1):
                schema = schema.add(f"system.gpu.{device}.{metric}", "double")
    return schema


def land_samples(samples: DataFrame, root: str, batch: str) -> None:
    """Write a batch in the folder of its layout; a batch that lands again replaces itself."""
    layout = layout_of(samples)
    stated = samples.select([f"`{f.name}`" for f in schema_of(layout).fields])
    stated.write.mode("overwrite").parquet(f"{root}/layout={layout}/batch={batch}")


def layouts(spark: SparkSession, root: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("layout="))


def read_landed_samples(spark: SparkSession, root: str) -> DataFrame:
    """All landed samples in long form: ``schemas.METRICS_LONG``."""
    parts = []
    for layout in layouts(spark, root):
        schema = schema_of(layout)
        folder = f"{root}/layout={layout}"
        wide = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
        if len(schema) > 2:
            parts.append(unpivot_metrics(wide))
    empty = spark.createDataFrame([], schemas.METRICS_LONG)
    return reduce(DataFrame.unionByName, parts, empty) if parts else empty
