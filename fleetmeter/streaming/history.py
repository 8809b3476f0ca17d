"""Feeding the usage history from landed files as they arrive.

The same newest-wins merge as the daily job, driven by a file stream: a later record
of a run day replaces the earlier one however late it comes, so no watermark is
needed and a repeated batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetmeter import schemas
from fleetmeter.operators.history import update_history
from fleetmeter.session import cut_lineage


def stream_into_history(
    spark: SparkSession,
    landing: str,
    history: str,
    checkpoint: str,
    shared: str | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Merge all run-day files in ``landing`` not merged yet, then stop.

    ``checkpoint`` must be in shared storage; it remembers the files that were merged.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        rows = cut_lineage(batch, shared)
        first, last = rows.agg(F.min("date"), F.max("date")).first()
        if first is not None:
            update_history(batch.sparkSession, history, rows, first, last, shared)

    return (
        spark.readStream.schema(schemas.RUN_DAYS)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
