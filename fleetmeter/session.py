"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are tuned for. None of them changes a result.
#
# No operator forces a broadcast: the small sides (teams, windows, rules,
# calendars) are broadcast by Spark while their size is under the threshold and
# turn into a shuffled join beyond it, where AQE splits hot keys.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Without the Python line of each column expression in error messages, plans of
    # this size are built in about half the time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "fleetmeter",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, when_unset: str | None = None) -> str:
    """The folder named by ``spark.checkpoint.dir``, else ``when_unset``, else one in the
    session's warehouse. On a cluster a warehouse on local disks is refused: executors
    would not see each other's files."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or when_unset
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        alone = spark.sparkContext.master.startswith("local")
        if not alone and (warehouse.startswith("file:") or "://" not in warehouse):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{warehouse}/shared"
    return folder.rstrip("/")


def cut_lineage(df: DataFrame, when_unset: str | None = None) -> DataFrame:
    """Reliable checkpoint: the result no longer depends on its inputs or on any executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, when_unset))
    return df.checkpoint()
