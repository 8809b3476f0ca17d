"""Fixed table schemas. Every reader states its schema; nothing is inferred."""

from pyspark.sql import types as T

SCHEDULE_ENTRY = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("assigned_gpu_node", T.LongType()),
    ]
)

COMPANY_CONFIG = T.StructType(
    [
        T.StructField("company", T.StringType(), False),
        T.StructField("teams", T.ArrayType(T.StringType())),
        T.StructField("schedule", T.ArrayType(SCHEDULE_ENTRY)),
        T.StructField("ignore_project_pattern", T.StringType()),
        T.StructField("include_project_pattern", T.StringType()),
    ]
)

GPU_COUNT_RULES = T.StructType(
    [
        T.StructField("team", T.StringType(), False),
        T.StructField("node_keys", T.ArrayType(T.StringType())),
        T.StructField("gpu_key", T.StringType()),
        T.StructField("multiplier", T.LongType()),
    ]
)

PROJECTS = T.StructType(
    [
        T.StructField("team", T.StringType()),
        T.StructField("project", T.StringType()),
    ]
)

RUN_NODES = T.StructType(
    [
        T.StructField("team", T.StringType()),
        T.StructField("project", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("createdAt", T.StringType()),
        T.StructField("updatedAt", T.StringType()),
        T.StructField("heartbeatAt", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("host", T.StringType()),
        T.StructField(
            "runInfo",
            T.StructType(
                [
                    T.StructField("gpuCount", T.LongType()),
                    T.StructField("gpu", T.StringType()),
                ]
            ),
        ),
        T.StructField("config", T.StringType()),
    ]
)

METRICS_LONG = T.StructType(
    [
        T.StructField("run_path", T.StringType()),
        T.StructField("_timestamp", T.DoubleType()),
        T.StructField("gpu_index", T.IntegerType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

RUN_DAYS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("company_name", T.StringType()),
        T.StructField("project", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("tags", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("state", T.StringType()),
        T.StructField("duration_hour", T.DoubleType()),
        T.StructField("gpu_count", T.LongType()),
        T.StructField("average_gpu_utilization", T.DoubleType()),
        T.StructField("average_gpu_memory", T.DoubleType()),
        T.StructField("max_gpu_utilization", T.DoubleType()),
        T.StructField("max_gpu_memory", T.DoubleType()),
        T.StructField("host_name", T.StringType()),
        T.StructField("logged_at", T.TimestampNTZType()),
    ]
)

REGISTRY = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)

ALERTS = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

RUN_DAY_COLUMNS = RUN_DAYS.fieldNames()
