"""GPU count of a run from its team's configuration keys.

A rule names the keys that may hold the node count, optionally a key with the
GPUs per node, and a multiplier. Each key is read at ``config[key].value``:

* no rule for the team, or no readable configuration: the run's own count;
* an entry that is not an object: the run's own count;
* a missing key, or a value that is not a whole number: 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _read(entry: Column) -> Column:
    """``usable`` is false for an entry that is not an object; ``n`` is its count.

    The type of the entry is only looked at when no count was found in it.
    """
    number = F.try_variant_get(entry, "$.value", "bigint")
    is_object = F.startswith(F.schema_of_variant(entry), F.lit("OBJECT"))
    return F.struct(
        (number.isNotNull() | entry.isNull() | is_object).alias("usable"),
        F.coalesce(number, F.lit(0).cast("bigint")).alias("n"),
    )


def with_gpu_count(runs: DataFrame, rules: DataFrame) -> DataFrame:
    """Replace ``gpu_count`` by the count the team's rule gives."""
    rules = rules.select(
        "team",
        F.col("node_keys").alias("_node_keys"),
        F.col("gpu_key").alias("_gpu_key"),
        F.coalesce("multiplier", F.lit(1)).cast("bigint").alias("_multiplier"),
    )
    # Null for text that is not a JSON object, and where no rule asks for it.
    entries = F.when(
        F.col("_node_keys").isNotNull(), F.from_json("config", "map<string,variant>")
    )
    # The first entry that settles the node count: one that is not usable, or is not 0.
    reads = F.transform("_node_keys", lambda key: _read(F.try_element_at("_entries", key)))
    nodes = F.get(F.filter(reads, lambda r: ~r["usable"] | (r["n"] != 0)), 0)
    gpus = _read(F.try_element_at("_entries", F.col("_gpu_key")))
    return (
        runs.join(rules, "team", "left")
        .withColumn("_entries", entries)
        .withColumn("_nodes", F.when(F.col("_entries").isNotNull(), nodes))
        .withColumn("_gpus", F.when(F.col("_gpu_key").isNotNull(), gpus))
        .withColumn(
            "gpu_count",
            F.when(
                F.col("_entries").isNull()
                | ~F.coalesce("_nodes.usable", F.lit(True))
                | ~F.coalesce("_gpus.usable", F.lit(True)),
                F.col("gpu_count"),
            ).otherwise(
                F.coalesce("_nodes.n", F.lit(0).cast("bigint"))
                * F.coalesce("_gpus.n", F.lit(1).cast("bigint"))
                * F.col("_multiplier")
            ),
        )
        .drop("_node_keys", "_gpu_key", "_multiplier", "_entries", "_nodes", "_gpus")
    )
