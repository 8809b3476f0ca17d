"""The registry of published runs: taking the latest tag off, and finding latest tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.operators.quality import OVERALL
from fleetmeter.sources.tables import with_tag


def retag_latest(registry: DataFrame, companies: DataFrame, latest: str) -> DataFrame:
    """Take the latest tag off published runs that also carry a company's tag or ``overall``.

    ``untagged`` marks the changed runs. Company tags are matched by a join, as
    neither the registry nor the companies need to be small.
    """
    named = (
        with_tag(registry, latest)
        .select("run_id", F.explode("tags").alias("company"))
        .join(companies.select("company"), "company", "left_semi")
        .select("run_id")
        .distinct()
        .withColumn("_named", F.lit(True))
    )
    hit = F.array_contains("tags", latest) & (
        F.array_contains("tags", OVERALL) | F.col("_named").isNotNull()
    )
    return (
        registry.join(named, "run_id", "left")
        .withColumn("untagged", F.coalesce(hit, F.lit(False)))
        .withColumn(
            "tags",
            F.when(F.col("untagged"), F.array_remove("tags", latest)).otherwise(F.col("tags")),
        )
        .drop("_named")
    )


def untagged_count(retagged: DataFrame) -> DataFrame:
    return retagged.agg(F.count_if("untagged").alias("removed"))


def latest_tables(registry: DataFrame, published: DataFrame, latest: str) -> DataFrame:
    """Rows of ``published`` that belong to runs carrying the latest tag.

    Where ``published`` has the partition ``run``, the names of these runs prune it: files of
    other runs are not opened.
    """
    runs = with_tag(registry, latest).select(F.col("run_id").alias("published_by"), F.col("name").alias("run"))
    if "run" not in published.columns:
        return published.join(runs, "published_by", "left_semi")
    return published.join(runs.where(F.length("run") > 0), ["run", "published_by"], "left_semi")
