"""A training corpus from raw documents: five stages, each of which reads what the one before wrote.

Defined cases: a null or empty text, and one without letters, goes in the first stage. Rows may repeat and doc_ids
be null; what that means is stated in each operator. Columns of documents that no stage changes
(all but text, lang and n_chars) come through as they are, whatever their names.
Empty documents give an empty corpus; an empty benchmark drops nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.llm import decontaminate, language_id, line_dedup, mixing, simhash
from fleetmeter.llm.stages import folder, held_out


def _row(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of ``docs`` from its struct ``row``, but for those that a stage changes."""
    return [changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; text without letters goes. ``lang`` is the prediction."""
    model = language_id.fit(language_id.training_sample(docs.where(~held_out(4, 2))))
    rows = docs.select("text", F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row"))
    found = language_id.identify(rows, model).where(F.col("lang_pred") != language_id.UNKNOWN)
    return found.select(_row(docs, text=F.col("text"), lang=F.col("lang_pred")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten or more documents hold; ``n_chars`` follows the text."""
    cleaned = line_dedup.drop_repeated_lines(docs)
    return cleaned.select(_row(docs, text=F.col("kept"), n_chars=F.length("kept").cast("bigint")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints, over four-word shingles, link within four bits."""
    return simhash.keep_one(docs, width=4, tau=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with block, slot and in_mix, their place in the mix of sources.

    Where documents has a column of such a name already, it keeps it, and the place goes by the name with
    ``mix_`` before it, as often as it takes.
    """
    mixed, taken, place = mixing.interleave(docs, carry=True), {c.lower() for c in docs.columns}, []
    for name in ("block", "slot", "in_mix"):
        free = name
        while free in taken:
            free = f"mix_{free}"
        place.append(F.col(name).alias(free))
    return mixed.select(*_row(docs), *place)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mixing", mix_sources),
]

#: Two of the stages, language identification and SimHash, are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written as Parquet in the shared folder and read again."""
    root = f"{folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{root}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{root}/{name}")
    return docs
