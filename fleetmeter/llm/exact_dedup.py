"""Exact deduplication by skew-safe combining, in three stages that each compare full content.

1. Each task folds equal texts of its own batches into one local group (digest, content,
   largest id, number of rows). A group of copies becomes at most one row per batch.
2. Local groups are merged by digest, salt and content: the salt spreads a digest that very many
   batches hold over ``salts`` tasks.
3. The salt winners, at most ``salts`` of a content, are combined by digest and content.

The rows of each local group then take the result by joining on two independent digests of the
content, 256 and 64 bits.

Texts are equal when identical after lower-casing A-Z only; null counts as empty. Of equal texts
the row with the largest doc_id stays. Defined cases: a null doc_id never wins unless its group
has no other; rows that repeat the winning doc_id all count as kept, as nothing tells them apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm import text as t

SALTS = 8


def _digests(content: bytes) -> tuple[bytes, int]:
    other = hashlib.blake2b(content, digest_size=8).digest()
    return hashlib.sha256(content).digest(), int.from_bytes(other, "little", signed=True)


def _fold(with_content: bool):
    """Local groups of a slice; equal means equal content, as the whole content is the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for piece in t.slices(batch.column("text"), 16 << 20):
                raw, cut = piece.data.tobytes().lower(), piece.starts.tolist()
                groups: dict[bytes, list] = {}
                for i, b, e in zip(ids[piece.lo : piece.hi], cut[:-1], cut[1:], strict=True):
                    groups.setdefault(raw[b:e], []).append(i)
                digests = [_digests(c) for c in groups]
                columns = [pa.array([d for d, _ in digests], pa.binary()), pa.array([c for _, c in digests], pa.int64())]
                names = ["digest", "check"]
                if with_content:
                    largest = [max((i for i in m if i is not None), default=None) for m in groups.values()]
                    columns += [
                        pa.array(list(groups), pa.binary()),
                        pa.array(largest, pa.int64()),
                        pa.array([len(m) for m in groups.values()], pa.int64()),
                    ]
                    names += ["content", "largest", "n"]
                else:
                    columns.append(pa.array(list(groups.values()), pa.list_(pa.int64())))
                    names.append("members")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def duplicate_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """digest, check, keep_id and group_size of each distinct content."""
    local = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _fold(True), "digest binary, check bigint, content binary, largest bigint, n bigint"
    )
    largest = [F.max("largest").alias("largest"), F.sum("n").alias("n")]
    salted = local.withColumn("salt", F.pmod(F.xxhash64("largest", F.spark_partition_id()), F.lit(salts)).cast("int"))
    winners = salted.groupBy("digest", "check", "salt", "content").agg(*largest)
    whole = winners.groupBy("digest", "check", "content").agg(*largest)
    return whole.select("digest", "check", F.col("largest").alias("keep_id"), F.col("n").alias("group_size"))


def mark_duplicates(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and the digest of every row."""
    groups = duplicate_groups(docs, salts)
    members = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _fold(False), "digest binary, check bigint, members array<bigint>"
    )
    joined = members.join(groups, ["digest", "check"])
    return joined.select(F.explode("members").alias("doc_id"), "keep_id", "group_size", "digest").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))
    )
