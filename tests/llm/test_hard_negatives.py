"""Hard negatives against all scores of small tables, and the curve against its definition."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetmeter.llm import hard_negatives
from fleetmeter.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, place string, q int, block string"


def vectors(seed: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(700):
        x = centres[i % 6] + rng.normal(size=8) * 0.3
        rows.append((i, [float(v) for v in x / np.linalg.norm(x)], int(rng.integers(0, 10)), "x", 1, "y"))
    # A common vector, ties, short, empty, missing and broken ones, very large components, repeated ids.
    same = rows[0][1]
    rows += [(1000 + i, same, i % 3, None, None, None) for i in range(150)]
    rows += [(2000, [1.0], 1, None, None, None), (2100, [], 1, None, None, None), (2200, None, 1, None, None, None)]
    rows += [(2300, same, None, None, None, None), (2400, [float("nan")] * 8, 2, None, None, None), (2500, [None, 1.0], 2, None, None, None)]
    rows += [(2600, [float("inf")] * 8, 2, None, None, None), (2700, [3e38, -3e38], 2, None, None, None), (None, same, 1, None, None, None)]
    return [*rows, rows[100], (200, [9.0] * 8, 9, None, None, None), (2800, [-v for v in same], 0, None, None, None)]


def expected(rows: list[tuple]) -> list[tuple]:
    kept: dict[int, tuple] = {}
    for i, x, label, *_ in rows:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        limit = hard_negatives.LIMIT
        q = [math.floor(min(max(256 * float(np.float32(v)), -limit), limit)) for v in x]
        kept[i] = min(kept.get(i, (label, q)), (label, q))
    out = []
    for a, (label, q) in kept.items():
        if a % 100:
            continue
        score = {i: sum(v * w for v, w in zip(q, r, strict=False)) for i, (_, r) in kept.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if kept[i][0] == label][:5]:
            fits = [i for i in order if kept[i][0] != label and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            out += [(a, p, rank, n, score[p], score[n]) for rank, n in enumerate(fits[:5], 1)]
    return sorted(out)


@pytest.mark.parametrize("block, seeds, size", [(256, 2, 8192), (5, 1, 7), (1, 2, 3)])
def test_against_all_scores(spark, tmp_path, monkeypatch, block, seeds, size):
    rows = vectors(block)
    for name, value in (("BLOCK", block), ("SEEDS", seeds), ("GROUP", size), ("PAGE", 40 if block < 9 else 4096), ("CHUNK", 30), ("ROWS", size)):
        monkeypatch.setattr(hard_negatives, name, value)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op12_hard_negatives"](spark, str(tmp_path))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == expected(rows)


def test_far_blocks_are_not_read(spark):
    """Clusters that point elsewhere stay unread, and what is read is whole."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in np.eye(8)[i % 8] + rng.normal(size=8) * 0.01], i % 16) for i in range(1600)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    search = hard_negatives.ZonedSearch(hard_negatives.quantised(df))
    assert search.blocks.agg(F.sum(F.size("ids"))).first()[0] == 1600
    anchors = hard_negatives.quantised(df).where("vec_id % 100 = 0").select(F.col("vec_id").alias("anchor_id"), "label", "q")
    grouped = anchors.select("*", F.array(F.lit(50_000)).alias("low"), F.array(F.lit(1 << 40)).alias("high"), F.array(F.lit(1 << 40)).alias("last"), F.lit(0).alias("group"))
    needed = search._bounds(grouped, 1, True, 0).agg(F.sum(F.size("anchors"))).first()[0]
    assert needed <= 16 * 2 < 16 * search.n_blocks / 4


@pytest.mark.parametrize("dims, bits", [(2, 2), (2, 4), (3, 2), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    """Every cell once, and each step to a cell beside it."""
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    index = [bytes(r) for r in hard_negatives.hilbert_index(cells, bits)]
    assert len(set(index)) == len(cells)
    along = cells[sorted(range(len(cells)), key=index.__getitem__)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()
