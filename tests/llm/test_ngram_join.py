"""The n-gram join against all pairs of sets, and the choice of the boundary."""

from __future__ import annotations

import re

import numpy as np
import pytest

from fleetmeter.llm import ngram_join
from fleetmeter.llm.queries import QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, n bigint, ref string, root string, token bigint"


def texts(seed: int) -> list[str | None]:
    rng = np.random.default_rng(seed)
    out = [None, "", "  ", "one two", "ONE  two", "one two three", "A b c d e", "a b\tc d e", "x" * 3000, "É é", "é é"]
    # Small sets at and around the boundary, with words added, dropped and changed at either end.
    for size in range(5, 40):
        base = [f"s{size}x{i}" for i in range(size)]
        out += [" ".join(base), " ".join(base[:-1]), " ".join([*base, "more"]), " ".join(["z", *base[1:]]), " ".join(base[size // 6 :])]
    for size in (45, 90, 300):
        for i in range(6):
            base = [f"w{x}" for x in rng.integers(0, 4000, size)]
            out.append(" ".join(base))
            for changes in range(0, 2 + size // 25):
                copy = list(base)
                for at in rng.integers(0, size, changes):
                    copy[at] = f"n{changes}x{i}"
                out.append(" ".join(copy))
            out.append(" ".join([*base, *(f"t{x}" for x in range(size // 5))]))
    # A group whose members are near the limit, a passage that many texts share, and a chain.
    common = [f"c{x}" for x in range(60)]
    for i in range(40):
        copy = list(common)
        copy[i] = f"own{i}"
        out.append(" ".join(copy))
        out.append(" ".join([*common, *(f"p{i}x{x}" for x in range(5 + i))]))
    chain = [f"k{x}" for x in range(200)]
    out += [" ".join(chain[k : k + 100]) for k in range(0, 60, 7)]
    return out + [t for t in out[::9]]


def expected(rows: list[tuple]) -> list[tuple]:
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
        sets.append({tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4))} if w else set())
    root, close = list(range(len(rows))), 0
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 5 * both >= 4 * len(sets[i] | sets[j]):
                close += 5 * both < 4.2 * len(sets[i] | sets[j])
                old, new = root[i], root[j]
                if old != new:
                    root = [new if x == old else x for x in root]
    assert close > 5
    least = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in root}
    return sorted(((rows[i][0], len(sets[i]), least[root[i]]) for i in range(len(rows))), key=str)


@pytest.mark.parametrize(
    "seed, settings",
    [
        (1, {}),
        (2, {"LIGHT": range(0, 1), "BLOCK": 7, "NEAREST": 1, "BUCKET": 500, "SLICE": 5000}),
        (3, {"COUNTED": 50.0, "BLOCK": 3, "PAIRS": 20, "WORTHWHILE": 2, "NEAREST": 1, "SLICE": 3000}),
    ],
)
def test_against_all_pairs(spark, tmp_path, monkeypatch, seed, settings):
    for name, value in settings.items():
        monkeypatch.setattr(ngram_join, name, value)
    found = texts(seed)
    ids = np.random.default_rng(seed).permutation(len(found)).tolist()
    rows = list(zip(ids, found, strict=True))
    rows[5] = (None, rows[5][1])
    rows.append(rows[30])
    extra = [(*r, 1, "x", "y", 2) for r in rows]
    spark.createDataFrame(extra, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_ngram_join"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    want = expected(rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_boundary_follows_cost(monkeypatch):
    """No small sets, no boundary to gain; dear lists push it up, dear subsets down."""
    assert ngram_join.choose_boundary({}) == 0
    sizes = dict.fromkeys(range(1, 31), 100)
    middle = ngram_join.choose_boundary(sizes)
    assert 0 < middle < 30
    monkeypatch.setattr(ngram_join, "COUNTED", 1000.0)
    assert ngram_join.choose_boundary(sizes) > middle
    monkeypatch.setattr(ngram_join, "COUNTED", 0.0)
    monkeypatch.setattr(ngram_join, "ENTRY", 0.0)
    assert ngram_join.choose_boundary(sizes) == 0


@pytest.mark.parametrize("n", range(1, 31))
def test_subsets_are_counted(n):
    """need() is the least overlap of a similar pair, and partners are all sizes that have one."""
    for m in range(1, 60):
        possible = [k for k in range(min(n, m) + 1) if 5 * k >= 4 * (n + m - k)]
        assert (m in ngram_join.partner_sizes(n)) == bool(possible)
        assert not possible or possible[0] == ngram_join.need(n, m)
