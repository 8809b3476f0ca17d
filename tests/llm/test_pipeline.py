"""The pipeline against a plain version of its stages, with hard rows and clashing columns."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from fleetmeter.llm import simhash
from fleetmeter.llm.queries import QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = ["score", "slot", "block", "mix_block", "_kept", "_gone", "row", "kept", "lang_pred", "fp", "_1", "hits"]


def fingerprint(text: str | None) -> int:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    grams = [" ".join(w[p : p + 4]) for p in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: list[int], tau: int = 4) -> list[int]:
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= tau and root[i] != root[j]:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    return root


def kept_of_groups(rows: list[tuple]) -> list[tuple]:
    """Of (doc_id, text) rows: those of the smallest doc_id of each group; texts of a doc_id are told apart."""
    root = components([fingerprint(t) for _, t in rows])
    first = {}
    for r, (i, _) in zip(root, rows, strict=True):
        first[r] = min(first.get(r, (True, 0)), (i is None, i or 0))
    return [row for r, row in zip(root, rows, strict=True) if (row[0] is None, row[0] or 0) == first[r]]


def without_lines(rows: list[tuple], least: int = 10) -> list[tuple]:
    key = lambda line: line.strip(" \t\n\v\f\r").translate(LOW)
    ids: dict[str, set] = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            ids.setdefault(key(line), set()).add(i)
    gone = {k for k, v in ids.items() if k and len(v) >= least}
    return [(i, "\n".join(x for x in (text or "").split("\n") if key(x) not in gone)) for i, text in rows]


def clean_of(rows: list[tuple], items: list[str]) -> list[tuple]:
    spelled = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for text in items:
        w = spelled.findall((text or "").translate(LOW))
        n = min(10, len(w))
        windows |= {tuple(w[p : p + n]) for p in range(len(w) - n + 1) if n}
    sizes = {len(x) for x in windows}

    def hit(text: str) -> bool:
        w = spelled.findall(text.translate(LOW))
        return any(tuple(w[p : p + n]) in windows for n in sizes for p in range(len(w) - n + 1))

    return [r for r in rows if not hit(r[1])]


def test_against_plain_stages(spark, sf_dir, tmp_path):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [r.text for r in given.where("n_chars > 1500").orderBy("doc_id").limit(30).collect()]
    passages = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").limit(5).collect()]
    planted = [*(f"{x} added" for x in texts[:8]), *(f"{x}\nRead  more here \n" for x in texts[8:22]), *(f"{x} {y}" for x, y in zip(texts[22:], passages, strict=False)), None, "", "..."]
    docs = given.union(spark.createDataFrame([(100_000 + i, x, None, None, None) for i, x in enumerate(planted)], given.schema))
    for name in CLASHING:
        docs = docs.selectExpr("*", f"doc_id as `{name}`")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    spoken = QUERIES["op1_language_id"](spark, str(tmp_path)).where("lang_pred != 'und'")
    lang = {r.doc_id: r.lang_pred for r in spoken.collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in lang]
    expected = clean_of(kept_of_groups(without_lines(rows)), [r.text for r in benchmark.collect()])
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*docs.columns, "mix_mix_block", "mix_slot", "in_mix"]
    got = out.collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(expected)
    assert len(expected) <= len(rows) - 20 < docs.count() - 22
    for r in got:
        assert {r[c] for c in CLASHING} == {r.doc_id} and r.lang == lang[r.doc_id] and r.n_chars == len(r.text)


def test_keep_one_with_hard_rows(spark):
    rng = np.random.default_rng(7)
    texts = [None, "", "  ", "one two", "ONE  two", "a b c", "x" * 3000]
    for size in (30, 200, 800):
        for i in range(6):
            base = [f"w{x}" for x in rng.integers(0, 5000, size)]
            texts.append(" ".join(base))
            for changes in (0, 1, 2):
                copy = list(base)
                for at in rng.integers(0, size, changes):
                    copy[at] = f"n{changes}x{i}"
                texts.append(" ".join(copy))
    rows = [(int(i), x) for i, x in zip(rng.permutation(len(texts)), texts, strict=True)]
    # Repeated rows, and a group without any doc_id but one text.
    rows += [rows[20], (None, "only here at all"), (None, "only here at all"), (None, rows[30][1])]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id bigint, text string, stays_id string, hash int").repartition(3)
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    expected = kept_of_groups(rows)
    assert len(expected) < len(rows) - 20
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(expected)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("text", [None, "", "...!!! 12"])
def test_nothing_but_rejected_rows(spark, sf_dir, tmp_path, text):
    spark.createDataFrame([(1, text, "en", "s", 0)], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
