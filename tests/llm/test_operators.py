"""Each operator against brute force on texts with the hard cases, on empty tables, and held-out rows."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from fleetmeter.llm import (
    decontaminate,
    exact_dedup,
    language_id,
    line_dedup,
    lm_score,
    mixing,
    simhash,
    substring_dedup,
    toxicity,
)
from fleetmeter.llm.oracles import ORACLES
from fleetmeter.llm.queries import QUERIES
from fleetmeter.llm.stages import held_out
from verification.compare import canonical, duckdb_views

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept int, hits int"
LONG = " ".join(f"w{i % 97}x{i % 13}" for i in range(400))
TEXTS = [
    None, "", "   ", "Same Text", "same text", "É É", "é é", "a\nb\n\nA \n", "one", "of the", LONG, LONG + " tail",
    "head " + LONG, LONG.replace("w5x5", "changed"), "...!!!", "x" * 5000, "\n".join(["Line"] * 50), "line\nother",
]
ROWS = [(i, text, "en" if i % 2 else None, "s" if i % 3 else None, None, 1.0, 1, 1) for i, text in enumerate(TEXTS * 4)]
ROWS += [(None, LONG, "en", "s", 1, None, None, None), (3, "Same Text", "en", "s", 1, None, None, None)]
ITEMS = [(1, "one"), (2, None), (3, " ".join(LONG.split()[20:60])), (3, "OF the"), (None, "same text"), (5, "?!")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def same(df, expected) -> None:
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted(expected, key=str)


def test_exact_dedup(docs):
    groups: dict[str, list] = {}
    for r in ROWS:
        groups.setdefault((r[1] or "").translate(LOW), []).append(r[0])
    expected = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        expected += [(i, keep, len(ids), i == keep, sha(text)) for i in ids]
    marked = exact_dedup.mark_duplicates(docs)
    same(marked.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest"))), expected)


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 40])
def test_decontaminate(spark, docs, block, monkeypatch):
    monkeypatch.setattr(decontaminate.test_blocks, "__defaults__", (block,))
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    tests: dict[tuple, set] = {}
    for item, text in ITEMS:
        w = pattern.findall((text or "").translate(LOW))
        n = min(10, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            tests.setdefault(tuple(w[p : p + n]), set()).update([] if item is None else [str(item)])
    expected = []
    for r in ROWS:
        w, hit, found = pattern.findall((r[1] or "").translate(LOW)), set(), set()
        for n in {len(k) for k in tests}:
            for p in range(len(w) - n + 1):
                if (key := tuple(w[p : p + n])) in tests:
                    hit.update(range(p, p + n))
                    found |= tests[key]
        expected.append((r[0], len(w), len(hit), ",".join(sorted(found)), bool(hit)))
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = decontaminate.find_matches(docs, items)
    joined = F.array_join(F.array_sort("items"), ",")
    same(got.select("doc_id", "n_words", decontaminate.hit_words(), joined, "touched"), expected)
    clean = decontaminate.drop_contaminated(docs, items)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not e[-1] for e in expected)


def test_line_dedup(docs):
    key = lambda line: line.strip(" \t\n\v\f\r").translate(LOW)
    held = Counter(k for r in ROWS for k in {key(x) for x in (r[1] or "").split("\n")})
    expected = []
    for r in ROWS:
        lines = (r[1] or "").split("\n")
        stay = [x for x in lines if not key(x) or held[key(x)] < 5]
        expected.append((r[0], len(lines), len(lines) - len(stay), "\n".join(stay)))
    cleaned = line_dedup.drop_repeated_lines(docs, min_docs=5)
    same(cleaned.select("row.doc_id", "n_lines", "n_dropped", "kept"), expected)


def test_substring_dedup(docs):
    first: dict[tuple, int] = {}
    for r in ROWS:
        w = words(r[1])
        for p in range(len(w) - 49 if r[0] is not None else 0):
            k = tuple(w[p : p + 50])
            first[k] = min(first.get(k, r[0]), r[0])
    expected = []
    for r in ROWS:
        w, gone = words(r[1]), set()
        for p in range(len(w) - 49 if r[0] is not None else 0):
            if first[tuple(w[p : p + 50])] < r[0]:
                gone.update(range(p, p + 50))
        expected.append((r[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    same(substring_dedup.remove_repeats(docs), expected)


@pytest.mark.parametrize("parts", [range(1, 6), [2], [4]])
def test_simhash(docs, parts, monkeypatch):
    monkeypatch.setattr(simhash, "PARTS", parts)
    prints = []
    for r in ROWS:
        w = words((r[1] or "").translate(LOW))
        each = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in each]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    root = list(range(len(prints)))
    for _ in root:
        for i, a in enumerate(prints):
            root[i] = min(root[j] for j, b in enumerate(prints) if (a ^ b).bit_count() <= 4)
    least: dict[int, int] = {}
    for i, r in enumerate(ROWS):
        if r[0] is not None:
            least[root[i]] = min(least.get(root[i], r[0]), r[0])
    expected = [(r[0], f"{p:016x}", least[root[i]]) for i, (r, p) in enumerate(zip(ROWS, prints, strict=True))]
    got = simhash.near_duplicates(docs)
    same(got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id"), expected)
    assert simhash.keep_one(docs).columns == docs.columns


def test_lm_score(docs):
    tokens = [[*words((r[1] or "").translate(LOW)), None] for r in ROWS]
    counts = Counter(t for w in tokens for t in w)
    n, v = sum(counts.values()), len(counts)
    scored = lm_score.score_texts(docs, docs).collect()
    mine = sorted((len(w), round(sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in w), 6)) for w in tokens)
    assert sorted((r.n_tokens, round(r.base_score, 6)) for r in scored) == mine
    assert all(r.train_tokens == n and r.score < 0 for r in scored)


def test_context_tree_is_a_distribution():
    rng = np.random.default_rng(1)
    rows = [(0, 0, {97: 60, 98: 40, 99: 7}), (1, 97, {98: 30, 97: 5}), (1, 98, {99: 7}), (2, 97 << 8 | 98, {98: 9})]
    tree = lm_score.build_tree(rows, 2)
    assert np.allclose((10.0 ** tree.log10.astype(float)).sum(axis=1), 1, atol=1e-4)
    stream = rng.integers(97, 100, 50).astype(np.uint8)
    assert (tree.score(stream, np.r_[[False] * 2, [True] * 48])[2:] < 0).all()


def coded(text: str | None) -> bytes:
    return b"".join(w.encode() + b" " for w in words((text or "").translate(LOW))) + b"\n"


def test_score_is_that_of_context_tree_weighting(spark):
    """Weighted and mixed probabilities of all contexts, by their definition."""
    texts = ["the cat sat", "The cat ate the rat", "a rat", None, "", "cat cat cat the", "é ü the"]
    other = ["the rat sat", "zzz", "a dog é", ""]
    depth, seen = 5, {}
    for t in texts:
        padded = b"\n" * depth + coded(t)
        for i in range(depth, len(padded)):
            for d in range(depth + 1):
                seen.setdefault(padded[i - d : i], Counter())[padded[i]] += 1

    def outcomes(context: bytes, node: int) -> list[int]:
        """How often decision ``node`` (heap order, from 1) of a byte went either way."""
        n = [0, 0]
        for byte, times in seen.get(context, {}).items():
            path = 256 | byte
            for shift in range(8, 0, -1):
                if path >> shift == node:
                    n[path >> (shift - 1) & 1] += times
        return n

    extended: dict[bytes, list[bytes]] = {}
    for c in seen:
        if c:
            extended.setdefault(c[1:], []).append(c)
    memo: dict[tuple, float] = {}

    def log_kt(n: list[int]) -> float:
        return math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.log(math.pi) - math.lgamma(sum(n) + 1)

    def weighted(context: bytes, node: int) -> float:
        key = (context, node)
        if key not in memo:
            own = log_kt(outcomes(context, node))
            if len(context) < depth:
                below = sum(weighted(c, node) for c in extended[context])
                own = math.log(0.5) + float(np.logaddexp(own, below))
            memo[key] = own
        return memo[key]

    def chance(history: bytes, node: int) -> float:
        mixed, left = 0.0, 1.0
        for d in range(depth + 1):
            context = history[len(history) - d :]
            n = outcomes(context, node)
            stop = math.exp(math.log(0.5) + log_kt(n) - weighted(context, node)) if context in seen and d < depth else 1.0
            mixed += left * stop * (n[1] + 0.5) / (sum(n) + 1)
            left *= 1 - stop
            if context not in seen:
                break
        return mixed

    def score(t: str | None) -> float:
        padded, total = b"\n" * depth + coded(t), 0.0
        for i in range(depth, len(padded)):
            path = 256 | padded[i]
            for shift in range(8, 0, -1):
                one = chance(padded[i - depth : i], path >> shift)
                total += math.log10(one if path >> (shift - 1) & 1 else 1 - one)
        return total

    table = lambda x: spark.createDataFrame(list(enumerate(x)), "doc_id int, text string")
    for scored in (texts, other):
        got = {r.doc_id: r.score for r in lm_score.score_texts(table(scored), table(texts)).collect()}
        assert got == pytest.approx({i: score(t) for i, t in enumerate(scored)}, rel=2e-4)


def context_tree_scores(texts, scored, depth=5) -> list[float]:
    """Context-tree weighting by its definition, from the counts of all contexts."""
    grams: Counter = Counter()
    for text in texts:
        padded = b"\n" * depth + coded(text)
        grams.update(padded[i : i + depth + 1] for i in range(len(padded) - depth))
    seen: dict[tuple, list[int]] = {}
    longer: dict[tuple, set] = {}
    for gram, times in grams.items():
        path = 256 | gram[-1]
        for shift in range(8, 0, -1):
            for d in range(depth + 1):
                at = gram[depth - d : depth], path >> shift
                seen.setdefault(at, [0, 0])[path >> (shift - 1) & 1] += times
                if d < depth:
                    longer.setdefault(at, set()).add((gram[depth - d - 1 : depth], path >> shift))

    def log_kt(at) -> float:
        n = seen.get(at, [0, 0])
        return math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.log(math.pi) - math.lgamma(sum(n) + 1)

    @cache
    def weighted(at) -> float:
        if len(at[0]) == depth:
            return log_kt(at)
        return math.log(0.5) + float(np.logaddexp(log_kt(at), sum(weighted(x) for x in longer.get(at, ()))))

    def one(history: bytes, node: int, d: int = 0) -> float:
        at = history[depth - d :], node
        n = seen.get(at, [0, 0])
        p = (n[1] + 0.5) / (sum(n) + 1)
        if d == depth:
            return p
        stop = math.exp(math.log(0.5) + log_kt(at) - weighted(at))
        return stop * p + (1 - stop) * one(history, node, d + 1)

    out = []
    for text in scored:
        padded, total = b"\n" * depth + coded(text), 0.0
        for i in range(depth, len(padded)):
            path = 256 | padded[i]
            for shift in range(8, 0, -1):
                p = one(padded[i - depth : i], path >> shift)
                total += math.log10(p if path >> (shift - 1) & 1 else 1 - p)
        out.append(total)
    return out


@pytest.mark.parametrize("held", [None, 1e-9])
def test_contexts_that_are_seen_once_count(spark, monkeypatch, held):
    """Of 120 KB of text, with all keys in the scoring tasks' memory and with none."""
    if held:
        monkeypatch.setattr(lm_score, "HELD", held)
    texts = ["The cat sat on the mat " * 2600, "the dog ate it " * 4000, "quizzing vexes jumbled fjords", "é quizzing ü", None, ""]
    scored = ["quizzing vexes", "jumbled cat", "é quizzing ü", "the quizzical dog", "ZZZ zzz zzz zzz", "ß ß", "", None]
    table = lambda x: spark.createDataFrame(list(enumerate(x)), "doc_id int, text string")
    got = {r.doc_id: r.score for r in lm_score.score_texts(table(scored), table(texts)).collect()}
    assert got == pytest.approx(dict(enumerate(context_tree_scores(texts, scored))), rel=1e-5)


def test_training_by_condition_is_training_on_those_rows(spark):
    rows = [(i, text, i % 3 > 0 if i % 7 else None) for i, text in enumerate(TEXTS * 2)]
    table = spark.createDataFrame(rows, "doc_id int, text string, learn boolean").repartition(3)
    a = lm_score.score_texts(table, "learn", ("doc_id", "learn")).collect()
    b = lm_score.score_texts(table, table.where("learn"), ("doc_id", "learn")).collect()
    figures = lambda x: {r.doc_id: pytest.approx(r[2:], rel=1e-6) for r in x}
    assert len(a) == len(rows) and {r.doc_id: r[2:] for r in a} == figures(b)


def test_keys_are_weighed_whole_contexts_at_a_time(monkeypatch):
    rng = np.random.default_rng(2)
    key = np.unique(rng.integers(97, 100, (3000, 6)) @ (1 << np.arange(40, -1, -8)))
    key[: len(key) // 2] = np.arange(len(key) // 2)  # one long subtree
    n = rng.integers(0, 5, len(key))
    table = pa.table({"key": key, "n": n, "seen": n + 1})

    def weighed(batch: int) -> tuple[dict, dict]:
        rows = pa.Table.from_batches(lm_score._weigh(5, 2)(iter(table.to_batches(batch)))).to_pylist()
        sums: Counter = Counter()
        for r in rows:
            if r["chances"] is None:
                sums[r["key"]] += r["weighted"]
        return {r["key"]: (r["seen"], *r["chances"]) for r in rows if r["chances"] is not None}, sums

    chances, sums = weighed(len(key))
    monkeypatch.setattr(lm_score, "WEIGHED", 20)
    again, sums_again = weighed(7)
    assert again == chances and len(chances) == len(key)
    assert sums_again == pytest.approx(sums)


def test_log_kt_of_large_counts():
    n = np.array([0.0, 1, 7, 8, 65535, 65536, 1e9])
    by_definition = [math.lgamma(x + 0.5) + math.lgamma(3.5) - math.log(math.pi) - math.lgamma(x + 4) for x in n]
    assert lm_score._log_kt(n, np.full(len(n), 3.0)) == pytest.approx(by_definition, abs=1e-5)


def test_contexts_grow_with_the_corpus():
    kept = [total / lm_score.least_count(total) for total in (10**6, 10**8, 10**9, 10**10, 10**13)]
    assert kept == sorted(kept) and kept[-1] > 10 * kept[1]


def test_contexts_follow_one_formula_at_every_size():
    sizes = [1 << n for n in range(10, 46, 5)]
    kept = [n / lm_score.least_count(n) for n in sizes]
    assert all(a < b for a, b in zip(kept, kept[1:]))
    # The cubes lie on one line, so there is no size at which another rule begins.
    assert [k**3 - kept[0] ** 3 for k in kept[1:]] == pytest.approx([(n - sizes[0]) * 2.0**21 for n in sizes[1:]], rel=1e-3)


def test_mixing_deviates_less_than_a_block(docs):
    rows = mixing.interleave(docs, period=100, block_chars=50).collect()
    assert len(rows) == len(ROWS)
    weights = {"": 1.0, "s": 3.0}
    shares = mixing.source_shares(docs.sparkSession.createDataFrame([("", 5), ("s", 5)], "source string, chars bigint"), 100, weights)
    share = {r.source: r.n for r in shares.collect()}
    assert sum(share.values()) == 100
    seen: Counter = Counter()
    for r in mixing.period_schedule(shares, 100).orderBy("at").collect():
        seen[r.source] += 1
        assert all(abs(seen[s] - (r["at"] + 1) * share[s] / 100) < 1 for s in share)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    lang = QUERIES["op1_language_id"](spark, sf_dir).where("held_out").join(docs, "doc_id")
    assert lang.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    good = QUERIES["op4_quality"](spark, sf_dir).where("held_out").join(labels, "doc_id")
    assert good.select(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.9
    toxic = QUERIES["op9_toxicity"](spark, sf_dir).join(labels, "doc_id").groupBy("toxic").agg(F.avg("score").alias("s"))
    means = {r.toxic: r.s for r in toxic.collect()}
    assert means[1] > 3 * means[0]


def test_no_letter_is_und(spark, docs):
    found = language_id.identify(docs, language_id.fit([("en", "the words"), ("de", "die woerter")]))
    assert {r.lang_pred for r in found.where("text is null or text in ('', '   ', '...!!!')").collect()} == {"und"}
    assert found.where("text is not null and length(trim(text)) > 6 and text like '%x%' and lang_pred = 'und'").count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path, name):
    for table, schema in (
        ("documents", "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        ("benchmark", "item_id bigint, text string"),
        ("labels", "doc_id bigint, quality int, toxic int"),
        ("conversations", "conv_id bigint, turn bigint, role string, text string"),
        ("embeddings", "vec_id bigint, embedding array<float>, label int"),
    ):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duckdb_views(sf_dir).execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, result.fetchall())


def test_toxicity_tables_count_every_bigram(spark, docs):
    sample = docs.select("text", (F.col("doc_id") % 2).cast("int").alias("label")).where("text is not null and label is not null")
    counted = toxicity.count_bigrams(sample)
    pairs: Counter = Counter()
    spelled = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in sample.collect():
        w = [None, *spelled.findall(r.text.translate(LOW))]
        pairs.update((r.label, a, b) for a, b in zip(w[:-1], w[1:], strict=True))
    assert sorted((r.ordinary, r.toxic) for r in counted.collect()) == sorted(
        (pairs[0, a, b], pairs[1, a, b]) for a, b in {k[1:] for k in pairs}
    )
    names = {x for k in pairs for x in k[1:]}
    kinds = lambda c, k, x: len({p for p in pairs if p[0] == c and p[k] == x})
    expected = sorted(
        (*(kinds(c, 2, x) for c in (0, 1)), *(kinds(c, 1, x) for c in (0, 1)), *(sum(n for p, n in pairs.items() if p[:2] == (c, x)) for c in (0, 1)))
        for x in names
    )
    words = toxicity.word_table(counted)
    assert sorted(tuple(r)[1:] for r in words.collect()) == expected
    assert all(r.ordinary + r.toxic >= toxicity.LEAST_BIGRAM for r in toxicity.kept_bigrams(counted, words).collect())


@pytest.mark.parametrize("sources", [1, 7, 20, 21, 95])
def test_mixing_with_more_sources_than_the_period(spark, sources):
    """Blocks lie where earliest deadline first over all sources puts them, and none is lost."""
    rows = [(i, "x" * (i % 9 * 10), f"s{i % sources:03}") for i in range(3 * sources)]
    period = 20 if sources <= 20 else 20 * (-(-sources // 20) + 1)
    out = mixing.interleave(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), period=20, block_chars=40).collect()
    assert sorted(r.doc_id for r in out) == list(range(3 * sources))
    totals = [(f"s{i:03}", 10 * i * i) for i in range(sources)]
    shares = mixing.source_shares(spark.createDataFrame(totals, "source string, chars bigint"), 20)
    n = {r.source: r.n for r in shares.collect()}
    assert sum(n.values()) == period and min(n.values()) >= 1
    done, expected = dict.fromkeys(n, 0), []
    for at in range(period):
        ready = [(-(-(done[s] + 1) * period // n[s]), s) for s in n if done[s] * period // n[s] <= at]
        s = min(ready)[1]
        expected.append((s, n[s], done[s], at))
        done[s] += 1
    same(mixing.period_schedule(shares, 20).select("source", "n", "k", "at"), expected)
