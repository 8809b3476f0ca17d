"""The prefix trie against a dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from fleetmeter.llm import prefix_trie
from fleetmeter.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, kind string, depth bigint, shard string"


def chats(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in range(-7, 60):
        if c % 13 == 4:
            continue
        for turn in range(rng.randrange(1, 7)):
            text = rng.choice(["hi", "ho", "", None, "é" * 3])
            rows.append((c, turn, ("user", "assistant", None)[turn % 3], text, "x", 1, "s"))
    # One conversation of many copies, long ones that part late, repeated and null turns, rows without a conversation.
    rows += [(c, t, "user", "same", None, None, None) for c in range(100, 200) for t in range(3)]
    rows += [(c, t, "user", f"t{t}" if t < 37 else f"{c % 3}", None, None, None) for c in range(200, 210) for t in range(41)]
    rows += [(300, None, "user", "b", None, None, None), (300, None, "user", "a", None, None, None), (300, 1, "user", "hi", None, None, None)] * 2
    rows += [(None, 0, "user", "hi", None, None, None), (301, 5, "user", "", None, None, None)]
    rng.shuffle(rows)
    return rows


def expected(rows: list[tuple], rebuild: bool) -> list[tuple]:
    own: dict[int, list] = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, role, tie, text))
    own = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in own.items()}
    seqs = own
    if rebuild:
        seqs = {}
        for c, turns in own.items():
            h, lead = zlib.crc32(str(c).encode()) % 9, abs(c) // 5 * 5 * (1 if c >= 0 else -1)
            seqs[c] = own.get(lead, [])[:h] + turns[h:]
    members: dict[tuple, list[int]] = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    kids: dict[tuple, int] = dict.fromkeys(members, 0)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, m in members.items():
        cost = (len(m) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += cost
            leaves[node[:d]] += kids[node] == 0
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(m), len(node), parent, len(m), kids[node], leaves[node], saved[node], digest))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_turns, ends", [(prefix_trie.SHARD_TURNS, prefix_trie.ENDS), (40, 7), (3, 1)])
def test_against_a_dictionary(spark, tmp_path, monkeypatch, shard_turns, ends):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard_turns)
    monkeypatch.setattr(prefix_trie, "ENDS", ends)
    rows = chats(shard_turns)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op11_prefix_trie"](spark, str(tmp_path)).collect()
    assert sorted((tuple(r[c] for c in ORDER) for r in got), key=str) == expected(rows, True)


ORDER = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_plain_conversations(spark):
    """Without rebuilding; members of a node's runs come in ascending order, one run after another."""
    rows = chats(5)
    trie = prefix_trie.prefix_trie(prefix_trie.conversations(spark.createDataFrame(rows, SCHEMA)))
    want = {r[:2]: r[2:7] for r in expected(rows, False)}
    assert {(r.conv_id, r.depth): tuple(r)[2:] for r in trie.nodes.collect()} == want
    assert sum(len(r.members) for r in trie.ends.collect()) == len({r[0] for r in rows if r[0] is not None})
    runs = sorted(r.members for r in trie.ends.where("conv_id = 100 and depth = 3").collect())
    assert [c for run in runs for c in run] == list(range(100, 200))
