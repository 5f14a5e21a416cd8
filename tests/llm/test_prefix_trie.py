"""The prefix trie against plain dictionaries, with bands, blocks and id strings of a few rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import messy
import pytest
from pyspark.sql import functions as F

from starlattice.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth string, pos string, said string"


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(rs)] for c, rs in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    found = {}
    for path in sorted(members, key=len, reverse=True):
        below = [found[x] for x in children.get(path, [])]
        ends = sorted(c for c in members[path] if len(whole[c]) == len(path))
        found[path] = {
            "conv_id": min(members[path]), "depth": len(path),
            "parent_conv_id": min(members[path[:-1]]) if path else None, "n_convs": len(members[path]), "n_children": len(below),
            "n_leaves": sum(x["n_leaves"] for x in below) or 1,
            "saved_tokens": (len(members[path]) - 1) * (len(path[-1][1]) if path else 0) + sum(x["saved_tokens"] for x in below),
            "ends_sha256": hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        }
    return list(found.values())


def conversations():
    rng = random.Random(6)
    texts = ["Hi.", "é😀 ok", "", None, "Yes?", "x" * 400]
    rows = []
    for c in [*range(90), *range(200, 230), -7, -130, 100_000_000_007]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([t, t, t, None, 3]), rng.choice(["user", "assistant", None]), rng.choice(texts)))
    # Equal conversations, long ones that share most of their turns, a row of no conversation.
    for c in range(300, 340):
        rows += [(c, t, "user", "same") for t in range(6)]
    for c in range(340, 343):
        rows += [(c, t, "user", f"turn {t}" if t < 60 else f"{c}") for t in range(75)]
    return rows + [(None, 0, "user", "nobody's"), (400, None, None, None), (400, 1, "user", "x"), (400, 1, "user", "x")]


def as_rows(found):
    return sorted((tuple(sorted(r.items(), key=lambda x: x[0])) for r in found), key=repr)


@pytest.mark.parametrize("band, bits", [(16, 12), (2, 1), (3, 2)])
def test_against_dictionaries(spark, monkeypatch, tmp_path, band, bits):
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", bits)
    monkeypatch.setattr(prefix_trie, "END_BITS", bits)
    monkeypatch.setattr(prefix_trie.prefix_trie, "__defaults__", (band,))
    monkeypatch.setattr(prefix_trie, "BROADCAST_BASES", 500_000 if band == 16 else 0)
    rows = conversations()
    spark.createDataFrame([(*r, "n", "d", "p", "s") for r in rows], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op12_prefix_trie(spark, str(tmp_path))
    assert as_rows(r.asDict() for r in got.collect()) == as_rows(brute(rows))


def test_a_conversation_over_many_ranges(spark, monkeypatch):
    rows = [(5, t, "user", f"t{t}") for t in range(500)] + [(5, 500, "user", "again")] * 300 + [(6, 0, "user", "x")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
        lines = prefix_trie.conversation_lines(turns)
        assert sorted(r.pos for r in lines.where("conv_id = 5").collect()) == list(range(1, 801))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_general_members(spark):
    rows = [(c, d, (f"turn {d if d < 2 or c else 99}" if d else None), 3 if d else None) for c in range(3) for d in range(4)]
    members = spark.createDataFrame(rows, "conv_id long, depth long, said string, chars long")
    trie = prefix_trie.prefix_trie(members)
    found = {(r.conv_id, r.depth): r for r in trie.nodes.collect()}
    assert set(found) == {(0, 0), (0, 1), (0, 2), (0, 3), (1, 2), (1, 3)}
    assert (found[0, 1].n_children, found[0, 1].n_leaves, found[0, 1].saved) == (2, 2, 6 + 3 + 3)
    assert found[1, 3].parent_conv_id == 1 and found[0, 0].parent_conv_id is None
    assert trie.ends.select(F.count_distinct("node")).first()[0] == 2


def test_no_rows(spark):
    empty = messy.empty(spark).selectExpr("doc_id conv_id", "n_chars turn", "lang role", "text")
    lines = prefix_trie.conversation_lines(empty)
    trie = prefix_trie.prefix_trie(prefix_trie.rebuild(lines, F.col("conv_id"), F.lit(1)))
    assert trie.nodes.count() == 0 and prefix_trie.ends_sha256(trie.ends).count() == 0
