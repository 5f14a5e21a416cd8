"""The n-gram Jaccard join against all pairs, and its parts."""

import random
import re
from collections import Counter

import messy
import numpy as np
import pyarrow as pa
import pytest

from starlattice.llm import components, overlap, set_join
from starlattice.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """(doc_id, n_shingles, component_id, n_links) of every row."""
    sets, root, degree = [shingles(t) for _, t in rows], list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                degree[i] += 1
                degree[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(d, len(s), (least.get(find(i)) if s else d), degree[i]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(12)
    rows = [(r.doc_id, r.text) for r in messy.documents(spark).collect()]
    # Two large groups of near copies that differ more and more, with a passage that all share.
    passage = messy.prose(rng, "en", 55)
    for k, changes in ((2000, 3), (3000, 12)):
        base = messy.prose(rng, "fr", 90).split(" ")
        for i in range(60):
            own = list(base)
            for _ in range(rng.randint(0, changes)):
                own[rng.randrange(len(own))] = f"new{rng.randrange(50)}"
            rows.append((k + i, " ".join(own) + (" " + passage if i % 3 == 0 else "")))
    rows += [(4000 + i, messy.prose(rng, "en", 200) + " " + passage) for i in range(15)]
    rows += [(5000 + i, "A b C" if i % 2 else "a B c") for i in range(6)] + [(5100, "a b c d"), (5101, "a  b c\td"), (5102, "a b c d e")]
    rows += [(6000, "one id of two texts first text here"), (6000, "one id of two texts then another text there")]
    return rows


@pytest.mark.parametrize("group, ids, block", [(set_join.GROUP_SETS, set_join.BROADCAST_IDS, set_join.BLOCK_SHINGLES), (16, 0, 300)])
def test_against_all_pairs(spark, docs, monkeypatch, group, ids, block):
    monkeypatch.setattr(set_join, "GROUP_SETS", group)
    monkeypatch.setattr(set_join, "BROADCAST_IDS", ids)
    monkeypatch.setattr(set_join, "BLOCK_SHINGLES", block)
    df = spark.createDataFrame([(*r, "x", "y") for r in docs], "doc_id long, text string, digest string, root string")
    got = [(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in set_join.near_copies(df.repartition(6)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(docs)))


def test_empty_blocks_add_no_links(spark, monkeypatch):
    """With a set a block, some of a band's blocks stay empty and others hold several sets."""
    monkeypatch.setattr(set_join, "GROUP_SETS", 1)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[:40 + i] + [f"own{i}"] + words[40 + i:])) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in set_join.near_copies(df).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(rows)))
    assert {r[3] for r in got} == {11}


def test_one_of_each_group_stays(spark, docs):
    df = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, group_no string")
    kept = set_join.drop_near_copies(df)
    assert kept.columns == df.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    remains = brute(rows)
    assert all(n == 0 for *_, n in remains)
    expected = {c for d, n, c, _ in brute(docs) if n and c is not None}
    assert {d for d, t in rows if d is not None and shingles(t)} == expected
    assert Counter(t for _, t in rows if not shingles(t)) == Counter(t for _, t in docs if not shingles(t))


def test_empty_tables(spark):
    assert set_join.near_copies(messy.empty(spark)).count() == 0
    assert set_join.drop_near_copies(messy.empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (None, " ")], "doc_id long, text string")
    assert sorted(map(repr, (tuple(r)[2:5] for r in set_join.near_copies(blank).collect()))) == sorted(
        map(repr, [(0, 1, 1), (0, 2, 2), (0, None, None)])
    )


def test_small_groups_derive_answers_where_that_reads_less():
    base = np.arange(400, dtype=np.uint64)
    near = [np.append(base[i:], np.uint64(1000 + i)) for i in range(4)]
    first, links, derived = overlap.link(near, np.zeros(4, int), np.ones(4, int), 75)
    assert links.tolist() == [3] * 4 and len(set(first.tolist())) == 1 and derived.sum() == 2
    # Two lists of two entries: reading both sets would cost as much.
    assert overlap.link(near[:2], np.zeros(2, int), np.ones(2, int), 75)[2].sum() == 0


def test_bytes_of_a_block_do_not_grow_with_the_parts():
    rng = np.random.default_rng(3)
    held = {i.to_bytes(16, "big"): np.unique(rng.integers(0, 2**63, 400).astype(np.uint64)) for i in range(1200)}
    sent = {}
    for parts in (64, 20_000):
        rows = pa.Table.from_batches(list(set_join._cut_block(held, parts)))
        sent[parts] = sum(len(x) for name in ("low", "high", "owners", "digests", "sizes", "known") for x in rows[name].to_pylist() if x)
    assert sent[64] == sent[20_000] == sum(map(len, held.values())) * 7 + 1200 * 24


def test_blocks_of_many_short_texts(spark, monkeypatch):
    monkeypatch.setattr(set_join, "BLOCK_SETS", 50)
    rows = [(i, f"w{i % 700} x") for i in range(1400)] + [(5000, "a b c d e f g h"), (5001, "a b c d e f g h i")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = [(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in set_join.near_copies(df).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(rows)))


@pytest.mark.parametrize("two", [False, True])
def test_groups_derive_the_same_answers(two):
    rng = np.random.default_rng(6)
    sets = []
    for _ in range(3):
        base = rng.choice(10**6, 200, replace=False)
        for _ in range(90):
            own = base.copy()
            own[rng.choice(200, rng.integers(0, 25), replace=False)] = rng.integers(10**6, 10**7, 1)
            sets.append(np.unique(own).astype(np.uint64)[rng.integers(0, 10) :])
    side = rng.integers(0, 2, len(sets)) if two else np.zeros(len(sets), int)
    weights = rng.integers(1, 5, len(sets))
    first, links, derived = overlap.link(sets, side, weights, 75)
    assert derived.sum() > 200
    expected, root = np.zeros(len(sets), int), np.arange(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and (not two or side[i] != side[j]):
                expected[i] += weights[j]
                expected[j] += weights[i]
                root[root == root[i]] = root[j]
    assert links.tolist() == expected.tolist()
    same = lambda labels: [[labels[i] == labels[j] for j in range(len(sets))] for i in range(len(sets))]
    assert same(first) == same(root)


def test_components_of_a_chain_a_star_and_a_clique(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, 500 + i) for i in range(1, 60)] + [(i, j) for i in range(900, 912) for j in range(900, 912)]
    rng = random.Random(2)
    rng.shuffle(edges)
    edges = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in edges]
    got = {r.node: r.root for r in components.components(spark.createDataFrame([*edges, (None, 1)], "a long, b long")).collect()}
    assert got == {i: 100 for i in range(101, 141)} | {i: 500 for i in range(501, 560)} | {i: 900 for i in range(901, 912)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingle_hashes_tell_sets_apart():
    rng = random.Random(9)
    texts = [messy.prose(rng, "en", rng.randint(0, 30)) for _ in range(200)] + [None, "", "\t", "a", "a a", "É é", "x" * 3_000_000]
    found = list(shingle_sets(texts))
    exact = [shingles(t) for t in texts]
    assert [len(f) for f in found] == [len(e) for e in exact]
    assert len(np.unique(np.concatenate(found))) == len(set().union(*exact))
