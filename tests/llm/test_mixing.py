"""Mixing: the fair queue against a plain simulation, caps, ties and odd rows."""

import hashlib
import re
from collections import defaultdict

import messy

from starlattice.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, weights=(5, 2, 1), share=1.5, seed=0):
    """Epochs taken of each (doc_id, text, source), and targets by source."""
    size = lambda t: len(WORD.findall(t or ""))
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    total = {s: sum(size(t) for _, t, x in rows if x == s) for s in sources}
    budget, capped = share * sum(total.values()), set()
    while True:
        open_ = [s for s in sources if s not in capped]
        level = (budget - sum(2 * total[s] for s in capped)) / sum(weight[s] for s in open_) if open_ else 0
        more = {s for s in open_ if 2 * total[s] <= level * weight[s]}
        if not more:
            break
        capped |= more
    target = {s: min(2.0 * total[s], level * weight[s]) if s not in capped else 2.0 * total[s] for s in sources}
    queue = []
    for s in sources:
        turn = lambda r: hashlib.md5(f"{seed}:{'' if r[0] is None else r[0]}:{r[1] or ''}".encode()).hexdigest()
        ends = 0
        for r in sorted((r for r in rows if r[2] == s), key=turn):
            ends += size(r[1])
            queue += [((ends + e * total[s]) / weight[s], turn(r), e, r, size(r[1])) for e in range(2)]
    queue.sort(key=lambda q: q[:3])
    taken, spent, last = defaultdict(int), 0, None
    for q in queue:
        if q[4]:
            if spent + q[4] > budget:
                break
            spent, last = spent + q[4], q[:3]
    for q in queue:
        if last is not None and q[:3] <= last:
            taken[q[3]] += 1
    return taken, target, weight


def test_against_a_plain_queue(spark):
    docs = messy.documents(spark)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    taken, target, _ = brute(rows)
    whole, copies = mixing.mix(docs)
    got = defaultdict(int)
    for r in whole.collect():
        key = (r.doc.doc_id, r.doc.text, r.doc.source)
        got[key] += r.epochs
        assert abs(r.target - target[r.doc.source]) < 1e-6
        assert r.doc["size"] == "x"
    assert {k: v for k, v in got.items() if v} == dict(taken)
    assert copies.count() == sum(got.values())
    assert copies.select("doc.*").columns == docs.columns


def test_every_word_count_stays_near_its_target(spark):
    docs = messy.documents(spark, rows=400)
    sums, targets = defaultdict(int), {}
    for r in mixing.mix(docs)[0].collect():
        sums[r.doc.source] += r.epochs * r["size"]
        targets[r.doc.source] = r.target
    longest = 9000
    assert all(abs(sums[s] - t) <= longest for s, t in targets.items())


def test_empty_tables_and_texts_without_words(spark):
    whole, copies = mixing.mix(messy.empty(spark))
    assert whole.count() == copies.count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r["size"] * r.epochs for r in mixing.mix(blank)[0].collect()] == [0, 0, 0]
