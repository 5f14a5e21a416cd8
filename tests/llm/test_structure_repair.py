"""Structure repair: faults and cheapest edits against a plain search, whole and in pieces."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import messy
import pytest

from starlattice.llm import queries, structure_grammar, structure_repair
from starlattice.llm.structure_grammar import FAULTS, LETTERS, ROLES, Grammar, choose_states

SCHEMA = "conv_id long, turn long, role string, text string, place string, audit string, digest string"
SPACE = " \t\n\x0b\x0c\r"


def brute(rows):
    """Report and repaired lines of one conversation's sorted rows (turn, role, text), by a plain DP over strings."""
    faults, seen = [], set()
    for _, role, text in rows:
        kept = text.rstrip(SPACE)
        faults.append("b" if not kept else "d" if (role, text) in seen else "t" if kept[-1] not in ".!?" else "k")
        seen.add((role, text))
    step = lambda s, r: {"s": 1 if s == 0 else None, "u": 2 if s != 2 else None, "a": 3 if s == 2 else None}.get(r)
    name = lambda s: "assistant" if s == 2 else "user"

    def inserts(best):
        # Cheapest first: an insert only leads to dearer ways.
        for _ in range(3):
            for s, (cost, audit, lines) in list(best.items()):
                new = (cost + 5, audit + "I", (*lines, name(s) + ":"))
                to = step(s, name(s)[0])
                if to not in best or new < best[to]:
                    best[to] = new
        return best

    ways = inserts({0: (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for s, (cost, audit, lines) in ways.items():
            edits = [(s, cost + 2, "D", lines)]
            if fault not in "bd":
                more = 5 if fault == "t" else 0
                edits.append((step(s, name(s)[0]), cost + 1 + more, "R", (*lines, f"{name(s)}:{text}")))
                if step(s, role[:1]) is not None:
                    edits.append((step(s, role[:1]), cost + more, "K", (*lines, f"{role}:{text}")))
            for to, price, edit, written in edits:
                new = (price, audit + edit, written)
                if to not in after or new < after[to]:
                    after[to] = new
        ways = inserts(after)
    cost, audit, lines = min(w for s, w in ways.items() if s in (0, 3))
    turns = [t for t, *_ in rows if t is not None]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
        "cost": cost, "audit": audit,
    }, list(lines)


def conversations(seed, number=60, longest=14):
    rng = random.Random(seed)
    texts = ["Hello.", "What now?", "no end", "", " \n\t", "é😀!", "trailing.  \n", "a. b", "Nbsp. ", "x" * 300 + "1", "x" * 300 + "2."]
    for conv in [*range(number), None]:
        for _ in range(rng.randint(1, longest)):
            turn = rng.choice([None, *range(12)])
            yield conv, turn, rng.choice(["user", "user", "assistant", "assistant", "system", "", "agent", "User", None]), rng.choice([None, *texts])


def sorted_rows(rows):
    filled = [(t, r or "", x or "") for t, r, x in rows]
    return sorted(filled, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def grouped(rows):
    found = {}
    for conv, *row in rows:
        found.setdefault(conv, []).append(row)
    return found


@pytest.mark.parametrize("bits, broadcast", [(12, 500_000), (1, 500_000), (2, 0)])
def test_against_a_plain_search(spark, monkeypatch, bits, broadcast):
    monkeypatch.setattr(structure_repair, "PIECE_BITS", bits)
    monkeypatch.setattr(structure_repair, "BROADCAST_REPEATS", broadcast)
    rows = list(conversations(bits, 25, 40 if bits < 12 else 14))
    found = structure_repair.repair(spark.createDataFrame([(*r, "p", "a", "d") for r in rows], SCHEMA))
    report = {r.conv_id: r.asDict() for r in found.report.collect()}
    lines = grouped((r.conv_id, r.place, r.step, f"{r.role}:{r.text}") for r in found.rows.collect())
    expected = grouped(rows)
    assert set(report) == set(expected)
    for conv, own in expected.items():
        want, repaired = brute(sorted_rows(own))
        assert {k: report[conv][k] for k in want} == want
        assert [x for *_, x in sorted(lines.get(conv, []))] == repaired
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in repaired))


def test_grammar_gives_the_answers_of_single_letters():
    rng = random.Random(4)
    plain = Grammar()
    pairs = [a + b for a, b in itertools.product(LETTERS[:8], repeat=2)][:40] + ["\ue000A", "\ue001\ue002"]
    grammar = Grammar(pairs)
    shortened = 0
    for _ in range(300):
        letters = "".join(rng.choices(LETTERS[:8], k=rng.randint(1, 30)))
        shortened += len(grammar.shorten(letters)) < len(letters)
        assert grammar.solve(letters, 0, None, True) == plain.solve(letters, 0, None, True)
        cuts = sorted(rng.sample(range(1, len(letters)), min(3, len(letters) - 1)))
        pieces = [letters[a:b] for a, b in zip([0, *cuts], [*cuts, len(letters)])]
        way = choose_states(*zip(*(grammar.transfers(p) for p in pieces)))
        solved = [grammar.solve(p, s, e, p_at == len(pieces) - 1) for p_at, (p, (s, e)) in enumerate(zip(pieces, way))]
        assert (sum(c for c, _ in solved), "".join(a for _, a in solved)) == plain.solve(letters, 0, None, True)
    assert shortened > 200


def test_learned_rules_are_frequent_pairs(spark):
    user, reply = (LETTERS[ROLES.index(r) * len(FAULTS) + FAULTS.index("k")] for r in "ua")
    strings = spark.createDataFrame([((user + reply) * n,) for n in range(1, 40)], "letters string")
    grammar = structure_grammar.learn(strings)
    assert grammar.pairs[0][0] == user + reply
    assert len(grammar.shorten((user + reply) * 64)) <= 8


def test_registered_query_on_messy_rows(spark, tmp_path):
    rows = list(conversations(9, 80))
    rows += [(70_000 + c, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for c in range(3) for t in range(200)]
    lone = next(c for c in range(10**6, 10**6 + 100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((lone, 0, "user", "dropped"))
    turns = spark.createDataFrame([(*r, "p", "a", "d") for r in rows], SCHEMA)
    turns.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r.asDict() for r in queries.op11_structure_repair(spark, str(tmp_path)).collect()}
    for conv, own in grouped(rows).items():
        left = []
        for turn, role, text in own:
            role, text = " " if role is None else role, " " if text is None else text
            fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            left += [(turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
        want, lines = brute(sorted_rows(left))
        want["repaired_sha256"] = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert {k: got[conv][k] for k in want} == want
    assert got[lone]["audit"] == "" and got[lone]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_no_rows(spark):
    empty = messy.empty(spark).selectExpr("doc_id conv_id", "n_chars turn", "lang role", "text", "row")
    found = structure_repair.repair(empty)
    assert found.report.count() == 0 and found.rows.count() == 0
