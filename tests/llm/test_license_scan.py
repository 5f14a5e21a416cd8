"""License scans: gates are necessary, containment and registered columns as in a plain scan."""

from __future__ import annotations

import random
import re
from re import _constants as ops
from re import _parser as parser

import messy
import pytest

from starlattice.llm import license_scan, queries
from starlattice.llm.license_rules import BASE, RULES

SCANNER = license_scan.Scanner(RULES)
SEPARATORS = [" ", " ", " ", "\n", " - ", ", ", ".", "/", "\t", "(", "_"]


def example(pattern, rng):
    """A text that the expression matches."""

    def made(tokens):
        out = ""
        for op, value in tokens:
            if op is ops.LITERAL:
                out += chr(value)
            elif op is ops.IN:
                kinds = [v for v in value if v[0] is not ops.NEGATE]
                kind, v = rng.choice(kinds)
                out += chr(v) if kind is ops.LITERAL else chr(v[0]) if kind is ops.RANGE else "x"
            elif op is ops.SUBPATTERN:
                out += made(value[-1])
            elif op is ops.BRANCH:
                out += made(rng.choice(value[1]))
            elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT):
                out += "".join(made(value[2]) for _ in range(rng.randint(value[0], min(value[1], value[0] + 2))))
            elif op is ops.CATEGORY or op is ops.ANY:
                out += "x"
        return out

    return made(parser.parse(pattern))


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def plain_scan(text):
    low = lowered(text or "")
    words = re.findall(license_scan.WORD, low)
    spaced = f" {' '.join(words)} "
    found = []
    for i, rule in enumerate(RULES):
        for m in rule.compiled().finditer(spaced):
            found.append((i, spaced[: m.start()].count(" ") - 1, spaced[: m.end()].count(" ")))
    inside = lambda d, e: e[0] <= d[0] and e != d and e[1] <= d[1] and d[2] <= e[2]
    kept = [d for d in found if RULES[d[0]].base or not any(inside(d, e) for e in found)]
    return len(words), sorted(kept, key=lambda d: (d[1], d[0]))


def test_hundreds_of_rules_with_gates_that_hold():
    rng = random.Random(1)
    assert len(RULES) >= 300 and RULES[-len(BASE) :] == BASE
    for i, rule in enumerate(RULES):
        assert rule.keywords and "," not in rule.label
        for _ in range(4):
            text = example(rule.pattern, rng)
            assert rule.compiled().search(f" {text} "), (rule, text)
            assert i in SCANNER.wanted(text), (rule, text)


def texts():
    rng = random.Random(2)
    rules = [r.pattern for r in RULES]
    for _ in range(250):
        parts = [example(rng.choice(rules), rng) if rng.random() < 0.6 else rng.choice(["some", "é word", "GNU", "license", "cc", "by", "mit", "😀"]) for _ in range(rng.randint(0, 8))]
        words = " ".join(parts).split(" ")
        yield "".join(w.upper() * (rng.random() < 0.1) or w for w in words[:1]) + "".join(rng.choice(SEPARATORS) + (w.upper() if rng.random() < 0.1 else w) for w in words[1:])


@pytest.fixture(scope="module")
def rows():
    found = list(enumerate(texts()))
    found += [(900, None), (901, ""), (None, "MIT License"), (None, None), (902, "x " * 40_000 + "cc by " * 2000 + "gnu gpl"), (903, "CC-BY CC-BY")]
    return found + [(904, "Apache License, Version 2.0")] * 3 + [(905, "İ mitK license mit license")]


def test_against_a_plain_scan(spark, rows):
    docs = spark.createDataFrame([(*r, "n", "s", "b") for r in rows], "doc_id long, text string, n_words string, start string, base string")
    got = license_scan.find_licenses(docs).collect()
    want = []
    for doc, text in rows:
        n, found = plain_scan(text)
        want.append((doc, n, [(RULES[i].label, a, b, RULES[i].base) for i, a, b in found]))
    assert sorted(repr((r.doc_id, r.n_words, [(d.label, d.start, d.stop, d.base) for d in r.detections])) for r in got) == sorted(map(repr, want))
    assert sum(len(f) for *_, f in want) > 500


def test_registered_columns(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_license_scan(spark, str(tmp_path)).drop("n_detections").collect()
    want = []
    for doc, text in rows:
        words = re.findall(license_scan.WORD, lowered(text or ""))
        starts, labels = [], set()
        for rule in BASE:
            phrase = rule.pattern.split(" ")
            here = [i for i in range(len(words) - len(phrase) + 1) if words[i : i + len(phrase)] == phrase]
            starts += here
            labels |= {rule.label} if here else set()
        found = [RULES[i] for i, *_ in plain_scan(text)[1]]
        want.append((doc, len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
                     ",".join(sorted({r.label for r in found})), max((r.weight for r in found), default=0.0)))
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))


@pytest.mark.parametrize(
    "text, labels",
    [
        ("SPDX-License-Identifier: GPL-3.0-or-later", ["gpl-3.0-or-later"]),
        ("GNU General Public License, version 2", ["gpl-2.0", "gpl"]),
        ("GNU Lesser General Public License v2.1", ["lgpl-2.1"]),
        ("Creative Commons Attribution-ShareAlike 4.0", ["cc-by-sa-4.0"]),
        ("CC BY-NC", ["cc-by-nc", "cc-by"]),
        ("https://opensource.org/licenses/MIT", ["mit"]),
        ("All rights reserved.", ["all-rights-reserved"]),
        ("a permit of the limit license", []),
    ],
)
def test_labels(text, labels):
    assert [d["label"] for d in SCANNER.scan(lowered(text))] == labels


def test_containment_against_all_pairs():
    rng = random.Random(5)
    for _ in range(400):
        found = {(rng.randrange(4), a, a + rng.randint(1, 6)) for a in (rng.randrange(12) for _ in range(rng.randint(0, 12)))}
        want = [d for d in found if not any(e != d and e[0] <= d[0] and e[1] <= d[1] and d[2] <= e[2] for e in found)]
        assert license_scan.uncontained(found) == sorted(want, key=lambda d: (d[1], d[0]))


def test_no_rows(spark):
    assert license_scan.find_licenses(messy.empty(spark)).count() == 0
