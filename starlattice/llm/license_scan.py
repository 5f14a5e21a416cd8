"""License scans: ordered signature rules, gated by keywords, without detections that stronger ones contain."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlattice.llm.common import ascii_lower
from starlattice.llm.license_rules import RULES, Rule

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words before A to Z are lower-cased.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# rule, start, stop: words of the text, stop exclusive.
Detection = tuple[int, int, int]


def uncontained(found: Iterable[Detection]) -> list[Detection]:
    """The detections that lie in no detection of an earlier rule, nor in a longer one of their own.

    Kept intervals of which none contains another have ascending starts and ends, so
    one look at the last that starts no later tells whether a new one is contained.
    """
    kept: list[Detection] = []
    starts: list[int] = []
    stops: list[int] = []
    for rule, start, stop in sorted(found, key=lambda d: (d[0], d[1], -d[2])):
        at = bisect_right(starts, start) - 1
        if at >= 0 and stops[at] >= stop:
            continue
        kept.append((rule, start, stop))
        # Intervals that the new one contains can contain nothing that it doesn't.
        first, last = bisect_left(starts, start), bisect_right(stops, stop)
        starts[first:last], stops[first:last] = [start], [stop]
    return sorted(kept, key=lambda d: (d[1], d[0]))


class Scanner:
    """The rules behind one automaton of all their keywords."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = rules
        self.patterns: dict[int, re.Pattern] = {}
        words = sorted({w for r in rules for group in r.keywords for w in group})
        numbers = {w: i for i, w in enumerate(words)}
        self.gates = [[frozenset(numbers[w] for w in group) for group in r.keywords] for r in rules]
        self.automaton = ahocorasick.Automaton()
        for word, number in numbers.items():
            self.automaton.add_word(word, number)
        self.automaton.make_automaton()
        self.word = re.compile(WORD)

    def wanted(self, low: str) -> list[int]:
        """The rules whose keywords are all in the text."""
        seen = {number for _, number in self.automaton.iter(low)}
        return [i for i, gate in enumerate(self.gates) if all(not seen.isdisjoint(g) for g in gate)] if seen else []

    def detect(self, low: str | None, *, gated: bool = True) -> list[Detection]:
        """All detections in a text with A to Z in lower case, contained ones too."""
        wanted = (self.wanted(low) if gated else range(len(self.rules))) if low else []
        if not wanted:
            return []
        words = self.word.findall(low)
        spaced = f" {' '.join(words)} "
        places = list(accumulate((len(w) + 1 for w in words), initial=1))
        found = []
        for i in wanted:
            pattern = self.patterns.get(i) or self.patterns.setdefault(i, self.rules[i].compiled())
            for match in pattern.finditer(spaced):
                found.append((i, bisect_left(places, match.start()), bisect_left(places, match.end())))
        return found

    def scan(self, low: str | None) -> list[dict]:
        """Base detections, and the others that no stronger detection contains."""
        found = self.detect(low)
        base = [d for d in found if self.rules[d[0]].base]
        kept = base + [d for d in uncontained(found) if not self.rules[d[0]].base]
        return [
            {"label": self.rules[i].label, "start": a, "stop": b, "weight": self.rules[i].weight, "base": self.rules[i].base}
            for i, a, b in sorted(kept, key=lambda d: (d[1], d[0]))
        ]


def find_licenses(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """License detections in every whole text of docs (doc_id, text).

    Returns doc_id, n_words and detections: label, start and stop (words of the text, from
    0, stop exclusive), weight, base; sorted by start and then by the order of rules. Words
    are runs of digits, letters a to z of either case and characters beyond ASCII; what
    stands between words does not matter. A rule is tried only in texts that hold its
    keywords. A detection within one of an earlier rule is left out, except for those of
    base rules, which all stay. Null and empty texts have no words and no
    detections; equal rows have equal results, one for each row, also where doc_id is
    null. Other columns are not read. No rows: no rows.
    """
    rules = tuple(rules)

    @F.pandas_udf("array<struct<label:string,start:long,stop:long,weight:double,base:boolean>>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(rules)
        for texts in batches:
            yield pd.Series([scanner.scan(t) for t in texts])

    n_words = F.coalesce(F.regexp_count("text", F.lit(ANY_CASE_WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", n_words.alias("n_words"), scan(ascii_lower(F.col("text"))).alias("detections"))
