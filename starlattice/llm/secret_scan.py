"""Secret scans: trigram queries derived from regular expressions, an inverted index, verification."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import product
from re import _constants as ops
from re import _parser as parser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlattice.llm.common import stored

# Up to this many candidate documents are broadcast: three longs each, at most about 50 MB.
BROADCAST_CANDIDATES = 500_000
# Alternatives of a literal that are followed before the query is cut into parts.
_MOST = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its regular expression, and the least length of a group (0: the match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# The three base kinds.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge_token", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)


# A trigram query is a frozenset of alternatives, each a frozenset of trigrams that all occur;
# a query with an empty alternative holds for every text.
Query = frozenset
ALWAYS: Query = frozenset([frozenset()])


def _both(a: Query, b: Query) -> Query:
    return _least(x | y for x, y in product(a, b))


def _least(alternatives) -> Query:
    found = set(alternatives)
    kept = frozenset(x for x in found if not any(y < x for y in found))
    return kept if len(kept) <= _MOST else ALWAYS


def _trigrams(strings) -> Query:
    return _least(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


@dataclass(frozen=True)
class _Part:
    """What a part of an expression matches: all its strings if they are few, else their ends and a query."""

    exact: frozenset | None
    starts: frozenset
    ends: frozenset
    query: Query

    def needs(self) -> Query:
        return _trigrams(self.exact) if self.exact is not None else self.query


_EMPTY = _Part(frozenset([""]), frozenset([""]), frozenset([""]), ALWAYS)
_ANYTHING = _Part(None, frozenset([""]), frozenset([""]), ALWAYS)


def _exact(strings) -> _Part:
    strings = frozenset(strings)
    if not strings or len(strings) > _MOST:
        return _ANYTHING
    return _Part(strings, frozenset(s[:2] for s in strings), frozenset(s[-2:] for s in strings), ALWAYS)


def _follow(a: _Part, b: _Part) -> _Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= _MOST:
        return _exact(x + y for x, y in product(a.exact, b.exact))
    # Only the two characters on each side can join in new trigrams.
    across = _trigrams(x + y for x, y in product(a.ends, b.starts))
    query = _both(_both(a.needs(), b.needs()), across)
    starts = a.starts if a.exact is None else frozenset((x + y)[:2] for x, y in product(a.exact, b.starts))
    ends = b.ends if b.exact is None else frozenset((x + y)[-2:] for x, y in product(a.ends, b.exact))
    small = lambda found: found if len(found) <= _MOST else frozenset([""])
    return _Part(None, small(starts), small(ends), query)


def _either(parts: list[_Part]) -> _Part:
    if all(p.exact is not None for p in parts):
        return _exact(frozenset().union(*(p.exact for p in parts)))
    ends = lambda side: frozenset().union(*(getattr(p, side) for p in parts))
    return _Part(None, ends("starts"), ends("ends"), _least(x for p in parts for x in p.needs()))


def _part(tokens) -> _Part:
    whole = _EMPTY
    for op, value in tokens:
        # Only ASCII letters have the same lower case everywhere; other literals ask for nothing.
        if op is ops.LITERAL and value < 128:
            part = _exact([chr(value).lower()])
        elif op is ops.IN and len(value) <= 8 and all(o is ops.LITERAL and v < 128 for o, v in value):
            part = _exact(chr(v).lower() for _, v in value)
        elif op is ops.SUBPATTERN:
            part = _part(value[-1])
        elif op is ops.BRANCH:
            part = _either([_part(branch) for branch in value[1]])
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT, ops.POSSESSIVE_REPEAT):
            least, most, inner = value[0], value[1], _part(value[2])
            if least == 0:
                part = _either([_EMPTY, inner]) if most == 1 else _ANYTHING
            else:
                part = inner
                for _ in range(min(least, 4) - 1):
                    part = _follow(part, inner)
                if most != least or least > 4:
                    part = _follow(_follow(part, _ANYTHING), _Part(None, frozenset([""]), inner.ends, ALWAYS))
        elif op is ops.AT:
            continue
        else:
            part = _ANYTHING
        whole = _follow(whole, part)
    return whole


def trigram_query(pattern: str) -> Query:
    """Alternatives of lower-case trigrams of which one must wholly occur in the lower-case text of any match."""
    return _part(parser.parse(pattern)).needs()


KEY = ("doc_id", "text_hash")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text_hash", F.xxhash64(F.lit("secrets"), "text"))


def build_index(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """Postings (trigram, doc_id, text_hash) of the given trigrams in the lower-case texts."""
    text = F.lower("text")
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in sorted(trigrams)]))
    return (
        _keyed(docs.select("doc_id", "text", text.alias("low")))
        .select(*KEY, F.explode(found).alias("trigram"))
        .distinct()
    )


def candidates(index: DataFrame, queries: dict[int, Query]) -> DataFrame:
    """Documents (doc_id, text_hash, rules): bit i is set if the document's postings satisfy query i."""
    rows = [
        (1 << rule, place, len(grams), gram)
        for rule, query in queries.items()
        for place, grams in enumerate(sorted(map(sorted, query)))
        for gram in grams
    ]
    wanted = F.broadcast(index.sparkSession.createDataFrame(rows, "rule long, alternative int, needed long, trigram string"))
    return (
        index.join(wanted, "trigram")
        .groupBy(*KEY, "rule", "alternative", "needed")
        .count()
        .where(F.col("count") == F.col("needed"))
        .groupBy(*KEY)
        .agg(F.bit_or("rule").alias("rules"))
    )


def _scanner(rules: Sequence[Rule], always: int):
    patterns = [(i, r.kind, r.compiled(), r.group, r.least) for i, r in enumerate(rules)]

    def spans(text: str | None, wanted: int) -> list[tuple[int, int, int, str]]:
        found = []
        for i, kind, pattern, group, least in patterns:
            if text and (wanted | always) >> i & 1:
                found += [(m.start(), i, m.end(), kind) for m in pattern.finditer(text) if len(m[group]) >= least]
        return sorted(found)

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def scan(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, wanted in batches:
            yield pd.Series(
                [[{"kind": k, "start": s, "end": e} for s, _, e, k in spans(t, int(w))] for t, w in zip(texts, wanted)]
            )

    return scan


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = BASE_RULES + MORE_RULES) -> DataFrame:
    """Finds secrets in every whole text of docs (doc_id, text).

    Returns doc_id and spans: kind, start and end (code points, end exclusive),
    sorted by start and then by the order of rules; for each kind the leftmost matches
    that do not overlap, without those whose group is too short. Rules with mandatory
    trigrams are verified only in the candidates of the index; the others scan all
    texts. Null and empty texts have no spans; equal rows have equal results, one for
    each row, also where doc_id is null. Other columns are not read. No rows: no rows.
    """
    if len(rules) > 62:
        raise ValueError("at most 62 rules are scanned at once")
    queries = {i: trigram_query(r.pattern) for i, r in enumerate(rules)}
    always = sum(1 << i for i, q in queries.items() if frozenset() in q)
    queries = {i: q for i, q in queries.items() if frozenset() not in q}
    docs = docs.select("doc_id", "text")
    wanted: Column = F.lit(0).cast("long")
    rows = _keyed(docs)
    if queries:
        grams = {gram for q in queries.values() for alternative in q for gram in alternative}
        found = stored(candidates(build_index(docs, sorted(grams)), queries), "secret-candidates")
        found = found.select(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"), "rules")
        small = found.count() <= BROADCAST_CANDIDATES
        same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash"))
        rows = rows.join(F.broadcast(found) if small else found, same, "left")
        wanted = F.coalesce("rules", wanted)
    return rows.select("doc_id", _scanner(rules, always)("text", wanted).alias("spans"))
