"""URL rules against a plain matcher."""

import random

import pytest

from starlattice.llm import url_filter

SCHEMA = "host string, path string, verdict string"


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    end = next((i for i, c in enumerate(path) if c in "?#"), len(path))
    path = path[:end]
    fits = [(len(h + p), len(h), v == "block", h + p) for h, p, v in rules
            if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], "block" if best and best[2] else "allow"


@pytest.mark.parametrize("limit", [url_filter.BROADCAST_RULES, 0])
def test_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", limit)
    rng = random.Random(2)
    part = lambda: rng.choice(["a", "b", "org", "B", ""])
    urls = [None, "", "no scheme/x", "://", "http://", "HTTP://Org/", "x://org?/a", "x://ORG#/", "a://b://c/d", "http://é.org/ü", "http://org/" + "p" * 5000]
    urls += ["s://" + ".".join(part() for _ in range(rng.randint(1, 4))) + "/" + "/".join(part() for _ in range(rng.randint(0, 3))) + rng.choice(["", "?q=/a", "#/b"]) for _ in range(300)]
    urls += ["http://a.org/a/b"] * 200
    rules = [("org", "/", "allow"), ("a.org", "/a", "block"), ("b.org", "/a/b", "allow"), ("a.org", "/a", "allow"), ("b", "", "block"), (None, "/", "block"), ("a", None, "block"), ("c", "/", None)]
    pages = spark.createDataFrame([(i % 250, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    got = sorted(map(repr, (tuple(r) for r in url_filter.judge(pages, spark.createDataFrame(rules, SCHEMA)).collect())))
    known = [r for r in rules if r[2]]
    assert got == sorted(repr((i % 250, *brute(u, known))) for i, u in enumerate(urls))


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a/b"), (None, None)], "page_id long, url string")
    none = spark.createDataFrame([], SCHEMA)
    assert [r.verdict for r in url_filter.judge(pages, none, default="block").collect()] == ["block", "block"]
    assert url_filter.judge(pages.limit(0), none).count() == 0
