"""Quality rules: counts against plain Python, adaptive bounds, odd rows."""

import math
import random
import re

import messy

from starlattice.llm import quality_rules
from starlattice.llm.common import stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen, covered = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered |= {p + k for p in places for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts(spark):
    docs = messy.documents(spark)
    more = [(800, "a b c a b c a"), (801, "x x x x"), (802, "# | one\n# | one\n\n# | two\r\n"), (803, "a b a b a"), (804, "p q r s " * 4000)]
    docs = docs.select("doc_id", "text", "lang", "source", "n_words").unionByName(
        spark.createDataFrame([(*r, None, None, "x") for r in more], "doc_id long, text string, lang string, source string, n_words string")
    )
    got = quality_rules.judge(docs).collect()
    count = lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    expected = sorted(repr((r.doc_id, brute(r.text))) for r in docs.collect())
    assert sorted(repr((r.doc_id, count(r))) for r in got) == expected
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_a_source_of_symbols_moves_its_own_bound_only(spark):
    word = lambda i: f"w{i * 7919 % 1000}"
    plain = lambda k: " ".join(word(k + i * i) for i in range(80))
    marked = lambda k: " ".join("#" + word(k + i * i) + ("#" if i % 5 < k % 3 else "") for i in range(80))
    rows = [(i, plain(i), "en", "prose") for i in range(200)] + [(1000 + i, marked(i), "en", "notes") for i in range(200)]
    rows += [(5000, marked(1), "en", "prose")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    assert not kept[5000]
    assert all(kept[i] for i in range(200)) and all(kept[1000 + i] for i in range(200))


def quantile(values, rank):
    return sorted(values)[max(math.ceil(rank * len(values)), 1) - 1]


def test_kept_against_exact_quantiles(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 9)))
    rows = []
    for i in range(1100):
        words = [word() for _ in range(rng.randint(45, 90))]
        if rng.random() < 0.3:
            words[3] += rng.choice("#*|") * rng.randint(1, 6)
        if rng.random() < 0.2:
            words += words[: rng.randint(3, 20)]
        lines = [" ".join(words[k : k + 9]) for k in range(0, len(words), 9)]
        if rng.random() < 0.2:
            lines.insert(2, lines[0])
        rows.append((i, "\n".join(lines), rng.choice(["en", "en", "fr", None]), rng.choice(["a", "a", "b", None, "rare"][: 5 if i % 20 == 0 else 4])))
    schema = "doc_id long, text string, lang string, source string"
    judged = [r.asDict() for r in quality_rules.judge(spark.createDataFrame(rows, schema)).collect()]
    good = [r for r in judged if not r["base_failed"]]
    assert len(good) < quality_rules.SKETCH_ITEMS  # then sketches are exact

    def level(r):
        for same in (lambda o: (o["lang"], o["source"]) == (r["lang"], r["source"]), lambda o: o["lang"] == r["lang"]):
            group = [o for o in good if same(o)]
            if len(group) >= quality_rules.LEAST_DOCUMENTS:
                return group
        return good

    dropped = 0
    for r in judged:
        fits = not r["base_failed"]
        for limit in quality_rules.LIMITS:
            values = [o[limit.name] for o in level(r)]
            q1, q3, rare = (quantile(values, x) for x in quality_rules.RANKS)
            high = max(q3 + quality_rules.REACH * (q3 - q1) if q3 > q1 else rare, limit.least)
            fits &= r[limit.name] <= high and (not limit.both or r[limit.name] >= q1 - quality_rules.REACH * (q3 - q1))
        assert r["kept"] == fits
        dropped += not r["kept"] and not r["base_failed"]
    assert 5 < dropped < 110


def test_a_large_group_stays_within_the_error_of_its_sketch(spark):
    n = 9000
    rows = spark.range(n).selectExpr(
        "id as doc_id",
        "concat(array_join(transform(sequence(1, 60), i -> concat('w', cast(pmod(xxhash64(id, i), 100000) as string))), ' '), ' ', "
        "repeat('# ', cast(pmod(id, 100) as int)))) as text".replace("))))", ")))"),
        "'en' as lang",
        "'s' as source",
    )
    measured = stored(quality_rules.measure(rows), "measures")
    bound = quality_rules.thresholds(measured).first()["high_symbols_per_word"]
    shares = sorted(r[0] for r in measured.where("not base_failed").select("symbols_per_word").collect())
    q1, q3 = (quantile(shares, x) for x in (0.25, 0.75))
    # Each quartile may be off by 1 % of the rows.
    near = [quantile(shares, x) for x in (0.23, 0.27, 0.73, 0.77)]
    assert near[2] + 3 * (near[2] - near[1]) <= bound <= near[3] + 3 * (near[3] - near[0])
    assert q3 > q1


def test_no_rows_and_nothing_good(spark):
    assert quality_rules.judge(messy.empty(spark)).count() == 0
    short = spark.createDataFrame([(1, "a", None, None), (2, None, None, None)], "doc_id long, text string, lang string, source string")
    assert [r.kept for r in quality_rules.judge(short).collect()] == [False, False]
