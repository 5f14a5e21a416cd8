"""Decontamination against a plain search for windows."""

import random
import re

import messy
import pytest

from starlattice.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window):
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            part = w[i : i + window]
            for at in range(len(own) - len(part) + 1):
                if own[at : at + len(part)] == part:
                    hit |= set(range(at, at + len(part)))
                    found.add("" if item is None else str(item))
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("block", [decontaminate.BLOCK_WINDOWS, 7])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choices(["a", "b", "É", "c1"], k=n))
    items = [(i, text(rng.randint(1, 9))) for i in range(12)] + [(3, "only"), (40, "only"), (41, None), (42, "?!"), (None, "b a b a")]
    items += items[:2]
    docs = [(i, text(rng.randint(0, 40))) for i in range(60)] + [(70, None), (71, ""), (None, "x b A b,a x"), (None, "nothing"), (72, "x only-ONLY x")]
    docs += [(73, "a b É c1 " * 3000), (0, docs[0][1]), (0, "another of id 0"), (74, "é É"), (75, "b É")]
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, n_hit string, place int")
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, window string")
    got = decontaminate.contamination(df, bench, 4).collect()
    small = [d for d in docs if d[0] != 73]
    assert sorted(repr((r.doc_id, r.n_words, r.n_hit, r["items"])) for r in got if r.doc_id != 73) == sorted(
        repr((d, *brute(t, items, 4))) for d, t in small
    )
    long = next(r for r in got if r.doc_id == 73)
    assert long.n_words == 12_000 and long.n_hit <= 12_000


def test_the_texts_are_read_once_for_any_number_of_windows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 10)
    # Few bits, so that many places pass which are in no window.
    monkeypatch.setattr(decontaminate, "BITS_A_HASH", 1)
    written, plain = [], decontaminate.stored
    monkeypatch.setattr(decontaminate, "stored", lambda rows, name: written.append(name) or plain(rows, name))
    rng = random.Random(11)
    text = lambda n: " ".join(rng.choices([f"w{i}" for i in range(25)], k=n))
    docs = [(i, text(rng.randint(0, 120))) for i in range(80)] + [(80, text(4000))]
    items = [(i, text(rng.randint(3, 14))) for i in range(60)]
    items += [(100 + i, " ".join(words(docs[i][1])[5:15])) for i in range(20)] + [(200, " ".join(words(docs[80][1])[-9:]))]
    got = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 4
    )
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got.collect()} == {d: brute(t, items, 4) for d, t in docs}
    assert written.count("shingle-places") == 1


def test_items_of_one_text_are_one_text(spark):
    copies = [(i, "Same five words, each time") for i in range(300)] + [(7, "same FIVE words each time"), (7, "five words alone")]
    items = spark.createDataFrame(copies, "item_id long, text string")
    windows, owners, texts = decontaminate.item_windows(items, 4)
    assert (windows.count(), owners.count(), texts.count()) == (3, 3, 2)
    docs = spark.createDataFrame([(1, "the same five words each time"), (2, "five words alone"), (3, "no")], "doc_id long, text string")
    found = {r.doc_id: r["items"] for r in decontaminate.contamination(docs, items, 4).collect()}
    assert found == {1: sorted(str(i) for i in range(300)), 2: ["7"], 3: []}


def test_dropping_keeps_columns_and_clean_rows(spark):
    docs = messy.documents(spark)
    passage = docs.where("doc_id = 1").first().text
    items = spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string")
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    flagged = decontaminate.contamination(docs, items)
    assert gone == {r.doc_id for r in flagged.where(decontaminate.contaminated()).collect()}
    assert {1, 100, 119} <= gone and None not in gone


def test_ids_of_any_type(spark):
    docs = [("a-7", "one two three four"), ("007", "one two three four"), (None, "one two three four"), ("b", "clean text"), ("", None)]
    rows = spark.createDataFrame(docs, "doc_id string, text string")
    items = spark.createDataFrame([(1, "two three four")], "item_id long, text string")
    kept = decontaminate.drop_contaminated(rows, items).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(docs[3:])


def test_empty_tables(spark):
    docs, none = messy.documents(spark, rows=5), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(messy.empty(spark), none).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(docs, none).collect()} == {0}
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contamination(messy.empty(spark), some).count() == 0


def test_no_python_in_the_plan(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = decontaminate.contamination(messy.documents(spark, rows=5), items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
