"""Language identification: held-out accuracy, rejection, odd rows."""

import random

import messy
import numpy as np
import pandas as pd

import __spark_entry__ as registered
from conftest import SF_DIR
from starlattice.llm import language_id


def test_held_out_accuracy_on_the_given_documents(spark):
    import zlib

    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet").collect()}
    got = registered.queries()["op10_language_id"](spark, SF_DIR.replace("0.001", "0.01")).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    right = [r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out]
    assert np.mean(right) > 0.97
    assert np.mean([r.rejected for r in got]) < 0.02
    assert all(0 <= r.score <= 1 for r in got)


def test_held_out_rows_are_not_learned_from(spark):
    docs = messy.documents(spark)
    changed = docs.withColumn("lang", language_id.F.when(language_id.held_out(), "wrong").otherwise(docs.lang))
    assert language_id.sample(docs).equals(language_id.sample(changed))
    assert "wrong" not in set(language_id.sample(changed)["lang"])


def test_odd_rows(spark):
    docs = messy.documents(spark)
    model = language_id.train(language_id.sample(docs))
    found = language_id.identify(docs.withColumnRenamed("language", "label"), model)
    got = {r.doc_id: r.language for r in found.collect()}
    for doc_id in (300, 301, 302, 305):
        assert tuple(got[doc_id]) == ("und", 0.0, True)
    assert got[304].lang_pred == "en"
    assert found.count() == docs.count()
    assert language_id.identify(messy.empty(spark), model).count() == 0


def test_without_labels(spark):
    model = language_id.train(language_id.sample(messy.empty(spark)))
    assert model.predict("some text") == ("und", 0.0, True)


def test_the_whole_text_counts():
    rng = random.Random(1)
    rows = pd.DataFrame({"lang": ["en", "fr"] * 100, "text": [messy.prose(rng, l, 60) for l in ["en", "fr"] * 100], "calibrates": [i % 5 == 0 for i in range(200)]})
    model = language_id.train(rows)
    late = messy.prose(rng, "en", 30) + " " + messy.prose(rng, "fr", 400_000)
    assert len(late) > language_id._CHUNK and model.predict(late)[0] == "fr"
    strange = model.predict("жщ ъыь эюя " * 5)
    assert strange[2] or strange[1] < 0.7


def test_languages_that_were_not_learned_are_rejected(spark):
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.train(language_id.sample(docs.where("lang <> 'es'")))
    rows = docs.where(language_id.held_out()).collect()
    rejected = lambda own: np.mean([model.predict(r.text)[2] for r in rows if (r.lang == "es") == own])
    assert rejected(True) > 0.9
    assert rejected(False) < 0.02
    for text in (
        "Wczoraj wieczorem poszliśmy z przyjaciółmi nad rzekę, żeby zobaczyć zachód słońca i porozmawiać o wakacjach.",
        "Eilen illalla menimme ystävien kanssa joen rannalle katsomaan auringonlaskua ja puhumaan tulevasta lomasta.",
        "Jana jioni tulikwenda na marafiki zetu kando ya mto kutazama machweo ya jua na kuzungumza kuhusu likizo.",
    ):
        assert model.predict(text)[2]


def test_calibration_loses_no_more_than_it_says_and_ignores_texts_without_letters():
    rng = random.Random(2)
    langs = ["en", "fr"] * 150
    rows = pd.DataFrame({"lang": langs, "text": [messy.prose(rng, l, 40) for l in langs], "calibrates": [i % 5 < 2 for i in range(300)]})
    model = language_id.train(rows)
    # Equal texts have equal scores, none of which is below the quantile.
    assert not any(model.predict(t)[2] for t in rows[rows.calibrates]["text"])
    bare = pd.DataFrame({"lang": ["en"] * 40, "text": ["12 34 ... !!"] * 40, "calibrates": [True] * 40})
    more = language_id.train(pd.concat([rows, bare], ignore_index=True))
    assert more.threshold > 0.6 and more.least_seen > 0.6
