"""The pipeline's stages, each on messy rows, and the registered queries against their SQL."""

from collections import Counter

import messy
import pytest

import __spark_entry__ as registered
import checks
import corpus_pipeline
from conftest import SF_DIR
from starlattice.llm import decontaminate, language_id, queries, set_join


@pytest.fixture(scope="module")
def connection():
    return checks.connect(SF_DIR)


@pytest.mark.parametrize("name", list(queries.CHECKS))
def test_query_against_sql(spark, connection, name):
    difference = checks.difference(registered.queries()[name](spark, SF_DIR), connection, queries.CHECKS[name])
    assert difference is None, difference


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert "pipeline" in registered.queries()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs = messy.documents(spark, rows=150).withColumnRenamed("shard", "extra")
    docs.write.parquet(f"{path}/documents.parquet")
    passage = docs.where("doc_id = 5").first().text
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_every_stage_does_its_work(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    key = lambda df: Counter((r.doc_id, r.text, r.source) for r in df.collect())
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_copies", "decontamination", "mixing", "sharding"]
    for name, stage in corpus_pipeline.STAGES:
        before = key(docs)
        out = stage(spark, docs, folder)
        if name != "sharding":
            assert out.columns == docs.columns
        after = key(out)
        assert set(after) <= set(before)
        if name == "language":
            model = language_id.train(language_id.sample(docs))
            assert after == Counter({k: n for k, n in before.items() if not model.predict(k[1])[2]})
        elif name == "near_copies":
            left = set_join.near_copies(out).where("n_shingles > 0")
            assert left.where("n_links > 0").count() == 0
            groups = {r.component_id for r in set_join.near_copies(docs).where("n_shingles > 0 and component_id is not null").collect()}
            assert {d for d, *_ in after if d is not None} == groups
        elif name == "decontamination":
            items = spark.read.parquet(f"{folder}/benchmark.parquet")
            bad = {r.doc_id for r in decontaminate.contamination(docs, items).where(decontaminate.contaminated()).collect()}
            assert bad and {d for d, *_ in before} - {d for d, *_ in after} == bad
        elif name == "mixing":
            assert max(after.values()) <= 2 * max(before.values())
        else:
            assert after == before and len({r.shard for r in out.collect()}) == 16
        path = f"{folder}/after-{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)


def test_the_whole_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    slots = Counter(r.shard for r in rows)
    assert max(slots.values()) - min(slots.values()) <= 1
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_nothing(spark, folder, name):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, folder).count() == 0
