"""Sharding: exact sizes, gapless slots, all rows, and that the shuffle is uniform."""

import zlib
from collections import Counter

import messy
import numpy as np
import pytest

from starlattice.llm import sharding


def test_whole_rows_sizes_and_slots(spark):
    docs = messy.documents(spark).repartition(5)
    dealt = sharding.shuffle_into_shards(docs, 7, block_rows=5)
    assert dealt.columns == [c for c in docs.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    rows = dealt.collect()
    assert Counter((r.doc_id, r.text, r.source) for r in rows) == Counter((r.doc_id, r.text, r.source) for r in docs.collect())
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(7))
    for shard, size in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(size))


def test_a_seed_repeats_and_another_differs(spark):
    docs = spark.range(300).withColumnRenamed("id", "doc_id").repartition(3)
    deal = lambda seed: sorted(map(tuple, sharding.shuffle_into_shards(docs, 4, seed=seed).collect()))
    assert deal(1) == deal(1) != deal(2)


@pytest.mark.parametrize("counted, dealt", [(1, 64), (64, 1)])
def test_other_cores_between_counting_and_dealing(spark, tmp_path, counted, dealt):
    """Spark cuts files by the cores alive, or by this setting; the deal must not depend on it."""
    spark.range(400).withColumnRenamed("id", "doc_id").repartition(9).write.parquet(str(tmp_path / "docs"))
    setting = "spark.sql.files.minPartitionNum"
    costs = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set(setting, counted)
        docs = spark.read.parquet(str(tmp_path / "docs"))
        cut = docs.rdd.getNumPartitions()
        found = sharding.shuffle_into_shards(docs, 7, block_rows=10)
        spark.conf.set(setting, dealt)
        assert spark.read.parquet(str(tmp_path / "docs")).rdd.getNumPartitions() != cut
        rows = found.collect()
    finally:
        spark.conf.unset(setting)
        spark.conf.set("spark.sql.files.openCostInBytes", costs)
    assert sorted(r.doc_id for r in rows) == list(range(400))
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(7))
    for shard, size in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(size))


def test_empty_and_fewer_rows_than_shards(spark):
    assert sharding.shuffle_into_shards(messy.empty(spark), 16).count() == 0
    assert sharding.shuffle_into_shards(spark.range(3), 16).where("slot = 0").count() == 3


def test_every_place_is_as_likely(spark):
    docs = spark.range(24).repartition(3)
    counts = np.zeros((24, 4))
    for seed in range(60):
        for r in sharding.shuffle_into_shards(docs, 4, seed=seed, block_rows=3).collect():
            counts[r.id, r.shard] += 1
    # 72 degrees of freedom: the 0.9999 quantile is 123.
    assert ((counts - 15) ** 2 / 15).sum() < 123


@pytest.mark.parametrize("partitions", [1, 2, 5, 8])
def test_matrix_rows_fit_together(partitions):
    sizes, _ = sharding.block_sizes(1003, 4, 100)
    before = np.concatenate([[0], np.cumsum(np.random.default_rng(1).multinomial(1003, [1 / partitions] * partitions))])
    rows = [sharding.matrix_row(before, p, sizes, 9) for p in range(partitions)]
    assert (np.sum(rows, 0) == sizes).all()
    assert [r.sum() for r in rows] == np.diff(before).tolist()


def test_large_draws_have_the_right_mean_and_spread():
    rng, good, bad, sample = np.random.default_rng(4), 3 * 10**9, 10**10, 10**6
    drawn = np.array([sharding._draw(rng, good, bad, sample) for _ in range(400)])
    p = good / (good + bad)
    assert abs(drawn.mean() - sample * p) < 5 * np.sqrt(sample * p * (1 - p) / 400)
    assert 0.8 < drawn.std() / np.sqrt(sample * p * (1 - p)) < 1.2
    assert sharding._split(rng, np.array([4 * 10**9, 0, 2 * 10**9]), 1000).sum() == 1000


def test_registered_query(spark):
    import __spark_entry__ as registered
    from conftest import SF_DIR

    rows = registered.queries()["op1_sharding"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    sizes = Counter(r.shard for r in rows)
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= 1
