"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix."""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlattice.llm.common import stored

# Rows that one target block gets; a shard is as many blocks as it needs.
BLOCK_ROWS = 32768
# numpy draws hypergeometric numbers for populations below this.
_DIRECT = 1_000_000_000


def block_sizes(rows: int, shards: int, block_rows: int = BLOCK_ROWS) -> tuple[np.ndarray, int]:
    """Rows of each block, shard by shard, and blocks per shard; shards and blocks differ by one row at most."""
    blocks = max(1, -(-rows // (shards * block_rows)))
    shard = rows // shards + (np.arange(shards) < rows % shards)
    inner = np.arange(blocks)
    return (shard[:, None] // blocks + (inner < (shard % blocks)[:, None])).reshape(-1).astype(np.int64), blocks


def _draw(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """One hypergeometric number; large populations by rejection from a binomial."""
    total = good + bad
    if sample == 0 or good == 0:
        return 0
    if bad == 0 or sample == total:
        return min(good, sample)
    if total < _DIRECT:
        return int(rng.hypergeometric(good, bad, sample))
    if bad < good:
        return sample - _draw(rng, bad, good, sample)
    # X ~ B(good, p) given Y ~ B(bad, p) and X + Y = sample: accept by the weight of Y.
    p = sample / total
    weight = lambda y: lgamma(bad + 1) - lgamma(y + 1) - lgamma(bad - y + 1) + y * log(p) + (bad - y) * log(1 - p)
    most = weight(min(bad, int((bad + 1) * p)))
    while True:
        x = int(rng.binomial(good, p))
        if 0 <= sample - x <= bad and rng.random() < np.exp(min(0.0, weight(sample - x) - most)):
            return x


def _split(rng: np.random.Generator, columns: np.ndarray, sample: int) -> np.ndarray:
    """How many of `sample` rows fall to each column: a multivariate hypergeometric draw."""
    if columns.sum() < _DIRECT:
        return rng.multivariate_hypergeometric(columns, sample, method="marginals")
    drawn, rest = np.zeros_like(columns), int(columns.sum())
    for i, size in enumerate(columns.tolist()):
        rest -= size
        drawn[i] = _draw(rng, size, rest, sample)
        sample -= int(drawn[i])
    return drawn


def matrix_row(before: np.ndarray, partition: int, sizes: np.ndarray, seed: int) -> np.ndarray:
    """Rows that one partition sends to each block.

    `before` holds the running total of partition sizes, from 0. The matrix is
    halved along a binary tree of partitions whose nodes draw from own seeds, so
    any task finds its own row alone and all rows fit together.
    """
    low, high, columns = 0, len(before) - 1, sizes
    while high - low > 1:
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        left = _split(rng, columns, int(before[middle] - before[low]))
        if partition < middle:
            high, columns = middle, left
        else:
            low, columns = middle, columns - left
    return columns


def shuffle_into_shards(
    docs: DataFrame, shards: int, *, seed: int = 0, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Deals the rows into shards 0 to `shards` - 1, uniformly at random, with sizes at most one apart.

    Each partition permutes its rows and cuts them by its row of the matrix; after
    the exchange each block is permuted again. Adds `shard` int and `slot` long
    (0, 1, ... in each shard); these names are replaced if the input has them, all other
    columns stay as they are. Nulls, empty texts, ties and repeated rows are rows
    like any other. No rows: no rows. A seed gives the same result again for the
    same partitions. Rows are stored with their partition and place first: files are
    cut by the cores alive when a job is planned, so a later job may read other partitions.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    docs = stored(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.monotonically_increasing_id().alias("id")
        ),
        "shards",
    )
    counts = {r["p"]: r["n"] for r in docs.groupBy(F.shiftright("id", 33).alias("p")).agg(F.count("*").alias("n")).collect()}
    rows = sum(counts.values())
    before = np.concatenate([[0], np.cumsum([counts.get(p, 0) for p in range(max(counts, default=-1) + 1)])])
    sizes, blocks = block_sizes(rows, shards, block_rows)
    held = spark.sparkContext.broadcast((before, sizes))

    @F.pandas_udf("long")
    def block_of(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        before, sizes = held.value
        partition, order, ends = -1, None, None
        for batch in ids:
            if not len(batch):
                yield batch
                continue
            values, found = batch.to_numpy(), []
            # A task may read several stored partitions, or a part of one.
            for own in np.split(values, np.flatnonzero(np.diff(values >> 33)) + 1):
                if partition != own[0] >> 33:
                    partition = int(own[0] >> 33)
                    order = np.random.default_rng([seed, 1, partition]).permutation(int(before[partition + 1] - before[partition]))
                    ends = np.cumsum(matrix_row(before, partition, sizes, seed))
                found.append(np.searchsorted(ends, order[own & ((1 << 33) - 1)], side="right"))
            yield pd.Series(np.concatenate(found).astype(np.int64))

    dealt = docs.withColumn("block", block_of("id")).withColumn("turn", F.xxhash64(F.lit(seed), "id"))
    shard = F.floor(F.col("block") / blocks).cast("long")
    # Where a block starts in its shard follows from the sizes alone.
    size, inner = F.lit(rows // shards) + (shard < rows % shards).cast("long"), F.col("block") % blocks
    start = inner * F.floor(size / blocks) + F.least(inner, size % blocks)
    place = F.row_number().over(Window.partitionBy("block").orderBy("turn", "id"))
    return dealt.select(
        "row.*", shard.cast("int").alias("shard"), (start + place - 1).cast("long").alias("slot")
    )
