"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlattice.llm.common import count_words, stored

WEIGHTS = (5, 2, 1)
# Rows of one source that are summed together.
BUCKET_ROWS = 4096
EPOCHS = 2


def source_targets(sizes: DataFrame, budget: float, most: int = EPOCHS) -> DataFrame:
    """Adds `target` to (source, weight, source_size): shares of the budget by weight, at most `most` sizes.

    What a capped source leaves goes to the others by weight until none is above
    its cap. Works by sums over the sources, a few rounds; no source leaves Spark.
    """
    cap = F.lit(float(most)) * F.col("source_size")
    share = None
    while True:
        full = F.lit(False) if share is None else cap <= F.col("weight") * F.lit(share)
        spent, weight, left = sizes.agg(
            F.sum(F.when(full, F.col("source_size") * most).otherwise(0)),
            F.sum(F.when(~full, F.col("weight")).otherwise(0)),
            F.sum(F.when(~full, 1).otherwise(0)),
        ).first()
        if not left:
            return sizes.withColumn("target", cap)
        found = (budget - float(spent)) / float(weight)
        if share is not None and found <= share:
            return sizes.withColumn("target", F.least(cap, F.col("weight") * F.lit(share)))
        share = found


def ranked_sources(sizes: DataFrame, weights: Sequence[int]) -> DataFrame:
    """Adds `weight`: the weights in turn, sources by code point, null last.

    The sources are few beside the documents, but may not fit one task: each range
    of the sorted sources is numbered by itself, after the ranges before it.
    """
    ranged = stored(
        sizes.repartitionByRange(F.col("source").isNull(), "source").withColumn("part", F.spark_partition_id()), "sources"
    )
    counts = {r["part"]: r["count"] for r in ranged.groupBy("part").count().collect()}
    parts = sorted(counts)
    starts = [(p, sum(counts[q] for q in parts if q < p)) for p in parts]
    before = F.broadcast(sizes.sparkSession.createDataFrame(starts, "part int, start long"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(
        F.array(*[F.lit(int(w)) for w in weights]), ((F.col("start") + inside - 1) % len(weights) + 1).cast("int")
    )
    return ranged.join(before, "part").withColumn("weight", weight).drop("part", "start")


def _queued(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds to each row its source's weight, size and target, and its bucket of the shuffled source.

    Buckets are ranges of the digest `turn`. They are summed first, so a source of
    any share of the rows is never one group.
    """
    known = sizes.select(
        F.col("source").alias("known_source"), "weight", "source_size", "target",
        F.ceil(F.col("source_rows") / BUCKET_ROWS).alias("buckets"),
    )
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("known_source"))).drop("known_source")
    place = F.conv(F.substring("turn", 1, 8), 16, 10).cast("long")
    return rows.withColumn("bucket", F.floor(place * F.col("buckets") / F.lit(1 << 32)).cast("long"))


def mix(
    docs: DataFrame,
    *,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    seed: int = 0,
    keep: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Takes documents (doc_id, text, source) until the budget, `share` of all words, is spent.

    Rows of a source are shuffled by a digest of seed, id and text. Every document
    stands twice in the queue of its source, once for each epoch, at the virtual time at which it ends: words of its source so far, divided by the
    weight. All queues are sorted by that time and cut where the budget is spent.
    A source that is used up twice over leaves its share to the others.

    Returns two frames. The first has each row's columns (those named by `keep`, else
    all) in a struct `doc`, and size
    (words; null text: 0), source_size, target and epochs (0 to 2: how often the mix
    takes it). The second has doc, epoch and the virtual time `finish` for every
    copy taken, to be sorted by finish, turn, epoch. The order of sources is by code
    point, null last; rows of equal id and text are equal. Documents without words
    cost nothing and are taken if their time comes before the cut. No rows: no rows.
    """
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "text")]
    rows = docs.select(
        F.struct(*(keep or ["*"])).alias("doc"),
        "source",
        count_words(F.col("text")).alias("size"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), *names)).alias("turn"),
    )
    sums = stored(
        rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows")),
        "source-sizes",
    )
    total = sums.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    budget = share * total
    sizes = stored(source_targets(ranked_sources(sums, weights), budget), "source-targets")
    rows = _queued(rows, sizes)
    bucket_sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    offsets = stored(
        bucket_sums.withColumn(
            "before", F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket")) - F.col("bucket_size")
        ).select(F.col("source").alias("offset_source"), F.col("bucket").alias("offset_bucket"), "before"),
        "source-offsets",
    )
    inside = F.sum("size").over(
        Window.partitionBy("source", "bucket").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    timed = (
        rows.withColumn("inside", inside)
        .join(offsets, F.col("source").eqNullSafe(F.col("offset_source")) & (F.col("bucket") == F.col("offset_bucket")))
        .withColumn("ends", F.col("before") + F.col("inside"))
    )
    finish = (F.col("ends") + F.col("epoch") * F.col("source_size")) / F.col("weight")
    narrow = (
        timed.where("size > 0")
        .select("turn", "size", "ends", "source_size", "weight", F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1))).alias("epoch"))
        .select(finish.alias("finish"), "turn", "epoch", "size")
    )
    cut = _cut(narrow, budget)
    at = F.struct(F.col("finish"), F.col("turn"), F.col("epoch"))
    last = F.struct(F.lit(cut[0]).cast("double").alias("finish"), F.lit(cut[1]).alias("turn"), F.lit(cut[2]).cast("int").alias("epoch"))
    taken = [F.struct(((F.col("ends") + e * F.col("source_size")) / F.col("weight")).alias("finish"), F.col("turn"), F.lit(e).alias("epoch")) for e in range(EPOCHS)]
    epochs = sum((F.when(t <= last, 1).otherwise(0) for t in taken), F.lit(0))
    whole = timed.select("doc", "size", "source_size", "target", epochs.alias("epochs"))
    copies = (
        timed.select("doc", "turn", "ends", "source_size", "weight", F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1))).alias("epoch"))
        .withColumn("finish", finish)
        .where(at <= last)
        .select("doc", "epoch", "finish", "turn")
    )
    return whole, copies


def _cut(copies: DataFrame, budget: float) -> tuple[float, str, int]:
    """The last copy (finish, turn, epoch) of the globally sorted queue that the budget pays for."""
    ranged = stored(
        copies.repartitionByRange("finish", "turn", "epoch").withColumn("part", F.spark_partition_id()), "queue"
    )
    sums = {r["part"]: r["words"] for r in ranged.groupBy("part").agg(F.sum("size").alias("words")).collect()}
    spent, place = 0, ("finish", "turn", "epoch")
    for part in sorted(sums):
        if spent + sums[part] > budget:
            running = F.lit(spent) + F.sum("size").over(Window.partitionBy("part").orderBy(*place))
            paid = ranged.where(F.col("part") == part).withColumn("running", running).where(F.col("running") <= F.lit(budget))
            return _last(paid) or _last(ranged.where(F.col("part") < part)) or (float("-inf"), "", 0)
        spent += sums[part]
    return float("inf"), "", 0


def _last(copies: DataFrame) -> tuple[float, str, int] | None:
    row = copies.agg(F.max(F.struct("finish", "turn", "epoch")).alias("last")).first()["last"]
    return tuple(row) if row else None
