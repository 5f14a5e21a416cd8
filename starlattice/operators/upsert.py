"""Upserts by primary key, load counts, freshness and table profiles.

Batches are applied as if row by row in the order given by `order_by`: the
first row of an absent key inserts, every further row of that key updates.
Duplicate keys are folded with partial aggregation before any join, so a key
that fills much of a batch is one row when it is shuffled.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _sequence(batch: DataFrame, order_by: Iterable[str]) -> Column:
    """Arrival order of batch rows; ties fall back to the row values, never to chance."""
    order_by = list(order_by)
    return F.struct(*order_by, *[c for c in batch.columns if c not in order_by])


def first_per_key(batch: DataFrame, key: Iterable[str], order_by: Iterable[str] = ()) -> DataFrame:
    """The first row of each key."""
    key = list(key)
    rest = [c for c in batch.columns if c not in key]
    if not rest:
        return batch.distinct()
    first = batch.groupBy(*key).agg(F.min(_sequence(batch, order_by)).alias("row"))
    return first.select(*[F.col(c) if c in key else F.col(f"row.{c}").alias(c) for c in batch.columns])


def _keyed(batch: DataFrame, key: Iterable[str]) -> DataFrame:
    """The batch, failing the load when a primary key value is missing."""
    missing = F.raise_error(F.lit("missing primary key value"))
    return batch.withColumns({k: F.coalesce(F.col(k), missing) for k in key})


def insert_if_absent(
    old: DataFrame, batch: DataFrame, key: Iterable[str], order_by: Iterable[str] = ()
) -> DataFrame:
    """Keep every old row; add the first batch row of each key the table lacks."""
    return old.unionByName(new_rows(old, batch, key, order_by))


def update_named(
    old: DataFrame,
    batch: DataFrame,
    key: Iterable[str],
    named: Iterable[str],
    order_by: Iterable[str] = (),
) -> DataFrame:
    """Insert absent keys; for present ones take only the `named` columns from the batch.

    A key repeated in the batch keeps the other columns of its first row and
    the named columns of its last one.
    """
    key, named = list(key), list(named)
    keyed = _keyed(batch, key)
    sequence = _sequence(keyed, order_by)
    changes = keyed.groupBy(*key).agg(F.min(sequence).alias("first"), F.max(sequence).alias("last"))
    present = old.withColumn("present", F.lit(True))
    merged = present.join(changes, key, "full")
    in_table, in_batch = F.col("present").isNotNull(), F.col("last").isNotNull()

    def value(column: str) -> Column:
        if column in key:
            return F.col(column)
        if column in named:
            return F.when(in_batch, F.col(f"last.{column}")).otherwise(F.col(column)).alias(column)
        return F.when(in_table, F.col(column)).otherwise(F.col(f"first.{column}")).alias(column)

    return merged.select(*[value(c) for c in old.columns])


def add_measures(old: DataFrame, batch: DataFrame, key: Iterable[str], measures: Iterable[str]) -> DataFrame:
    """Additive upsert: measures of equal keys are summed, within the batch too."""
    key, measures = list(key), list(measures)
    kinds = {f.name: f.dataType for f in old.schema.fields}
    added = old.unionByName(_keyed(batch, key).select(*old.columns)).groupBy(*key)
    summed = added.agg(*[F.sum(m).cast(kinds[m]).alias(m) for m in measures])
    return summed.select(*old.columns)


def load_counts(old: DataFrame, batch: DataFrame, key: Iterable[str], *, updates: bool) -> DataFrame:
    """One row: how many rows a load inserts and how many it updates.

    A batch row that meets a present key counts as an update, or as nothing
    when present keys are left alone.
    """
    key = list(key)
    per_key = _keyed(batch, key).groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
    present = old.select(*key).withColumn("present", F.lit(True))
    seen = per_key.join(present, key, "left")
    inserted = F.coalesce(F.sum(F.when(F.col("present").isNull(), 1)), F.lit(0)).cast("bigint")
    touched = F.sum(F.col("rows") - F.when(F.col("present").isNull(), 1).otherwise(0))
    updated = F.coalesce(touched, F.lit(0)).cast("bigint") if updates else F.lit(0).cast("bigint")
    return seen.agg(inserted.alias("rows_inserted"), updated.alias("rows_updated"))


# The update rule of each target table: "absent", "add" or the named columns.
UPSERT_RULES: Mapping[str, str | tuple[str, ...]] = {
    "representative_office": ("city_name", "last_updated_time"),
    "product": ("price", "last_updated_time"),
    "customer": "absent",
    "store": "absent",
    "tourist_customer": "absent",
    "mail_order_customer": "absent",
    "order": "absent",
    "order_product": "absent",
    "stocked_product": ("stock_quantity", "last_updated_time"),
    "dim_time": "absent",
    "dim_location": ("city",),
    "dim_product": ("description",),
    "dim_store": "absent",
    "dim_customer": ("customer_type",),
    "fact_sales": "add",
    "fact_inventory": ("quantity_on_hand",),
}


def upsert(
    old: DataFrame,
    batch: DataFrame,
    table: str,
    key: Iterable[str],
    order_by: Iterable[str] = (),
) -> DataFrame:
    """Apply a batch by the rule of its target table."""
    rule = UPSERT_RULES[table]
    if rule == "absent":
        return insert_if_absent(old, batch, key, order_by)
    if rule == "add":
        measures = [c for c in old.columns if c not in set(key)]
        return add_measures(old, batch, key, measures)
    return update_named(old, batch, key, rule, order_by)


def new_rows(old: DataFrame, batch: DataFrame, key: Iterable[str], order_by: Iterable[str] = ()) -> DataFrame:
    """The batch rows an insert-if-absent adds, to be appended to the stored table."""
    key = list(key)
    first = first_per_key(_keyed(batch, key), key, order_by)
    return first.join(old.select(*key), key, "left_anti").select(*old.columns)


def merge_counted(
    old: DataFrame, batch: DataFrame, table: str, key: Iterable[str], order_by: Iterable[str] = (), stamp: Iterable[str] = ()
) -> DataFrame:
    """The table after a batch, by the rule of the table, with what each row counts for a load report.

    One join of old rows and batch gives the rows and both counts: `rows_inserted` and
    `rows_updated` of a row sum up to the counts of the load. Columns of `stamp`,
    such as a load number, are taken from the batch where a row is new or another value comes.
    """
    key, stamp, rule = list(key), list(stamp), UPSERT_RULES[table]
    keyed = _keyed(batch, key).select(*old.columns)
    if rule == "add":
        measures = [c for c in old.columns if c not in {*key, *stamp}]
        kinds = {f.name: f.dataType for f in old.schema.fields}
        both = old.withColumn("rows", F.lit(0)).unionByName(keyed.withColumn("rows", F.lit(1)))
        summed = both.groupBy(*key).agg(
            *[F.sum(m).cast(kinds[m]).alias(m) for m in measures],
            *[F.max(c).alias(c) for c in stamp],
            F.sum("rows").alias("rows"),
            F.max(F.col("rows") == 0).alias("present"),
        )
        present, rows = F.col("present"), F.col("rows")
        values = [F.col(c) for c in old.columns]
        updates = True
    else:
        named = [] if rule == "absent" else list(rule)
        sequence = _sequence(keyed, order_by)
        last = [F.max(sequence).alias("last")] if named else []
        changes = keyed.groupBy(*key).agg(F.min(sequence).alias("first"), *last, F.count(F.lit(1)).alias("rows"))
        summed = old.withColumn("present", F.lit(True)).join(changes, key, "full")
        present, rows = F.col("present").isNotNull(), F.coalesce("rows", F.lit(0))
        met = F.col("rows").isNotNull()
        differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"last.{c}")) for c in named], ~present)
        values = []
        for c in old.columns:
            if c in key:
                values.append(F.col(c))
            elif named and c in {*named, *stamp}:
                taken = met & differs if c in stamp else met
                values.append(F.when(taken, F.col(f"last.{c}")).otherwise(F.col(c)).alias(c))
            else:
                values.append(F.when(present, F.col(c)).otherwise(F.col(f"first.{c}")).alias(c))
        updates = bool(named)
    inserted = F.when(present, 0).otherwise(1).cast("bigint")
    updated = (rows - inserted if updates else F.lit(0)).cast("bigint")
    return summed.select(*values, inserted.alias("rows_inserted"), updated.alias("rows_updated"))


def touched_values(batch: DataFrame, partition: str) -> list:
    """The partition values of a batch: months of a calendar or ranges of keys, so few."""
    return [row[0] for row in batch.select(partition).distinct().collect()]


def replace_partitions(rows: DataFrame, target: str, partition: str) -> None:
    """Overwrite only the stored partitions that `rows` has values of."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(target)
    )


def high_water_mark(batch: DataFrame, change_column: str) -> DataFrame:
    """One row: the newest business date of a batch, NULL when it is empty."""
    return batch.agg(F.max(change_column).cast("date").alias("mark"))


# --- reports over loaded tables ---------------------------------------------


def freshness(tables: Mapping[str, tuple[DataFrame, str]], as_of: datetime) -> DataFrame:
    """Per table the newest change and whether it is fresh, older than two days, or absent."""
    parts = [
        df.agg(F.max(column).cast("timestamp_ntz").alias("last_refreshed")).select(
            F.lit(name).alias("data_object"), "last_refreshed"
        )
        for name, (df, column) in tables.items()
    ]
    limit = F.lit(as_of).cast("timestamp_ntz") - F.expr("interval 2 days")
    verdict = (
        F.when(F.col("last_refreshed").isNull(), "never loaded")
        .when(F.col("last_refreshed") < limit, "stale (>2d)")
        .otherwise("fresh")
    )
    return _stack(parts).withColumn("freshness", verdict).orderBy("data_object")


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table, as one Spark job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("object_name"), "row_count")
        for name, df in tables.items()
    ]
    return _stack(parts).orderBy("object_name")


def footer_profile(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Row count of stored Parquet tables from the footers of their files; no row is read.

    Counting is pushed down by the newer Parquet reader, which a session of its own
    turns on, so that other queries keep their settings.
    """
    counting = spark.newSession()
    counting.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    counting.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    parts = [
        counting.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("object_name"), "row_count")
        for name, path in paths.items()
    ]
    # A table without any row has no footer count to add up: null there.
    return _stack(parts).groupBy("object_name").agg(F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("row_count"))


def timed_counts(tables: Mapping[str, DataFrame]) -> list[tuple[str, int, float]]:
    """Row count of every table with the milliseconds its own count took."""
    measured = []
    for name, df in tables.items():
        start = time.perf_counter()
        rows = df.count()
        measured.append((name, rows, round((time.perf_counter() - start) * 1000, 2)))
    return measured


def _stack(parts: list[DataFrame]) -> DataFrame:
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked
