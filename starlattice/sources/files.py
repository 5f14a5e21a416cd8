"""Readers of source tables, whole or as a stream of files, and the full-refresh writer."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from starlattice.schemas import SOURCE_SCHEMAS


CSV = {"header": True, "sep": ",", "quote": '"', "escape": '"', "enforceSchema": False, "mode": "FAILFAST"}


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A comma-separated source table with a header line and `"` quoting.

    A quote inside a quoted field is written twice. Lines end at a line feed,
    so large files stay splittable.
    """
    return spark.read.schema(SOURCE_SCHEMAS[table]).options(**CSV).csv(path)


def stream_files(spark: SparkSession, folder: str, schema: str, kind: str, files_a_batch: int) -> DataFrame:
    """The CSV (as `read_csv` has them) or Parquet files of a folder as a stream."""
    options = {"maxFilesPerTrigger": files_a_batch, **(CSV if kind == "csv" else {})}
    return spark.readStream.format(kind).schema(schema).options(**options).load(folder)


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A table of a database, read in parallel ranges of a numeric key when one is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for name, value in (properties or {}).items():
        reader = reader.option(name, value)
    if partition_column is not None:
        if lower is None or upper is None or partitions is None:
            raise ValueError("a partition column needs lower, upper and partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()


def write_full_refresh(
    df: DataFrame,
    path: str,
    *,
    partition_by: str | Sequence[str] | None = None,
    sort_by: str | None = None,
    spread: bool = True,
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Replace a stored table; an empty input leaves an empty table.

    `watch` sees the rows as they go into the files, for counts that come with the write.

    With `partition_by`, rows are first rebalanced by that column: adaptive
    execution splits a partition value that holds far more rows than others
    over several files and packs small ones together; a small table needs no `spread`. `sort_by` orders the
    rows inside each file, so that a filter on that column skips most pages.
    """
    if partition_by is None:
        watch(df).write.mode("overwrite").parquet(path)
        return
    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    rows = df.hint("rebalance", *columns) if spread else df
    if sort_by is not None:
        rows = rows.sortWithinPartitions(*columns, sort_by)
    watch(rows).write.mode("overwrite").partitionBy(*columns).parquet(path)


def write_buckets(
    df: DataFrame,
    path: str,
    table: str,
    *,
    buckets: int,
    key: str,
    sort_by: Sequence[str],
    partition_by: str | None = None,
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """A stored table whose rows lie in buckets of a key, sorted; the session knows it as `table` to read it so.

    Rows have to come in as many partitions by that key, so that each task writes one bucket.
    """
    writer = watch(df).write.format("parquet").option("path", path).option("compression", "zstd")
    writer = writer.partitionBy(partition_by) if partition_by else writer
    writer.bucketBy(buckets, key).sortBy(*sort_by).saveAsTable(table)
