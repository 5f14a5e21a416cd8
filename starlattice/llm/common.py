"""What the operators of this subpackage share: the shared folder, stored tables, words."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Everything but space, tab, line feed, vertical tab, form feed, carriage return.
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; where it is unset, as in tests, a new private one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet to the shared folder and read back: a cut in the lineage."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case and nothing else; texts of ASCII alone take the faster built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def count_words(text: Column) -> Column:
    """Number of spaced words; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


# Keys (two longs each) that are broadcast, at most about 30 MB.
BROADCAST_KEYS = 500_000


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text, ...) whose id and text hash are not among the keys (doc_id, text_hash).

    Ids may be of any type that compares with that of the keys; null ids are equal.
    """
    gone = stored(keys.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct(), "dropped-keys")
    small = gone.count() <= BROADCAST_KEYS
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("gone_id")) & (F.xxhash64("row.text") == F.col("gone_hash"))
    return rows.join(F.broadcast(gone) if small else gone, same, "left_anti").select("row.*")
