"""Rows of conversations in their order, and digests of texts too long for one row."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starlattice.llm.common import stored

# Code points of a text that order rows of one turn and role; longer ones go on by a hash of the text.
ORDER_CHARS = 256


def in_order(turns: DataFrame, keep: dict[str, Column], name: str) -> DataFrame:
    """The columns `keep` of turns (conv_id, turn, role, text) with `place`, stored.

    Places ascend by conv_id, turn (null first), role and text, and go without a gap
    within a stored range of rows, `place >> 33`. The rows are cut into ranges
    anywhere, so a conversation with very many turns, or a row repeated very often,
    is spread over many tasks.
    """
    keys = [
        F.col("conv_id"),
        F.col("turn"),
        F.col("role"),
        F.substring("text", 1, ORDER_CHARS),
        F.xxhash64("text"),
        F.monotonically_increasing_id(),
    ]
    names = [f"order_{i}" for i in range(len(keys))]
    rows = turns.select(*[c.alias(n) for n, c in keep.items()], *[k.alias(n) for k, n in zip(keys, names)])
    ranged = rows.repartitionByRange(*names).sortWithinPartitions(*names)
    return stored(ranged.select(*keep, F.monotonically_increasing_id().alias("place")), name)


def joined_sha256(parts: DataFrame, key: str, order: list[str], separator: str) -> DataFrame:
    """key, sha256: the lower-case hex digest of each key's `part` strings, in order, joined.

    A digest is made from first byte to last, so the parts of a key stream through
    one task; the task holds one batch of them.
    """
    kind = dict(parts.dtypes)[key]

    schema = to_arrow_schema(T.StructType.fromDDL(f"key {kind}, sha256 string"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, running = None, None
        for batch in batches:
            done = []
            for value, part in zip(*(column.to_pylist() for column in batch.columns)):
                if running is not None and value == current:
                    running.update(separator.encode())
                else:
                    if running is not None:
                        done.append((current, running.hexdigest()))
                    current, running = value, hashlib.sha256()
                running.update(part.encode())
            yield rows_of(done)
        yield rows_of([(current, running.hexdigest())] if running is not None else [])

    def rows_of(done: list[tuple]) -> pa.RecordBatch:
        columns = zip(*done) if done else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    narrow = parts.select(F.col(key).alias("key"), *order, "part")
    sorted_parts = narrow.repartition("key").sortWithinPartitions("key", *order).select("key", "part")
    return sorted_parts.mapInArrow(digests, f"key {kind}, sha256 string").withColumnRenamed("key", key)
