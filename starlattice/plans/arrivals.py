"""Loads of files as they arrive: a file stream that takes what is there and ends.

The stream's checkpoint knows which files it has read, so no mark is kept and the dates of rows
play no part. A batch that a stop interrupts comes again with the same number; the table's state
holds the number of the newest batch in it, so what it has already taken is passed over.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from starlattice.plans import loads
from starlattice.schemas import SOURCE_SCHEMAS
from starlattice.sources.files import stream_files
from starlattice.sources.storage import exists

# Files of one batch, unless told otherwise.
FILES_A_BATCH = 1_000


def load_arriving(
    store: loads.LoadStore,
    table: str,
    folder: str,
    at: datetime,
    *,
    kind: str = "csv",
    schema: str | None = None,
    files_a_batch: int = FILES_A_BATCH,
) -> list[loads.LoadReport]:
    """Files of a source table that reached `folder` since the last run into its conformed table; a report a batch.

    Files must appear whole, as by a rename, and under new names. Rows that came before
    are treated as in any load: known keys stay or are updated as the table says.
    """
    checkpoint = f"{store.root}/arrivals/{table}"
    known = store.state("conformed", table)
    if known is not None and known.batch >= 0 and not exists(store.spark, checkpoint):
        raise ValueError(f"{table} holds batches of arriving files, but the stream's checkpoint {checkpoint} is gone")
    reports: list[loads.LoadReport] = []

    def take(batch: DataFrame, number: int) -> None:
        report = loads.load_batch(store, table, batch, number, at)
        if report is not None:
            reports.append(report)

    rows = stream_files(store.spark, folder, schema or SOURCE_SCHEMAS[table], kind, files_a_batch)
    writer = rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return reports
