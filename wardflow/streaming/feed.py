"""Keyed upsert fed by a stream: the stream's checkpoint takes the place of the high-water mark."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardflow.operators.ordered import By
from wardflow.operators.relational import latest_by
from wardflow.sources.tables import KeyedTable


def upsert_stream(stream: DataFrame, table: KeyedTable, order: list[By], progress: str) -> None:
    """Upsert everything that has arrived, then stop.

    Rows of a batch are put next to the table's rows of the same keys, and the first in order stays.
    A batch that is run again after a failure therefore changes nothing.
    """

    def batch(rows: DataFrame, _: int) -> None:
        if table.exists():
            rows = rows.unionByName(table.read_keys(rows))
        table.merge(latest_by(rows, table.keys, order))

    query = (
        stream.writeStream.foreachBatch(batch)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
