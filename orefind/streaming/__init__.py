"""Streams of documents into a collection."""

from __future__ import annotations

from pyspark.sql import DataFrame


def upsert_stream(stream: DataFrame, collection, key: str, checkpoint: str, order: str | None = None, **trigger):
    """Lay each micro-batch of a stream of documents over a custom index; a batch run again gives the same documents."""

    def batch(rows: DataFrame, _: int) -> None:
        collection.index("custom", key, rows, order=order)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
