"""Keeping an index up to date from a stream of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import DataStreamWriter

from lexispan.plans.index import TextIndex


def index_stream(changes: DataFrame, index: TextIndex, checkpoint: str, order: Column | None = None) -> DataStreamWriter:
    """A stream of ``(doc_id, text [, deleted])`` rows applied to ``index`` batch by batch.

    Returns the writer, so the caller picks the trigger and starts it. A batch
    that is replayed after a failure finds its documents unchanged and skips
    them. If a document may occur more than once, ``order`` (a whole number or a
    time) says which row is the latest, within a batch and across all of them: a
    row that comes after one of later order is left out, also if that one was a
    deletion.
    """

    def apply(batch: DataFrame, _batch_id: int) -> None:
        index.apply_changes(batch, order).collect()

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
