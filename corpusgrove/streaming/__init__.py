"""Assigning topics to a stream of documents against a fixed tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from corpusgrove.operators.backend import Backend
from corpusgrove.plans.assign import assignments


def assign_stream(documents: DataFrame, tree: DataFrame, backend: Backend, template: str, out: str, checkpoint: str, **options) -> StreamingQuery:
    """Assign every micro-batch as it arrives, into a folder of ``out`` of its own.

    Assignment keeps no state between documents, so each batch is the batch
    job; the checkpoint makes a restarted query go on where it stopped.  A batch
    that is repeated replaces its folder (``batch_id=n``), so nothing is there
    twice; reading ``out`` adds the column ``batch_id``.
    """

    def each(batch: DataFrame, number: int) -> None:
        assignments(batch, tree, backend, template, **options).write.mode("overwrite").parquet(f"{out}/batch_id={number}")

    return (
        documents.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
