"""Keyed sinks for streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.commits import write_folder
from ..sources.replacing import ReplacingTable
from .messages import POSITION
from .records import Record, conform, is_complete, missing_fields
from .totals import OwnerTotals


def upsert(
    rows: DataFrame,
    table: ReplacingTable,
    checkpoint: str,
    record: Record | None = None,
    dead_letters: str | None = None,
    output_mode: str = "append",
    drain: bool = True,
    merge_every: int | None = None,
    totals: OwnerTotals | None = None,
) -> StreamingQuery:
    """Write a stream into a replacing table.

    With a ``record``, rows that lack a required field go to ``dead_letters``
    with their message and the names of the fields, so that none is lost; a
    folder for them has to be named.  Both writes are named by
    the batch number, so a batch that is delivered again changes nothing; a
    query restarted on the same checkpoint goes on where it stopped.  ``drain``
    takes everything available and ends; otherwise the query keeps running.
    ``merge_every`` folds the batches into a base after that many of them, which
    bounds what a reader has to reduce.  ``totals`` take in each batch too.

    Where rows carry the position of their message, their place in the batch is
    added to it, so that lines of one file can be told in order.
    """

    if record is not None and dead_letters is None:
        raise ValueError("a record contract needs a folder for the dead letters")

    def write(batch: DataFrame, number: int) -> None:
        if POSITION in batch.columns:
            batch = batch.withColumn(POSITION, F.struct(POSITION, F.monotonically_increasing_id().alias("line")))
        if record is None:
            append(batch, number)
        else:
            write_checked(batch, number)
        if merge_every and (number + 1) % merge_every == 0:
            table.merge()
            if totals is not None:
                totals.merge()

    def append(batch: DataFrame, number: int) -> None:
        if totals is not None:
            totals.change(batch, number)
        table.append(batch, number)

    def write_checked(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            complete = is_complete(record)
            append(conform(held.filter(complete), record), number)
            rejected = held.filter(~complete).select(
                F.col("value").cast("string").alias("message"), missing_fields(record).alias("missing")
            )
            write_folder(rejected, f"{dead_letters}/batch={number}")
        finally:
            held.unpersist()

    writer = rows.writeStream.outputMode(output_mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer).start()


def publish(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Append messages to a topic.  Needs Spark's Kafka package on the class path."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .start()
    )
