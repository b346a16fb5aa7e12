"""Contract-checked stream ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltstone.operators.contracts import PAYLOAD, Contract, check
from siltstone.sources.lake import write_checked


def batch_name(batch: DataFrame, number: int) -> str:
    """A name for a micro-batch that no other query, and no other number of this one, has."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("a batch has a name only while its streaming query runs")
    return f"q{query}-{number}"


def ingest_stream(
    stream: DataFrame, contract: Contract, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Check each micro-batch and append it to Bronze and the dead letters.

    The day and detection time are the batch's own timestamp, which Spark keeps in its offset
    log. The batch is named after the query's id, which lives in its checkpoint, and the batch's
    number: a batch that is run again after a failure replaces its rows, and another query's
    rows are never touched. Offsets are committed after the write.
    """
    stamped = stream.select(PAYLOAD, F.current_timestamp().alias("_seen"))

    def write(batch: DataFrame, number: int) -> None:
        write_checked(
            check(batch, contract),
            contract,
            root,
            ingestion_date=F.date_format("_seen", "yyyy-MM-dd"),
            detected_at=F.col("_seen"),
            batch=batch_name(batch, number),
        )

    return (
        stamped.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream of rows to a folder, exactly once through the file sink's own log."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
