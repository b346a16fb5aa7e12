"""Streaming idempotent insert: an outbox that never forgets a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltstone.operators.keyed import insert_new
from siltstone.sources.lake import BUCKET, read_table, replace_partitions
from siltstone.streaming.ingest import batch_name

KEY = "idempotency_key"


def outbox_stream(
    requests: DataFrame, path: str, checkpoint: str, arrival: Sequence[str], buckets: int = 64, trigger: dict | None = None
) -> StreamingQuery:
    """Append the first request of every key, however long ago the key was seen.

    The outbox is its own index of keys: rows lie in hash buckets of the key and carry the name of
    the micro-batch that added them. A micro-batch reads the key column of the buckets that it
    touches, less what it wrote itself in an earlier attempt, and adds the requests whose key is not
    there; of several it takes the first in ``arrival`` order. There is no watermark and no state
    store, so nothing expires and late requests count like any other. One stream writes to an outbox.
    """

    def write(batch: DataFrame, number: int) -> None:
        enqueue(batch, path, batch_name(batch, number), arrival, buckets)

    return (
        requests.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def enqueue(batch: DataFrame, path: str, name: str, arrival: Sequence[str], buckets: int = 64) -> None:
    """Add the new requests of one named batch; the same batch again changes nothing. A request without a key fails."""
    spark = batch.sparkSession
    keyed = batch.withColumn(KEY, F.coalesce(F.col(KEY), F.raise_error(F.lit("a request has no key")).cast("string")))
    keyed = keyed.withColumn(BUCKET, F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")).persist()
    touched = [r[0] for r in keyed.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
    known = read_outbox(spark, path, f"{KEY} string").where(F.col(BUCKET).isin(touched) & (F.col("batch") != name))
    fresh = insert_new(known.select(KEY), keyed, KEY, arrival).withColumn("batch", F.lit(name))
    replace_partitions(fresh.hint("rebalance", BUCKET), path, [BUCKET, "batch"])
    keyed.unpersist()


def read_outbox(spark: SparkSession, path: str, columns: T.StructType | str) -> DataFrame:
    """The given columns of the outbox with the bucket and batch of each row; no rows when it does not exist yet."""
    schema = T.StructType.fromDDL(columns) if isinstance(columns, str) else columns
    layout = [T.StructField(BUCKET, T.IntegerType()), T.StructField("batch", T.StringType())]
    return read_table(spark, path, T.StructType([*schema.fields, *layout]))
