"""Keyed JSON topics, on a broker or as files of the same shape."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.contracts import PAYLOAD

def topic_stream(
    spark: SparkSession, servers: str, topic: str, max_messages: int | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """A topic as a stream of JSON texts, all that is there per batch unless ``max_messages`` is given. Offsets advance only with the query's checkpoint.

    Needs the Kafka connector on the classpath.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**(options or {}))
    )
    if max_messages:
        reader = reader.option("maxOffsetsPerTrigger", max_messages)
    return reader.load().select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias(PAYLOAD))


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same stream from JSON line files."""
    reader = spark.readStream.schema("value string").format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(F.col("value").alias(PAYLOAD)).where(F.col(PAYLOAD).rlike(r"\S"))


def normalise_quotes(raw: DataFrame) -> DataFrame:
    """Provider field names to contract names; quotes without ticker or price are skipped."""
    return raw.where("symbol is not null and regularMarketPrice is not null").select(
        F.col("symbol").alias("ticker"),
        F.col("regularMarketPrice").alias("price"),
        F.col("regularMarketVolume").alias("volume"),
        F.col("regularMarketTime").alias("quote_timestamp"),
    )


def keyed_json(records: DataFrame, *keys: str) -> DataFrame:
    """Topic rows: the first present key column as text (else empty) and the record as JSON."""
    key: Column = F.coalesce(*[F.col(k).cast("string") for k in keys], F.lit(""))
    return records.select(key.alias("key"), F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_topic(rows: DataFrame, servers: str, topic: str, options: Mapping[str, str] | None = None) -> None:
    """Append keyed rows to a topic. Needs the Kafka connector on the classpath."""
    (
        rows.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**(options or {}))
        .save()
    )
