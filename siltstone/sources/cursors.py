"""Cursors: one row per source saying how far it has been read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.keyed import first_per_key, upsert
from siltstone.sources.lake import read_table

EPOCH = "1970-01-01 00:00:00"
SCHEMA = "source string, position string, updated_at timestamp"


def high_water(df: DataFrame, timestamp: str) -> DataFrame:
    """One row with the newest timestamp, or no row for an empty batch: it must not move a cursor."""
    return df.agg(F.max(timestamp).alias("position")).where("position is not null")


def set_cursors(cursors: DataFrame, changes: DataFrame) -> DataFrame:
    """Cursor table after an update: changed sources replaced, the others kept.

    Both sides: source, position, updated_at; of several changes to a source the latest wins.
    """
    return upsert(cursors, changes, ["source"], [F.col("updated_at").desc(), F.col("position").desc()])


def save_cursors(spark: SparkSession, path: str, changes: DataFrame) -> None:
    """Note new positions; the newest ``updated_at`` of a source counts.

    The table is a log that is only added to, a row per source and run, so a run that dies leaves
    the old positions readable. Call this only after the effects of the batch are durable.
    """
    changes.select("source", "position", "updated_at").coalesce(1).write.mode("append").parquet(path)


def read_cursors(spark: SparkSession, path: str) -> DataFrame:
    """One row per source: its newest position."""
    return first_per_key(read_table(spark, path, SCHEMA), ["source"], [F.col("updated_at").desc(), F.col("position").desc()])


def position(cursors: DataFrame, source: str) -> Column:
    """The newest position of a source as a scalar, the epoch when there is none."""
    found = cursors.where(F.col("source") == source).agg(F.max_by("position", F.struct("updated_at", "position")).alias("p"))
    return F.coalesce(found.scalar(), F.lit(EPOCH))
