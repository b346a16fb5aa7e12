"""The lake: Bronze and dead letters, Silver merges, logs and published products.

Tables are plain Hive-partitioned folders written by Spark's own committer. Appends carry a
``batch`` partition and overwrite only that partition, so running a batch again replaces its
rows instead of adding them twice. A ledger says which attempt of a batch is the one that counts,
on which days it has rows and how many, so readers know a corrected batch from one they have seen.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.contracts import PAYLOAD, REASON, Contract, typed_columns
from siltstone.operators.keyed import all_present, first_per_key, upsert
from siltstone.sources.landing import matching_paths, path_exists

DLQ_SCHEMA = f"zone string, source string, ingestion_date string, batch string, {REASON} string, {PAYLOAD} string, detected_at timestamp"
LEDGER_SCHEMA = "source string, batch string, zone string, ingestion_date string, rows long, attempt string"
BUCKET, ARRIVED = "_bucket", "_arrived"
ATTEMPT = "_attempt"
_PLAIN_NAME = re.compile(r"[\w.-]+")


def bronze_path(root: str, source: str) -> str:
    return f"{root}/zone=bronze/source={source}"


def dlq_path(root: str) -> str:
    return f"{root}/zone=dlq"


def ledger_path(root: str) -> str:
    return f"{root}/ledger"


def write_checked(
    checked: DataFrame,
    contract: Contract,
    root: str,
    ingestion_date: Column,
    detected_at: Column,
    batch: str,
    backfill: bool = False,
) -> dict[str, int]:
    """Append accepted rows to Bronze and refused rows to the dead letters in one pass and one commit.

    Returns how many rows of the batch lie in each zone, counted from what was written.

    Bronze is partitioned by ingestion date, dead letters by source and ingestion date. An
    empty batch creates nothing. A day's batch is written without a shuffle; a ``backfill`` over
    many days is first gathered by partition, which AQE splits again where a day is large.

    A batch that is written again replaces its rows in both zones, on every day it had: what a
    corrected batch no longer holds is emptied after the write, and the ledger then names the new
    attempt. A run that dies before that is run again. Batch names are plain (letters, digits, dot,
    dash and underscore).
    """
    if not _PLAIN_NAME.fullmatch(batch):
        raise ValueError(f"not a plain batch name: {batch!r}")
    spark, attempt = checked.sparkSession, uuid.uuid4().hex
    accepted = F.col(REASON).isNull()
    rows = checked.select(
        *typed_columns(contract),
        PAYLOAD,
        REASON,
        F.when(~accepted, detected_at.cast("timestamp")).alias("detected_at"),
        F.lit(attempt).alias(ATTEMPT),
        F.when(accepted, "bronze").otherwise("dlq").alias("zone"),
        F.lit(contract.source).alias("source"),
        ingestion_date.cast("string").alias("ingestion_date"),
        F.lit(batch).alias("batch"),
    )
    layout = ["zone", "source", "ingestion_date", "batch"]
    replace_partitions(rows.hint("rebalance", *layout) if backfill else rows, root, layout)
    found = matching_paths(spark, f"{root}/zone=*/source={contract.source}/ingestion_date=*/batch={batch}")
    if not found:
        return {"bronze": 0, "dlq": 0}
    now = spark.read.schema(f"zone string, ingestion_date string, {ATTEMPT} string").option("basePath", root).parquet(*found)
    mine = F.count_if(F.coalesce(F.col(ATTEMPT) == attempt, F.lit(False)))
    written, counts = [], {"bronze": 0, "dlq": 0}
    for zone, day, size, all_rows in now.groupBy("zone", "ingestion_date").agg(mine, F.count(F.lit(1))).collect():  # at most the days of a batch
        if size < all_rows:  # rows of an earlier attempt
            path = f"{root}/zone={zone}/source={contract.source}/ingestion_date={day}/batch={batch}"
            rows.drop(*layout).limit(0).write.mode("overwrite").parquet(path)
        else:
            written.append((contract.source, batch, zone, day, size, attempt))
            counts[zone] += size
    if not counts["bronze"]:
        written.append((contract.source, batch, "bronze", None, 0, attempt))
    replace_partitions(spark.createDataFrame(written, LEDGER_SCHEMA).coalesce(1), ledger_path(root), ["source", "batch"])
    return counts


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch, zone and day: the rows there and the attempt that wrote them.

    Every batch has a row of zone ``bronze``, without a day where none of its rows was accepted.
    """
    return read_table(spark, ledger_path(root), LEDGER_SCHEMA)


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Write a frame over exactly the partitions it holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def read_bronze(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    extra = [T.StructField(c, T.StringType()) for c in (PAYLOAD, "ingestion_date", "batch")]
    schema = T.StructType([*contract.schema().fields, *extra])
    path = bronze_path(root, contract.source)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_dlq(spark: SparkSession, root: str) -> DataFrame:
    schema = T._parse_datatype_string(DLQ_SCHEMA)
    if not path_exists(spark, dlq_path(root)):
        return spark.createDataFrame([], schema).drop("zone")
    return spark.read.schema(schema).option("basePath", root).parquet(dlq_path(root)).drop("zone")


def read_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table by path, or no rows when it does not exist yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def incremental(df: DataFrame, timestamp: str, since: Column, partition: str | None = None) -> DataFrame:
    """Rows strictly after the cursor. With a date partition the scan also skips older folders."""
    rows = df.where(F.col(timestamp) > since)
    return rows.where(F.col(partition) >= F.date_format(since, "yyyy-MM-dd")) if partition else rows


def append_log(df: DataFrame, path: str, batch: str) -> None:
    """Append event, rejection or insight rows; the same batch written twice stays once."""
    replace_partitions(df.withColumn("batch", F.lit(batch)), path, ["batch"])


def merge_into(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[Column],
    buckets: int = 64,
    stays: Sequence[Column] = (),
    withdrawn: DataFrame | None = None,
) -> None:
    """Keyed merge into a Silver folder laid out in hash buckets of the key.

    Only the buckets that the source touches are read and rewritten (at most ``buckets``
    numbers reach the driver to name them). The merged buckets are first written beside the table
    and then put in place: a run that dies before leaves the table as it was, one that dies
    amid the switch is finished by :func:`finish_merge`, which every merge calls first. Choose
    ``buckets`` so that one bucket is a few gigabytes; the number is stored with the table and
    another one is refused. A table format with row-level MERGE replaces this function where present.

    An incoming row replaces a stored one, but with ``stays`` only if it is not behind it in that
    order: a batch that arrives late leaves newer rows alone. Stored rows of the keys in
    ``withdrawn`` go first, so that only incoming rows can take their place. Rows without a key
    match nothing and are all kept.
    """
    schema = T.StructType([*source.schema.fields, T.StructField(BUCKET, T.IntegerType())])
    finish_merge(spark, path, schema)
    _require_layout(spark, path, buckets)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    incoming = source.withColumn(BUCKET, bucket)
    named = incoming.select(BUCKET)
    if withdrawn is not None:
        named = named.unionByName(withdrawn.select(bucket.alias(BUCKET)))
    touched = [r[0] for r in named.distinct().collect()]
    target = spark.read.schema(schema).parquet(path).where(F.col(BUCKET).isin(touched))
    if withdrawn is not None:
        target = target.join(withdrawn.select(*keys).distinct(), list(keys), "left_anti").select(*schema.fieldNames())
    if stays:
        present = all_present(keys)
        both = target.withColumn(ARRIVED, F.lit(0)).unionByName(incoming.withColumn(ARRIVED, F.lit(1)))
        merged = first_per_key(both.where(present), keys, [*stays, F.col(ARRIVED).desc(), *order])
        merged = merged.unionByName(both.where(~present)).drop(ARRIVED)
    else:
        merged = upsert(target, incoming, keys, order)
    # Rebalancing lets AQE pick the file count: small buckets share a task, large ones are split.
    _stage(merged.select(*schema.fieldNames()).hint("rebalance", BUCKET), path)
    finish_merge(spark, path, schema)


def _stage(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(f"{path}/_staged")


def finish_merge(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Put completely staged buckets in place; doing it twice changes nothing. Spark's readers skip the staging folder."""
    staged = f"{path}/_staged"
    if path_exists(spark, f"{staged}/_SUCCESS") and path_exists(spark, f"{staged}/{BUCKET}=*"):
        replace_partitions(spark.read.schema(schema).parquet(staged), path, [BUCKET])
        _stage(spark.createDataFrame([], schema), path)


def _require_layout(spark: SparkSession, path: str, buckets: int) -> None:
    layout = f"{path}/_layout"
    if path_exists(spark, f"{layout}/_SUCCESS"):
        stored = spark.read.schema("buckets int").parquet(layout).first()["buckets"]
        if stored != buckets:
            raise ValueError(f"{path} is laid out in {stored} buckets, not {buckets}")
    elif path_exists(spark, f"{path}/{BUCKET}=*"):
        raise ValueError(f"{path} does not say in how many buckets it is laid out")
    else:
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(layout)


def publish(
    df: DataFrame,
    table: str,
    path: str,
    comment: str,
    properties: Mapping[str, str],
    gate: Callable[[DataFrame], object] | None = None,
) -> None:
    """Replace a product, an external table, with its contract properties.

    Every version gets a folder of its own below ``path``; ``gate`` sees the written rows and raises
    to refuse them. The table's location is switched last, so readers by name see the old version or
    the new one, whole. Only a version with other columns creates the table anew.
    """
    spark, version = df.sparkSession, f"{path}/{uuid.uuid4().hex}"
    df.write.parquet(version)
    written = spark.read.schema(df.schema).parquet(version)
    if gate is not None:
        gate(written)
    if spark.catalog.tableExists(table) and spark.table(table).schema.simpleString() == df.schema.simpleString():
        spark.sql("ALTER TABLE {} SET LOCATION '{}'".format(table, version.replace("'", "\\'")))
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=version, source="parquet", schema=df.schema)
    entries = {"quality": "gold", **properties, "comment": comment}
    listed = ", ".join("'{}' = '{}'".format(k, v.replace("'", "''")) for k, v in entries.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")
