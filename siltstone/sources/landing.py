"""Dated NDJSON drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.contracts import PAYLOAD


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that match a path or pattern, on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return [status.getPath().toString() for status in found or []]


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(matching_paths(spark, path))


def write_drops(df: DataFrame, base: str, day: Column) -> None:
    """One folder of JSON lines per day; rewriting a day replaces only that day."""
    (
        df.withColumn("ds", F.date_format(day, "yyyy-MM-dd"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy("ds")
        .json(base)
    )


def read_drop(spark: SparkSession, base: str, ds: str, strict: bool = False, folder: str = "ds={ds}") -> DataFrame:
    """Raw JSON lines of one day in ``payload``; a missing day gives no rows, blank lines are skipped.

    ``folder`` names a day's folder or file below ``base``, e.g. ``{ds}/lost_sales.json``.

    Lines that are not JSON objects go on to the contract check, which rejects them with a
    reason; ``strict`` makes them fail the query instead.
    """
    path = f"{base}/{folder.format(ds=ds)}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{PAYLOAD} string")
    lines = spark.read.text(path).select(F.col("value").alias(PAYLOAD)).where(F.col(PAYLOAD).rlike(r"\S"))
    if strict:
        return lines.where(F.parse_json(PAYLOAD).isNotNull())
    return lines
