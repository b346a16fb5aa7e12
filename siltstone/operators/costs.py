"""Usage by job and cost anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD_STDDEV = 2.0  # fixed value: standard deviations above the mean


def usage_by_job(usage: DataFrame, since: Column) -> DataFrame:
    """Consumption per job from ``since`` on."""
    return (
        usage.where(F.col("usage_date") >= since).groupBy("job_name").agg(F.sum("quantity").alias("consumption"))
    )


def run_durations(runs: DataFrame, since: Column) -> DataFrame:
    """Fallback measure: one row per finished run with its seconds as consumption."""
    seconds = (F.unix_micros(F.col("end_date").cast("timestamp")) - F.unix_micros(F.col("start_date").cast("timestamp"))) / 1e6
    return runs.where((F.col("start_date") >= since) & F.col("end_date").isNotNull()).select(
        "job_name", seconds.alias("consumption")
    )


def usage_by_bucket(usage: DataFrame, unit: str = "day") -> DataFrame:
    """Consumption per job and time bucket: the observations a job's baseline is made of."""
    return usage.groupBy("job_name", F.date_trunc(unit, "usage_date").alias("bucket")).agg(
        F.sum("quantity").alias("consumption")
    )


def detect_cost_anomalies(current: DataFrame, history: DataFrame, k: float = THRESHOLD_STDDEV) -> DataFrame:
    """Current rows above mean + k * sample std of their job's history; no spread flags nothing."""
    stats = history.groupBy("job_name").agg(
        F.avg("consumption").alias("mean"), F.coalesce(F.stddev_samp("consumption"), F.lit(0.0)).alias("std")
    )
    joined = current.join(stats, "job_name", "left").fillna(0.0, subset=["mean", "std"])
    flagged = joined.withColumn("threshold", F.col("mean") + F.lit(k) * F.col("std"))
    return flagged.where((F.col("std") > 0) & (F.col("consumption") > F.col("threshold")))
