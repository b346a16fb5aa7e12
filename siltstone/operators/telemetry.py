"""Counters: attribute guard, roll-up and rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Attribute names a counter may carry.
ALLOWED_ATTRIBUTES = ("domain", "result", "reason_code", "source_class", "gate", "capability_id")


def counter_violation(amount: Column, attributes: Column, allowed: Sequence[str] = ALLOWED_ATTRIBUTES) -> Column:
    """Reason a point is refused: a negative amount or attributes outside the allowed names."""
    unknown = F.array_sort(F.array_except(F.map_keys(attributes), F.array(*[F.lit(a) for a in allowed])))
    return F.when(amount < 0, "negative_amount").when(
        F.size(unknown) > 0, F.concat(F.lit("unbounded_attributes:"), F.array_join(unknown, ", "))
    )


def split_points(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted points and refused points with their reason (``points``: name, amount, attributes)."""
    judged = points.withColumn("violation", counter_violation(F.col("amount"), F.col("attributes")))
    return judged.where(F.col("violation").isNull()).drop("violation"), judged.where(F.col("violation").isNotNull())


def counter_rollup(points: DataFrame) -> DataFrame:
    """Total per counter name and attribute set, whatever order the attributes were given in."""
    entries = F.array_sort(F.map_entries("attributes"))
    return points.groupBy("name", entries.alias("attributes")).agg(F.sum("amount").alias("amount"))


def rate(points: DataFrame, by: Sequence[str], minutes: int = 5, timestamp: str = "ts") -> DataFrame:
    """Per-second rate over fixed windows; batch or streaming (set a watermark on a stream)."""
    return (
        points.groupBy(F.window(timestamp, f"{minutes} minutes").alias("w"), *by)
        .agg(F.sum("amount").alias("_total"))
        .select(F.col("w.start").alias("window_start"), *by, (F.col("_total") / (60.0 * minutes)).alias("rate"))
    )


def failures_by(points: DataFrame, by: Sequence[str] = ("capability_id", "reason_code")) -> DataFrame:
    """Total of failed validation points."""
    return points.where(F.lower("result") == "fail").groupBy(*by).agg(F.sum("amount").alias("failures"))
