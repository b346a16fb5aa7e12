"""Grouped metrics and declared metric formulas."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.guards import required


def sum_by(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Sum as double under the value's own name; a NULL value fails the query."""
    amount = required(F.col(value), f"cannot sum a null {value}").cast("double")
    return df.groupBy(*group).agg(F.sum(amount).alias(value))


def count_by(df: DataFrame, group: Sequence[str]) -> DataFrame:
    return df.groupBy(*group).agg(F.count("*").alias("metric_count"))


def market_aggregate(df: DataFrame) -> DataFrame:
    """Daily totals per source class with the newest source watermark."""
    return df.groupBy("event_date", "source_class").agg(
        F.sum("metric_value").alias("total_value"),
        F.count("*").alias("metric_count"),
        F.max("_updated_at").alias("source_watermark"),
    )


@dataclass(frozen=True)
class Metric:
    """A registered metric: an aggregate formula at a grain over one product, with its declared tests."""

    metric_id: str
    product: str
    grain: tuple[str, ...]
    formula: str
    tests: tuple[str, ...] = ()

    @property
    def summed(self) -> str | None:
        """The column whose plain sum the formula is, if it is one."""
        found = re.fullmatch(r"sum\((\w+)\)", self.formula)
        return found[1] if found else None


def metric(df: DataFrame, spec: Metric) -> DataFrame:
    return df.groupBy(*spec.grain).agg(F.expr(spec.formula).alias(spec.metric_id))


def metric_tests(values: DataFrame, spec: Metric, now: Column | None = None, watermark: str = "source_watermark") -> DataFrame:
    """One row per declared test of a metric: how many grain rows break it.

    ``freshness_15m`` compares the rows' watermark with ``now``; a declared test that is not known fails.
    """
    broken = {
        "not_null": F.col(spec.metric_id).isNull(),
        "non_negative": F.col(spec.metric_id) < 0,
    }
    if "freshness_15m" in spec.tests:
        if now is None:
            raise ValueError(f"{spec.metric_id}: freshness_15m needs the time")
        late = F.col(watermark) < now - F.expr("INTERVAL 15 MINUTES")
        broken["freshness_15m"] = F.coalesce(late, F.lit(True))
    if unknown := set(spec.tests) - broken.keys():
        raise ValueError(f"{spec.metric_id}: unknown tests {sorted(unknown)}")
    tests = list(spec.tests)
    counts = values.agg(
        F.array(
            *[F.struct(F.lit(t).alias("test"), F.count_if(broken[t]).alias("violations")) for t in tests]
        ).alias("tests")
    )
    return counts.select(F.lit(spec.metric_id).alias("metric_id"), F.inline("tests")).withColumn(
        "passed", F.col("violations") == 0
    )
