"""The flagship query: raw messages to gated daily totals in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import contracts, metrics, quality
from siltstone.plans.queries.ingest import QUOTES, checked_quotes


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check quote messages, keep the latest accepted one per ticker and day, gate it, sum per day."""
    valid, _ = contracts.split(checked_quotes(spark, sf_dir), QUOTES, keep=["event_id"])
    daily = valid.withColumn("event_date", F.col("quote_timestamp").substr(1, 10)).withColumn(
        "quote_id", F.concat_ws("-", "ticker", "event_date")
    )
    product = quality.Product("daily_quotes", "quote_id", "quote_timestamp", ("quote_id", "event_date", "price", "quote_timestamp"))
    rows, report = quality.build_product(daily, product, ["event_id"])
    totals = metrics.sum_by(rows, ("event_date",), "price")
    gate = report.select("passed", "reason_codes")
    return totals.withColumn("gate_passed", gate.select("passed").scalar()).withColumn("price", F.round("price", 2))
