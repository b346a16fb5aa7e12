"""Feature columns of the outlier model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.ordering import lag_by_key, with_row_index

# The model's feature columns.
FEATURES = ("price_change_pct", "volume_zscore", "lost_sales_value_zscore")


def zscore(df: DataFrame, value: str, output: str) -> DataFrame:
    """(x - mean) / sample std over the whole table; no spread or a NULL value gives 0.

    The two statistics are a one-row scalar subquery, so rows are neither shuffled nor joined.
    """
    stats = df.agg(
        F.struct(F.avg(value).cast("double").alias("mean"), F.stddev_samp(value).alias("std")).alias("stats")
    )
    joined = df.withColumn("_stats", stats.scalar())
    spread = F.coalesce(F.col("_stats.std"), F.lit(0.0))
    score = F.when(spread > 0, (F.col(value) - F.col("_stats.mean")) / spread)
    return joined.withColumn(output, F.coalesce(score, F.lit(0.0))).drop("_stats")


def relative_change(now: Column, before: Column) -> Column:
    """now / before - 1 as floating point: x/0 is infinite, 0/0 and unknown values are 0."""
    from_zero = F.when(now > 0, F.lit(float("inf"))).when(now < 0, F.lit(float("-inf"))).otherwise(F.lit(0.0))
    change = F.when(before == 0, from_zero).otherwise(F.try_divide(now, before) - 1.0)
    return F.coalesce(change, F.lit(0.0))


def price_change(quotes: DataFrame, tiebreak: tuple[str, ...], partitions: int | None = None) -> DataFrame:
    """Change of price against the ticker's previous quote; the first quote gives 0.

    ``tiebreak`` columns order quotes of one ticker and instant, so that runs agree.
    """
    lagged = lag_by_key(quotes, "ticker", ["quote_timestamp", *tiebreak], "price", "_previous", partitions)
    change = relative_change(F.col("price"), F.col("_previous"))
    return lagged.withColumn("price_change_pct", change).drop("_previous")


def build_features(
    quotes: DataFrame,
    sales: DataFrame,
    tiebreak: tuple[str, ...],
    partitions: int | None = None,
) -> DataFrame:
    """Quotes and lost sales paired by position, cut to the shorter side, gaps filled with 0.

    Positions follow a declared order: quotes by (quote_timestamp, ticker), sales by
    (lost_at, opportunity_id). The ticker travels along so that an insight can name it. When
    one side is empty the result keeps one row, filled with zeros on that side.
    """
    left = price_change(zscore(quotes, "volume", "volume_zscore"), tiebreak, partitions)
    left = with_row_index(
        left.select("quote_timestamp", "ticker", *tiebreak, "price_change_pct", "volume_zscore"),
        ["quote_timestamp", "ticker", *tiebreak],
        partitions=partitions,
    ).select("row_index", "ticker", "quote_timestamp", "price_change_pct", "volume_zscore")
    right = zscore(sales, "estimated_value", "lost_sales_value_zscore")
    right = with_row_index(
        right.select("lost_at", "opportunity_id", "lost_sales_value_zscore"),
        ["lost_at", "opportunity_id"],
        partitions=partitions,
    ).select("row_index", "lost_sales_value_zscore")
    length = max(min(left.count(), right.count()), 1)
    paired = left.where(F.col("row_index") < length).join(
        right.where(F.col("row_index") < length), "row_index", "full_outer"
    )
    return paired.fillna(0.0, subset=list(FEATURES))
