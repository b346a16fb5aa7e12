"""Quality gates for products and the levels declared by contracts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.contracts import Contract
from siltstone.operators.keyed import latest_by_key


@dataclass(frozen=True)
class Product:
    """A Gold product: business key, watermark, required and sensitive columns."""

    product_id: str
    key: str
    watermark: str
    required: tuple[str, ...]
    sensitive: tuple[str, ...] = ()


def quality_report(df: DataFrame, product: Product, sensitive: Sequence[str] | None = None) -> DataFrame:
    """One row: product, rows, passed and the reason codes in their fixed order.

    Rows are first counted per key (partial counts on the map side), so a hot key costs one
    row per task; duplicates and NULL keys are read from those counts.
    """
    listed = tuple(product.sensitive if sensitive is None else sensitive)
    gap = F.lit(False)
    for name in product.required:
        gap = gap | F.col(name).isNull()
    per_key = df.groupBy(F.col(product.key).alias("_key")).agg(
        F.count("*").alias("_n"), F.max(gap.cast("int")).alias("_gap")
    )
    facts = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.bool_or(F.col("_key").isNull()), F.lit(False)).alias("null_key"),
        F.coalesce(F.max("_n") > 1, F.lit(False)).alias("duplicate"),
        F.coalesce(F.max("_gap") > 0, F.lit(False)).alias("gap"),
    )
    exposed = F.lit(any(name in product.required for name in listed))
    reasons = F.filter(
        F.array(
            F.when(F.col("null_key"), "NULL_PRIMARY_KEY"),
            F.when(F.col("duplicate"), "DUPLICATE_BUSINESS_KEY"),
            F.when(F.col("gap"), "REQUIRED_COLUMN_NULL"),
            F.when(exposed, "SENSITIVE_COLUMN_IN_REQUIRED_SCHEMA"),
        ),
        lambda r: r.isNotNull(),
    )
    return facts.select(F.lit(product.product_id).alias("product_id"), "rows", reasons.alias("reason_codes")).select(
        "product_id", "rows", (F.size("reason_codes") == 0).alias("passed"), "reason_codes"
    )


def require_quality(df: DataFrame, product: Product, sensitive: Sequence[str] | None = None) -> DataFrame:
    """The report, or a failed query naming the product and its reasons."""
    report = quality_report(df, product, sensitive)
    text = F.concat(F.lit(f"QUALITY_FAILED:{product.product_id}:"), F.array_join("reason_codes", ","))
    return report.withColumn("passed", F.when(F.col("passed"), F.lit(True)).otherwise(F.raise_error(text)))


def build_product(df: DataFrame, product: Product, arrival: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Latest rows of a product, reduced to its declared columns, and their quality report."""
    columns = [c for c in product.required if c not in product.sensitive]
    rows = latest_by_key(df, [product.key], product.watermark, arrival).select(*columns)
    return rows, quality_report(rows, product)


def completeness(df: DataFrame, contract: Contract) -> DataFrame:
    """Share of present values per declared column against its floor, in one pass."""
    pairs = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.coalesce(F.avg(F.col(name).isNotNull().cast("double")), F.lit(0.0)).alias("ratio"),
            F.lit(float(floor)).alias("floor"),
        )
        for name, floor in contract.completeness.items()
    ]
    return (
        df.agg(F.array(*pairs).alias("checks"))
        .select(F.lit(contract.source).alias("source"), F.inline("checks"))
        .withColumn("passed", F.col("ratio") >= F.col("floor"))
    )


def iso_interval(text: str) -> Column:
    """The ISO-8601 durations contracts use (``P1D``, ``PT15M``, ``PT2H``) as a day-time interval."""
    days, _, clock = text.removeprefix("P").partition("T")
    amounts = {unit: 0 for unit in "DHMS"}
    for part in (days, clock):
        number = ""
        for ch in part:
            if ch in amounts:
                amounts[ch] = int(number)
                number = ""
            else:
                number += ch
    return F.make_dt_interval(*[F.lit(amounts[u]) for u in "DHM"], F.lit(float(amounts["S"])))


def staleness(df: DataFrame, source: Column, timestamp: str, limit: str, now: Column) -> DataFrame:
    """Newest timestamp of each source in one pass, and whether it is older than the limit allows."""
    newest = df.groupBy(source.alias("source")).agg(F.max(timestamp).alias("newest"))
    return newest.select(
        "source",
        "newest",
        F.coalesce(F.col("newest") < now - iso_interval(limit), F.lit(True)).alias("stale"),
    )
