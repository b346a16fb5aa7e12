"""One row per key: latest rows, upserts and keyed replacement."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.functions.guards import require_rows
from siltstone.session import BROADCAST_ROW_LIMIT, is_small


def all_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order.

    ``row_number() = 1`` lets Spark cut every key to one row per task before the exchange,
    so a key that owns a third of the table sends one row per task, not a third of the table.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], watermark: str, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Latest row per key, the form used by the SQL products: NULL watermarks sort last."""
    return first_per_key(df, keys, [F.col(watermark).desc_nulls_last(), *tiebreak])


def latest_by_key(df: DataFrame, keys: Sequence[str], watermark: str, arrival: Sequence[str]) -> DataFrame:
    """Latest row per key where the earliest arrival wins ties; NULL keys or watermarks fail the query."""
    checked = require_rows(df, all_present(keys), "business keys cannot be null")
    checked = require_rows(checked, F.col(watermark).isNotNull(), f"watermark cannot be null: {watermark}")
    return latest_per_key(checked, keys, watermark, [F.col(a).asc() for a in arrival])


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int = BROADCAST_ROW_LIMIT
) -> DataFrame:
    """Target after a keyed merge: matching rows replaced, the others inserted.

    The source is cut to its first row per key in ``order``. NULL keys match nothing, so such
    rows pass through. A small source is broadcast and the target is not shuffled; otherwise
    one full outer join keeps it to one exchange per side, reusing the partitioning that the
    cut has already made.
    """
    present = all_present(keys)
    columns = target.columns
    fresh = first_per_key(source.where(present), keys, order)
    held = target.where(present)
    unkeyed = target.where(~present).unionByName(source.where(~present).select(*columns))
    if is_small(source, limit):
        kept = held.join(fresh.select(*keys).hint("broadcast"), list(keys), "left_anti").select(*columns)
        return kept.unionByName(fresh.select(*columns)).unionByName(unkeyed)
    joined = held.join(fresh.select(*keys, F.struct(*columns).alias("_new")), list(keys), "full_outer")
    merged = joined.select(
        *[
            F.col(c) if c in keys else F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c)
            for c in columns
        ]
    )
    return merged.unionByName(unkeyed)


def merge_by_key(existing: DataFrame, incoming: DataFrame, key: str, arrival: Sequence[str]) -> DataFrame:
    """Keyed replacement where the last incoming arrival wins; a NULL incoming key fails the query."""
    checked = require_rows(incoming, F.col(key).isNotNull(), "business keys cannot be null")
    return upsert(existing, checked, [key], [F.col(a).desc() for a in arrival])


def insert_new(
    existing: DataFrame, incoming: DataFrame, key: str, arrival: Sequence[str], limit: int = BROADCAST_ROW_LIMIT
) -> DataFrame:
    """Idempotent insert: the incoming rows whose key is new, first arrival per key, and none of the others.

    For a small batch the existing keys are first cut to those it names, without shuffling them.
    """
    first = first_per_key(incoming, [key], [F.col(a).asc() for a in arrival])
    known = existing.select(key)
    if is_small(incoming, limit):
        known = known.join(first.select(key).hint("broadcast"), key, "left_semi")
    return first.join(known, key, "left_anti")
