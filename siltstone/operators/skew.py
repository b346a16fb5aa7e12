"""Joins that stay balanced when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import BROADCAST_ROW_LIMIT, is_small

HOT_SHARE = 1.0 / 1000


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys that own more than ``share`` of the rows, with the number of slices each needs.

    At most ``1 / share`` keys can qualify, which bounds the result whatever the input size.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = df.agg(F.count("*").alias("_total"))
    level = F.greatest(F.lit(1.0), total.scalar() * F.lit(share))
    return (
        counts.withColumn("_level", level)
        .where(F.col("_n") > F.col("_level"))
        .select(*keys, F.ceil(F.col("_n") / F.col("_level")).cast("int").alias("_slices"))
    )


def _with_slices(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the slices of its key; a key with NULLs is found as well."""
    named = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], "_slices").hint("broadcast")  # at most 1 / share rows
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    return df.join(named, same, "left").drop(*[f"_hot_{k}" for k in keys])


def salted_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    salt_by: Sequence[str],
    how: str = "inner",
    share: float = HOT_SHARE,
) -> DataFrame:
    """Join where each hot key of ``big`` is cut into slices and its lookup rows are repeated per slice.

    The slice of a row is a hash of ``salt_by``, so a recomputed task gives the same rows. Rows
    without a key match nothing, but an outer join keeps them: they are sliced like a hot key.
    """
    hot = hot_keys(big, keys, share)
    slices = F.coalesce("_slices", F.lit(1))
    left = _with_slices(big, hot, keys).withColumn("_salt", F.pmod(F.xxhash64(*salt_by), slices).cast("int"))
    right = _with_slices(lookup, hot, keys).withColumn("_salt", F.explode(F.sequence(F.lit(0), slices - 1)))
    return left.drop("_slices").join(right.drop("_slices"), [*keys, "_salt"], how).drop("_salt")


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    salt_by: Sequence[str],
    how: str = "inner",
    limit: int = BROADCAST_ROW_LIMIT,
) -> DataFrame:
    """Broadcast the lookup side when counting shows it is small, else the salted join."""
    if is_small(lookup, limit):
        return big.join(lookup.hint("broadcast"), list(keys), how)
    return salted_join(big, lookup, keys, salt_by, how)


def left_join_many(
    left: DataFrame, many: DataFrame, keys: Sequence[str], salt_by: Sequence[str], limit: int = BROADCAST_ROW_LIMIT
) -> DataFrame:
    """``left`` outer-joined to a side that may hold very many rows for one key.

    Spark can split a skewed left side of an outer join but not a skewed right one, so the
    matches are taken from the large side and the left rows without any are added.
    """
    matched = lookup_join(many, left, keys, salt_by, "inner", limit)
    bare = left.join(many.select(*keys).distinct(), list(keys), "left_anti")
    extra = [c for c in many.columns if c not in keys]
    empty = bare.select("*", *[F.lit(None).cast(many.schema[c].dataType).alias(c) for c in extra])
    order = [*left.columns, *extra]
    return matched.select(*order).unionByName(empty.select(*order))
