"""Run-time assertions inside a plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def required(value: Column, message: str) -> Column:
    """The value itself; evaluating a NULL fails the query."""
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(message)))


def require_rows(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """Pass rows through and fail the query on the first row that breaks the condition.

    ``spark_partition_id() < 0`` never holds. It makes the check nondeterministic in Catalyst's eyes, so the
    optimizer cannot move it below an earlier filter and fail on rows that filter drops.
    """
    holds = F.coalesce(condition, F.lit(False)) | (F.spark_partition_id() < 0)
    return df.where(F.assert_true(holds, F.lit(message)).isNull())
