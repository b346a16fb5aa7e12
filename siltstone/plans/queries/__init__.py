"""Registered queries: operators over the given tables, each with its SQL twin where SQL can say it.

Faults, sources and keys the tables do not have are derived from their columns by fixed
rules; every query reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

# Event-time borders of the derived histories.
MIDPOINT = "2024-01-16 00:00:00"
MONTH_END = "2024-01-31 00:00:00"


@dataclass(frozen=True)
class Registered:
    run: Query
    sql: str | None = None


REGISTRY: dict[str, Registered] = {}


def register(sql: str | None = None, name: str | None = None):
    """Register a function under its own name together with its SQL twin."""

    def wrap(fn: Query) -> Query:
        REGISTRY[name or fn.__name__] = Registered(fn, sql)
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def load_all() -> dict[str, Registered]:
    from siltstone.plans.queries import (  # noqa: F401
        delivery,
        documents,
        gold,
        ingest,
        insights,
        streams,
        validation,
    )

    return REGISTRY
