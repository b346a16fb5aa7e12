"""Order-dependent operators over whole tables, without a single-task sort.

Rows are range-partitioned on a total order, so no partition depends on how many rows one
key owns: a hot key simply spans several partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.session import cut_lineage, planned_bytes

# monotonically_increasing_id() holds the partition in the upper bits and the row below bit 33.
_ROW_BITS = 33
_SLICE_BYTES = 64 << 20
# Bins of one pass of a rank search.
_BINS = 1024


def _partitions(df: DataFrame, partitions: int | None) -> int:
    """As many partitions as the rows ask for, and at least one per core.

    Catalyst's estimate is only believed where it is small: that of a join grows with the product of
    its sides. Otherwise the rows are counted.
    """
    if partitions:
        return partitions
    cores = df.sparkSession.sparkContext.defaultParallelism
    if planned_bytes(df) <= cores * _SLICE_BYTES:
        return cores
    return max(cores, df.count() * df._jdf.schema().defaultSize() // _SLICE_BYTES)


def sorted_partitions(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partitioned and sorted rows with their ``_slice`` (partition) and ``_place`` (row in it).

    The result is checkpointed: later passes must see the same slice borders, which a
    recomputed sample would move.
    """
    n = _partitions(df, partitions)
    placed = (
        df.repartitionByRange(n, *[F.col(c).asc() for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_id", _ROW_BITS))
        .withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_id")
    )
    return cut_lineage(placed)


def _offsets(slices: DataFrame) -> DataFrame:
    """Rows before each slice. At most one row per partition, so one task may order them."""
    sizes = slices.groupBy("_slice").agg(F.count("*").alias("_rows"))
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    return sizes.select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))


def with_row_index(df: DataFrame, order: Sequence[str], index: str = "row_index", partitions: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in a total order (``order`` must be unique)."""
    slices = sorted_partitions(df, order, partitions)
    offsets = _offsets(slices).hint("broadcast")  # one row per partition
    return (
        slices.join(offsets, "_slice")
        .withColumn(index, F.col("_before") + F.col("_place"))
        .drop("_slice", "_place", "_before")
    )


def lag_by_key(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    output: str,
    partitions: int | None = None,
) -> DataFrame:
    """Previous ``value`` of the same key in ``order`` (which must be total within a key), for keys of any size.

    One range exchange: the sorted slices are read twice in Arrow batches, first for the last row of
    each slice, which is all that another slice can need (one row per partition reaches the driver),
    then to shift the values by one row. A key holding a third of all rows spans many slices; NULL keys are one key.
    """
    slices = sorted_partitions(df, [key, *order], partitions)
    kinds = {c: slices.schema[c].dataType for c in (key, value)}
    edge = T.StructType([T.StructField("s", T.LongType()), T.StructField("k", kinds[key]), T.StructField("v", kinds[value])])

    def last_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            if len(batch):
                tail = batch.slice(len(batch) - 1)
        if tail is not None:
            yield pa.RecordBatch.from_arrays([tail["_slice"], tail[key], tail[value]], ["s", "k", "v"])

    tails = slices.select("_slice", key, value).mapInArrow(last_row, edge).toArrow().sort_by("s").combine_chunks()
    before = df.sparkSession.sparkContext.broadcast(tails)
    columns = [c for c in slices.columns if c not in ("_slice", "_place")]

    def shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge_k = edge_v = None
        for batch in batches:
            if not len(batch):
                continue
            keys, values = batch[key], batch[value]
            if edge_k is None:  # the last row of the nearest slice before this one
                known = before.value.filter(pc.less(before.value["s"], batch["_slice"][0]))
                edge_k, edge_v = (known[c].slice(max(len(known) - 1, 0)).combine_chunks() for c in ("k", "v"))
            first = len(edge_k) == 0
            prior_k = pa.concat_arrays([keys[:1] if first else _array(edge_k, keys.type), keys[:-1]])
            prior_v = pa.concat_arrays([pa.nulls(1, values.type) if first else _array(edge_v, values.type), values[:-1]])
            same = pc.fill_null(pc.equal(prior_k, keys), False)
            same = pc.or_(same, pc.and_(pc.is_null(prior_k), pc.is_null(keys)))
            found = pc.if_else(same, prior_v, pa.nulls(len(batch), values.type))
            edge_k, edge_v = keys[-1:], values[-1:]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in columns), found], [*columns, output])

    fields = [slices.schema[c] for c in columns]
    return slices.mapInArrow(shifted, T.StructType([*fields, T.StructField(output, kinds[value])]))


def _array(edge: pa.Array | pa.ChunkedArray, kind: pa.DataType) -> pa.Array:
    one = edge.combine_chunks() if isinstance(edge, pa.ChunkedArray) else edge
    return one.cast(kind)


def running_extremes(
    df: DataFrame, group: str, order: str, step: Column, partitions: int | None = None
) -> DataFrame:
    """Largest and smallest running total of ``step`` along ``order`` in each group.

    One range shuffle and no checkpoint: each partition reports per group only its total and
    the extremes of its local running total; the offsets are added to those few rows. ``df``
    must hold one row per (group, order).
    """
    n = _partitions(df, partitions)
    ordered = (
        df.select(F.col(group).alias("g"), F.col(order).alias("o"), step.cast("double").alias("s"))
        .repartitionByRange(n, "g", "o")
        .sortWithinPartitions("g", "o")
        .select("g", "s", F.spark_partition_id().alias("p"))
    )
    parts = ordered.mapInPandas(_local_extremes, "g string, p int, total double, high double, low double")
    before = W.partitionBy("g").orderBy("p").rowsBetween(W.unboundedPreceding, -1)  # at most n rows a group
    shifted = parts.withColumn("start", F.coalesce(F.sum("total").over(before), F.lit(0.0)))
    return shifted.groupBy(F.col("g").alias(group)).agg(
        F.max(F.col("start") + F.col("high")).alias("high"), F.min(F.col("start") + F.col("low")).alias("low")
    )


def _local_extremes(batches):
    """Per group of one sorted partition: total, highest and lowest running total."""
    import pandas as pd

    state: dict[str, list[float]] = {}
    partition = 0
    for batch in batches:
        if batch.empty:
            continue
        partition = int(batch["p"].iloc[0])
        for name, steps in batch.groupby("g", sort=False)["s"]:
            path = steps.cumsum()
            total, high, low = state.get(name, [0.0, float("-inf"), float("inf")])
            state[name] = [
                total + float(path.iloc[-1]),
                max(high, total + float(path.max())),
                min(low, total + float(path.min())),
            ]
    if state:
        yield pd.DataFrame([(g, partition, *v) for g, v in state.items()], columns=["g", "p", "total", "high", "low"])


def value_at_rank(df: DataFrame, value: str, rank: int) -> tuple[float, int] | None:
    """(the value at a 0-based rank, rows with smaller values) of finite DOUBLEs, exact, without ordering the rows.

    A histogram of equal bins narrows the range to the bin that holds the rank, and again within it, until
    the bin holds one value. Bins of different tasks add up, and a pass returns at most ``_BINS`` rows.
    """
    rows = df.select(F.col(value).alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    low, high, total = rows.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if not 0 <= rank < total:
        return None
    below = 0
    while low < high:
        width = (high - low) / _BINS
        even = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width or 1.0)), F.lit(_BINS - 1))  # the ends lie in different bins
        spot = even if width > 0 else (F.col("v") > low).cast("long")
        bins = rows.where(F.col("v").between(low, high)).groupBy(spot.alias("b")).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n"))
        for found in sorted(bins.collect(), key=lambda r: r["low"]):
            if rank < below + found["n"]:
                break
            below += found["n"]
        low, high = found["low"], found["high"]
    return low, below

