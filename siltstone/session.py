"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest side, in rows and in bytes, that an operator marks for broadcast after measuring it.
BROADCAST_ROW_LIMIT = 200_000
BROADCAST_BYTE_LIMIT = 64 << 20
# A side planned above this is not measured, since that would run its plan once more.
MEASURED_BYTES = 4 << 30


def build_session(app: str = "siltstone", cores: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session with the settings the operators expect (a cluster passes its own)."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_LOCAL_ROOT: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    global _LOCAL_ROOT
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _LOCAL_ROOT is None or not os.path.isdir(_LOCAL_ROOT):
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="siltstone-")
    return _LOCAL_ROOT


_RUN_ROOTS: dict[tuple[str, str], str] = {}


def run_root(spark: SparkSession) -> str:
    """This application's own folder below the shared one; its driver deletes it when it ends."""
    root, context = shared_root(spark), spark.sparkContext
    key = (root, context.applicationId)
    if key not in _RUN_ROOTS:
        folder = f"{root}/run-{uuid.uuid4().hex}"
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _RUN_ROOTS[key] = folder
    return _RUN_ROOTS[key]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run of an operator, gone when the application ends."""
    return f"{run_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of the executors that made it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate: file sizes for scans, upper bounds for what is computed from them."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> bool:
    """Whether a side may be broadcast: its rows and bytes are measured, one row per task.

    The planner's estimate only spares the measurement of a side that is plainly large; it is no
    upper bound (an exploded array counts as one row), so nothing is broadcast on its word.
    """
    if planned_bytes(df) > MEASURED_BYTES:
        return False
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()
    return rows <= limit and size <= BROADCAST_BYTE_LIMIT


def _row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: the length of text, binary and nested values, eight for any other."""
    fixed, total = 0, F.lit(0).cast("long")
    for field in df.schema.fields:
        value = df[f"`{field.name}`"]
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            total = total + F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(field.dataType, T.StructType | T.ArrayType | T.MapType | T.VariantType):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(value.alias("v")))), F.lit(0))
        else:
            fixed += 8
    return total + F.lit(fixed)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast hint for a side whose size is checked, otherwise the frame as it is."""
    return df.hint("broadcast") if is_small(df, limit) else df


def spread(df: DataFrame, limit_bytes: int = 1 << 30) -> DataFrame:
    """Deal the rows of a small input out over all cores before costly row-wise work.

    A small table is often one file that one task would read and process alone. Inputs above
    the limit already come in many splits and are left as they are: no shuffle at scale.
    """
    small = planned_bytes(df) <= limit_bytes
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if small else df
