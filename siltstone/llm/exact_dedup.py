"""Exact dedup: binary-fuse filters over an immutable snapshot screen the digests of a new batch.

A snapshot is a written table of digests, dealt into buckets by digest, with one static
three-wise binary-fuse filter per bucket. Digests of a new batch that no filter knows cannot be
in the snapshot; only the others are joined with the exact buckets. Every group of equal digests
is then checked byte by byte, so neither a false positive nor a digest collision merges texts.

NULL texts count as empty. Rows that repeat an id and a text are members of their group like any
other, and all rows with the largest id stay. NULL ids sort below all others. Empty tables give
empty results; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.llm.common import id_and_text, stored
from siltstone.session import work_path

DIGESTS_PER_FILTER = 1 << 15
SALTS = 8

_FILTER_SCHEMA = "bucket int, seed bigint, segment int, n_slots int, prints binary"


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser, so that each seed gives another hash of a key."""
    with np.errstate(over="ignore"):
        h = keys + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def _slots(h: np.ndarray, segment: int, n_slots: int) -> np.ndarray:
    """Three slots per key, in three neighbouring segments."""
    n_starts = n_slots // segment - 2
    start = ((h >> np.uint64(40)) * np.uint64(n_starts)) >> np.uint64(24)
    inside = np.uint64(segment - 1)
    return np.stack([(start + np.uint64(i)) * np.uint64(segment) + ((h >> np.uint64(13 * i)) & inside) for i in range(3)]).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build_fuse(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment, slots, fingerprints) of a filter that knows all ``keys`` (distinct uint64)."""
    n = len(keys)
    segment = 1 << max(2, min(12, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    segments = max(3, int(np.ceil(n * factor / segment)) + 2)
    for seed in range(1, 200):
        n_slots = (segments + seed // 4) * segment  # a little more room after every four failures
        h = _mix(keys, seed)
        slots = _slots(h, segment, n_slots)
        layers, alive = [], np.arange(n)
        while len(alive):
            flat = slots[:, alive].ravel()
            lonely = np.bincount(flat, minlength=n_slots)[flat].reshape(3, -1) == 1
            free = lonely.any(axis=0)
            if not free.any():
                break
            layers.append((alive[free], lonely[:, free].argmax(axis=0)))
            alive = alive[~free]
        if len(alive):
            continue
        table, prints = np.zeros(n_slots, np.uint8), _prints(h)
        for at, own in reversed(layers):  # the owned slot of a key belongs to no key of its layer or a later one
            three = slots[:, at]
            value = prints[at] ^ table[three[0]] ^ table[three[1]] ^ table[three[2]]
            table[three[own, np.arange(len(at))]] ^= value
        return seed, segment, n_slots, table.tobytes()
    raise RuntimeError("no binary-fuse filter found")


def fuse_contains(filter_row: tuple[int, int, int, bytes], keys: np.ndarray) -> np.ndarray:
    seed, segment, n_slots, prints = filter_row
    table, h = np.frombuffer(prints, np.uint8), _mix(keys, seed)
    three = _slots(h, segment, n_slots)
    return (table[three[0]] ^ table[three[1]] ^ table[three[2]]) == _prints(h)


def digest_rows(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``sha256`` of every row's whole text."""
    pair = id_and_text(df, key, text)
    return pair.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))


def _grouped(rows: DataFrame) -> DataFrame:
    """One row per digest: largest id and size. Combined per task first, so a hot digest sends one row per task."""
    return rows.groupBy("sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def _in_buckets(groups: DataFrame, buckets: int) -> DataFrame:
    key = F.xxhash64("sha256")
    return groups.select("sha256", key.alias("key"), F.pmod(key, F.lit(buckets)).cast("int").alias("bucket"))


@dataclass(frozen=True)
class Snapshot:
    """An immutable set of digest groups and its filters, both written tables."""

    groups: DataFrame
    filters: DataFrame
    buckets: int


def write_snapshot(spark: SparkSession, rows: DataFrame, expected: int = 0) -> Snapshot:
    """Group ``rows`` (doc_id, sha256), write the groups and one filter per bucket of digests.

    ``expected``: digests that a later batch may bring, so that its buckets stay small as well.
    """
    groups = stored(_grouped(rows), "dedup-groups")
    buckets = max(32, -(-max(groups.count(), expected) // DIGESTS_PER_FILTER))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        seed, segment, n_slots, prints = build_fuse(np.unique(part["key"].to_numpy().view(np.uint64)))
        return pd.DataFrame([(part["bucket"].iloc[0], seed, segment, n_slots, prints)], columns=["bucket", "seed", "segment", "n_slots", "prints"])

    path = work_path(spark, "dedup-filters")
    dealt = _in_buckets(groups, buckets).select("bucket", "key")
    dealt.groupBy("bucket").applyInPandas(build, _FILTER_SCHEMA).write.parquet(path)
    return Snapshot(groups, spark.read.schema(_FILTER_SCHEMA).parquet(path), buckets)


def screen(incoming: DataFrame, snapshot: Snapshot) -> DataFrame:
    """``sha256`` and ``maybe`` (false: certainly new) of the distinct digests of a batch."""

    def look_up(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        found = np.zeros(len(batch), bool)
        for row in filters.itertuples(index=False):
            found |= fuse_contains((row.seed, row.segment, row.n_slots, row.prints), batch["key"].to_numpy().view(np.uint64))
        return pd.DataFrame({"sha256": batch["sha256"], "maybe": found})

    dealt = _in_buckets(incoming, snapshot.buckets)
    return dealt.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket")).applyInPandas(look_up, "sha256 string, maybe boolean")


def merge_groups(incoming: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Digest groups of snapshot and batch together; only screened positives meet the exact buckets."""
    screened = stored(screen(incoming, snapshot), "dedup-screened")
    positive = incoming.join(screened.where("maybe"), "sha256", "left_semi")
    new = incoming.join(screened.where("not maybe"), "sha256", "left_semi")
    batch = positive.select("sha256", F.col("keep_id").alias("new_id"), F.col("group_size").alias("new_size"))
    both = snapshot.groups.join(batch, "sha256", "full_outer").select(
        "sha256",
        F.greatest("keep_id", "new_id").alias("keep_id"),
        (F.coalesce("group_size", F.lit(0)) + F.coalesce("new_size", F.lit(0))).alias("group_size"),
    )
    return both.unionByName(new.select(*both.columns))


def _texts_of(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """Distinct (digest, text) of the named digests with largest id and size.

    The named digests are repeated per salt, so the copies of one text are spread before they are
    counted, and each task sends one row per text.
    """
    salted = digests.select("sha256", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = docs.select("doc_id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    # merged at every size, so that the cost does not jump where the digests outgrow a broadcast
    return rows.join(salted.hint("merge"), ["sha256", "salt"], "left_semi").groupBy("sha256", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", stored_part=None) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256.

    ``stored_part`` is a boolean Column over (doc_id) that says which rows form the snapshot; the
    others are the incoming batch. By default even hashes of the id are the snapshot.
    """
    spark = df.sparkSession
    docs = id_and_text(df, key, text)
    rows = stored(digest_rows(df, key, text), "dedup-rows")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0 if stored_part is None else F.coalesce(stored_part, F.lit(False))
    batch = stored(_grouped(rows.where(~part)), "dedup-batch")
    snapshot = write_snapshot(spark, rows.where(part), batch.count())
    groups = stored(merge_groups(batch, snapshot).where("group_size > 1"), "dedup-merged")

    texts = stored(_texts_of(docs, groups.select("sha256")).withColumn("text_key", F.xxhash64("text")), "dedup-texts")
    clashes = texts.groupBy("sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sha256")
    checked = texts.join(clashes, "sha256", "left_anti").select("sha256", "keep_id", "group_size")
    checked = stored(checked, "dedup-checked")
    result = rows.join(checked, "sha256", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("sha256").alias("text_sha256"),
    )
    if not clashes.isEmpty():  # digests shared by different texts: their rows are grouped by the text itself
        apart = docs.withColumn("sha256", F.sha2(F.col("text").cast("binary"), 256)).join(clashes, "sha256", "left_semi")
        own = W.partitionBy("sha256", "text")
        apart = apart.select(
            "doc_id", F.max("doc_id").over(own).alias("keep_id"), F.count(F.lit(1)).over(own).alias("group_size"), F.col("sha256").alias("text_sha256")
        )
        result = result.join(clashes.withColumnRenamed("sha256", "text_sha256"), "text_sha256", "left_anti").unionByName(apart)
    return result.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
