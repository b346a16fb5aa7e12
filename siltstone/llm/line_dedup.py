"""Line dedup over levelled sorted runs of line hashes.

A run is a written table of (line hash, documents, newest id), sorted by hash. Each batch is
merge-anti-joined with the runs so far, which tells the lines it is the first to bring, and is
added as a run of level 0; ``fanout`` runs of one level are merged into one of the next. The runs
together give, for every line, how many documents hold it and which is the newest.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased; its
hash has 128 bits. A row is a document: rows that repeat an id count one each, NULL ids are equal
to each other and older than all others, and every row with the newest id keeps the line. NULL and
empty texts are one empty line. Empty tables give empty results; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import id_and_text, stored
from siltstone.session import work_path

MIN_CHARS = 40
MIN_DOCS = 5
_BLANKS = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(_BLANKS).lower()  # bytes.lower changes A-Z only


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars)


def _hash(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def line_hashes(df: DataFrame, key: str, text: str, min_chars: int, batches: int) -> DataFrame:
    """(batch, doc_id, line) for each distinct long enough line of a document."""

    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, hashes = [], []
            for at, text in enumerate(frame["text"]):
                own = {k for k in map(line_key, text.encode().split(b"\n")) if _long_enough(k, min_chars)}
                ids.extend([at] * len(own))
                hashes.extend(map(_hash, own))
                if len(hashes) > 50_000:
                    yield frame[["doc_id", "batch"]].iloc[ids].assign(line=hashes)
                    ids, hashes = [], []
            yield frame[["doc_id", "batch"]].iloc[ids].assign(line=hashes)

    pair = id_and_text(df, key, text)
    kind = pair.schema["doc_id"].dataType.simpleString()
    pair = pair.withColumn("batch", F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(batches)).cast("int"))
    return pair.mapInPandas(emit, f"doc_id {kind}, batch int, line binary")


class LineRuns:
    """The levelled runs of one corpus."""

    def __init__(self, spark: SparkSession, fanout: int = 2) -> None:
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def unseen(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` (line, ...) whose line is in no run: one merge-anti-join per run."""
        for run in self.runs():
            batch = batch.join(run.select("line").hint("merge"), "line", "left_anti")
        return batch

    def add(self, batch: DataFrame) -> DataFrame:
        """Add (line, doc_id) rows as a run; returns the lines that this batch is the first to bring."""
        own = self._written(
            batch.groupBy("line").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("newest"))
        )
        fresh = self.unseen(own)
        fresh = self._written(fresh) if self.runs() else own
        self._push(own, 0)
        return fresh

    def _push(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._written(self._sum(self.levels[level]))
            self.levels[level] = []
            self._push(merged, level + 1)

    def _sum(self, runs: list[DataFrame]) -> DataFrame:
        rows = runs[0]
        for run in runs[1:]:
            rows = rows.unionByName(run)
        return rows.groupBy("line").agg(F.sum("n_docs").alias("n_docs"), F.max("newest").alias("newest"))

    def _written(self, rows: DataFrame) -> DataFrame:
        path = work_path(self.spark, "line-run")
        rows.sortWithinPartitions("line").write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def totals(self) -> DataFrame:
        """(line, n_docs, newest) over all runs."""
        return self._sum(self.runs()) if len(self.runs()) > 1 else self.runs()[0]


def line_dedup(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = 4
) -> DataFrame:
    """One row per row of ``df``: doc_id, n_lines, n_dropped, kept_text.

    Lines of at least ``min_chars`` code points found in at least ``min_docs`` documents stay in
    the newest document only. Occurrences are written once, by batch; only hashes of frequent
    lines travel back to the documents.
    """
    spark = df.sparkSession
    path = work_path(spark, "line-rows")
    line_hashes(df, key, text, min_chars, batches).write.partitionBy("batch").parquet(path)
    kind = df.schema[key].dataType.simpleString()
    rows = spark.read.schema(f"doc_id {kind}, line binary, batch int").parquet(path)
    runs = LineRuns(spark)
    for batch in range(batches):
        runs.add(rows.where(F.col("batch") == batch).select("line", "doc_id"))
    frequent = stored(runs.totals().where(F.col("n_docs") >= min_docs).select("line", "newest"), "line-frequent")
    lost = rows.join(frequent, "line").where(~F.col("doc_id").eqNullSafe(F.col("newest")))
    lost = lost.groupBy("doc_id").agg(F.collect_set("line").alias("lost")).withColumnRenamed("doc_id", "lost_id")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text, gone in zip(frame["text"], frame["lost"], strict=True):
                lines = text.encode().split(b"\n")
                kept = lines
                if gone is not None and len(gone):
                    known = {bytes(h) for h in gone}
                    kept = [x for x in lines if not (_long_enough(k := line_key(x), min_chars) and _hash(k) in known)]
                out.append((len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
            made = pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept_text"], index=frame.index)
            yield pd.concat([frame[["doc_id"]], made], axis=1)

    docs = id_and_text(df, key, text)
    joined = docs.join(lost, docs["doc_id"].eqNullSafe(lost["lost_id"]), "left").select("doc_id", "text", "lost")
    return joined.mapInPandas(cut, f"doc_id {kind}, n_lines long, n_dropped long, kept_text string")
