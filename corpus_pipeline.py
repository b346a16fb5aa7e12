"""The corpus pipeline: documents pass five stages, each of which calls one training-data operator.

NULL and empty texts count as equal: the one with the largest id stays, has no near copies and no
tokens. Rows are known by id and text: of rows equal in both, exact dedup keeps the first by its other
columns, and rows that share an id but not a text are judged one by one. Of near copies the least id
stays. Empty tables give empty results, and the columns of the documents, whatever they are, pass
unchanged through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.llm.byte_bpe import decode, encode
from siltstone.llm.chosen_path import WORDS, document_sets, jaccard_join
from siltstone.llm.common import stored, whole_text, without_ids
from siltstone.llm.decontaminate import decontaminate
from siltstone.llm.exact_dedup import exact_dedup
from siltstone.llm.queries import BYTE_RANKS, read
from siltstone.llm.toxicity import toxicity


def text_digest(docs: DataFrame) -> Column:
    return F.sha2(whole_text(docs, "text").cast("binary"), 256)


def _same(docs: DataFrame, named: DataFrame) -> Column:
    return docs["doc_id"].eqNullSafe(named["_named_id"]) & (text_digest(docs) == named["_named_text"])


def _named(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("doc_id").alias("_named_id"), F.col("text_sha256").alias("_named_text"))


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows whose id and text are not in ``gone`` (doc_id, text_sha256); NULL ids compare equal."""
    named = _named(gone)
    return docs.join(named, _same(docs, named), "left_anti")


def once(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Of rows equal in id and text the first by all columns; ``rows``: (doc_id, text_sha256) of each."""
    named = _named(rows).groupBy("_named_id", "_named_text").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    named = stored(named, "pipeline-repeated")
    if named.isEmpty():
        return docs
    several = docs.join(named, _same(docs, named), "left_semi")
    own = W.partitionBy("doc_id", text_digest(several)).orderBy(F.to_json(F.struct(*[several[c] for c in docs.columns])))
    first = several.withColumn("_place", F.row_number().over(own)).where("_place = 1").drop("_place")
    return docs.join(named, _same(docs, named), "left_anti").unionByName(first)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    judged = toxicity(docs, read(spark, sf_dir, "labels"))
    return without_rows(docs, judged.where("predicted = 1"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id, once."""
    judged = stored(exact_dedup(docs).select("doc_id", "text_sha256", "kept"), "pipeline-copies")
    return once(without_rows(docs, judged.where("not kept")), judged.where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group joined by five-word Jaccard links of 0.8 or more, the document with the least id."""
    gone = jaccard_join(docs).where(F.col("doc_id") != F.col("class_id")).select("doc_id", "set_key")
    texts = docs.select("doc_id", whole_text(docs, "text").alias("text"), text_digest(docs).alias("text_sha256"))
    several = texts.groupBy("doc_id").agg(F.min("text_sha256").alias("least"), F.max("text_sha256").alias("most"))
    several = stored(several.where("least != most and doc_id is not null").select("doc_id"), "pipeline-shared-ids")
    if several.isEmpty():
        return without_ids(docs, "doc_id", gone.select("doc_id"))
    # ids that have several texts: the set that goes is looked up for each of their texts
    shared = stored(texts.join(several, "doc_id", "left_semi"), "pipeline-shared-texts")
    distinct = shared.select(F.col("text_sha256").alias("doc_id"), "text").dropDuplicates(["doc_id"])
    sets = document_sets(distinct, WORDS).select(F.col("doc_id").alias("text_sha256"), "set_key")
    lost = shared.select("doc_id", "text_sha256").join(sets, "text_sha256").join(gone, ["doc_id", "set_key"], "left_semi")
    alone = gone.join(several, "doc_id", "left_anti").select("doc_id")
    return without_rows(without_ids(docs, "doc_id", alone), lost)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    texts = docs.select(text_digest(docs).alias("digest"), whole_text(docs, "text").alias("text"))  # a text is judged by itself
    judged = stored(decontaminate(texts, read(spark, sf_dir, "benchmark"), key="digest").where("contaminated").select("doc_id"), "pipeline-leaks")
    named = judged.distinct().withColumnRenamed("doc_id", "_named_text")
    return docs.join(named, text_digest(docs) == named["_named_text"], "left_anti")


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document that is left, and whether they decode to its text."""
    ranks = public_tokenizers.path(BYTE_RANKS)
    # stored first, so that a core runs one Python worker at a time, not one that encodes beside one that decodes
    ids = stored(encode(docs, ranks, public_tokenizers.PATTERN), "pipeline-ids")
    return ids.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), ranks), 256).alias("decoded_sha256"),
        "ids",
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode_texts),
]

# A trained model and a randomised join decide which rows stay: tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
