"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import licenses
from siltstone.llm.byte_bpe import encode
from siltstone.llm.chosen_path import jaccard_join
from siltstone.llm.collocations import collocations, collocations_sql
from siltstone.llm.compression_quality import compression_quality
from siltstone.llm.decontaminate import decontaminate
from siltstone.llm.exact_dedup import exact_dedup
from siltstone.llm.html_consensus import extract_pages
from siltstone.llm.line_dedup import line_dedup
from siltstone.llm.maxent_lm import language_model
from siltstone.llm.token_alignment import token_alignment
from siltstone.llm.token_counts import token_counts
from siltstone.llm.toxicity import toxicity

BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files below their source: 'src0/1/2/345' is document 12345, so short ids lie near the top."""
    digits = F.col("doc_id").cast("string")
    named = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.substring(digits, 1, 1), F.substring(digits, 2, 1), F.expr("substring(cast(doc_id AS string), 3)"))
    docs = read(spark, sf_dir, "documents").withColumn("path", F.regexp_replace(named, "/+$", ""))
    return licenses.scan(docs, "doc_id", "path")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(BYTE_RANKS)
    encoded = encode(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_maxent_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model(read(spark, sf_dir, "documents"))


def op5_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit", "n_merged")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_MODEL))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_license_scan,
        op3_byte_bpe,
        op4_maxent_scoring,
        op5_html_consensus,
        op6_token_counts,
        op7_jaccard_join,
        op8_exact_dedup,
        op9_line_dedup,
        op10_toxicity,
        op11_compression_quality,
        op12_collocations,
        op13_token_alignment,
    )
}

SQL: dict[str, str] = {
    "op12_collocations": collocations_sql(),
    "op2_license_scan": licenses.scan_sql(
        """(SELECT *, regexp_replace(concat_ws('/', coalesce(source, 'none'), substr(cast(doc_id AS varchar), 1, 1),
                substr(cast(doc_id AS varchar), 2, 1), substr(cast(doc_id AS varchar), 3)), '/+$', '') AS path FROM documents)""",
        "doc_id",
        "path",
    ),
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op9_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        keyed AS (
            SELECT doc_id, pos, line,
                   translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines),
        frequent AS (
            SELECT key, max(doc_id) AS newest FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        marked AS (
            SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.newest AS lost
            FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
}
