"""The failure feed: contract and execution failures, routing, guardrails and gated content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import gates, guardrails

# The diagnosis fields, the failure type and the source of prepared content.
DIAGNOSIS = "root_cause string, target_file string, diff string, explanation string"
CONTENT = "content_generation"
CONTENT_SOURCE = "dag_generate_content"
# ISO 8601 in UTC; the fraction is left out when it is zero.
_SECONDS, _MICROS = "yyyy-MM-dd'T'HH:mm:ss'+00:00'", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def iso_utc(ts: Column) -> Column:
    whole = F.date_trunc("second", ts) == ts
    return F.when(whole, F.date_format(ts, _SECONDS)).otherwise(F.date_format(ts, _MICROS))


def contract_failures(dlq: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Dead-letter rows as failure events; rows of one source and instant share an event id."""
    return dlq.select(
        F.concat(F.lit("dlq-"), "source", F.lit("-"), iso_utc(F.col("detected_at"))).alias("event_id"),
        F.lit("contract").alias("source_failure_type"),
        "source",
        F.coalesce("_failure_reason", F.lit("unknown")).alias("detail"),
        F.concat(F.lit("contracts/"), "source", F.lit(".contract.yaml")).alias("code_context"),
        iso_utc(F.col("detected_at")).alias("detected_at"),
        *keep,
    )


def execution_failures(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return events.select(
        "event_id",
        "source_failure_type",
        "source",
        "detail",
        F.lit("").alias("code_context"),
        iso_utc(F.col("detected_at")).alias("detected_at"),
        *keep,
    )


def failure_feed(dlq: DataFrame, events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Both kinds of failure in one feed; ``keep`` names further columns of both sides."""
    return contract_failures(dlq, keep).unionByName(execution_failures(events, keep))


def event_log(df: DataFrame, source: Column, kind: str | Column, detail: Column, detected_at: Column) -> DataFrame:
    """Event-log rows with content-hash ids: replaying the same batch gives the same ids."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    rows = df.select(
        kind.alias("source_failure_type"),
        source.alias("source"),
        detail.alias("detail"),
        detected_at.alias("detected_at"),
    )
    parts = ["source_failure_type", "source", "detail", F.col("detected_at").cast("string")]
    return rows.select(F.sha2(F.concat_ws("|", *parts), 256).alias("event_id"), *rows.columns)


def route(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events that carry their diagnosis, parsed, and events that still need one.

    The prepared text is JSON in ``detail``; it is taken over unchanged.
    """
    ready = feed.where(F.col("source_failure_type") == CONTENT).withColumn("_d", F.from_json("detail", DIAGNOSIS))
    prepared = ready.select("event_id", "source_failure_type", "detected_at", F.lit("content").alias("fix_type"), "_d.*")
    open_events = feed.where(~F.col("source_failure_type").eqNullSafe(CONTENT))
    return prepared, open_events


def apply_guardrails(
    proposals: DataFrame,
    prefixes: Sequence[str] = guardrails.ALLOWED_PATH_PREFIXES,
    patterns: Sequence[tuple[str, bool]] = guardrails.DANGEROUS_PATTERNS,
) -> DataFrame:
    """Add ``rejection_reason`` to proposals (target_file, diff); NULL means accepted. No shuffle."""
    reason = guardrails.verdict(F.col("target_file"), F.col("diff"), prefixes, patterns)
    return proposals.withColumn("rejection_reason", reason)


def rejections(judged: DataFrame, rejected_at: Column) -> DataFrame:
    """Rejection log rows of judged proposals."""
    kept = judged.where(F.col("rejection_reason").isNotNull())
    return kept.select(
        F.sha2(F.concat_ws("|", "event_id", "rejection_reason"), 256).alias("event_id"),
        "source_failure_type",
        "rejection_reason",
        F.col("diff").alias("proposed_diff"),
        rejected_at.alias("rejected_at"),
    )


def score_gate(
    drafts: DataFrame,
    generated_at: Column,
    folder: str = "pipelines/rag/reports",
    faithfulness_floor: float = gates.FAITHFULNESS_FLOOR,
    relevancy_floor: float = gates.RELEVANCY_FLOOR,
) -> tuple[DataFrame, DataFrame]:
    """Scored drafts split into queued content events and ``low_ragas_score`` rejections.

    ``drafts``: insight_id, draft, documents (number of chunks used), faithfulness, answer_relevancy.
    """
    passed = gates.passes_gate(F.col("faithfulness"), F.col("answer_relevancy"), faithfulness_floor, relevancy_floor)
    report = F.concat_ws("-", F.col("insight_id").cast("string"), F.date_format(generated_at, "yyyyMMdd'T'HHmmss"))
    explanation = F.format_string(
        f"Report on outlier %s from %d document(s). faithfulness=%.2f, answer_relevancy=%.2f "
        f"(floors: {faithfulness_floor}/{relevancy_floor}).",
        F.col("insight_id").cast("string"), F.col("documents"), F.col("faithfulness"), F.col("answer_relevancy"),
    )
    payload = F.to_json(
        F.struct(
            F.lit(CONTENT).alias("root_cause"),
            F.concat(F.lit(folder + "/"), report, F.lit(".md")).alias("target_file"),
            F.col("draft").alias("diff"),
            explanation.alias("explanation"),
        )
    )
    judged = drafts.withColumn("_passed", passed)
    queued = event_log(
        judged.where("_passed"), F.lit(CONTENT_SOURCE), CONTENT, payload, generated_at
    )
    rejected = judged.where(~F.col("_passed")).select(
        F.sha2(F.concat_ws("|", F.lit(CONTENT), F.col("insight_id").cast("string")), 256).alias("event_id"),
        F.lit(CONTENT).alias("source_failure_type"),
        F.lit("low_ragas_score").alias("rejection_reason"),
        F.col("draft").alias("proposed_diff"),
        generated_at.alias("rejected_at"),
    )
    return queued, rejected
