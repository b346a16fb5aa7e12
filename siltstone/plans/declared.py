"""Declared contracts, products and metrics (fixed values)."""

from __future__ import annotations

from siltstone.operators.contracts import Contract, Field
from siltstone.operators.metrics import Metric
from siltstone.operators.quality import Product

CONTRACTS = {
    c.source: c
    for c in (
        Contract(
            "b3_quotes",
            (
                Field("ticker", "string", required=True),
                Field("price", "decimal", required=True, minimum=0),
                Field("volume", "long"),
                Field("quote_timestamp", "timestamp", required=True),
            ),
            max_staleness="PT5M",
            completeness={"ticker": 1.0, "price": 1.0},
        ),
        Contract(
            "crm_lost_sales",
            (
                Field("opportunity_id", "string", required=True),
                Field("account_name", "string", required=True),
                Field("lost_reason", "string", required=True),
                Field("estimated_value", "decimal", required=True, minimum=0),
                Field("lost_at", "timestamp", required=True),
            ),
            max_staleness="P1D",
            completeness={"opportunity_id": 1.0, "estimated_value": 1.0},
        ),
        Contract(
            "infra_telemetry",
            (
                Field("host_id", "string", required=True),
                Field("metric_name", "string", required=True),
                Field("metric_value", "decimal", required=True),
                Field("collected_at", "timestamp", required=True),
            ),
            max_staleness="PT15M",
        ),
        Contract(
            "usage_logs",
            (
                Field("user_id", "string", required=True),
                Field("action", "string", required=True),
                Field("resource", "string", required=True),
                Field("occurred_at", "timestamp", required=True),
            ),
            max_staleness="PT15M",
        ),
        Contract(
            "pdf_contracts",
            (
                Field("document_id", "string", required=True),
                Field("source_path", "string", required=True),
                Field("contract_type", "string", required=True),
                Field("uploaded_at", "timestamp", required=True),
            ),
        ),
        Contract(
            "video_transcripts",
            (
                Field("transcript_id", "string", required=True),
                Field("video_source", "string", required=True),
                Field("transcript_text", "string", required=True),
                Field("duration_seconds", "long", required=True),
                Field("recorded_at", "timestamp", required=True),
            ),
        ),
        Contract(
            "sharepoint_documents",
            (
                Field("document_id", "string", required=True),
                Field("source_path", "string", required=True),
                Field("chunk_index", "long", required=True),
                Field("chunk_text", "string", required=True),
                Field("updated_at", "timestamp", required=True),
            ),
            max_staleness="PT30M",
        ),
    )
}

# Business keys of the merged Silver sources; the other sources are append-only.
SILVER_KEYS = {"b3_quotes": ("ticker", "quote_timestamp"), "crm_lost_sales": ("opportunity_id",)}
APPEND_ONLY = ("infra_telemetry", "usage_logs")

PRODUCTS = {
    p.product_id: p
    for p in (
        Product(
            "gold_market_insights", "source_event_id", "event_date",
            ("source_event_id", "event_date", "source_class", "metric_value"),
        ),
        Product(
            "gold_lost_sales", "sale_id", "event_date",
            ("sale_id", "event_date", "region", "lost_value"), ("customer_email", "customer_name"),
        ),
        Product(
            "gold_finops_costs", "usage_id", "usage_date", ("usage_id", "usage_date", "job_name", "consumption"),
        ),
        Product(
            "gold_platform_health", "event_id", "observed_at",
            ("event_id", "observed_at", "capability_id", "result"), ("raw_message",),
        ),
    )
}

METRICS = {
    m.metric_id: m
    for m in (
        Metric(
            "market_total_value", "gold_market_insights", ("source_class", "event_date"), "sum(metric_value)",
            ("not_null", "non_negative", "freshness_15m"),
        ),
        Metric(
            "lost_sales_value", "gold_lost_sales", ("region", "event_date"), "sum(lost_value)",
            ("not_null", "non_negative", "freshness_15m"),
        ),
        Metric(
            "finops_consumption", "gold_finops_costs", ("job_name", "usage_date"), "sum(consumption)",
            ("not_null", "non_negative"),
        ),
        # Results are compared without regard to case: evidence writes FAIL.
        Metric(
            "platform_quality_failures", "gold_platform_health", ("capability_id", "observed_at"),
            "count_if(lower(result) = 'fail')", ("not_null", "freshness_15m"),
        ),
    )
}
