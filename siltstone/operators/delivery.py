"""Notifications, decisions and applications as folds over event tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.functions.delivery import notification_key, send_outcome
from siltstone.operators.keyed import first_per_key, insert_new
from siltstone.operators.skew import lookup_join

# Channel, the action a notification type asks for, attempts, lease and time to live.
CHANNEL = "teams"
FALLBACK_CHANNEL = "outlook"
ACTIONS = {"pr_review": "review_pr", "model_promotion": "promote_model", "finops": "ack_finops"}
MAX_ATTEMPTS = 3
LEASE_SECONDS = 120
DECISION_TTL_HOURS = 24
DISPATCHABLE = ("pending", "retryable")
EXPIRY_ACTOR = "system:expiry"


def map_column(values: Mapping[str, str], key: Column) -> Column:
    """Look a key up in a small fixed mapping."""
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def pr_requests(results: DataFrame, title_prefix: str = "Review: ") -> DataFrame:
    """Opened pull requests as notification requests; other results give nothing.

    ``results``: status, pr_url, event_id, root_cause, target_file, explanation, recipient_ref, arrival.
    """
    return results.where(F.col("status") == "pr_opened").select(
        F.lit("pr_review").alias("notification_type"),
        F.col("event_id").alias("correlation_id"),
        F.col("pr_url").alias("resource_ref"),
        F.concat_ws(":", "event_id", "target_file").alias("resource_version"),
        "recipient_ref",
        F.create_map(
            F.lit("title"), F.concat(F.lit(title_prefix), F.substring("root_cause", 1, 72)),
            F.lit("summary"), F.col("explanation"),
            F.lit("url"), F.col("pr_url"),
        ).alias("payload"),
        F.create_map(
            F.lit("pr_url"), F.col("pr_url"), F.lit("target_file"), F.col("target_file")
        ).alias("expected_state"),
        "arrival",
    )


def enqueue(
    requests: DataFrame, outbox: DataFrame, now: Column, ttl_hours: int = DECISION_TTL_HOURS
) -> tuple[DataFrame, DataFrame]:
    """New notifications and the decisions they open.

    A request whose idempotency key is already in the outbox, or came earlier in the batch,
    adds nothing. Ids derive from the key, so replaying a batch is harmless.
    """
    key = notification_key(
        F.col("notification_type"), F.col("resource_ref"), F.col("resource_version"), F.col("recipient_ref"), F.lit(CHANNEL)
    )
    keyed = requests.withColumn("idempotency_key", key)
    action = map_column(ACTIONS, F.col("notification_type"))
    fresh = (
        insert_new(outbox, keyed, "idempotency_key", ["arrival"])
        .withColumn("action_type", action)
        .withColumn("decision_id", F.when(action.isNotNull(), F.sha2(F.concat(F.lit("decision|"), "idempotency_key"), 256)))
    )
    notifications = fresh.select(
        "idempotency_key",
        F.col("idempotency_key").alias("notification_id"),
        "notification_type",
        "correlation_id",
        "recipient_ref",
        F.lit(CHANNEL).alias("channel"),
        "payload",
        "decision_id",
        F.lit("pending").alias("status"),
        F.lit(0).cast("long").alias("attempt_count"),
        now.alias("created_at"),
    )
    decisions = fresh.where(F.col("decision_id").isNotNull()).select(
        "decision_id",
        "correlation_id",
        "action_type",
        "resource_ref",
        "expected_state",
        F.lit("pending").alias("status"),
        (now + F.make_dt_interval(hours=F.lit(ttl_hours))).alias("expires_at"),
    )
    return notifications, decisions


def dispatchable(outbox: DataFrame) -> DataFrame:
    return outbox.where(F.col("status").isin(*DISPATCHABLE))


def allowed_groups(policy: Mapping[str, Sequence[str]], action: Column) -> Column:
    """Groups a policy admits for an action; an action without policy admits nobody."""
    pairs: list[Column] = []
    for name, groups in policy.items():
        pairs += [F.lit(name), F.array(*[F.lit(g) for g in groups])]
    found = F.try_element_at(F.create_map(*pairs), action) if pairs else F.lit(None).cast("array<string>")
    return F.coalesce(found, F.array().cast("array<string>"))


def judge_events(
    decisions: DataFrame, events: DataFrame, policy: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Events joined to their decision with an ``outcome`` each.

    ``unknown_verb``, ``unauthorized``, ``expired`` (at or after the deadline, whatever the verb),
    ``reason_required`` (a rejection without reason), else ``approved`` or ``rejected``.
    """
    joined = lookup_join(
        events, decisions.select("decision_id", "action_type", "expires_at"), ["decision_id"], ["event_id"]
    )
    overlap = F.arrays_overlap("actor_groups", allowed_groups(policy, F.col("action_type")))
    admitted = F.coalesce(overlap, F.lit(False))
    outcome = (
        F.when(~F.coalesce(F.col("verb").isin("approved", "rejected"), F.lit(False)), "unknown_verb")
        .when(~admitted, "unauthorized")
        .when(F.col("expires_at") <= F.col("ts"), "expired")
        .when((F.col("verb") == "rejected") & (F.coalesce("reason", F.lit("")) == ""), "reason_required")
        .otherwise(F.col("verb"))
    )
    return joined.withColumn("outcome", outcome)


def resolve_decisions(
    decisions: DataFrame, events: DataFrame, policy: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Decisions after their events: the first effective event decides, later ones change nothing.

    ``events``: event_id, decision_id, verb, actor_id, actor_groups, reason, ts. Candidates are
    cut to one row per decision and task before the exchange.
    """
    effective = judge_events(decisions, events, policy).where(F.col("outcome").isin("approved", "rejected", "expired"))
    winner = first_per_key(effective, ["decision_id"], [F.col("ts").asc(), F.col("event_id").asc()]).select(
        "decision_id",
        F.col("outcome").alias("_status"),
        F.col("actor_id").alias("_actor"),
        F.when(F.col("outcome") != "expired", F.col("reason")).alias("_reason"),
        F.col("ts").alias("_at"),
    )
    return decisions.join(winner, "decision_id", "left").select(
        *[c for c in decisions.columns if c != "status"],
        F.coalesce("_status", "status").alias("status"),
        F.col("_actor").alias("actor_id"),
        F.col("_reason").alias("reason"),
        F.col("_at").alias("decided_at"),
    )


def expire_decisions(decisions: DataFrame, now: Column) -> DataFrame:
    """Overdue pending decisions become expired by the system actor."""
    due = (F.col("status") == "pending") & (F.col("expires_at") <= now)
    changes = {"status": F.lit("expired"), "actor_id": F.lit(EXPIRY_ACTOR), "decided_at": now}
    return decisions.select(
        *[F.when(due, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in decisions.columns]
    )


def delivery_outcomes(
    notifications: DataFrame, attempts: DataFrame, now: Column, max_attempts: int = MAX_ATTEMPTS
) -> DataFrame:
    """Status, attempt count and fallback flag of each notification after its send attempts.

    ``attempts``: notification_id, attempt_id, started_at, code (HTTP status, NULL while open).
    An open attempt counts as transient once its lease has run out, and holds the notification
    in ``delivering`` before that. Only the first ``max_attempts`` attempts can matter, so the
    rest are dropped before the exchange.
    """
    lease_over = F.col("started_at") + F.make_dt_interval(secs=F.lit(float(LEASE_SECONDS))) <= now
    outcome = F.when(F.col("code").isNotNull(), send_outcome(F.col("code"))).otherwise(
        F.when(lease_over, "transient").otherwise("open")
    )
    order = W.partitionBy("notification_id").orderBy("started_at", "attempt_id")
    early = (
        attempts.withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= max_attempts)
        .select("notification_id", "n", outcome.alias("outcome"))
    )
    last = F.min(F.when(F.col("outcome") != "transient", F.struct("n", "outcome")))
    folded = early.groupBy("notification_id").agg(last.alias("stop"), F.max("n").alias("tries"))
    spent = F.coalesce(F.col("tries") >= max_attempts, F.lit(False))
    status = (
        F.when(F.col("stop.outcome") == "delivered", "delivered")
        .when(F.col("stop.outcome") == "open", "delivering")
        .when((F.col("stop.outcome") == "permanent") | spent, "failed")
        .when(F.col("tries").isNotNull(), "retryable")
        .otherwise("pending")
    )
    kept = [c for c in notifications.columns if c not in ("status", "attempt_count")]
    return (
        notifications.select(*kept)
        .join(folded, "notification_id", "left")
        .select(
            *kept,
            status.alias("status"),
            F.coalesce("stop.n", "tries", F.lit(0)).cast("long").alias("attempt_count"),
        )
        .withColumn("fallback", F.col("status") == "failed")
    )


def fallback_messages(outcomes: DataFrame) -> DataFrame:
    """Mail rows for failed notifications."""
    return outcomes.where("fallback").select(
        "notification_id",
        "recipient_ref",
        F.lit(FALLBACK_CHANNEL).alias("channel"),
        F.coalesce(F.try_element_at("payload", F.lit("title")), F.lit("Notification")).alias("title"),
        F.coalesce(F.try_element_at("payload", F.lit("summary")), F.lit("Delivery failed.")).alias("summary"),
    )


def applications(decisions: DataFrame, existing: DataFrame) -> DataFrame:
    """One application per approved model promotion that has none yet (decision ids are unique)."""
    approved = decisions.where((F.col("status") == "approved") & (F.col("action_type") == "promote_model"))
    return approved.join(existing.select("decision_id"), "decision_id", "left_anti").select(
        F.sha2(F.concat(F.lit("application|"), "decision_id"), 256).alias("application_id"),
        "decision_id",
        "action_type",
        "resource_ref",
        "expected_state",
        F.lit("pending").alias("status"),
        F.lit(0).cast("long").alias("attempt_count"),
    )
