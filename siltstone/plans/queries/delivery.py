"""The outbox, the decision ledger, send outcomes and model promotions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import delivery, promotion
from siltstone.plans.queries import MIDPOINT, MONTH_END, moment, register, stamp, table

POLICY = {"review_pr": ["reviewers"], "promote_model": ["ml"], "ack_finops": ["finops"]}

REQUESTS_SQL = """
WITH r AS (SELECT event_id, ts, CASE event_type WHEN 'click' THEN 'pr_review' WHEN 'view' THEN 'report' WHEN 'purchase' THEN 'finops' ELSE 'model_promotion' END AS kind,
  'r' || user_id AS resource, 'v' || (CAST(json_extract(props, '$.k') AS BIGINT) % 5) AS version, 'u' || (user_id % 10) AS recipient FROM events),
k AS (SELECT *, sha256(kind || '|' || resource || '|' || version || '|' || recipient || '|teams') AS key FROM r)
"""


def request_rows(events: DataFrame) -> DataFrame:
    kind = (
        F.when(F.col("event_type") == "click", "pr_review")
        .when(F.col("event_type") == "view", "report")
        .when(F.col("event_type") == "purchase", "finops")
        .otherwise("model_promotion")
    )
    return events.select(
        kind.alias("notification_type"),
        F.concat(F.lit("e"), "event_id").alias("correlation_id"),
        F.concat(F.lit("r"), "user_id").alias("resource_ref"),
        F.concat(F.lit("v"), F.get_json_object("props", "$.k").cast("long") % 5).alias("resource_version"),
        F.concat(F.lit("u"), F.col("user_id") % 10).alias("recipient_ref"),
        F.create_map(F.lit("title"), F.concat(F.lit("about "), "user_id")).alias("payload"),
        F.create_map(F.lit("value"), F.col("value").cast("string")).alias("expected_state"),
        "ts",
        F.col("event_id").alias("arrival"),
    )


def two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Notifications of the first half, then notifications and decisions of the second."""
    rows = request_rows(table(spark, sf_dir, "events"))
    nothing = spark.createDataFrame([], "idempotency_key string")
    first, _ = delivery.enqueue(rows.where(F.col("ts") <= moment(MIDPOINT)), nothing, moment(MIDPOINT))
    second, decisions = delivery.enqueue(rows.where(F.col("ts") > moment(MIDPOINT)), first, moment(MONTH_END))
    return first, second, decisions


NEW_SQL = (
    REQUESTS_SQL
    + f""", f AS (SELECT * FROM k WHERE ts > TIMESTAMP '{MIDPOINT}' AND key NOT IN (SELECT key FROM k WHERE ts <= TIMESTAMP '{MIDPOINT}')
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY event_id) = 1)
"""
)


@register(
    NEW_SQL
    + """SELECT key AS idempotency_key, kind AS notification_type, 'e' || event_id AS correlation_id, recipient AS recipient_ref,
  'teams' AS channel, 'pending' AS status, CASE WHEN kind <> 'report' THEN sha256('decision|' || key) END AS decision_id FROM f"""
)
def outbox_enqueue(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, second, _ = two_batches(spark, sf_dir)
    return second.select(
        "idempotency_key", "notification_type", "correlation_id", "recipient_ref", "channel", "status", "decision_id"
    )


@register(
    NEW_SQL
    + f"""SELECT sha256('decision|' || key) AS decision_id,
  CASE kind WHEN 'pr_review' THEN 'review_pr' WHEN 'model_promotion' THEN 'promote_model' ELSE 'ack_finops' END AS action_type,
  resource AS resource_ref, strftime(TIMESTAMP '{MONTH_END}' + INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS expires_at FROM f WHERE kind <> 'report'"""
)
def opened_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, decisions = two_batches(spark, sf_dir)
    return decisions.select("decision_id", "action_type", "resource_ref", stamp(F.col("expires_at")).alias("expires_at"))


@register(
    """SELECT 'pr_review' AS notification_type, 'e' || event_id AS correlation_id, 'https://git/pr/' || event_id AS resource_ref,
  'e' || event_id || ':contracts/' || event_type || '.yaml' AS resource_version,
  'Review: ' || substr(repeat(event_type || ' ', 20), 1, 72) AS title, 'user ' || user_id AS summary
FROM events WHERE event_type <> 'view'"""
)
def pr_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as results of proposed fixes; views were refused."""
    results = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "view", "rejected").otherwise("pr_opened").alias("status"),
        F.concat(F.lit("https://git/pr/"), "event_id").alias("pr_url"),
        F.concat(F.lit("e"), "event_id").alias("event_id"),
        F.repeat(F.concat("event_type", F.lit(" ")), 20).alias("root_cause"),
        F.concat(F.lit("contracts/"), "event_type", F.lit(".yaml")).alias("target_file"),
        F.concat(F.lit("user "), "user_id").alias("explanation"),
        F.lit("reviewer").alias("recipient_ref"),
        F.col("event_id").alias("arrival"),
    )
    return delivery.pr_requests(results).select(
        "notification_type", "correlation_id", "resource_ref", "resource_version",
        F.col("payload.title").alias("title"), F.col("payload.summary").alias("summary"),
    )


DECISIONS_SQL = f"""
WITH d AS (SELECT DISTINCT 'd' || user_id AS decision_id, 'user' || user_id AS resource_ref,
  CASE user_id % 4 WHEN 0 THEN 'review_pr' WHEN 1 THEN 'promote_model' WHEN 2 THEN 'ack_finops' ELSE 'other' END AS action_type,
  TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 HOUR * (user_id % 30) AS expires_at FROM events),
e AS (SELECT event_id, 'd' || user_id AS decision_id, ts, 'a' || (CAST(json_extract(props, '$.k') AS BIGINT) % 7) AS actor_id,
  CASE event_type WHEN 'purchase' THEN 'noted' WHEN 'click' THEN 'approved' WHEN 'signup' THEN 'approved' ELSE 'rejected' END AS verb,
  CASE WHEN event_type = 'view' THEN 'because' END AS reason, CAST(json_extract(props, '$.k') AS BIGINT) % 3 AS g FROM events),
j AS (SELECT e.*, action_type, expires_at, CASE WHEN verb = 'noted' THEN 'unknown_verb'
    WHEN NOT coalesce((action_type = 'review_pr' AND g IN (0, 2)) OR (action_type = 'promote_model' AND g = 1) OR (action_type = 'ack_finops' AND g = 2), false) THEN 'unauthorized'
    WHEN expires_at <= ts THEN 'expired' WHEN verb = 'rejected' AND reason IS NULL THEN 'reason_required' ELSE verb END AS outcome
  FROM e JOIN d USING (decision_id)),
w AS (SELECT * FROM j WHERE outcome IN ('approved', 'rejected', 'expired') QUALIFY row_number() OVER (PARTITION BY decision_id ORDER BY ts, event_id) = 1)
"""


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pending decision per user, each open for some hours of the month's first day."""
    n = F.col("user_id") % 4
    action = F.when(n == 0, "review_pr").when(n == 1, "promote_model").when(n == 2, "ack_finops").otherwise("other")
    start = moment("2024-01-01 00:00:00")
    return table(spark, sf_dir, "events").select("user_id").distinct().select(
        F.concat(F.lit("d"), "user_id").alias("decision_id"),
        F.concat(F.lit("user"), "user_id").alias("resource_ref"),
        action.alias("action_type"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("expected_state"),
        F.lit("pending").alias("status"),
        (start + F.make_dt_interval(hours=(F.col("user_id") % 30).cast("int"))).alias("expires_at"),
    )


def verbs(events: DataFrame) -> DataFrame:
    """Events as decision verbs of actors from three sets of groups."""
    k = F.get_json_object("props", "$.k").cast("long")
    verb = (
        F.when(F.col("event_type") == "purchase", "noted")
        .when(F.col("event_type").isin("click", "signup"), "approved")
        .otherwise("rejected")
    )
    groups = (
        F.when(k % 3 == 0, F.array(F.lit("reviewers")))
        .when(k % 3 == 1, F.array(F.lit("ml")))
        .otherwise(F.array(F.lit("finops"), F.lit("reviewers")))
    )
    return events.select(
        "event_id",
        F.concat(F.lit("d"), "user_id").alias("decision_id"),
        verb.alias("verb"),
        F.concat(F.lit("a"), k % 7).alias("actor_id"),
        groups.alias("actor_groups"),
        F.when(F.col("event_type") == "view", "because").alias("reason"),
        "ts",
    )


@register(DECISIONS_SQL + "SELECT event_id, decision_id, outcome FROM j")
def judged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = delivery.judge_events(decisions(spark, sf_dir), verbs(table(spark, sf_dir, "events")), POLICY)
    return judged.select("event_id", "decision_id", "outcome")


LEDGER_SQL = (
    DECISIONS_SQL
    + """SELECT decision_id, action_type, coalesce(w.outcome, 'pending') AS status, w.actor_id,
  CASE WHEN w.outcome <> 'expired' THEN w.reason END AS reason, strftime(w.ts, '%Y-%m-%d %H:%M:%S.%f') AS decided_at
FROM d LEFT JOIN (SELECT decision_id, outcome, actor_id, reason, ts FROM w) w USING (decision_id)"""
)


@register(LEDGER_SQL)
def decision_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = delivery.resolve_decisions(decisions(spark, sf_dir), verbs(table(spark, sf_dir, "events")), POLICY)
    return resolved.select(
        "decision_id", "action_type", "status", "actor_id", "reason", stamp(F.col("decided_at")).alias("decided_at")
    )


@register(
    DECISIONS_SQL
    + """SELECT decision_id, CASE WHEN w.outcome IS NULL AND expires_at <= TIMESTAMP '2024-01-01 20:00:00' THEN 'expired' ELSE coalesce(w.outcome, 'pending') END AS status,
  CASE WHEN w.outcome IS NULL AND expires_at <= TIMESTAMP '2024-01-01 20:00:00' THEN 'system:expiry' ELSE w.actor_id END AS actor_id
FROM d LEFT JOIN (SELECT decision_id, outcome, actor_id FROM w) w USING (decision_id)"""
)
def expired_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = delivery.resolve_decisions(decisions(spark, sf_dir), verbs(table(spark, sf_dir, "events")), POLICY)
    return delivery.expire_decisions(resolved, moment("2024-01-01 20:00:00")).select("decision_id", "status", "actor_id")


@register(
    DECISIONS_SQL
    + """SELECT sha256('application|' || decision_id) AS application_id, decision_id, 'user' || substr(decision_id, 2) AS resource_ref
FROM w JOIN d USING (decision_id) WHERE outcome = 'approved' AND d.action_type = 'promote_model' AND w.ts > TIMESTAMP '2024-01-01 06:00:00'"""
)
def new_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications of the whole month beyond those of its first six hours."""
    ledger, events = decisions(spark, sf_dir), verbs(table(spark, sf_dir, "events"))
    early = delivery.resolve_decisions(ledger, events.where(F.col("ts") <= moment("2024-01-01 06:00:00")), POLICY)
    existing = delivery.applications(early, spark.createDataFrame([], "decision_id string"))
    fresh = delivery.applications(delivery.resolve_decisions(ledger, events, POLICY), existing)
    return fresh.select("application_id", "decision_id", "resource_ref")


OUTCOME_SQL = f"""
WITH a AS (SELECT user_id, event_id, ts, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
o AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, CASE WHEN k < 20 THEN 'delivered'
    WHEN k < 70 THEN 'transient' WHEN k < 80 THEN 'permanent' WHEN ts + INTERVAL 120 SECOND <= TIMESTAMP '{MONTH_END}' THEN 'transient' ELSE 'open' END AS r FROM a),
s AS (SELECT user_id, min(n) FILTER (r <> 'transient') AS stop, max(n) AS tries, arg_min(r, n) FILTER (r <> 'transient') AS r FROM o WHERE n <= 3 GROUP BY 1),
f AS (SELECT 'n' || user_id AS notification_id, CASE WHEN r = 'delivered' THEN 'delivered' WHEN r = 'open' THEN 'delivering'
    WHEN r = 'permanent' OR tries >= 3 THEN 'failed' ELSE 'retryable' END AS status, CAST(coalesce(stop, tries) AS BIGINT) AS attempt_count FROM s
  UNION ALL SELECT DISTINCT 'c' || conv_id, 'pending', CAST(0 AS BIGINT) FROM conversations)
"""


def outcome_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as notifications with their events as attempts; conversations were never tried."""
    k = F.get_json_object("props", "$.k").cast("long")
    events = table(spark, sf_dir, "events")
    code = (
        F.when(k < 20, 200).when(k < 40, 408).when(k < 55, 429).when(k < 70, 503).when(k < 80, 404)
    )  # NULL above: still open
    attempts = events.select(
        F.concat(F.lit("n"), "user_id").alias("notification_id"),
        F.col("event_id").alias("attempt_id"),
        F.col("ts").alias("started_at"),
        code.alias("code"),
    )
    tried = events.select(F.concat(F.lit("n"), "user_id").alias("notification_id")).distinct()
    untried = table(spark, sf_dir, "conversations").select(F.concat(F.lit("c"), "conv_id").alias("notification_id")).distinct()
    notifications = tried.unionByName(untried).select(
        "notification_id",
        F.concat(F.lit("to-"), "notification_id").alias("recipient_ref"),
        F.create_map(F.lit("title"), F.col("notification_id")).alias("payload"),
    )
    return delivery.delivery_outcomes(notifications, attempts, moment(MONTH_END))


@register(OUTCOME_SQL + "SELECT notification_id, status, attempt_count FROM f")
def delivery_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome_rows(spark, sf_dir).select("notification_id", "status", "attempt_count")


@register(OUTCOME_SQL + "SELECT notification_id, status FROM f WHERE status IN ('pending', 'retryable')")
def dispatchable_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.dispatchable(outcome_rows(spark, sf_dir)).select("notification_id", "status")


@register(
    OUTCOME_SQL
    + """SELECT notification_id, 'to-' || notification_id AS recipient_ref, 'outlook' AS channel, notification_id AS title, 'Delivery failed.' AS summary
FROM f WHERE status = 'failed'"""
)
def fallback_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.fallback_messages(outcome_rows(spark, sf_dir))


PROMOTION_SQL = """
WITH RECURSIVE p AS (SELECT p_partkey, p_brand, CAST(p_size % 4 AS VARCHAR) AS expected, CAST((p_size + p_partkey) % 4 AS VARCHAR) AS approved,
  row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part WHERE p_type <> 'SMALL'),
s AS (SELECT p_brand, CAST(0 AS BIGINT) AS n, CAST(min(p_size) % 4 AS VARCHAR) AS version, CAST(NULL AS BIGINT) AS p_partkey, CAST(NULL AS VARCHAR) AS status
  FROM part GROUP BY 1
  UNION ALL
  SELECT s.p_brand, p.n, CASE WHEN s.version = p.expected THEN p.approved ELSE s.version END, p.p_partkey,
    CASE WHEN s.version = p.expected THEN 'applied' ELSE 'stale_precondition' END
  FROM s JOIN p ON s.p_brand = p.p_brand AND p.n = s.n + 1)
"""


def promotion_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parts as applications to their brand's alias; small parts ask for another action."""
    part = table(spark, sf_dir, "part")
    pending = part.select(
        F.concat(F.lit("a"), "p_partkey").alias("application_id"),
        F.when(F.col("p_type") == "SMALL", "review_pr").otherwise("promote_model").alias("action_type"),
        F.lit("pending").alias("status"),
        F.lit(0).alias("attempt_count"),
        F.col("p_brand").alias("model_name"),
        F.lit("champion").alias("alias"),
        (F.col("p_size") % 4).cast("string").alias("current_version"),
        ((F.col("p_size") + F.col("p_partkey")) % 4).cast("string").alias("approved_version"),
        F.col("p_partkey").alias("arrival"),
    )
    aliases = part.groupBy(F.col("p_brand").alias("model_name")).agg((F.min("p_size") % 4).cast("string").alias("version"))
    return pending, aliases.withColumn("alias", F.lit("champion"))


@register(
    PROMOTION_SQL
    + "SELECT 'a' || p_partkey AS application_id, p_brand AS model_name, status, CAST(1 AS BIGINT) AS attempt_count, version FROM s WHERE n > 0"
)
def model_promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending, aliases = promotion_rows(spark, sf_dir)
    outcome = promotion.apply_promotions(pending, aliases)
    return outcome.select("application_id", "model_name", "status", "attempt_count", "version")


@register(PROMOTION_SQL + "SELECT p_brand AS model_name, 'champion' AS alias, arg_max(version, n) AS version FROM s GROUP BY 1")
def promoted_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending, aliases = promotion_rows(spark, sf_dir)
    outcome = promotion.apply_promotions(pending, aliases)
    arrivals = pending.select("application_id", "arrival")
    return promotion.promoted_aliases(aliases, outcome.join(arrivals, "application_id"))
