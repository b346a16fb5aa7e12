"""Counters, evidence rules, maturity, reports and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import telemetry, validation
from siltstone.plans.queries import MIDPOINT, moment, register, stamp, table

POINTS_SQL = """
WITH p AS (SELECT event_id, ts, 'records_total' AS name, CASE WHEN value > 400 THEN -value ELSE value END AS amount, event_type AS domain,
  CASE WHEN event_type = 'error' THEN 'fail' ELSE 'ok' END AS result, user_id % 4 AS u, user_id % 20 = 0 AS bad FROM events)
"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as counter points: large values are negative, some users add an attribute of their own."""
    result = F.when(F.col("event_type") == "error", "fail").otherwise("ok")
    gate = F.concat(F.lit("g"), F.col("user_id") % 4)
    known = F.create_map(F.lit("result"), result, F.lit("domain"), F.col("event_type"), F.lit("gate"), gate)
    reordered = F.create_map(F.lit("gate"), gate, F.lit("domain"), F.col("event_type"), F.lit("result"), result)
    own = F.create_map(F.lit("user"), F.col("user_id").cast("string"), F.lit("result"), result)
    attributes = F.when(F.col("user_id") % 20 == 0, own).when(F.col("event_id") % 2 == 0, known).otherwise(reordered)
    return table(spark, sf_dir, "events").select(
        "event_id", "ts",
        F.lit("records_total").alias("name"),
        F.when(F.col("value") > 400, -F.col("value")).otherwise(F.col("value")).alias("amount"),
        attributes.alias("attributes"),
    )


@register(
    POINTS_SQL
    + """SELECT name, 'domain=' || domain || ',gate=g' || u || ',result=' || result AS attributes, round(sum(amount), 6) AS amount
FROM p WHERE amount >= 0 AND NOT bad GROUP BY 1, 2"""
)
def counter_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = telemetry.split_points(points(spark, sf_dir))
    text = F.array_join(F.transform("attributes", lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return telemetry.counter_rollup(accepted).select("name", text.alias("attributes"), F.round("amount", 6).alias("amount"))


@register(
    POINTS_SQL
    + """SELECT event_id, CASE WHEN amount < 0 THEN 'negative_amount' ELSE 'unbounded_attributes:user' END AS violation FROM p WHERE amount < 0 OR bad"""
)
def refused_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, refused = telemetry.split_points(points(spark, sf_dir))
    return refused.select("event_id", "violation")


@register(
    """SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S.%f') AS window_start, event_type AS domain,
  CASE WHEN event_type = 'error' THEN 'fail' ELSE 'ok' END AS result, round(sum(value) / 300, 6) AS rate FROM events GROUP BY 1, 2, 3"""
)
def counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "ts",
        F.col("event_type").alias("domain"),
        F.when(F.col("event_type") == "error", "fail").otherwise("ok").alias("result"),
        F.col("value").alias("amount"),
    )
    rates = telemetry.rate(rows, ["domain", "result"])
    return rates.select(
        stamp(F.col("window_start")).alias("window_start"), "domain", "result", F.round("rate", 6).alias("rate")
    )


EVIDENCE_SQL = f"""
WITH b AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
e AS (SELECT event_id, 'CAP-' || lpad(CAST(user_id % 11 AS VARCHAR), 2, '0') AS capability_id,
  ['unit', 'contract', 'lint', 'dagbag', 'local_integration', 'external_smoke', 'recovery', 'alert', 'runbook', 'party'][k % 10 + 1] AS gate,
  CASE WHEN value > 90 THEN 'MAYBE' WHEN event_type = 'error' THEN 'FAIL' WHEN event_type = 'view' AND value > 10 THEN 'SKIP_WITH_REASON' ELSE 'PASS' END AS status,
  CASE WHEN event_type = 'error' AND k < 50 THEN 'TIMEOUT' WHEN event_type = 'error' AND k < 80 THEN 'OTHER' WHEN event_type = 'view' AND value > 5 THEN 'EXTERNAL_DISABLED' END AS reason_code,
  'local' AS environment, CASE WHEN user_id % 3 = 0 THEN 'old' ELSE 'abc' END AS commit_sha, ts AS started_at,
  CASE WHEN k = 7 THEN ts - INTERVAL 1 MINUTE ELSE ts + INTERVAL 1 MINUTE END AS finished_at,
  CASE WHEN k % 4 = 0 THEN ts + INTERVAL 5 DAY WHEN event_type = 'signup' THEN ts + INTERVAL 60 DAY END AS expires_at FROM b)
"""


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as evidence records, with every kind of broken rule among them."""
    k = F.get_json_object("props", "$.k").cast("long")
    gates = F.array(*[F.lit(g) for g in (*validation.GATES, "party")])
    kind, value = F.col("event_type"), F.col("value")
    status = (
        F.when(value > 90, "MAYBE")
        .when(kind == "error", "FAIL")
        .when((kind == "view") & (value > 10), "SKIP_WITH_REASON")
        .otherwise("PASS")
    )
    reason = (
        F.when((kind == "error") & (k < 50), "TIMEOUT")
        .when((kind == "error") & (k < 80), "OTHER")
        .when((kind == "view") & (value > 5), "EXTERNAL_DISABLED")
    )

    def after(**amounts):
        return F.col("ts") + F.make_dt_interval(**{n: F.lit(a) for n, a in amounts.items()})

    return table(spark, sf_dir, "events").select(
        "event_id",
        F.format_string("CAP-%02d", (F.col("user_id") % 11).cast("int")).alias("capability_id"),
        F.element_at(gates, (k % 10 + 1).cast("int")).alias("gate"),
        status.alias("status"),
        reason.alias("reason_code"),
        F.lit("local").alias("environment"),
        F.when(F.col("user_id") % 3 == 0, "old").otherwise("abc").alias("commit_sha"),
        F.col("ts").alias("started_at"),
        F.when(k == 7, after(mins=-1)).otherwise(after(mins=1)).alias("finished_at"),
        F.when(k % 4 == 0, after(days=5)).when(kind == "signup", after(days=60)).alias("expires_at"),
        F.array(F.concat(F.lit("log-"), "event_id")).alias("artifact_refs"),
    )


@register(
    EVIDENCE_SQL
    + """SELECT event_id, concat_ws(',', CASE WHEN NOT regexp_matches(capability_id, '^CAP-(0[1-9]|10)$') THEN 'invalid_capability_id' END,
  CASE WHEN gate = 'party' THEN 'unknown_gate' END, CASE WHEN status = 'MAYBE' THEN 'unknown_status' END,
  CASE WHEN status = 'PASS' AND reason_code IS NOT NULL THEN 'pass_with_reason' END,
  CASE WHEN status <> 'PASS' AND reason_code IS NULL THEN 'reason_required' END, CASE WHEN reason_code = 'OTHER' THEN 'unknown_reason_code' END,
  CASE WHEN gate = 'external_smoke' AND status = 'PASS' AND expires_at IS NULL THEN 'external_pass_without_expiry' END,
  CASE WHEN finished_at < started_at THEN 'finished_before_started' END) AS violations FROM e"""
)
def evidence_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.array_join(validation.evidence_violations(), ",")
    return evidence(spark, sf_dir).select("event_id", found.alias("violations"))


def capabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One capability per user number modulo 12: odd ones need recovery gates, even ones an external
    smoke test, every third one asks for no code gate. Number 11 has no evidence."""
    n = F.col("n")
    base = F.array(F.lit("unit"), F.lit("contract"), F.lit("lint"), F.lit("local_integration"))
    required = F.when(n % 3 == 0, F.array(F.lit("dagbag"), F.lit("alert"))).when(
        n % 2 == 1, F.concat(base, F.array(F.lit("recovery"), F.lit("alert"), F.lit("runbook")))
    ).otherwise(F.concat(base, F.array(F.lit("external_smoke"))))
    numbers = table(spark, sf_dir, "events").select((F.col("user_id") % 12).cast("int").alias("n")).distinct()
    return numbers.select(
        F.format_string("CAP-%02d", n).alias("capability_id"),
        F.concat(F.lit("capability "), n).alias("name"),
        F.concat(F.lit("team "), n % 4).alias("owner"),
        required.alias("required_gates"),
    )


MATURITY_SQL = (
    EVIDENCE_SQL
    + f""", c AS (SELECT DISTINCT user_id % 12 AS n FROM events),
cap AS (SELECT 'CAP-' || lpad(CAST(n AS VARCHAR), 2, '0') AS capability_id, 'capability ' || n AS name, 'team ' || (n % 4) AS owner,
  CASE WHEN n % 3 = 0 THEN ['dagbag', 'alert'] WHEN n % 2 = 1 THEN ['unit', 'contract', 'lint', 'local_integration', 'recovery', 'alert', 'runbook']
    ELSE ['unit', 'contract', 'lint', 'local_integration', 'external_smoke'] END AS req FROM c),
g AS (SELECT capability_id, list(DISTINCT gate) AS passed FROM e WHERE status = 'PASS' AND commit_sha = 'abc'
  AND regexp_matches(capability_id, '^CAP-(0[1-9]|10)$') AND gate <> 'party' AND reason_code IS NULL
  AND NOT (gate = 'external_smoke' AND expires_at IS NULL) AND finished_at >= started_at
  AND (expires_at IS NULL OR expires_at >= TIMESTAMP '{MIDPOINT}') GROUP BY 1),
m AS (SELECT cap.*, coalesce(passed, []::VARCHAR[]) AS passed FROM cap LEFT JOIN g USING (capability_id)),
r AS (SELECT capability_id, name, owner, CASE
  WHEN NOT list_has_any(req, ['unit', 'contract', 'lint']) OR NOT list_has_all(passed, list_intersect(req, ['unit', 'contract', 'lint'])) THEN 'Not Validated'
  WHEN NOT list_has_all(passed, list_intersect(req, ['local_integration'])) THEN 'Implemented'
  WHEN NOT list_has_all(passed, list_intersect(req, ['external_smoke'])) THEN 'Locally Validated'
  WHEN NOT list_has_all(passed, list_intersect(req, ['recovery', 'alert', 'runbook'])) THEN 'Infrastructure Validated'
  ELSE 'Operationally Complete' END AS maturity FROM m)
"""
)


@register(
    MATURITY_SQL
    + """SELECT capability_id, name, owner, maturity, CAST(count(event_id) AS BIGINT) AS evidence_count
FROM r LEFT JOIN e USING (capability_id) GROUP BY ALL"""
)
def maturity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.report_summary(capabilities(spark, sf_dir), evidence(spark, sf_dir), moment(MIDPOINT), "abc")


@register(MATURITY_SQL + "SELECT capability_id, name, owner, maturity, event_id, gate, status, reason_code FROM r LEFT JOIN e USING (capability_id)")
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = validation.validation_report(capabilities(spark, sf_dir), evidence(spark, sf_dir), moment(MIDPOINT), "abc")
    return report.select("capability_id", "name", "owner", "maturity", "event_id", "gate", "status", "reason_code")


@register(
    """SELECT 'CAP-' || lpad(CAST(user_id % 10 + 1 AS VARCHAR), 2, '0') AS capability_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS reason_code,
  round(sum(value), 6) AS failures FROM events WHERE event_type = 'error' GROUP BY 1, 2"""
)
def validation_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed points per capability and reason."""
    rows = table(spark, sf_dir, "events").select(
        F.format_string("CAP-%02d", (F.col("user_id") % 10 + 1).cast("int")).alias("capability_id"),
        F.get_json_object("props", "$.k").alias("reason_code"),
        F.when(F.col("event_type") == "error", "FAIL").otherwise("ok").alias("result"),
        F.col("value").alias("amount"),
    )
    return telemetry.failures_by(rows).withColumn("failures", F.round("failures", 6))


@register(
    """WITH x AS (SELECT 'order-' || o_orderkey AS metric, o_totalprice AS v FROM orders),
a AS (SELECT 'order-' || l_orderkey AS metric, sum(l_extendedprice) AS v FROM lineitem GROUP BY 1)
SELECT metric, round(x.v, 2) AS expected, round(a.v, 2) AS actual, round(a.v - x.v, 2) AS delta,
  CASE WHEN abs(a.v - x.v) <= 50000 THEN 'PASS' ELSE 'FAIL' END AS status FROM x LEFT JOIN a USING (metric)"""
)
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals against the sums of their lines."""
    expected = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("order-"), "o_orderkey").alias("metric"), F.col("o_totalprice").alias("value")
    )
    actual = table(spark, sf_dir, "lineitem").groupBy(F.concat(F.lit("order-"), "l_orderkey").alias("metric")).agg(
        F.sum("l_extendedprice").alias("value")
    )
    rounded = validation.reconcile(expected, actual, 50_000.0)
    return rounded.select("metric", *[F.round(c, 2).alias(c) for c in ("expected", "actual", "delta")], "status")
