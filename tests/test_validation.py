import pytest
from pyspark.sql import functions as F

from siltstone.functions.gates import freshness
from siltstone.operators import gold, metrics, telemetry, validation
from siltstone.plans.declared import METRICS

NOW = "2026-08-01 00:00:00"
SCHEMA = (
    "capability_id string, gate string, status string, reason_code string, environment string, commit_sha string, "
    "started_at string, finished_at string, expires_at string"
)
CODE = ["unit", "contract", "lint", "local_integration"]


def moment(text):
    return F.lit(text).cast("timestamp")


def evidence(spark, *rows):
    full = [
        (
            r.get("capability_id", "CAP-01"), r["gate"], r.get("status", "PASS"), r.get("reason_code"), "local",
            r.get("commit_sha", "abc"), "2026-07-01 00:00:00", r.get("finished_at", "2026-07-01 00:01:00"), r.get("expires_at"),
        )
        for r in rows
    ]
    df = spark.createDataFrame(full, SCHEMA)
    for column in ("started_at", "finished_at", "expires_at"):
        df = df.withColumn(column, F.col(column).cast("timestamp"))
    return df


def capability(spark, required):
    return spark.createDataFrame(
        [("CAP-01", "n", "o", required)], "capability_id string, name string, owner string, required_gates array<string>"
    )


def gates(*names, **extra):
    return [{"gate": n, **extra} for n in names]


@pytest.mark.parametrize(
    ("required", "records", "level"),
    [
        (CODE, gates("unit", "contract", "lint"), "Implemented"),
        (CODE, gates("unit", "contract"), "Not Validated"),
        (CODE, gates(*CODE), "Operationally Complete"),
        ([*CODE, "external_smoke"], gates(*CODE), "Locally Validated"),
        ([*CODE, "external_smoke"], gates(*CODE) + gates("external_smoke", expires_at="2026-07-15 00:00:00"), "Locally Validated"),
        ([*CODE, "external_smoke"], gates(*CODE) + gates("external_smoke", expires_at=NOW), "Operationally Complete"),
        ([*CODE, "recovery"], gates(*CODE), "Infrastructure Validated"),
        (CODE, gates(*CODE, commit_sha="old"), "Not Validated"),
        (CODE, gates(*CODE, status="SKIP_WITH_REASON", reason_code="TIMEOUT"), "Not Validated"),
        (["dagbag"], gates("dagbag"), "Not Validated"),
        (CODE, gates(*CODE, capability_id="CAP-02"), "Not Validated"),
    ],
)
def test_maturity(spark, required, records, level):
    caps, found = capability(spark, required), evidence(spark, *records)
    assert validation.maturity(caps, found, moment(NOW), "abc").first()["maturity"] == level


def test_report_keeps_capabilities_without_evidence(spark):
    caps = capability(spark, CODE).unionByName(capability(spark, CODE).withColumn("capability_id", F.lit("CAP-09")))
    found = evidence(spark, *gates("unit", "lint"))
    report = validation.validation_report(caps, found, moment(NOW), "abc")
    assert sorted((r["capability_id"], r["gate"]) for r in report.where("gate is not null").collect()) == [
        ("CAP-01", "lint"), ("CAP-01", "unit"),
    ]
    assert report.where("gate is null").first()["capability_id"] == "CAP-09"
    summary = validation.report_summary(caps, found, moment(NOW), "abc").collect()
    assert {r["capability_id"]: r["evidence_count"] for r in summary} == {"CAP-01": 2, "CAP-09": 0}


@pytest.mark.parametrize(
    ("record", "broken"),
    [
        ({"gate": "unit"}, []),
        ({"gate": "unit", "reason_code": "TIMEOUT"}, ["pass_with_reason"]),
        ({"gate": "unit", "status": "FAIL"}, ["reason_required"]),
        ({"gate": "unit", "status": "FAIL", "reason_code": "NOPE"}, ["unknown_reason_code"]),
        ({"gate": "external_smoke"}, ["external_pass_without_expiry"]),
        ({"gate": "unit", "finished_at": "2026-06-01 00:00:00"}, ["finished_before_started"]),
        ({"gate": "party", "capability_id": "CAP-11"}, ["invalid_capability_id", "unknown_gate"]),
    ],
)
def test_evidence_rules(spark, record, broken):
    assert evidence(spark, record).select(validation.evidence_violations()).first()[0] == broken


def test_reconcile(spark):
    schema = "metric string, value double"
    expected = spark.createDataFrame([("a", 100.0), ("b", 1.0)], schema)
    actual = spark.createDataFrame([("a", 100.4), ("extra", 5.0)], schema)
    got = {r["metric"]: r["status"] for r in validation.reconcile(expected, actual, 0.5).collect()}
    assert got == {"a": "PASS", "b": "FAIL"}
    assert validation.reconcile(expected, actual).first()["status"] == "FAIL"


def test_counters(spark):
    points = spark.sql(
        "select 'c' name, 2.0D amount, map('domain', 'a', 'result', 'ok') attributes "
        "union all select 'c', 3.0D, map('result', 'ok', 'domain', 'a') "
        "union all select 'c', 1.0D, map('user_id', 'x') union all select 'c', -1.0D, map('domain', 'a')"
    )
    accepted, refused = telemetry.split_points(points)
    assert [r["amount"] for r in telemetry.counter_rollup(accepted).collect()] == [5.0]
    assert sorted(r["violation"] for r in refused.collect()) == ["negative_amount", "unbounded_attributes:user_id"]


def test_freshness_and_views(spark, rows):
    df = spark.createDataFrame([("2026-07-31 23:44:59",), ("2026-07-31 23:45:00",), (None,)], "at string")
    labels = df.select(freshness(F.col("at").cast("timestamp"), moment(NOW)))
    assert [r[0] for r in labels.collect()] == ["STALE", "FRESH", "FRESH"]
    market = spark.createDataFrame([("d1", "b3", 10.0, "w"), ("d2", "b3", 5.0, "w")], "event_date string, source_class string, total_value double, source_watermark string")
    lost = spark.createDataFrame([("d1", 1.0), ("d1", 2.0)], "event_date string, lost_value double")
    cost = spark.createDataFrame([("d1", 7.0), ("d1", 8.0)], "usage_date string, consumption double")
    assert gold.executive_view(market, lost, cost).count() == 5
    daily = gold.executive_view_daily(market, lost, cost)
    assert rows(daily, "event_date", "lost_value", "consumption") == [("d1", 3.0, 15.0), ("d2", None, None)]


def test_failure_metric_ignores_case(spark):
    health = spark.createDataFrame([("c", "t", "FAIL"), ("c", "t", "fail"), ("c", "t", "PASS")], "capability_id string, observed_at string, result string")
    spec = METRICS["platform_quality_failures"]
    assert metrics.metric(health, spec).first()[spec.metric_id] == 2
