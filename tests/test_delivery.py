import hashlib
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from siltstone.functions.delivery import notification_key, send_outcome
from siltstone.operators import delivery, promotion

POLICY = {"review_pr": ["reviewers"], "promote_model": ["ml"]}


def ts(text):
    return F.lit(text).cast("timestamp")


def ledger(spark, *rows):
    df = spark.createDataFrame(list(rows), "decision_id string, action_type string, expires_at string")
    return df.select(
        "decision_id", "action_type", F.lit("r").alias("resource_ref"),
        F.create_map(F.lit("alias"), F.lit("champion")).alias("expected_state"),
        F.lit("pending").alias("status"), F.col("expires_at").cast("timestamp").alias("expires_at"),
    )


def events(spark, *rows):
    schema = "event_id int, decision_id string, verb string, actor_id string, actor_groups array<string>, reason string, ts string"
    return spark.createDataFrame(list(rows), schema).withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.mark.parametrize(
    ("changes", "status", "actor"),
    [
        ([("approved", ["reviewers"], None, "10:00"), ("rejected", ["reviewers"], "late", "10:01")], "approved", "a0"),
        ([("approved", ["others"], None, "10:00")], "pending", None),
        ([("approved", None, None, "10:00")], "pending", None),
        ([("rejected", ["reviewers"], None, "10:00"), ("rejected", ["reviewers"], "no", "10:01")], "rejected", "a1"),
        ([("approved", ["reviewers"], None, "12:00")], "expired", "a0"),
        ([("rejected", ["reviewers"], None, "12:30")], "expired", "a0"),
        ([("noted", ["reviewers"], None, "10:00"), ("expired", ["reviewers"], None, "10:00")], "pending", None),
    ],
)
def test_decisions(spark, changes, status, actor):
    decisions = ledger(spark, ("d", "review_pr", "2026-01-01 12:00:00"))
    rows = [(i, "d", v, f"a{i}", g, r, f"2026-01-01 {t}:00") for i, (v, g, r, t) in enumerate(changes)]
    got = delivery.resolve_decisions(decisions, events(spark, *rows), POLICY).first()
    assert (got["status"], got["actor_id"]) == (status, actor)


def test_no_policy_denies(spark):
    decisions = ledger(spark, ("d", "review_pr", "2026-01-01 12:00:00"))
    rows = events(spark, (0, "d", "approved", "a", ["reviewers"], None, "2026-01-01 10:00:00"))
    assert delivery.resolve_decisions(decisions, rows, {}).first()["status"] == "pending"


def test_expiry_and_applications(spark):
    decisions = ledger(spark, ("d1", "promote_model", "2026-01-01 12:00:00"), ("d2", "review_pr", "2026-01-01 09:00:00"))
    rows = events(spark, (0, "d1", "approved", "a", ["ml"], None, "2026-01-01 10:00:00"))
    resolved = delivery.resolve_decisions(decisions, rows, POLICY)
    expired = delivery.expire_decisions(resolved, ts("2026-01-01 09:00:00"))
    assert {r["decision_id"]: (r["status"], r["actor_id"]) for r in expired.collect()} == {
        "d1": ("approved", "a"), "d2": ("expired", "system:expiry"),
    }
    nothing = spark.createDataFrame([], "decision_id string")
    made = delivery.applications(expired, nothing)
    assert made.count() == 1 and made.first()["expected_state"] == {"alias": "champion"}
    assert delivery.applications(expired, made).count() == 0


def test_keys(spark):
    parts = ["pr_review", "r", "v", "u", "teams"]
    df = spark.createDataFrame([tuple(parts)], "a string, b string, c string, d string, e string")
    key = df.select(notification_key(*[F.col(c) for c in "abcde"])).first()[0]
    assert key == hashlib.sha256("|".join(parts).encode()).hexdigest()
    with pytest.raises(Exception, match="key part is null"):
        df.select(notification_key(F.lit(None).cast("string"), *[F.col(c) for c in "bcde"])).collect()


def test_enqueue_is_idempotent(spark):
    requests = spark.createDataFrame(
        [("pr_review", "c1", "r", "v1", "u", 0), ("pr_review", "c2", "r", "v1", "u", 1), ("report", "c3", "r", "v1", "u", 2)],
        "notification_type string, correlation_id string, resource_ref string, resource_version string, recipient_ref string, arrival int",
    ).withColumn("payload", F.create_map(F.lit("title"), F.lit("t"))).withColumn("expected_state", F.col("payload"))
    nothing = spark.createDataFrame([], "idempotency_key string")
    now = ts("2026-01-01 00:00:00")
    made, opened = delivery.enqueue(requests, nothing, now)
    assert {(r["correlation_id"], r["decision_id"] is None) for r in made.collect()} == {("c1", False), ("c3", True)}
    assert [(r["action_type"], str(r["expires_at"])) for r in opened.collect()] == [("review_pr", "2026-01-02 00:00:00")]
    again, reopened = delivery.enqueue(requests, made, now)
    assert again.count() == 0 and reopened.count() == 0


@pytest.mark.parametrize(
    ("codes", "status", "count", "fallback"),
    [
        ([200, 500], "delivered", 1, False),
        ([503], "retryable", 1, False),
        ([429, 408, 200], "delivered", 3, False),
        ([500, 500, 500, 200], "failed", 3, True),
        ([404, 200], "failed", 1, True),
        ([], "pending", 0, False),
        ([None], "delivering", 1, False),
        ([(None, "old")], "retryable", 1, False),
    ],
)
def test_outcomes(spark, codes, status, count, fallback):
    attempts = [
        ("n", i, f"2026-01-01 {'08' if isinstance(c, tuple) else '10'}:0{i}:00", None if isinstance(c, tuple) else c)
        for i, c in enumerate(codes)
    ]
    df = spark.createDataFrame(attempts, "notification_id string, attempt_id int, started_at string, code int")
    df = df.withColumn("started_at", F.col("started_at").cast("timestamp"))
    notes = spark.createDataFrame([("n", "u", {"title": "T"})], "notification_id string, recipient_ref string, payload map<string,string>")
    got = delivery.delivery_outcomes(notes, df, ts("2026-01-01 10:01:00"))
    row = got.first()
    assert (row["status"], row["attempt_count"], row["fallback"]) == (status, count, fallback)
    assert delivery.fallback_messages(got).count() == int(fallback)


def test_send_codes(spark):
    df = spark.createDataFrame([(c,) for c in (200, 301, 400, 404, 408, 429, 499, 500, 503)], "c int")
    got = [r[0] for r in df.select(send_outcome(F.col("c"))).collect()]
    assert got == ["delivered"] * 2 + ["permanent"] * 2 + ["transient"] * 2 + ["permanent"] + ["transient"] * 2


def test_promotions_match_a_sequential_run(spark):
    rnd = random.Random(8)
    pending = []
    for i in range(400):
        model = "hot" if i % 3 else f"m{rnd.randrange(4)}"
        expected = rnd.choice(["1", "2", "3", None])
        pending.append((f"a{i}", "promote_model", "pending", 0, model, "champion", expected, rnd.choice("123"), i))
    pending.append(("other", "review_pr", "pending", 0, "hot", "champion", "1", "2", 0))
    schema = (
        "application_id string, action_type string, status string, attempt_count int, model_name string, alias string, "
        "current_version string, approved_version string, arrival int"
    )
    start = {"hot": "1", "m0": "2", "m1": "3"}  # m2 and m3 have no version yet
    aliases = spark.createDataFrame([(m, "champion", v) for m, v in start.items()], "model_name string, alias string, version string")
    df = spark.createDataFrame(pending, schema).repartition(3)
    got = promotion.apply_promotions(df, aliases, partitions=7)
    state, expected = dict(start), {}
    for app, action, *_, model, _, wanted, approved, _ in sorted(pending, key=lambda r: r[-1]):
        if action != "promote_model":
            continue
        if state.get(model) == wanted:
            state[model] = approved
            expected[app] = ("applied", approved)
        else:
            expected[app] = ("stale_precondition", state.get(model))
    assert {r["application_id"]: (r["status"], r["version"]) for r in got.collect()} == expected
    after = promotion.promoted_aliases(aliases, got.join(df.select("application_id", "arrival"), "application_id"))
    assert {r["model_name"]: r["version"] for r in after.collect()} == state


def test_a_busy_alias_is_worked_off_in_a_tree(spark):
    assert promotion._compose(  # a moves to c through b, d stays behind the swap of the second node
        pd.DataFrame([(2, "m", "x", ["a"], ["b"]), (3, "m", "x", ["b", "d"], ["c", "a"])], columns=["node", "model_name", "alias", "befores", "afters"])
    ).iloc[0].tolist() == [1, "m", "x", ["b", "d", "a"], ["c", "a", "c"]]
    n = 30_000
    rows = spark.range(n).select(
        F.concat(F.lit("a"), "id").alias("application_id"), F.lit("promote_model").alias("action_type"), F.lit("pending").alias("status"),
        F.lit(0).alias("attempt_count"), F.lit("hot").alias("model_name"), F.lit("champion").alias("alias"),
        (F.col("id") % 5).cast("string").alias("current_version"), ((F.col("id") * 7 + 3) % 5).cast("string").alias("approved_version"), F.col("id").alias("arrival"),
    )
    aliases = spark.createDataFrame([("hot", "champion", "0")], "model_name string, alias string, version string")
    version, expected = "0", {}
    for i in range(n):
        if version == str(i % 5):
            version = str((i * 7 + 3) % 5)
            expected[f"a{i}"] = ("applied", version)
        else:
            expected[f"a{i}"] = ("stale_precondition", version)
    got = promotion.apply_promotions(rows, aliases, partitions=64).collect()
    assert len(got) == n and {r["application_id"]: (r["status"], r["version"]) for r in got} == expected


def test_pr_requests(spark):
    rows = [("pr_opened", "u", "e1", "x" * 100, "f", "because", "me", 0), ("rejected", "u", "e2", "c", "f", "b", "me", 1)]
    results = spark.createDataFrame(
        rows,
        "status string, pr_url string, event_id string, root_cause string, target_file string, explanation string, recipient_ref string, arrival int",
    )
    made = delivery.pr_requests(results).collect()
    assert len(made) == 1 and made[0]["payload"]["title"] == "Review: " + "x" * 72
    assert made[0]["resource_version"] == "e1:f"
