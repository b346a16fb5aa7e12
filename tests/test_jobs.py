import json

import pytest
from pyspark.sql import functions as F

from siltstone.plans import jobs
from siltstone.sources import lake


def at(text):
    return F.lit(text).cast("timestamp")


def drop(base, ds, *sales):
    folder = base / f"ds={ds}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [
        json.dumps({"opportunity_id": k, "account_name": "a", "lost_reason": "r", "estimated_value": v, "lost_at": ds})
        for k, v in sales
    ]
    (folder / "part.json").write_text("\n".join(lines))


def test_drop_to_failure_feed(spark, tmp_path, rows):
    place, base, source = jobs.Lake(str(tmp_path / "lake")), tmp_path / "raw", "crm_lost_sales"
    drop(base, "2026-07-31", ("o1", 1.0), ("o2", 2.0), ("bad", -1.0))
    drop(base, "2026-08-01", ("o1", 5.0), (None, 1.0))
    for ds in ("2026-07-31", "2026-08-01", "2026-08-02"):
        for _ in range(2):  # every job runs twice
            jobs.ingest_drop(spark, place, source, str(base), ds, at(f"{ds} 10:00:00"))
            jobs.promote_to_silver(spark, place, source, at(f"{ds} 11:00:00"), buckets=4)
    silver = spark.read.parquet(place.silver(source))
    assert rows(silver, "opportunity_id", "estimated_value") == [("o1", 5.0), ("o2", 2.0)]

    feed = jobs.collect_failures(spark, place)
    assert sorted(r["detail"] for r in feed.collect()) == ["constraint_violation:estimated_value", "null_violation:opportunity_id"]
    jobs.acknowledge_failures(spark, place, feed, at("2026-08-03 00:00:00"))
    assert jobs.collect_failures(spark, place).count() == 0


def test_failures_written_late_or_at_the_same_instant_are_handed_out(spark, tmp_path):
    place, base, source = jobs.Lake(str(tmp_path / "lake")), tmp_path / "raw", "crm_lost_sales"
    drops = {"2026-07-31": "2026-07-31 10:00:00", "2026-08-01": "2026-07-31 10:00:00", "2026-08-02": "2026-07-31 09:59:00"}
    for ds, seen in drops.items():  # the second has the same instant, the third an older one
        drop(base, ds, (f"bad {ds}", -1.0))
        jobs.ingest_drop(spark, place, source, str(base), ds, at(seen))
        feed = jobs.collect_failures(spark, place)
        assert feed.count() == 1
        for _ in range(2):  # acknowledging twice changes nothing
            jobs.acknowledge_failures(spark, place, feed, at("2026-08-03 00:00:00"))
    jobs.ingest_drop(spark, place, source, str(base), "2026-08-02", at("2026-08-04 00:00:00"))  # a replay
    assert jobs.collect_failures(spark, place).count() == 0


def test_a_late_older_day_reaches_silver(spark, tmp_path, rows):
    place, base, source = jobs.Lake(str(tmp_path / "lake")), tmp_path / "raw", "crm_lost_sales"
    drop(base, "2026-08-01", ("o1", 1.0))
    drop(base, "2026-07-30", ("o2", 2.0))
    for ds in ("2026-08-01", "2026-07-30"):
        jobs.ingest_drop(spark, place, source, str(base), ds, at("2026-08-02 10:00:00"))
        jobs.promote_to_silver(spark, place, source, at("2026-08-02 11:00:00"), buckets=4)
    assert rows(spark.read.parquet(place.silver(source)), "opportunity_id") == [("o1",), ("o2",)]


def test_a_corrected_older_drop_reaches_silver(spark, tmp_path, rows):
    place, base, source = jobs.Lake(str(tmp_path / "lake")), tmp_path / "raw", "crm_lost_sales"

    def run(ds, *sales):
        drop(base, ds, *sales)
        counts = jobs.ingest_drop(spark, place, source, str(base), ds, at("2026-08-02 10:00:00"))
        done = jobs.promote_to_silver(spark, place, source, at("2026-08-02 11:00:00"), buckets=4)
        assert jobs.promote_to_silver(spark, place, source, at("2026-08-02 11:30:00"), buckets=4) == {"batches": 0, "rows": 0}
        silver = lake.read_table(spark, place.silver(source), "opportunity_id string, estimated_value double")
        return counts, done, rows(silver, "opportunity_id", "estimated_value")

    assert run("2026-07-31", ("a", 1.0), ("b", 2.0), ("g", 9.0)) == ({"bronze": 3, "dlq": 0}, {"batches": 1, "rows": 3}, [("a", 1.0), ("b", 2.0), ("g", 9.0)])
    assert run("2026-08-01", ("b", 5.0), ("x", -1.0))[1:] == ({"batches": 1, "rows": 1}, [("a", 1.0), ("b", 5.0), ("g", 9.0)])
    # the older day again: a has another value, c is new, g is withdrawn, and b still comes from the newer day
    assert run("2026-07-31", ("a", 3.0), ("b", 2.5), ("c", 4.0))[2] == [("a", 3.0), ("b", 5.0), ("c", 4.0)]
    # the newer day no longer holds b: it falls back to the older one
    assert run("2026-08-01", ("d", 6.0)) == ({"bronze": 1, "dlq": 0}, {"batches": 1, "rows": 1}, [("a", 3.0), ("b", 2.5), ("c", 4.0), ("d", 6.0)])
    assert run("2026-08-01")[2] == [("a", 3.0), ("b", 2.5), ("c", 4.0)]  # and now holds nothing
    assert lake.read_bronze(spark, place.bronze, jobs.CONTRACTS[source]).count() == 3


def test_a_corrected_append_only_batch_leaves_no_old_days(spark, tmp_path):
    place, contract = jobs.Lake(str(tmp_path / "lake")), jobs.CONTRACTS["usage_logs"]

    def run(*days):
        record = json.dumps({"user_id": "u", "action": "a", "resource": "r", "occurred_at": "t"})
        lines = spark.createDataFrame([(d, record) for d in days], "day string, payload string")
        lake.write_checked(jobs.contracts.check(lines, contract), contract, place.bronze, F.col("day"), at("2026-08-03 00:00:00"), "b1", backfill=True)
        jobs.promote_to_silver(spark, place, "usage_logs", at("2026-08-03 00:00:00"))
        silver = spark.read.schema("user_id string, ingestion_date string").parquet(place.silver("usage_logs"))
        return sorted(r["ingestion_date"] for r in silver.collect())

    assert run("2026-08-01", "2026-08-02", "2026-08-02") == ["2026-08-01", "2026-08-02", "2026-08-02"]
    assert run("2026-08-02", "2026-08-03") == ["2026-08-02", "2026-08-03"]


def test_append_only_promotion_is_idempotent(spark, tmp_path):
    place, base = jobs.Lake(str(tmp_path / "lake")), tmp_path / "raw"
    folder = base / "ds=2026-07-31"
    folder.mkdir(parents=True)
    record = {"user_id": "u", "action": "a", "resource": "r", "occurred_at": "t"}
    (folder / "x.json").write_text("\n".join([json.dumps(record)] * 3))
    jobs.ingest_drop(spark, place, "usage_logs", str(base), "2026-07-31", at("2026-07-31 10:00:00"))
    for _ in range(2):
        jobs.promote_to_silver(spark, place, "usage_logs", at("2026-07-31 11:00:00"))
    assert spark.read.parquet(place.silver("usage_logs")).count() == 3
    with pytest.raises(ValueError):
        jobs.promote_to_silver(spark, place, "pdf_contracts", at("2026-07-31 11:00:00"))


def test_gold_is_not_written_when_the_gate_fails(spark, tmp_path):
    place = jobs.Lake(str(tmp_path / "lake"))
    schema = "usage_id string, usage_date string, job_name string, consumption double, n int"
    good = spark.createDataFrame([("u1", "2026-08-17", "gold", 2.0, 0), ("u1", "2026-08-16", "gold", 1.0, 1)], schema)
    report = jobs.build_gold(place, "gold_finops_costs", good, ["n"])
    assert report.first()["passed"] and spark.table(place.product("gold_finops_costs")).count() == 1
    bad = spark.createDataFrame([("u2", "2026-08-17", None, 2.0, 0)], schema)
    with pytest.raises(Exception, match="REQUIRED_COLUMN_NULL"):
        jobs.build_gold(place, "gold_finops_costs", bad, ["n"])
    assert [r["usage_id"] for r in spark.table(place.product("gold_finops_costs")).collect()] == ["u1"]
    more = spark.createDataFrame([("u3", "2026-08-18", "x", 2.0, 0), ("u4", "2026-08-18", "y", 2.0, 0)], schema)
    jobs.build_gold(place, "gold_finops_costs", more, ["n"])  # a new version beside the old one
    assert spark.table(place.product("gold_finops_costs")).count() == 2
    assert len(list((tmp_path / "lake" / "gold" / "gold_finops_costs").iterdir())) == 3
    spark.sql(f"DROP TABLE {place.product('gold_finops_costs')}")


def test_review(spark, tmp_path):
    place = jobs.Lake(str(tmp_path / "lake"))
    proposals = spark.createDataFrame(
        [("e1", "contract", "pipelines/rag/a.md", "fine"), ("e2", "contract", "etc/passwd", "x")],
        "event_id string, source_failure_type string, target_file string, diff string",
    )
    for _ in range(2):
        accepted = jobs.review_proposals(place, proposals, at("2026-08-01 00:00:00"), "b1")
    assert [r["event_id"] for r in accepted.collect()] == ["e1"]
    log = lake.read_table(spark, place.rejections, "event_id string, rejection_reason string")
    assert [r["rejection_reason"] for r in log.collect()] == ["out_of_scope_path:etc/passwd"]


def test_insights_log(spark, tmp_path):
    place = jobs.Lake(str(tmp_path / "lake"))
    quotes = spark.createDataFrame(
        [(f"T{i % 5}", 100.0 + (i * 7) % 11, 10 + i % 3, f"{i:04d}") for i in range(200)] + [("T1", 9000.0, 999, "9999")],
        "ticker string, price double, volume long, quote_timestamp string",
    )
    sales = spark.createDataFrame(
        [(f"o{i}", f"{i:04d}", float(i % 9)) for i in range(300)], "opportunity_id string, lost_at string, estimated_value double"
    )
    champion = spark.createDataFrame([("7",)], "version string")
    for _ in range(2):
        found = jobs.generate_insights(place, quotes, sales, champion, at("2026-08-01 00:00:00"), "b1", ("volume",))
    logged = spark.read.parquet(place.gold("market_insights_log"))
    assert logged.count() == found.count() and 1 <= logged.count() <= 15
    lowest = logged.orderBy("anomaly_score").first()
    assert lowest["source_ticker"] == "T1" and lowest["model_version"] == "7"
