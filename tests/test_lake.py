import json

import pytest
from pyspark.sql import functions as F

from siltstone.operators.contracts import check
from siltstone.plans.declared import CONTRACTS
from siltstone.sources import changefeed, cursors, lake, landing, topics, usage

QUOTES = CONTRACTS["b3_quotes"]


def messages(spark, *tickers):
    texts = [
        json.dumps({"ticker": t, "price": 1.0, "quote_timestamp": f"2026-07-31T10:0{i}:00Z", "more": [1]})
        for i, t in enumerate(tickers)
    ]
    return check(spark.createDataFrame([(t,) for t in texts], "payload string"), QUOTES)


def append(spark, root, batch, *tickers):
    lake.write_checked(
        messages(spark, *tickers), QUOTES, root, F.lit("2026-07-31"), F.lit("2026-07-31 10:00:00"), batch
    )


def test_bronze_and_dead_letters(spark, tmp_path):
    root = str(tmp_path)
    assert lake.read_bronze(spark, root, QUOTES).count() == 0 and lake.read_dlq(spark, root).count() == 0
    append(spark, root, "1", "A", None)
    append(spark, root, "2", "B")
    append(spark, root, "2", "B")  # the same batch again
    bronze = lake.read_bronze(spark, root, QUOTES)
    assert sorted(r["ticker"] for r in bronze.collect()) == ["A", "B"]
    assert json.loads(bronze.first()["payload"])["more"] == [1]
    letter = lake.read_dlq(spark, root).first()
    assert (letter["source"], letter["_failure_reason"], letter["ingestion_date"]) == (
        "b3_quotes", "null_violation:ticker", "2026-07-31",
    )


def test_empty_batch_creates_nothing(spark, tmp_path):
    append(spark, str(tmp_path / "lake"), "1")
    assert not landing.path_exists(spark, lake.bronze_path(str(tmp_path / "lake"), "b3_quotes"))


def test_table_merge(spark, tmp_path, rows):
    path, order = str(tmp_path / "silver"), [F.col("v").desc()]
    first = spark.createDataFrame([(k, k) for k in range(50)], "k int, v int")
    second = spark.createDataFrame([(7, 100), (7, 90), (99, 1)], "k int, v int")
    lake.merge_into(spark, first, path, ["k"], order, buckets=4)
    for _ in range(2):
        lake.merge_into(spark, second, path, ["k"], order, buckets=4)
    table = dict(rows(spark.read.parquet(path), "k", "v"))
    assert len(table) == 51 and table[7] == 100 and table[99] == 1 and table[8] == 8


def test_incremental_is_strict_and_pushed_down(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "timestamp_seconds(id) as ts", "'1970-01-01' as ingestion_date").write.partitionBy(
        "ingestion_date"
    ).parquet(path)
    found = lake.incremental(
        spark.read.parquet(path), "ts", F.lit("1970-01-01 00:00:04").cast("timestamp"), "ingestion_date"
    )
    assert sorted(r["id"] for r in found.collect()) == [5, 6, 7, 8, 9]
    plan = found._jdf.queryExecution().toString()
    assert "GreaterThan(ts" in plan and "PartitionFilters: [isnotnull(ingestion_date" in plan


def test_landing(spark, tmp_path):
    base = str(tmp_path)
    folder = tmp_path / "ds=2026-07-31"
    folder.mkdir()
    (folder / "lost_sales.json").write_text('{"a": 1}\n\n   \n{"a": 2}\n')
    assert landing.read_drop(spark, base, "2026-07-31").count() == 2
    assert landing.read_drop(spark, base, "2026-07-31", folder="ds={ds}/lost_sales.json").count() == 2
    assert landing.read_drop(spark, base, "2026-08-01").count() == 0


def test_cursors(spark, tmp_path):
    path = str(tmp_path / "cursors")

    def save(source, position, at):
        change = spark.createDataFrame([(source, position, at)], "source string, position string, updated_at string")
        cursors.save_cursors(spark, path, change.withColumn("updated_at", F.col("updated_at").cast("timestamp")))

    def position(source):
        table = lake.read_table(spark, path, cursors.SCHEMA)
        return spark.range(1).select(cursors.position(table, source)).first()[0]

    assert position("a") == cursors.EPOCH
    save("a", "2026-01-01 00:00:00", "2026-01-01 00:00:00")
    save("b", "2026-02-01 00:00:00", "2026-02-01 00:00:00")
    save("a", "2026-03-01 00:00:00", "2026-03-01 00:00:00")
    assert position("a") == "2026-03-01 00:00:00" and position("b") == "2026-02-01 00:00:00"
    empty = spark.createDataFrame([], "ts timestamp")
    assert cursors.high_water(empty, "ts").count() == 0


def test_topic_messages(spark, rows):
    raw = spark.createDataFrame(
        [("PETR4", 38.5, 10, "t"), (None, 1.0, 1, "t"), ("VALE3", None, 1, "t")],
        "symbol string, regularMarketPrice double, regularMarketVolume long, regularMarketTime string",
    )
    sent = topics.keyed_json(topics.normalise_quotes(raw), "ticker").collect()
    assert [(r["key"], json.loads(r["value"])) for r in sent] == [
        ("PETR4", {"ticker": "PETR4", "price": 38.5, "volume": 10, "quote_timestamp": "t"})
    ]
    mixed = spark.createDataFrame([("h", None), (None, "u"), (None, None)], "host_id string, user_id string")
    assert sorted(r["key"] for r in topics.keyed_json(mixed, "host_id", "user_id").collect()) == ["", "h", "u"]


def test_change_feed(spark, rows):
    first = {
        "value": [
            {"id": "1", "name": "a.txt", "parentReference": {"path": "/p"}, "file": {"mimeType": "x"}},
            {"id": "2", "name": "f", "folder": {"childCount": 1}},
        ],
        "@odata.nextLink": "next",
    }
    second = {"value": [{"id": "3", "name": "b.txt", "parentReference": {"path": "/p"}, "file": {}}], "@odata.deltaLink": "L2"}
    pages = spark.createDataFrame([(0, json.dumps(first)), (1, json.dumps(second))], "page_no int, body string")
    assert rows(changefeed.changed_files(pages), "document_id", "source_path") == [("1", "/p/a.txt"), ("3", "/p/b.txt")]
    assert changefeed.delta_link(pages).first()[0] == "L2"
    assert changefeed.delta_link(pages.limit(0), "old").first()[0] == "old"


def test_usage_falls_back_to_run_durations(spark, tmp_path, rows):
    runs, billing = str(tmp_path / "runs"), str(tmp_path / "billing")
    spark.sql(
        "select 'j' job_name, timestamp'2026-01-02 00:00:00' start_date, timestamp'2026-01-02 00:01:30' end_date "
        "union all select 'k', timestamp'2026-01-02 00:00:00', null "
        "union all select 'old', timestamp'2025-01-02 00:00:00', timestamp'2025-01-02 00:01:30'"
    ).write.parquet(runs)
    since = F.lit("2026-01-01").cast("timestamp")
    assert rows(usage.fetch_usage(spark, billing, runs, since)) == [("j", 90.0)]
    spark.sql("select 'b' job_name, timestamp'2026-01-02 00:00:00' usage_date, 2.5D quantity").write.parquet(billing)
    assert rows(usage.fetch_usage(spark, billing, runs, since)) == [("b", 2.5)]
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("not a table")
    assert rows(usage.fetch_usage(spark, str(broken), runs, since)) == [("j", 90.0)]


def test_rows_without_a_key_are_all_kept_by_an_ordered_merge(spark, tmp_path, rows):
    path, order = str(tmp_path / "silver"), [F.col("v").desc()]
    for data in ([(None, 1), (None, 2), (7, 1)], [(None, 3), (7, 2)]):
        lake.merge_into(spark, spark.createDataFrame(data, "k int, v int"), path, ["k"], order, 4, stays=order)
    assert rows(spark.read.parquet(path), "k", "v") == [(7, 2), (None, 1), (None, 2), (None, 3)]


def test_publish_sets_properties(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "id string, v int")
    for _ in range(2):
        lake.publish(df, "gold_test", str(tmp_path / "gold"), "it's gold", {"contract_version": "1"})
    properties = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES gold_test").collect()}
    assert properties["quality"] == "gold" and properties["contract_version"] == "1"
    assert spark.table("gold_test").count() == 1
    spark.sql("DROP TABLE gold_test")


def test_corrected_batch_leaves_nothing_behind(spark, tmp_path):
    root = str(tmp_path)
    append(spark, root, "0", None)
    append(spark, root, "1", "A", None)
    append(spark, root, "1", "A", "B")  # corrected: nothing is refused any more
    assert sorted(r["ticker"] for r in lake.read_bronze(spark, root, QUOTES).collect()) == ["A", "B"]
    assert lake.read_dlq(spark, root).count() == 1
    append(spark, root, "1", None)  # and the other way round
    assert lake.read_bronze(spark, root, QUOTES).count() == 0 and lake.read_dlq(spark, root).count() == 2
    append(spark, root, "1")  # an empty batch now
    assert lake.read_dlq(spark, root).count() == 1
    with pytest.raises(ValueError, match="batch name"):
        append(spark, root, "*", "A")


def test_merge_refuses_another_layout_and_survives_a_crash(spark, tmp_path, rows, monkeypatch):
    path, order = str(tmp_path / "silver"), [F.col("v").desc()]
    merge = lambda data, buckets=4: lake.merge_into(spark, spark.createDataFrame(data, "k int, v int"), path, ["k"], order, buckets)
    merge([(k, k) for k in range(20)])
    with pytest.raises(ValueError, match="4 buckets"):
        merge([(1, 5)], buckets=8)
    write = lake.replace_partitions

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(lake, "replace_partitions", crash)
    with pytest.raises(RuntimeError):
        merge([(3, 100)])
    assert dict(rows(spark.read.parquet(path), "k", "v"))[3] == 3  # the old table is whole
    monkeypatch.setattr(lake, "replace_partitions", write)
    merge([(4, 200)])
    table = dict(rows(spark.read.parquet(path), "k", "v"))
    assert len(table) == 20 and table[3] == 100 and table[4] == 200


def test_refused_version_is_not_published(spark, tmp_path):
    def gate(written):
        if written.count() > 1:
            raise ValueError("refused")

    publish = lambda n: lake.publish(spark.range(n), "gated_test", str(tmp_path / "g"), "c", {}, gate)
    publish(1)
    with pytest.raises(ValueError, match="refused"):
        publish(2)
    assert spark.table("gated_test").count() == 1
    lake.publish(spark.range(3).selectExpr("id", "id + 1 AS more"), "gated_test", str(tmp_path / "g"), "c", {})
    assert spark.table("gated_test").columns == ["id", "more"] and spark.table("gated_test").count() == 3
    spark.sql("DROP TABLE gated_test")
