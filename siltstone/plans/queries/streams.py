"""Streaming forms, run to completion over the event table and compared with their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.delivery import notification_key
from siltstone.operators import contracts, delivery, telemetry
from siltstone.plans.queries import MIDPOINT, register, stamp, table
from siltstone.plans.queries.delivery import DECISIONS_SQL, POLICY, REQUESTS_SQL, decisions, request_rows, verbs
from siltstone.plans.queries.ingest import CHECKED_SQL, QUOTES, raw_quotes
from siltstone.session import ROCKSDB, work_path
from siltstone.sources.lake import read_bronze, read_dlq, read_ledger
from siltstone.streaming.decisions import decision_stream
from siltstone.streaming.ingest import append_stream, ingest_stream
from siltstone.streaming.outbox import outbox_stream, read_outbox

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a file stream with event time as TIMESTAMP."""
    schema = table(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def finished(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over everything available and read what it wrote."""
    spark = stream.sparkSession
    path = work_path(spark, name)
    append_stream(stream, path, work_path(spark, f"{name}-checkpoint")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@register(
    CHECKED_SQL
    + """SELECT coalesce(reason, 'accepted') AS outcome, CAST(count(*) AS BIGINT) AS rows,
  round(sum(CASE WHEN reason IS NULL THEN value END), 2) AS total_price FROM q GROUP BY 1"""
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote messages through the checked stream; started twice, the second run finds nothing new."""
    root, checkpoint = work_path(spark, "stream-lake"), work_path(spark, "stream-checkpoint")
    for _ in range(2):
        messages = raw_quotes(event_stream(spark, sf_dir))
        ingest_stream(messages, QUOTES, root, checkpoint).awaitTermination()
    bronze = read_bronze(spark, root, QUOTES).select(F.lit("accepted").alias("outcome"), "price")
    dlq = read_dlq(spark, root).select(F.col(contracts.REASON).alias("outcome"), F.lit(None).cast("double").alias("price"))
    return (
        bronze.unionByName(dlq)
        .groupBy("outcome")
        .agg(F.count("*").alias("rows"), F.round(F.sum("price"), 2).alias("total_price"))
    )


@register(
    """SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S.%f') AS window_start, event_type AS domain,
  CASE WHEN event_type = 'error' THEN 'fail' ELSE 'ok' END AS result, round(sum(value) / 300, 6) AS rate
FROM events WHERE time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <= date_trunc('milliseconds', (SELECT max(ts) FROM events)) - INTERVAL 10 MINUTE
GROUP BY 1, 2, 3"""
)
def stream_counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter rates on a stream: every window the watermark has closed."""
    points = event_stream(spark, sf_dir).select(
        "ts",
        F.col("event_type").alias("domain"),
        F.when(F.col("event_type") == "error", "fail").otherwise("ok").alias("result"),
        F.col("value").alias("amount"),
    )
    rates = finished(telemetry.rate(points.withWatermark("ts", "10 minutes"), ["domain", "result"]), "rates")
    return rates.select(
        stamp(F.col("window_start")).alias("window_start"), "domain", "result", F.round("rate", 6).alias("rate")
    )


@register(
    CHECKED_SQL
    + """SELECT event_id % 2 AS half, coalesce(reason, 'accepted') AS outcome, CAST(count(*) AS BIGINT) AS rows FROM q GROUP BY ALL"""
)
def stream_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams of one source into one lake, each with its own checkpoint: both number their batches from 0
    and neither touches the other's rows. Each is started twice."""
    root = work_path(spark, "two-streams")
    checkpoints = [work_path(spark, f"two-streams-{half}") for half in (0, 1)]
    for _ in range(2):
        for half, checkpoint in enumerate(checkpoints):
            mine = event_stream(spark, sf_dir).where(F.col("event_id") % 2 == half)
            ingest_stream(raw_quotes(mine), QUOTES, root, checkpoint).awaitTermination()
    ledger = read_ledger(spark, root).groupBy("batch", "zone").agg(F.sum("rows").alias("listed"))
    bronze = read_bronze(spark, root, QUOTES).select(F.lit("bronze").alias("zone"), "batch", F.lit("accepted").alias("outcome"))
    dlq = read_dlq(spark, root).select(F.lit("dlq").alias("zone"), "batch", F.col(contracts.REASON).alias("outcome"))
    counted = bronze.unionByName(dlq).groupBy("zone", "batch", "outcome").agg(F.count(F.lit(1)).alias("rows"))
    # a batch of the ledger that the lake holds in full
    zones = counted.groupBy("zone", "batch").agg(F.sum("rows").alias("held")).join(ledger, ["batch", "zone"]).where("held = listed").select("zone", "batch")
    ids = [spark.read.text(f"{c}/metadata").select(F.get_json_object("value", "$.id").alias("id"), F.lit(h).cast("long").alias("half")) for h, c in enumerate(checkpoints)]
    named = counted.join(zones, ["zone", "batch"]).withColumn("id", F.regexp_extract("batch", "^q(.*)-[0-9]+$", 1))
    return named.join(ids[0].unionByName(ids[1]), "id").groupBy("half", "outcome").agg(F.sum("rows").alias("rows"))


@register(REQUESTS_SQL + "SELECT key AS idempotency_key, 'e' || arg_min(event_id, (ts, event_id)) AS correlation_id FROM k GROUP BY 1")
def stream_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First request per idempotency key on a stream, in three runs over the month's parts; no key is forgotten."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    key = notification_key(
        F.col("notification_type"), F.col("resource_ref"), F.col("resource_version"), F.col("recipient_ref"),
        F.lit(delivery.CHANNEL),
    )
    keyed = request_rows(events).withColumn("idempotency_key", key).select("idempotency_key", "correlation_id", "notification_type", "ts", "arrival")
    folder, path, checkpoint = (work_path(spark, f"outbox-{name}") for name in ("in", "table", "checkpoint"))
    borders = [MIDPOINT, "2024-01-24 00:00:00", None]
    for part in parts_of(keyed, borders):
        part.write.mode("append").parquet(folder)
        outbox_stream(spark.readStream.schema(keyed.schema).parquet(folder), path, checkpoint, ["ts", "arrival"]).awaitTermination()
    return read_outbox(spark, path, "idempotency_key string, correlation_id string").select("idempotency_key", "correlation_id")


def parts_of(rows: DataFrame, borders: list[str | None]) -> list[DataFrame]:
    """Rows before each border and not before the one ahead of it; None has no border."""
    out, low = [], F.lit(True)
    for border in borders:
        high = F.col("ts") < F.lit(border).cast("timestamp") if border else F.lit(True)
        out.append(rows.where(low & high))
        low = ~high
    return out


# Verbs of each part of the decision stream; decisions of odd users are opened with the second part, the others with the first.
_START, _NOON, _MIDNIGHT = "2023-12-31 00:00:00", "2024-01-01 12:00:00", "2024-01-02 00:00:00"


@register(
    DECISIONS_SQL
    + f""", p AS (SELECT *, CASE WHEN ts < TIMESTAMP '{_NOON}' THEN 0 WHEN ts < TIMESTAMP '{_MIDNIGHT}' THEN 1 ELSE 2 END AS part FROM e),
m AS (SELECT greatest(max(ts) FILTER (part = 0), TIMESTAMP '2023-12-31 00:00:00') - INTERVAL 1 HOUR AS w0,
  greatest(max(ts) FILTER (part <= 1), TIMESTAMP '{_NOON}') - INTERVAL 1 HOUR AS w1, max(ts) - INTERVAL 1 HOUR AS w2 FROM p),
r AS (SELECT d.*, w.outcome, w.actor_id, w.reason, w.ts, CASE WHEN w.ts < TIMESTAMP '{_NOON}' THEN 0 WHEN w.ts < TIMESTAMP '{_MIDNIGHT}' THEN 1 ELSE 2 END AS part,
  CAST(substr(d.decision_id, 2) AS BIGINT) % 2 = 1 AS later FROM d LEFT JOIN (SELECT decision_id, outcome, actor_id, reason, ts FROM w) w USING (decision_id)),
x AS (SELECT r.*, outcome IS NULL OR (part = 1 AND NOT later AND expires_at <= w0) OR (part = 2 AND expires_at <= w1) AS timed, w2 FROM r, m)
SELECT decision_id, CASE WHEN timed THEN 'expired' ELSE outcome END AS status, CASE WHEN timed THEN 'system:expiry' ELSE actor_id END AS actor_id,
  CASE WHEN NOT timed AND outcome <> 'expired' THEN reason END AS reason,
  strftime(CASE WHEN timed THEN expires_at ELSE ts END, '%Y-%m-%d %H:%M:%S.%f') AS decided_at
FROM x WHERE outcome IS NOT NULL OR expires_at <= w2"""
)
def stream_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision state machine on a stream, in three runs: verbs of decisions that are opened in the second run
    wait for them, and timers expire the decisions that nobody settled in time."""
    every = decisions(spark, sf_dir).withColumn("expires_at", F.col("expires_at").cast("timestamp")).select("decision_id", "action_type", "expires_at")
    later = F.substring("decision_id", 2, 20).cast("long") % 2 == 1
    opened = every.withColumn("opened_at", F.when(later, F.lit(_NOON)).otherwise(F.lit(_START)).cast("timestamp"))
    events = verbs(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    folder, openings, path, checkpoint = (work_path(spark, f"decisions-{name}") for name in ("verbs", "openings", "out", "checkpoint"))
    opened.where(~later).write.parquet(openings)
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # state with timers needs RocksDB
    try:
        for run, part in enumerate(parts_of(events, [_NOON, _MIDNIGHT, None])):
            part.write.mode("append").parquet(folder)
            if run == 1:
                opened.where(later).write.mode("append").parquet(openings)
            settled = decision_stream(
                spark.readStream.schema(events.schema).parquet(folder), None, POLICY,
                openings=spark.readStream.schema(opened.schema).parquet(openings),
            )
            append_stream(settled, path, checkpoint).awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before)
    rows = spark.read.schema(settled.schema).parquet(path)
    return rows.select("decision_id", "status", "actor_id", "reason", stamp(F.col("decided_at")).alias("decided_at"))
