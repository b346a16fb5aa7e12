"""End-to-end jobs over the lake's tables.

Each job reads from its cursor, writes, and moves the cursor last; running one again after a
crash repeats the same writes and changes nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import contracts, healing, keyed, quality
from siltstone.operators.contracts import PAYLOAD, REASON
from siltstone.operators.forest import fit_and_score, insights
from siltstone.operators.features import FEATURES, build_features
from siltstone.plans.declared import APPEND_ONLY, CONTRACTS, PRODUCTS, SILVER_KEYS
from siltstone.session import cut_lineage
from siltstone.sources import cursors, lake, landing

EVENTS = "event_id string, source_failure_type string, source string, detail string, detected_at timestamp"
PROMOTED = "ingestion_date string, attempt string, promoted_at timestamp, source string, batch string"
HANDLED = "failure_key string"
EVENT_PARTS = ("source_failure_type", "source", "detail", "detected_at")


@dataclass(frozen=True)
class Lake:
    """Where the tables live; every path is on storage all executors can reach."""

    root: str
    database: str = "default"

    def product(self, product: str) -> str:
        """The name of a product's table."""
        return f"{self.database}.{product}"

    def silver(self, source: str) -> str:
        return f"{self.root}/silver/{source}"

    def gold(self, product: str) -> str:
        return f"{self.root}/gold/{product}"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def promoted(self) -> str:
        return f"{self.root}/control/promoted"

    @property
    def handled(self) -> str:
        return f"{self.root}/control/handled"

    @property
    def cursors(self) -> str:
        return f"{self.root}/control/cursors"

    @property
    def events(self) -> str:
        return f"{self.root}/logs/events"

    @property
    def rejections(self) -> str:
        return f"{self.root}/logs/rejections"


def ingest_drop(
    spark: SparkSession, place: Lake, source: str, base: str, ds: str, now: Column, folder: str = "ds={ds}"
) -> dict[str, int]:
    """One day's drop through its contract into Bronze and the dead letters; returns the rows written to each."""
    contract = CONTRACTS[source]
    checked = contracts.check(landing.read_drop(spark, base, ds, folder=folder), contract)
    return lake.write_checked(checked, contract, place.bronze, F.lit(ds), now, batch=f"drop-{ds}")


def _advance(spark: SparkSession, place: Lake, name: str, newest: DataFrame, now: Column) -> None:
    change = newest.select(
        F.lit(name).alias("source"), F.col("position").cast("string"), now.cast("timestamp").alias("updated_at")
    )
    cursors.save_cursors(spark, place.cursors, change)


def promote_to_silver(spark: SparkSession, place: Lake, source: str, now: Column, buckets: int = 64) -> dict[str, int]:
    """New and corrected Bronze batches into Silver: merged sources by key, append-only sources batch by batch.

    The ledger tells which attempts of which batches were not promoted yet, whatever their day, so
    only those batches are opened. Silver follows Bronze as it is now: where a corrected batch no
    longer holds a key, the key falls back to its newest row in the other batches, or goes. Merging
    rows twice and replacing a batch's partition by itself change nothing.

    Returns how many batches and accepted rows were processed.
    """
    contract, named = CONTRACTS[source], ["ingestion_date", "batch"]
    if source not in SILVER_KEYS and source not in APPEND_ONLY:
        raise ValueError(f"no Silver rule for source {source}")
    ledger = lake.read_ledger(spark, place.bronze).where((F.col("source") == source) & (F.col("zone") == "bronze"))
    done = lake.read_table(spark, place.promoted, PROMOTED).where(F.col("source") == source)
    fresh = cut_lineage(ledger.join(done, ["batch", "attempt"], "left_anti").select(*named, "attempt", "rows"))
    before = cut_lineage(done.join(fresh.select("batch").distinct(), "batch", "left_semi").select(*named))
    # names of partitions, which the driver lists in any case
    names = [r["batch"] for r in fresh.select("batch").distinct().collect()]
    corrected = [r["batch"] for r in before.select("batch").distinct().collect()]
    if not names:
        return {"batches": 0, "rows": 0}
    columns = [*contract.schema().fieldNames(), *named, *([PAYLOAD] if source in SILVER_KEYS else [])]
    bronze = lake.read_bronze(spark, place.bronze, contract).select(*columns)
    rows = bronze.where(F.col("batch").isin(names))
    if source in SILVER_KEYS:
        keys, path = SILVER_KEYS[source], place.silver(source)
        newest = [F.col("ingestion_date").desc(), F.col("batch").desc(), F.col(PAYLOAD).desc()]
        gone = None
        if corrected:
            held = lake.read_table(spark, path, rows.schema).where(F.col("batch").isin(corrected)).select(*keys, *named)
            gone = cut_lineage(held.join(rows.select(*keys, *named).distinct(), [*keys, *named], "left_anti").select(*keys).distinct())
            others = bronze.where(~F.col("batch").isin(names)).join(gone, list(keys), "left_semi")
            rows = rows.unionByName(keyed.first_per_key(others, keys, newest))
        lake.merge_into(spark, rows, path, keys, newest, buckets, stays=newest[:2], withdrawn=gone)
    else:
        lake.replace_partitions(rows, place.silver(source), named)
        for r in before.join(fresh, named, "left_anti").where("ingestion_date IS NOT NULL").collect():  # days of a corrected batch
            path = f"{place.silver(source)}/ingestion_date={r['ingestion_date']}/batch={r['batch']}"
            rows.drop(*named).limit(0).write.mode("overwrite").parquet(path)
    promoted = fresh.select(F.lit(source).alias("source"), *named, "attempt", now.cast("timestamp").alias("promoted_at"))
    lake.replace_partitions(promoted, place.promoted, ["source", "batch"])
    _advance(spark, place, f"bronze/{source}", cursors.high_water(fresh, "ingestion_date"), now)
    return {"batches": len(names), "rows": fresh.agg(F.sum("rows")).first()[0]}


def build_gold(place: Lake, product_id: str, rows: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """Build, gate and publish one product as a new version of its table; returns the gate's report.

    The gate sees the written rows before the table points to them; a breach raises and leaves the
    version that is there.
    """
    spark, product = rows.sparkSession, PRODUCTS[product_id]
    made, _ = quality.build_product(rows, product, arrival)
    verdict: list = []

    def gate(written: DataFrame) -> None:
        report = quality.require_quality(written, product)
        verdict.append((report.collect(), report.schema))  # one row

    lake.publish(made, place.product(product_id), place.gold(product_id), f"product {product_id}", {"product": product_id}, gate)
    return spark.createDataFrame(*verdict[0])


def generate_insights(
    place: Lake, quotes: DataFrame, sales: DataFrame, champion: DataFrame, now: Column, batch: str,
    tiebreak: tuple[str, ...],
) -> DataFrame:
    """Score the feature matrix and log its anomalies; the forest stands in for the registered model."""
    matrix = cut_lineage(build_features(quotes, sales, tiebreak))
    found = insights(fit_and_score(matrix, list(FEATURES), ["row_index"]), champion, now, ["row_index"])
    lake.append_log(found, place.gold("market_insights_log"), batch)
    return found


def collect_failures(spark: SparkSession, place: Lake) -> DataFrame:
    """Contract and execution failures that were never acknowledged, with their ``failure_key``.

    A failure is known by its key, not by its time, so one stamped at or before the newest handled
    instant but written later is handed out as well. A dead letter's key is its batch, reason and
    record: replaying a batch raises nothing anew. The feed is fixed here, so that acknowledging it
    covers what was handed out and nothing that has arrived since.
    """
    handled = lake.read_table(spark, place.handled, HANDLED)
    parts = [F.coalesce(c, F.lit("")) for c in ("source", "ingestion_date", "batch", REASON, PAYLOAD)]
    dlq = lake.read_dlq(spark, place.bronze).withColumn("failure_key", F.sha2(F.to_json(F.array(*parts)), 256))
    events = lake.read_table(spark, place.events, EVENTS).withColumn(
        "failure_key", F.coalesce(F.concat(F.lit("event-"), "event_id"), F.sha2(F.to_json(F.struct(*EVENT_PARTS)), 256))
    )
    unread = [df.join(handled, "failure_key", "left_anti") for df in (dlq, events)]
    return cut_lineage(healing.failure_feed(*unread, keep=["failure_key"]))


def acknowledge_failures(spark: SparkSession, place: Lake, feed: DataFrame, now: Column) -> None:
    """Remember the failures handled, then move both cursors to the newest; an empty feed moves nothing.

    Remembering a failure twice changes nothing, so a run that dies half-way is run again.
    """
    feed.select("failure_key").distinct().write.mode("append").parquet(place.handled)
    at = F.to_timestamp("detected_at").cast("string")
    kinds = {"bronze_dlq": F.col("source_failure_type") == "contract", "self_healing_events": F.col("source_failure_type") != "contract"}
    for name, mine in kinds.items():
        _advance(spark, place, name, cursors.high_water(feed.where(mine).select(at.alias("at")), "at"), now)


def review_proposals(place: Lake, proposals: DataFrame, now: Column, batch: str) -> DataFrame:
    """Judge proposed changes, log the rejected ones and return the accepted ones."""
    judged = healing.apply_guardrails(proposals)
    lake.append_log(healing.rejections(judged, now), place.rejections, batch)
    return judged.where(F.col("rejection_reason").isNull()).drop("rejection_reason")
