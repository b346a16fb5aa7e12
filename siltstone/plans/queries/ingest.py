"""Contract checks, Bronze and dead letters, Silver merges, cursors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.operators import contracts, keyed, quality
from siltstone.plans import jobs
from siltstone.plans.declared import CONTRACTS
from siltstone.plans.queries import MIDPOINT, MONTH_END, moment, register, stamp, table
from siltstone.session import spread, work_path
from siltstone.sources import changefeed, cursors, lake, landing, topics

QUOTES = CONTRACTS["b3_quotes"]


def raw_quotes(events: DataFrame) -> DataFrame:
    """Events as quote messages with derived faults: no ticker, text price, negative price,
    cut-off JSON, boolean, fractional or absent volume."""
    ticker = F.when(F.col("event_type") == "error", "null").otherwise(F.concat(F.lit('"T'), "user_id", F.lit('"')))
    price = (
        F.when(F.col("event_id") % 10 == 0, F.lit('"n/a"'))
        .when(F.col("value") < 1, (F.col("value") - 1).cast("string"))  # below 0 for a value of 0 too
        .otherwise(F.col("value").cast("string"))
    )
    k = F.get_json_object("props", "$.k")
    volume = (
        F.when(F.col("event_id") % 13 == 0, F.lit(',"volume":true'))
        .when(F.col("event_id") % 11 == 0, F.lit(',"volume":2.0'))
        .when(F.col("event_id") % 7 == 0, F.lit(""))
        .otherwise(F.concat(F.lit(',"volume":'), k))
    )
    body = F.concat(
        F.lit('{"ticker":'), ticker, F.lit(',"price":'), price, volume,
        F.lit(',"quote_timestamp":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('"}'),
    )
    cut = (F.col("event_type") == "signup") & (F.col("value") > 100)
    return events.select("event_id", "ts", F.when(cut, F.lit('{"ticker":')).otherwise(body).alias("payload"))


CHECKED_SQL = """
WITH q AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         CASE WHEN event_type = 'signup' AND value > 100 THEN 'malformed_json'
              WHEN event_type = 'error' THEN 'null_violation:ticker'
              WHEN event_id % 10 = 0 THEN 'type_mismatch:price'
              WHEN value < 1 THEN 'constraint_violation:price'
              WHEN event_id % 13 <> 0 AND event_id % 11 = 0 THEN 'type_mismatch:volume' END AS reason
  FROM events)
"""


def checked_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.check(raw_quotes(spread(table(spark, sf_dir, "events"))), QUOTES)


@register(CHECKED_SQL + "SELECT event_id, reason AS failure_reason FROM q")
def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_quotes(spark, sf_dir).select("event_id", F.col(contracts.REASON).alias("failure_reason"))


@register(
    CHECKED_SQL
    + """SELECT event_id, 'T' || user_id AS ticker, value AS price,
  CASE WHEN event_id % 13 = 0 THEN 1 WHEN event_id % 7 = 0 THEN NULL ELSE k END AS volume,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS quote_timestamp
FROM q WHERE reason IS NULL"""
)
def contract_accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = contracts.split(checked_quotes(spark, sf_dir), QUOTES, keep=["event_id"])
    return valid.drop(contracts.PAYLOAD)


@register(
    CHECKED_SQL
    + """SELECT coalesce(reason, 'accepted') AS outcome, CAST(count(*) AS BIGINT) AS rows FROM q GROUP BY 1"""
)
def dlq_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.reason_counts(checked_quotes(spark, sf_dir))


@register(
    CHECKED_SQL
    + """SELECT CASE WHEN reason IS NULL THEN 'bronze' ELSE 'dlq' END AS zone,
  strftime(ts, '%Y-%m-%d') AS ingestion_date, coalesce(reason, 'accepted') AS outcome,
  CAST(count(*) AS BIGINT) AS rows, round(sum(CASE WHEN reason IS NULL THEN value END), 2) AS total_price
FROM q GROUP BY 1, 2, 3"""
)
def bronze_and_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the batch twice (a replay) and read both tables back."""
    root = work_path(spark, "lake")
    checked = checked_quotes(spark, sf_dir)
    day = F.date_format("ts", "yyyy-MM-dd")
    for _ in range(2):
        lake.write_checked(checked, QUOTES, root, day, moment(MONTH_END), "2024-01", backfill=True)
    bronze = lake.read_bronze(spark, root, QUOTES).select(
        F.lit("bronze").alias("zone"), "ingestion_date", F.lit("accepted").alias("outcome"), "price"
    )
    dlq = lake.read_dlq(spark, root).select(
        F.lit("dlq").alias("zone"), "ingestion_date", F.col(contracts.REASON).alias("outcome"),
        F.lit(None).cast("double").alias("price"),
    )
    return (
        bronze.unionByName(dlq)
        .groupBy("zone", "ingestion_date", "outcome")
        .agg(F.count("*").alias("rows"), F.round(F.sum("price"), 2).alias("total_price"))
    )


@register(
    CHECKED_SQL
    + """SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS batch, CASE WHEN reason IS NULL THEN 'bronze' ELSE 'dlq' END AS zone,
  strftime(ts, '%Y-%m-%d') AS ingestion_date, CAST(count(*) AS BIGINT) AS rows FROM q WHERE event_type <> 'view' OR event_id % 2 = 1 GROUP BY ALL"""
)
def batch_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written per batch, zone and day as the writer's ledger counts them; the even batch is written with all
    its rows first and then corrected to be without views."""
    root, checked = work_path(spark, "lake"), checked_quotes(spark, sf_dir).join(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id")
    even, day = F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd")
    for name, rows in (("even", even), ("odd", ~even), ("even", even & (F.col("event_type") != "view"))):
        lake.write_checked(checked.where(rows), QUOTES, root, day, moment(MONTH_END), name, backfill=True)
    return lake.read_ledger(spark, root).where("rows > 0").select("batch", "zone", "ingestion_date", "rows")


@register(
    """SELECT strftime(o_orderdate, '%Y') AS year, CAST(count(*) AS BIGINT) AS rows,
  round(sum(o_totalprice), 2) AS total, CAST(count(DISTINCT o_orderdate) AS BIGINT) AS days
FROM orders GROUP BY 1"""
)
def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lost-sales drops, one folder per year's first day, written and read back with a contract."""
    base = work_path(spark, "landing")
    sales = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("opportunity_id"),
        F.concat(F.lit("C"), "o_custkey").alias("account_name"),
        F.col("o_orderpriority").alias("lost_reason"),
        F.col("o_totalprice").alias("estimated_value"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("lost_at"),
    )
    landing.write_drops(sales, base, F.trunc(F.col("lost_at").substr(1, 10).cast("date"), "year"))
    contract = CONTRACTS["crm_lost_sales"]
    lines = landing.read_drop(spark, base, "*").unionByName(landing.read_drop(spark, base, "no-such-day"))
    valid, _ = contracts.split(contracts.check(lines, contract), contract)
    return valid.groupBy(F.col("lost_at").substr(1, 4).alias("year")).agg(
        F.count("*").alias("rows"),
        F.round(F.sum("estimated_value"), 2).alias("total"),
        F.countDistinct("lost_at").alias("days"),
    )


@register(
    """SELECT 'T' || user_id AS key,
  '{"ticker":"T' || user_id || '","price":' || CAST(value AS VARCHAR) || ',"volume":'
  || CAST(json_extract(props, '$.k') AS VARCHAR) || ',"quote_timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '"}' AS value
FROM events WHERE event_type <> 'error'"""
)
def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider quotes normalised to keyed topic messages; quotes without a symbol are skipped."""
    raw = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "error", F.concat(F.lit("T"), "user_id")).alias("symbol"),
        F.col("value").alias("regularMarketPrice"),
        F.get_json_object("props", "$.k").cast("long").alias("regularMarketVolume"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("regularMarketTime"),
    )
    return topics.keyed_json(topics.normalise_quotes(raw), "ticker")


@register(
    f"""SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts
FROM events WHERE event_type = 'error' AND ts > TIMESTAMP '{MIDPOINT}'"""
)
def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = table(spark, sf_dir, "events").where("event_type = 'error'")
    return lake.incremental(failures, "ts", moment(MIDPOINT)).select("event_id", "user_id", stamp(F.col("ts")).alias("ts"))


@register(
    CHECKED_SQL
    + f"""SELECT 1 + (ts <= TIMESTAMP '{MIDPOINT}')::INTEGER AS run, 'contract' AS source_failure_type, reason AS detail, CAST(count(*) AS BIGINT) AS failures
  FROM q WHERE reason IS NOT NULL GROUP BY ALL
UNION ALL
SELECT 1 + (event_id % 3 = 0)::INTEGER, 'execution', 'user ' || user_id % 50, CAST(count(*) AS BIGINT) FROM events WHERE event_type = 'error' GROUP BY ALL"""
)
def failures_across_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures handed out by two runs of the feed, the first acknowledged before more are written: dead
    letters of the same instant, and events some of which are older than the newest handled."""
    place = jobs.Lake(work_path(spark, "lake"))
    checked = checked_quotes(spark, sf_dir)
    day, early = F.date_format("ts", "yyyy-MM-dd"), F.col("ts") <= moment(MIDPOINT)
    third = F.col("event_id") % 3 == 0
    log = table(spark, sf_dir, "events").where("event_type = 'error'").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.lit("execution").alias("source_failure_type"),
        F.col("user_id").cast("string").alias("source"),
        F.concat(F.lit("user "), F.col("user_id") % 50).alias("detail"),
        F.col("ts").alias("detected_at"),
    )
    runs = []
    for run, quotes, errors in ((1, ~early, ~third), (2, early, third)):
        lake.write_checked(checked.where(quotes), QUOTES, place.bronze, day, moment(MONTH_END), f"b{run}", backfill=True)
        lake.append_log(log.where(errors), place.events, f"b{run}")
        feed = jobs.collect_failures(spark, place)
        jobs.acknowledge_failures(spark, place, feed, moment(MONTH_END))
        runs.append(feed.withColumn("run", F.lit(run)))
    runs.append(jobs.collect_failures(spark, place).withColumn("run", F.lit(3)))  # nothing is left
    found = runs[0].unionByName(runs[1]).unionByName(runs[2])
    return found.groupBy("run", "source_failure_type", "detail").agg(F.count(F.lit(1)).alias("failures"))


@register(
    """SELECT 'o' || o_custkey AS opportunity_id, round(max_by(o_totalprice, (o_orderdate, o_orderkey)), 2) AS estimated_value FROM orders GROUP BY 1"""
)
def silver_late_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lost sales of one account each: the odd years' drops reach Silver first, the older even
    years' drops arrive late; the newest sale of an account stays."""
    place, orders = jobs.Lake(work_path(spark, "lake")), table(spark, sf_dir, "orders")
    odd = F.year("o_orderdate") % 2 == 1
    for name, rows in (("odd", orders.where(odd)), ("even", orders.where(~odd))):
        promote_drop(spark, place, yearly_sales(rows), name)
    return promoted_sales(spark, place)


SALES = "crm_lost_sales"


def yearly_sales(orders: DataFrame) -> DataFrame:
    """Orders as lost sales of one account each, the newest of an account and year, as (year, payload) lines."""
    newest = W.partitionBy("o_custkey", F.year("o_orderdate")).orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc())
    sales = orders.select(
        F.concat(F.lit("o"), "o_custkey").alias("opportunity_id"),
        F.col("o_orderkey").cast("string").alias("account_name"),
        F.lit("r").alias("lost_reason"),
        F.col("o_totalprice").alias("estimated_value"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("lost_at"),
        F.year("o_orderdate").alias("year"),
        F.row_number().over(newest).alias("n"),
    ).where("n = 1")
    return sales.select("year", F.to_json(F.struct(*CONTRACTS[SALES].schema().fieldNames())).alias(contracts.PAYLOAD))


def promote_drop(spark: SparkSession, place: jobs.Lake, lines: DataFrame, name: str) -> dict[str, int]:
    """Write one named batch whose days are the ends of its years, then promote what Silver has not seen."""
    day = F.concat(F.col("year").cast("string"), F.lit("-12-31"))
    lake.write_checked(contracts.check(lines, CONTRACTS[SALES]), CONTRACTS[SALES], place.bronze, day, moment(MONTH_END), name, backfill=True)
    return jobs.promote_to_silver(spark, place, SALES, moment(MONTH_END))


def promoted_sales(spark: SparkSession, place: jobs.Lake) -> DataFrame:
    return spark.read.parquet(place.silver(SALES)).select("opportunity_id", F.round("estimated_value", 2).alias("estimated_value"))


@register(
    """SELECT 'o' || o_custkey AS opportunity_id, round(max_by(CASE WHEN odd AND o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END, (o_orderdate, o_orderkey)), 2) AS estimated_value
FROM (SELECT *, year(o_orderdate) % 2 = 1 AS odd FROM orders) WHERE NOT (odd AND o_orderkey % 5 = 0) GROUP BY 1"""
)
def silver_corrected_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The odd years' drop is replaced after both drops were promoted: some of its sales are withdrawn, some
    have another value. Accounts fall back to their newest sale that is left."""
    place, orders = jobs.Lake(work_path(spark, "lake")), table(spark, sf_dir, "orders")
    odd = F.year("o_orderdate") % 2 == 1
    raised = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    corrected = orders.where(odd & (F.col("o_orderkey") % 5 != 0)).withColumn("o_totalprice", raised)
    for name, rows in (("odd", orders.where(odd)), ("even", orders.where(~odd)), ("odd", corrected)):
        promote_drop(spark, place, yearly_sales(rows), name)
    return promoted_sales(spark, place)


@register(
    """SELECT event_type AS source, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS position FROM events GROUP BY 1
UNION ALL SELECT 'orders', strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%f') FROM orders"""
)
def cursor_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursor table after two updates: first halves of all sources, then second halves and one new source."""
    path = work_path(spark, "cursors")
    events = table(spark, sf_dir, "events")

    def marks(rows: DataFrame, at: str) -> DataFrame:
        newest = rows.groupBy("source").agg(F.max("position").alias("position"))
        return newest.withColumn("updated_at", F.lit(at).cast("timestamp"))

    tagged = events.select(F.col("event_type").alias("source"), "ts", stamp(F.col("ts")).alias("position"))
    orders = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("source"), stamp(F.col("o_orderdate")).alias("position")
    )
    cursors.save_cursors(spark, path, marks(tagged.where(F.col("ts") <= moment(MIDPOINT)), MIDPOINT))
    newer = tagged.where(F.col("ts") > moment(MIDPOINT)).drop("ts").unionByName(orders)
    cursors.save_cursors(spark, path, marks(newer, MONTH_END))
    return cursors.read_cursors(spark, path).select("source", "position")


def state_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "user_id", F.get_json_object("props", "$.k").cast("long").alias("k"), "ts", "event_id", "value"
    )


SILVER_SQL = """
WITH e AS (SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, ts, event_id, value FROM events)
SELECT user_id, k, event_id, value FROM e
QUALIFY row_number() OVER (PARTITION BY user_id, k ORDER BY ts DESC, event_id DESC) = 1"""


@register(SILVER_SQL)
def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of the first half of the month, then the second half merged into it."""
    rows, newest = state_rows(spark, sf_dir), [F.col("ts").desc(), F.col("event_id").desc()]
    keys = ["user_id", "k"]
    target = keyed.first_per_key(rows.where(F.col("ts") <= moment(MIDPOINT)), keys, newest)
    merged = keyed.upsert(target, rows.where(F.col("ts") > moment(MIDPOINT)), keys, newest)
    return merged.select("user_id", "k", "event_id", "value")


@register(SILVER_SQL)
def silver_table_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge through a bucketed table on disk; the second batch is merged twice (a replay)."""
    path = work_path(spark, "silver")
    rows, newest = state_rows(spark, sf_dir), [F.col("ts").desc(), F.col("event_id").desc()]
    first = rows.where(F.col("ts") <= moment(MIDPOINT))
    second = rows.where(F.col("ts") > moment(MIDPOINT))
    for batch in (first, second, second):
        lake.merge_into(spark, batch, path, ["user_id", "k"], newest, buckets=8)
    return spark.read.parquet(path).select("user_id", "k", "event_id", "value")


@register(
    """WITH i AS (SELECT l_orderkey, l_extendedprice, l_shipdate, l_linenumber, l_partkey FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) = 1)
SELECT o_orderkey AS key, coalesce(l_extendedprice, o_totalprice) AS value,
  CASE WHEN l_orderkey IS NULL THEN 'kept' ELSE 'replaced' END AS origin
FROM orders LEFT JOIN i ON o_orderkey = l_orderkey"""
)
def merge_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders replaced by their last arriving line."""
    existing = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("value"), F.lit("kept").alias("origin")
    )
    incoming = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"), F.col("l_extendedprice").alias("value"), F.lit("replaced").alias("origin"),
        "l_shipdate", "l_linenumber", "l_partkey",
    )
    return keyed.merge_by_key(existing, incoming, "key", ["l_shipdate", "l_linenumber", "l_partkey", "value"])


@register(
    CHECKED_SQL
    + """SELECT 'b3_quotes' AS source, column_name, round(ratio, 6) AS ratio, 1.0::DOUBLE AS floor, ratio >= 1.0 AS passed FROM (
  SELECT 'ticker' AS column_name, avg(CASE WHEN reason IN ('malformed_json', 'null_violation:ticker') THEN 0.0 ELSE 1.0 END) AS ratio FROM q
  UNION ALL
  SELECT 'price', avg(CASE WHEN event_type = 'signup' AND value > 100 OR event_id % 10 = 0 THEN 0.0 ELSE 1.0 END) FROM q)"""
)
def declared_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness of all received quotes, before any row is refused (a text price reads as missing)."""
    rows = checked_quotes(spark, sf_dir).select(*contracts.typed_columns(QUOTES))
    return quality.completeness(rows, QUOTES).withColumn("ratio", F.round("ratio", 6))


@register(
    f"""SELECT event_type AS source, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS newest,
  max(ts) < TIMESTAMP '{MONTH_END}' - INTERVAL 15 MINUTE AS stale FROM events GROUP BY 1"""
)
def declared_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event type as a source that promises to be at most 15 minutes old."""
    events = table(spark, sf_dir, "events")
    found = quality.staleness(events, F.col("event_type"), "ts", "PT15M", moment(MONTH_END))
    return found.select("source", stamp(F.col("newest")).alias("newest"), "stale")


PAGE_ITEMS_SQL = """
SELECT page_id AS page_no, CAST(0 AS INTEGER) AS position, 'p' || page_id AS document_id, '/sites/' || page_id || '/' || url AS source_path,
  url AS filename, '2024-01-01T00:00:00Z' AS updated_at FROM pages
"""


def feed_pages(pages: DataFrame) -> DataFrame:
    """Each web page as one page of a change feed: the page itself as a file and its folder."""
    item = F.struct(
        F.concat(F.lit("p"), "page_id").alias("id"),
        F.col("url").alias("name"),
        F.lit("2024-01-01T00:00:00Z").alias("lastModifiedDateTime"),
        F.struct(F.concat(F.lit("/sites/"), "page_id").alias("path")).alias("parentReference"),
        F.struct(F.lit("text/html").alias("mimeType")).alias("file"),
        F.lit(None).cast("struct<childCount:bigint>").alias("folder"),
    )
    folder = F.struct(
        F.concat(F.lit("f"), "page_id").alias("id"),
        F.lit("folder").alias("name"),
        F.lit("2024-01-01T00:00:00Z").alias("lastModifiedDateTime"),
        F.struct(F.lit("/sites").alias("path")).alias("parentReference"),
        F.lit(None).cast("struct<mimeType:string>").alias("file"),
        F.struct(F.lit(1).cast("long").alias("childCount")).alias("folder"),
    )
    link = F.concat(F.lit("https://feed/delta?token="), "page_id")
    body = F.to_json(F.struct(F.array(item, folder).alias("value"), link.alias("@odata.deltaLink")))
    return pages.select(F.col("page_id").alias("page_no"), body.alias("body"))


@register(PAGE_ITEMS_SQL)
def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changefeed.changed_files(feed_pages(table(spark, sf_dir, "pages")))


@register("SELECT 'https://feed/delta?token=' || max(page_id) AS delta_link FROM pages")
def change_feed_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changefeed.delta_link(feed_pages(table(spark, sf_dir, "pages")))
