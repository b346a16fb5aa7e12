"""Latest rows, quality gates, metrics, products and views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import gold, keyed, metrics, quality
from siltstone.plans.declared import METRICS, PRODUCTS
from siltstone.plans.queries import MONTH_END, moment, register, stamp, table
from siltstone.session import work_path
from siltstone.sources.lake import publish


def day(name: str):
    return F.date_format(name, "yyyy-MM-dd")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def market_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("source_event_id"),
        day("l_shipdate").alias("event_date"),
        F.col("l_returnflag").alias("source_class"),
        F.col("l_extendedprice").alias("metric_value"),
        F.col("l_shipdate").alias("_updated_at"),
        "l_partkey",
        "l_suppkey",
    )


def sale_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lost sales with the region of their customer."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(
        nations.select("n_nationkey", "r_name"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("sale_id"),
        day("o_orderdate").alias("event_date"),
        F.col("r_name").alias("region"),
        F.col("o_totalprice").alias("lost_value"),
        F.concat(F.lit("c"), F.col("o_custkey"), F.lit("@example.com")).alias("customer_email"),
    )


def cost_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities per job (line status) and day."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(day("l_shipdate").alias("usage_date"), F.col("l_linestatus").alias("job_name"))
        .agg(F.sum("l_quantity").alias("consumption"))
        .withColumn("usage_id", F.concat_ws("-", "usage_date", "job_name"))
    )


def health_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("h"), "event_id").alias("event_id"),
        F.date_trunc("hour", "ts").alias("observed_at"),
        F.format_string("CAP-%02d", (F.col("user_id") % 10 + 1).cast("int")).alias("capability_id"),
        F.when(failed, "FAIL").otherwise("PASS").alias("result"),
        F.when(failed, "ASSERTION_FAILED").alias("reason_code"),
        F.col("ts").alias("_updated_at"),
    )


@register(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS ship_date FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1"""
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    tie = [F.col(c).desc() for c in ("l_partkey", "l_suppkey", "l_extendedprice")]
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"
    )
    latest = keyed.latest_per_key(rows, ["l_orderkey", "l_linenumber"], "l_shipdate", tie)
    return latest.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day("l_shipdate").alias("ship_date"))


@register(
    """SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d') AS event_date FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, event_id) = 1"""
)
def latest_first_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest day per user; the first event of that day wins the tie."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", day("ts").alias("event_date"))
    return keyed.latest_by_key(rows, ["user_id"], "event_date", ["event_id"])


@register(
    """WITH p AS (
  SELECT 'raw_lines' AS product_id, l_orderkey || '-' || l_linenumber AS k, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS r FROM lineitem
  UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR), o_orderstatus FROM orders
  UNION ALL SELECT 'quotes', CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id AS VARCHAR) END, event_type FROM events),
f AS (SELECT product_id, count(*) AS n, count(k) AS nk, count(DISTINCT k) AS dk, count(r) AS nr FROM p GROUP BY 1)
SELECT product_id, CAST(n AS BIGINT) AS rows, n = nk AND n = dk AND n = nr AND product_id <> 'quotes' AS passed,
  concat_ws(',', CASE WHEN nk < n THEN 'NULL_PRIMARY_KEY' END, CASE WHEN dk < nk OR n - nk > 1 THEN 'DUPLICATE_BUSINESS_KEY' END,
    CASE WHEN nr < n OR (nk < n AND product_id = 'quotes') THEN 'REQUIRED_COLUMN_NULL' END,
    CASE WHEN product_id = 'quotes' THEN 'SENSITIVE_COLUMN_IN_REQUIRED_SCHEMA' END) AS reason_codes
FROM f"""
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("k"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("r"),
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("r"))
    quotes = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "error", F.col("event_id")).alias("k"), F.col("event_type").alias("r")
    )
    cases = [
        (lines, quality.Product("raw_lines", "k", "r", ("r",))),
        (orders, quality.Product("orders", "k", "r", ("k", "r"))),
        (quotes, quality.Product("quotes", "k", "r", ("k", "r"), ("r",))),
    ]
    reports = union_all([quality.quality_report(df, product) for df, product in cases])
    return reports.withColumn("reason_codes", F.array_join("reason_codes", ","))


@register(
    """SELECT strftime(l_shipdate, '%Y-%m-%d') AS event_date, l_returnflag AS source_class,
  round(sum(l_extendedprice), 2) AS metric_value FROM lineitem GROUP BY 1, 2"""
)
def sum_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = metrics.sum_by(market_rows(spark, sf_dir), ("event_date", "source_class"), "metric_value")
    return totals.withColumn("metric_value", F.round("metric_value", 2))


@register(
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f') AS observed_at,
  'CAP-' || lpad(CAST(user_id % 10 + 1 AS VARCHAR), 2, '0') AS capability_id,
  CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END AS result, CAST(count(*) AS BIGINT) AS metric_count
FROM events GROUP BY 1, 2, 3"""
)
def operational_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = gold.operational_metrics(health_rows(spark, sf_dir))
    return counts.withColumn("observed_at", stamp(F.col("observed_at")))


@register(
    """SELECT strftime(l_shipdate, '%Y-%m-%d') AS event_date, l_returnflag AS source_class,
  round(sum(l_extendedprice), 2) AS total_value, CAST(count(*) AS BIGINT) AS metric_count,
  strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S.%f') AS source_watermark FROM lineitem GROUP BY 1, 2"""
)
def market_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = metrics.market_aggregate(market_rows(spark, sf_dir))
    return totals.withColumn("total_value", F.round("total_value", 2)).withColumn(
        "source_watermark", stamp(F.col("source_watermark"))
    )


EXECUTIVE_SQL = """
SELECT 'market_total_value' AS metric_id, strftime(l_shipdate, '%Y-%m-%d') AS day, l_returnflag AS grain, round(sum(l_extendedprice), 2) AS value
FROM lineitem GROUP BY 2, 3
UNION ALL
SELECT 'lost_sales_value', strftime(o_orderdate, '%Y-%m-%d'), r_name, round(sum(o_totalprice), 2)
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 2, 3
UNION ALL
SELECT 'finops_consumption', strftime(l_shipdate, '%Y-%m-%d'), l_linestatus, round(sum(l_quantity), 2) FROM lineitem GROUP BY 2, 3"""


def metric_rows(values: DataFrame, metric_id: str, day_column: str, grain: str, value: str) -> DataFrame:
    return values.select(
        F.lit(metric_id).alias("metric_id"),
        F.col(day_column).alias("day"),
        F.col(grain).alias("grain"),
        F.round(value, 2).alias("value"),
    )


@register(EXECUTIVE_SQL)
def executive_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = {
        "gold_market_insights": market_rows(spark, sf_dir), "gold_lost_sales": sale_rows(spark, sf_dir), "gold_finops_costs": cost_rows(spark, sf_dir),
    }
    sets = gold.executive_metrics(products, METRICS.values())
    return union_all(
        [
            metric_rows(sets["market_total_value"], "market_total_value", "event_date", "source_class", "metric_value"),
            metric_rows(sets["lost_sales_value"], "lost_sales_value", "event_date", "region", "lost_value"),
            metric_rows(sets["finops_consumption"], "finops_consumption", "usage_date", "job_name", "consumption"),
        ]
    )


@register(
    EXECUTIVE_SQL
    + """
UNION ALL
SELECT 'platform_quality_failures', strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f'),
  'CAP-' || lpad(CAST(user_id % 10 + 1 AS VARCHAR), 2, '0'), CAST(count(*) FILTER (event_type = 'error') AS DOUBLE)
FROM events GROUP BY 2, 3"""
)
def registry_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every registered formula at its grain."""
    sources = {
        "gold_market_insights": market_rows(spark, sf_dir),
        "gold_lost_sales": sale_rows(spark, sf_dir),
        "gold_finops_costs": cost_rows(spark, sf_dir),
        "gold_platform_health": health_rows(spark, sf_dir).withColumn("observed_at", stamp(F.col("observed_at"))),
    }
    parts = []
    for spec in METRICS.values():
        grain, when = spec.grain
        values = metrics.metric(sources[spec.product], spec)
        parts.append(
            metric_rows(values.withColumn(spec.metric_id, F.col(spec.metric_id).cast("double")), spec.metric_id, when, grain, spec.metric_id)
        )
    return union_all(parts)


@register(
    """WITH v AS (SELECT user_id, sum(value - 20) AS net, sum(CASE WHEN event_type = 'purchase' THEN value END) AS spent FROM events GROUP BY 1)
SELECT 'net_value' AS metric_id, 'not_null' AS test, CAST(count(*) FILTER (net IS NULL) AS BIGINT) AS violations, count(*) FILTER (net IS NULL) = 0 AS passed FROM v
UNION ALL SELECT 'net_value', 'non_negative', CAST(count(*) FILTER (net < 0) AS BIGINT), count(*) FILTER (net < 0) = 0 FROM v
UNION ALL SELECT 'spent', 'not_null', CAST(count(*) FILTER (spent IS NULL) AS BIGINT), count(*) FILTER (spent IS NULL) = 0 FROM v
UNION ALL SELECT 'spent', 'non_negative', CAST(count(*) FILTER (spent < 0) AS BIGINT), count(*) FILTER (spent < 0) = 0 FROM v"""
)
def metric_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared value tests on two metrics per user, one of which can go below zero."""
    events = table(spark, sf_dir, "events")
    tests = ("not_null", "non_negative")
    specs = [
        metrics.Metric("net_value", "events", ("user_id",), "sum(value - 20)", tests),
        metrics.Metric("spent", "events", ("user_id",), "sum(if(event_type = 'purchase', value, null))", tests),
    ]
    return union_all([metrics.metric_tests(metrics.metric(events, s), s) for s in specs])


@register(
    """WITH p AS (
  SELECT 'gold_market_insights' AS product_id, CAST(count(DISTINCT l_orderkey || '-' || l_linenumber) AS BIGINT) AS rows FROM lineitem
  UNION ALL SELECT 'gold_lost_sales', count(DISTINCT o_orderkey) FROM orders
  UNION ALL SELECT 'gold_finops_costs', count(DISTINCT (l_shipdate, l_linestatus)) FROM lineitem
  UNION ALL SELECT 'gold_platform_health', count(DISTINCT event_id) FROM events)
SELECT product_id, CAST(rows AS BIGINT) AS rows, true AS passed, '' AS reason_codes FROM p"""
)
def product_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four products built and gated; a breach fails the query."""
    sources = {
        "gold_market_insights": (market_rows(spark, sf_dir), ["l_partkey", "l_suppkey", "metric_value"]),
        "gold_lost_sales": (sale_rows(spark, sf_dir), ["lost_value"]),
        "gold_finops_costs": (cost_rows(spark, sf_dir), ["consumption"]),
        "gold_platform_health": (health_rows(spark, sf_dir), ["result"]),
    }
    reports = []
    for product_id, (rows, arrival) in sources.items():
        built, _ = quality.build_product(rows, PRODUCTS[product_id], arrival)
        reports.append(quality.require_quality(built, PRODUCTS[product_id]))
    return union_all(reports).withColumn("reason_codes", F.array_join("reason_codes", ","))


LOST_SQL = """SELECT l_orderkey AS sale_id, strftime(l_shipdate, '%Y-%m-%d') AS event_date, l_linestatus AS region,
  l_extendedprice AS lost_value, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS source_watermark FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1"""


def lost_sales_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("sale_id"),
        day("l_shipdate").alias("event_date"),
        F.col("l_linestatus").alias("region"),
        F.col("l_extendedprice").alias("lost_value"),
        F.col("l_shipdate").alias("_updated_at"),
        "l_linenumber", "l_partkey", "l_suppkey",
    )
    tie = tuple(F.col(c).asc() for c in ("l_linenumber", "l_partkey", "l_suppkey", "lost_value"))
    return gold.latest_product(silver, "sale_id", ("sale_id", "event_date", "region", "lost_value"), tie)


@register(LOST_SQL)
def gold_lost_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = lost_sales_product(spark, sf_dir)
    return product.withColumn("source_watermark", stamp(F.col("source_watermark")))


@register(LOST_SQL)
def published_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product published twice as a table and read back by name."""
    path, name = work_path(spark, "gold"), "gold_lost_sales"
    for _ in range(2):
        publish(
            lost_sales_product(spark, sf_dir), name, path,
            "Governed lost-sales metrics by region and date", {"contract_version": "1"},
        )
    return spark.table(name).withColumn("source_watermark", stamp(F.col("source_watermark")))


VIEW_SQL = """
WITH m AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS event_date, l_returnflag AS source_class, sum(l_extendedprice) AS total_value,
    max(l_shipdate) AS source_watermark FROM lineitem GROUP BY 1, 2),
l AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS event_date, o_totalprice AS lost_value FROM orders),
f AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS usage_date, l_linestatus AS job_name, sum(l_quantity) AS consumption FROM lineitem GROUP BY 1, 2)
"""


@register(
    VIEW_SQL
    + """SELECT m.event_date, source_class, round(total_value, 2) AS total_value, lost_value, consumption,
  strftime(source_watermark, '%Y-%m-%d %H:%M:%S.%f') AS source_watermark
FROM m LEFT JOIN l USING (event_date) LEFT JOIN f ON f.usage_date = m.event_date"""
)
def executive_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view as declared. Market and cost rows per date are bounded by their classes, so it
    grows with the lost sales only."""
    view = gold.executive_view(
        metrics.market_aggregate(market_rows(spark, sf_dir)), sale_rows(spark, sf_dir), cost_rows(spark, sf_dir)
    )
    return view.withColumn("total_value", F.round("total_value", 2)).withColumn(
        "source_watermark", stamp(F.col("source_watermark"))
    )


@register(
    VIEW_SQL
    + """, ls AS (SELECT event_date, sum(lost_value) AS lost_value FROM l GROUP BY 1),
fs AS (SELECT usage_date, sum(consumption) AS consumption FROM f GROUP BY 1)
SELECT m.event_date, source_class, round(total_value, 2) AS total_value, round(lost_value, 2) AS lost_value, consumption,
  strftime(source_watermark, '%Y-%m-%d %H:%M:%S.%f') AS source_watermark
FROM m LEFT JOIN ls USING (event_date) LEFT JOIN fs ON fs.usage_date = m.event_date"""
)
def executive_view_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = gold.executive_view_daily(
        metrics.market_aggregate(market_rows(spark, sf_dir)), sale_rows(spark, sf_dir), cost_rows(spark, sf_dir)
    )
    rounded = view.withColumn("total_value", F.round("total_value", 2)).withColumn("lost_value", F.round("lost_value", 2))
    return rounded.withColumn("source_watermark", stamp(F.col("source_watermark")))


@register(
    f"""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f') AS observed_at,
  'CAP-' || lpad(CAST(user_id % 10 + 1 AS VARCHAR), 2, '0') AS capability_id,
  CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END AS result,
  CASE WHEN event_type = 'error' THEN 'ASSERTION_FAILED' END AS reason_code,
  CASE WHEN date_trunc('hour', ts) < TIMESTAMP '{MONTH_END}' - INTERVAL 720 MINUTE THEN 'STALE' ELSE 'FRESH' END AS freshness_status
FROM events"""
)
def operational_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness of each health row at the end of the month, with a limit of half a day."""
    view = gold.operational_view(health_rows(spark, sf_dir), moment(MONTH_END), minutes=720)
    return view.withColumn("observed_at", stamp(F.col("observed_at")))
