"""Cost anomalies, model features, drift, isolation forest and promotion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import costs, drift, features, forest, healing
from siltstone.plans.queries import MIDPOINT, MONTH_END, moment, register, table
from siltstone.session import cut_lineage, work_path
from siltstone.sources import usage

LAST_MONTH = "2001-10-05 00:00:00"


def usage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("job"), "l_suppkey").alias("job_name"),
        F.col("l_shipdate").alias("usage_date"),
        F.col("l_quantity").alias("quantity"),
    )


@register(
    f"""SELECT 'job' || l_suppkey AS job_name, round(sum(l_quantity), 2) AS consumption FROM lineitem
WHERE l_shipdate >= TIMESTAMP '{LAST_MONTH}' GROUP BY 1"""
)
def usage_by_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    usage = costs.usage_by_job(usage_rows(spark, sf_dir), moment(LAST_MONTH))
    return usage.withColumn("consumption", F.round("consumption", 2))


@register(
    f"""SELECT 'run' || user_id AS job_name, round(5.0 * value, 6) AS consumption FROM events
WHERE ts >= TIMESTAMP '{MIDPOINT}' AND event_type <> 'error'"""
)
def usage_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as job runs of 5 * value seconds; failed runs have no end."""
    length = F.make_dt_interval(secs=(F.col("value") * 5).cast("decimal(18,6)"))
    runs = table(spark, sf_dir, "events").select(
        F.concat(F.lit("run"), "user_id").alias("job_name"),
        F.col("ts").alias("start_date"),
        F.when(F.col("event_type") != "error", F.col("ts") + length).alias("end_date"),
    )
    found = costs.run_durations(runs, moment(MIDPOINT))
    return found.withColumn("consumption", F.round("consumption", 6))


@register(
    f"""SELECT 'billing' AS billing, 'job' || l_suppkey AS job_name, round(sum(l_quantity), 2) AS consumption FROM lineitem
WHERE l_shipdate >= TIMESTAMP '{LAST_MONTH}' GROUP BY ALL
UNION ALL SELECT name, 'run' || o_custkey, CAST(count(*) * 60 AS DOUBLE) FROM orders, (VALUES ('broken'), ('absent')) AS n(name)
WHERE o_orderdate >= TIMESTAMP '{LAST_MONTH}' GROUP BY ALL"""
)
def usage_fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage from the billing table; from runs of a minute for each order where billing is not Parquet, and where it is absent."""
    base = work_path(spark, "usage")
    rows = usage_rows(spark, sf_dir).select("job_name", F.col("usage_date").cast("timestamp").alias("usage_date"), F.col("quantity").cast("double").alias("quantity"))
    rows.write.parquet(f"{base}/billing")
    rows.select(F.to_json(F.struct("*"))).write.text(f"{base}/broken")
    start = F.col("o_orderdate").cast("timestamp")
    table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run"), "o_custkey").alias("job_name"), start.alias("start_date"), (start + F.expr("INTERVAL 1 MINUTE")).alias("end_date")
    ).write.parquet(f"{base}/runs")
    since = F.lit(LAST_MONTH).cast("timestamp")
    found = [
        usage.fetch_usage(spark, f"{base}/{name}", f"{base}/runs", since).select(F.lit(name).alias("billing"), "job_name", F.round("consumption", 2).alias("consumption"))
        for name in ("billing", "broken", "absent")
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


ANOMALY_SQL = f"""
WITH b AS (SELECT 'job' || l_suppkey AS job_name, l_shipdate AS bucket, sum(l_quantity) AS consumption FROM lineitem GROUP BY 1, 2),
s AS (SELECT job_name, avg(consumption) AS mean, coalesce(stddev_samp(consumption), 0) AS std FROM b WHERE bucket < TIMESTAMP '{LAST_MONTH}' GROUP BY 1),
a AS (SELECT b.job_name, bucket, consumption, coalesce(mean, 0) + 2.0 * coalesce(std, 0) AS threshold, coalesce(std, 0) AS std
  FROM b LEFT JOIN s USING (job_name) WHERE bucket >= TIMESTAMP '{LAST_MONTH}')
"""


def cost_anomaly_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily consumption of the last month against each job's earlier days."""
    buckets = costs.usage_by_bucket(usage_rows(spark, sf_dir), "day")
    border = moment(LAST_MONTH)
    return costs.detect_cost_anomalies(
        buckets.where(F.col("bucket") >= border), buckets.where(F.col("bucket") < border)
    )


@register(
    ANOMALY_SQL
    + """SELECT job_name, strftime(bucket, '%Y-%m-%d') AS day, consumption, round(threshold, 6) AS threshold
FROM a WHERE std > 0 AND consumption > threshold"""
)
def cost_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cost_anomaly_rows(spark, sf_dir).select(
        "job_name", F.date_format("bucket", "yyyy-MM-dd").alias("day"), "consumption", F.round("threshold", 6).alias("threshold")
    )


@register(
    ANOMALY_SQL
    + """SELECT 'cost_anomaly' AS source_failure_type, job_name AS source,
  printf('consumption=%.2f threshold=%.2f', consumption, threshold) AS detail FROM a WHERE std > 0 AND consumption > threshold"""
)
def cost_anomaly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = F.format_string("consumption=%.2f threshold=%.2f", F.col("consumption"), F.col("threshold"))
    log = healing.event_log(
        cost_anomaly_rows(spark, sf_dir), F.col("job_name"), "cost_anomaly", detail, F.col("bucket")
    )
    return log.select("source_failure_type", "source", "detail")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("T"), "user_id").alias("ticker"),
        F.col("ts").alias("quote_timestamp"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("long").alias("volume"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("opportunity_id"),
        F.col("o_orderdate").alias("lost_at"),
        F.col("o_totalprice").alias("estimated_value"),
    )


CHANGE_SQL = """
WITH q AS (SELECT event_id, 'T' || user_id AS ticker, ts, value AS price, CAST(json_extract(props, '$.k') AS BIGINT) AS volume FROM events),
c AS (SELECT *, lag(price) OVER (PARTITION BY ticker ORDER BY ts, event_id) AS prev FROM q),
p AS (SELECT *, CASE WHEN prev IS NULL THEN 0.0 ELSE price / prev - 1.0 END AS price_change_pct FROM c),
z AS (SELECT avg(volume) AS m, stddev_samp(volume) AS s FROM q)
"""


@register(CHANGE_SQL + "SELECT event_id, ticker, round(price_change_pct, 6) AS price_change_pct FROM p")
def price_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = features.price_change(quotes(spark, sf_dir), ("event_id",))
    return changed.select("event_id", "ticker", F.round("price_change_pct", 6).alias("price_change_pct"))


@register(CHANGE_SQL + "SELECT event_id, round((volume - m) / s, 6) AS volume_zscore FROM q, z")
def volume_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = features.zscore(quotes(spark, sf_dir), "volume", "volume_zscore")
    return scored.select("event_id", F.round("volume_zscore", 6).alias("volume_zscore"))


FEATURES_SQL = (
    CHANGE_SQL
    + """, a AS (SELECT row_number() OVER (ORDER BY ts, ticker, event_id) - 1 AS i, ticker, ts, price_change_pct, (volume - m) / s AS vz FROM p, z),
o AS (SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i,
  (o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / (SELECT stddev_samp(o_totalprice) FROM orders) AS lz FROM orders)
"""
)


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.build_features(quotes(spark, sf_dir), sales(spark, sf_dir), ("event_id",))


@register(
    FEATURES_SQL
    + """SELECT CAST(i AS BIGINT) AS row_index, ticker, round(price_change_pct, 6) AS price_change_pct, round(vz, 6) AS volume_zscore,
  round(lz, 6) AS lost_sales_value_zscore FROM a JOIN o USING (i)"""
)
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = [F.round(c, 6).alias(c) for c in features.FEATURES]
    return feature_rows(spark, sf_dir).select("row_index", "ticker", *rounded)


def drift_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First against second half of the month: price, volume, and price shifted by a tenth of a standard deviation."""
    rows = quotes(spark, sf_dir).withColumn(
        "shifted", F.when(F.col("quote_timestamp") <= moment(MIDPOINT), F.col("price")).otherwise(F.col("price") * 1.2 + 1)
    )
    border = F.col("quote_timestamp") <= moment(MIDPOINT)
    return drift.ks_two_sample(rows.where(border), rows.where(~border), ["price", "volume", "shifted"])


KS_SQL = f"""
WITH q AS (SELECT value AS price, CAST(json_extract(props, '$.k') AS DOUBLE) AS volume, ts <= TIMESTAMP '{MIDPOINT}' AS base FROM events),
t AS (SELECT 'price' AS feature, price AS v, base FROM q UNION ALL SELECT 'volume', volume, base FROM q
  UNION ALL SELECT 'shifted', CASE WHEN base THEN price ELSE price * 1.2 + 1 END, base FROM q),
n AS (SELECT feature, count(*) FILTER (base) AS nb, count(*) FILTER (NOT base) AS nc FROM t GROUP BY 1),
c AS (SELECT feature, v, count(*) FILTER (base) AS b, count(*) FILTER (NOT base) AS c FROM t GROUP BY 1, 2),
r AS (SELECT feature, sum(b) OVER w AS sb, sum(c) OVER w AS sc FROM c WINDOW w AS (PARTITION BY feature ORDER BY v)),
d AS (SELECT feature, any_value(nb) AS nb, any_value(nc) AS nc, max(abs(sb / nb::DOUBLE - sc / nc::DOUBLE)) AS d FROM r JOIN n USING (feature) GROUP BY 1),
l AS (SELECT *, d * (sqrt(nb * nc / (nb + nc)::DOUBLE) + 0.12 + 0.11 / sqrt(nb * nc / (nb + nc)::DOUBLE)) AS lam FROM d),
pv AS (SELECT *, CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0,
  2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * lam * lam))))) END AS p FROM l)
"""


@register(
    KS_SQL
    + """SELECT feature, CAST(nb AS BIGINT) AS n_base, CAST(nc AS BIGINT) AS n_current, round(d, 6) AS statistic,
  round(p, 6) AS p_value, nb >= 2 AND nc >= 2 AND p < 0.05 AS drifted FROM pv"""
)
def ks_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drift_rows(spark, sf_dir)
    return found.withColumn("statistic", F.round("statistic", 6)).withColumn("p_value", F.round("p_value", 6))


@register(
    KS_SQL
    + "SELECT bool_or(p < 0.05) AS drifted, CASE WHEN bool_or(p < 0.05) THEN 'retrain' ELSE 'skip' END AS branch FROM pv"
)
def drift_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.any_drift(drift_rows(spark, sf_dir))


SCORES_SQL = """
WITH s AS (SELECT source AS model_name, (coalesce(quality, 0) - 0.6) + n_chars / 100000.0 AS champion, 0.3 - coalesce(toxic, 0) - n_chars / 50000.0 AS challenger
  FROM documents LEFT JOIN labels USING (doc_id))
"""


def shadow_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two score columns per document, labels that are absent as 0; a document's source is the model scored."""
    labelled = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    quality, toxic = (F.coalesce(c, F.lit(0)) for c in ("quality", "toxic"))
    return labelled.select(
        F.col("source").alias("model_name"),
        (quality - F.lit(0.6) + F.col("n_chars") / F.lit(100000.0)).alias("champion"),
        (F.lit(0.3) - toxic - F.col("n_chars") / F.lit(50000.0)).alias("challenger"),
    )


MEASURES_SQL = """round(avg(CASE WHEN champion < 0 THEN 1.0 ELSE 0.0 END), 6) AS champion_anomaly_rate,
  round(avg(CASE WHEN challenger < 0 THEN 1.0 ELSE 0.0 END), 6) AS challenger_anomaly_rate,
  round(avg(champion), 6) AS champion_mean_score, round(avg(challenger), 6) AS challenger_mean_score"""
MEASURES = ("champion_anomaly_rate", "challenger_anomaly_rate", "champion_mean_score", "challenger_mean_score")


@register(SCORES_SQL + f"SELECT {MEASURES_SQL} FROM s")
def shadow_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.shadow_comparison(shadow_scores(spark, sf_dir)).select(*[F.round(m, 6).alias(m) for m in MEASURES])


CANDIDATES_SQL = (
    SCORES_SQL
    + f""", a AS (SELECT DISTINCT source AS model_name, CAST(substr(source, 4) AS BIGINT) AS n FROM documents),
v AS (SELECT model_name, CASE WHEN n % 5 > 0 THEN n END AS champion_version, CASE WHEN n % 3 > 0 THEN n + n % 2 END AS challenger_version FROM a),
c AS (SELECT model_name, {MEASURES_SQL} FROM s GROUP BY 1),
pc AS (SELECT model_name, champion_version, challenger_version,
  CASE WHEN champion_version IS NULL THEN 'no champion yet' WHEN champion_anomaly_rate IS NULL THEN 'no current data' END AS note,
  CASE WHEN champion_version IS NOT NULL THEN champion_anomaly_rate END AS champion_anomaly_rate,
  CASE WHEN champion_version IS NOT NULL THEN challenger_anomaly_rate END AS challenger_anomaly_rate,
  CASE WHEN champion_version IS NOT NULL THEN champion_mean_score END AS champion_mean_score,
  CASE WHEN champion_version IS NOT NULL THEN challenger_mean_score END AS challenger_mean_score
FROM v LEFT JOIN c USING (model_name)
WHERE challenger_version IS NOT NULL AND challenger_version IS DISTINCT FROM champion_version)
"""
)


@register(CANDIDATES_SQL + "SELECT * FROM pc")
def promotion_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as models whose alias versions follow from their number."""
    models = table(spark, sf_dir, "documents").select(F.col("source").alias("model_name")).distinct()
    n = F.substring("model_name", 4, 9).cast("long")
    alias = F.explode(
        F.array(
            F.struct(F.lit("champion").alias("alias"), F.when(n % 5 > 0, n).alias("version")),
            F.struct(F.lit("challenger").alias("alias"), F.when(n % 3 > 0, n + n % 2).alias("version")),
        )
    )
    aliases = models.select("model_name", alias.alias("a")).select("model_name", "a.*").where("version is not null")
    found = drift.promotion_candidates(aliases, drift.shadow_comparison(shadow_scores(spark, sf_dir), ["model_name"]))
    return found.select(
        "model_name", "champion_version", "challenger_version", "note", *[F.round(m, 6).alias(m) for m in MEASURES]
    )


@register(
    CANDIDATES_SQL
    + """SELECT 'model_promotion' AS source_failure_type, 'model=' || model_name || ' challenger_version=' || challenger_version || ' comparison='
  || CASE WHEN note IS NOT NULL THEN '{"note":"' || note || '"}' ELSE '{"champion_anomaly_rate":' || champion_anomaly_rate || ',"challenger_anomaly_rate":'
  || challenger_anomaly_rate || ',"champion_mean_score":' || champion_mean_score || ',"challenger_mean_score":' || challenger_mean_score || '}' END AS detail FROM pc"""
)
def promotion_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drift.promotion_events(promotion_candidates(spark, sf_dir), F.lit("insights"), moment(MONTH_END))
    return found.select("source_failure_type", "detail")


def champion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest model version: one per part size."""
    return table(spark, sf_dir, "part").agg(F.max("p_size").alias("version"))


# A small forest of two trees over the features, in the layout of a fitted one.
SMALL_FOREST = [
    (0, 0, 0, 0.1, 1, 2, 0.0, 256), (0, 1, -1, 0.0, -1, -1, 6.5, 200), (0, 2, 1, 0.55, 3, 4, 0.0, 56),
    (0, 3, -1, 0.0, -1, -1, 4.25, 40), (0, 4, -1, 0.0, -1, -1, 2.0, 16),
    (1, 0, 2, -0.35, 1, 2, 0.0, 256), (1, 1, -1, 0.0, -1, -1, 3.0, 60), (1, 2, -1, 0.0, -1, -1, 7.75, 196),
]


@register(
    FEATURES_SQL
    + """, d AS (SELECT i, ticker,
  (CASE WHEN price_change_pct < 0.1 THEN 6.5 WHEN vz < 0.55 THEN 4.25 ELSE 2.0 END + CASE WHEN lz < -0.35 THEN 3.0 ELSE 7.75 END) / 2.0 AS depth FROM a JOIN o USING (i))
SELECT CAST(i AS BIGINT) AS row_index, ticker, round(-pow(2.0, -CAST(depth AS DOUBLE) / (2 * (ln(255.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2 * 255.0::DOUBLE / 256)), 6) AS raw_score FROM d"""
)
def forest_scores_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature matrix scored by the small forest."""
    nodes = spark.createDataFrame(SMALL_FOREST, forest.NODES)
    scored = forest.raw_scores(feature_rows(spark, sf_dir), nodes, list(features.FEATURES))
    return scored.select("row_index", "ticker", F.round("raw_score", 6).alias("raw_score"))


@register(
    """SELECT sha256(CAST((SELECT max(p_size) FROM part) AS VARCHAR) || '|' || event_id) AS insight_id, 'T' || user_id AS source_ticker,
  round(value - 100, 6) AS anomaly_score, CAST((SELECT max(p_size) FROM part) AS VARCHAR) AS model_version FROM events WHERE value - 100 < 0"""
)
def insight_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insights of derived scores: with a registered champion, and beside them none without one."""
    scored = quotes(spark, sf_dir).withColumn("anomaly_score", F.col("price") - 100)
    registered = champion(spark, sf_dir)
    found = [forest.insights(scored, c, moment(MONTH_END), ["event_id"]) for c in (registered, registered.where("false"))]
    return found[0].unionByName(found[1]).select("insight_id", "source_ticker", F.round("anomaly_score", 6).alias("anomaly_score"), "model_version")


@register()
def isolation_forest_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forest fitted on the feature matrix and its anomalies as insight rows (no SQL twin: randomised trees)."""
    matrix = cut_lineage(feature_rows(spark, sf_dir))  # read twice: training and scoring
    scored = forest.fit_and_score(matrix, list(features.FEATURES), ["row_index"])
    rows = forest.insights(scored, champion(spark, sf_dir), moment(MONTH_END), ["row_index"])
    return rows.withColumn("anomaly_score", F.round("anomaly_score", 6))
