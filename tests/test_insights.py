import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.operators import costs, drift, features, forest, ordering

QUOTE = "ticker string, price double, volume long, quote_timestamp string"
SALE = "opportunity_id string, lost_at string, estimated_value double"


def test_features(spark):
    quotes = spark.createDataFrame(
        [("X", 8.0, 5, "1"), ("Y", 3.0, 9, "2"), ("X", 6.0, 1, "3"), ("X", 9.0, 5, "4")], QUOTE
    )
    sales = spark.createDataFrame([("d", "1", 4.0), ("e", "2", 4.0), ("f", "3", 7.0), ("g", "4", 1.0), ("h", "5", 4.0)], SALE)
    got = features.build_features(quotes, sales, ("volume",), partitions=2).orderBy("row_index").collect()
    assert [r["price_change_pct"] for r in got] == [0.0, 0.0, -0.25, 0.5]
    spread = math.sqrt(32 / 3)  # volumes 5, 9, 1, 5 around 5
    assert [round(r["volume_zscore"], 9) for r in got] == [0.0, round(4 / spread, 9), round(-4 / spread, 9), 0.0]
    assert [round(r["lost_sales_value_zscore"], 9) for r in got] == [0.0, 0.0, round(3 / math.sqrt(4.5), 9), round(-3 / math.sqrt(4.5), 9)]


def test_features_of_empty_sides(spark):
    quotes = spark.createDataFrame([("A", 1.0, 1, "1"), ("A", 2.0, 2, "2")], QUOTE)
    nothing = spark.createDataFrame([], SALE)
    got = features.build_features(quotes, nothing, ("volume",), partitions=2).collect()
    assert len(got) == 1 and got[0]["lost_sales_value_zscore"] == 0.0
    assert features.build_features(spark.createDataFrame([], QUOTE), nothing, ("volume",), partitions=2).count() == 0


def test_change_against_zero(spark):
    data = [("A", p, 1, str(i)) for i, p in enumerate([0.0, 5.0, 0.0, 0.0, None, 4.0])]
    got = features.price_change(spark.createDataFrame(data, QUOTE), ("volume",), partitions=2).orderBy("quote_timestamp").collect()
    assert [r["price_change_pct"] for r in got] == [0.0, math.inf, -1.0, 0.0, 0.0, 0.0]


def test_zscore_without_spread(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (None,)], "v double")
    assert {r["z"] for r in features.zscore(df, "v", "z").collect()} == {0.0}


def brute_ks(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(sum(x <= p for x in a) / len(a) - sum(x <= p for x in b) / len(b)) for p in points)


def test_ks_statistic_and_decisions(spark):
    rnd = random.Random(1)
    near, far = [rnd.gauss(1, 0.1) for _ in range(50)], [rnd.gauss(5, 0.1) for _ in range(50)]
    half = [rnd.choice([0.0, 1.0, 2.0]) for _ in range(70)]  # one value in three: heavy ties

    def run(a, b):
        frames = [spark.createDataFrame([(float(x),) for x in v], "v double") for v in (a, b)]
        return drift.ks_two_sample(*frames, ["v"], partitions=5).first()

    assert run(near, far)["drifted"] and run(near, far)["statistic"] == 1.0
    assert not run(near, near)["drifted"] and run(near, near)["p_value"] == 1.0
    assert not run([1.0], [2.0, 3.0])["drifted"]
    assert run(half, near)["statistic"] == pytest.approx(brute_ks(half, near))
    assert drift.any_drift(spark.createDataFrame([], "drifted boolean")).first()["branch"] == "skip"


def test_shadow_comparison(spark):
    pairs = list(zip([0.1, -0.2, 0.3, -0.1], [-0.1, -0.2, 0.1, 0.2]))
    got = drift.shadow_comparison(spark.createDataFrame(pairs, "champion double, challenger double")).first()
    assert got["champion_anomaly_rate"] == 0.5 and got["challenger_anomaly_rate"] == 0.5
    empty = drift.shadow_comparison(spark.createDataFrame([], "champion double, challenger double")).first()
    assert tuple(empty) == (0.0, 0.0, 0.0, 0.0)


def test_cost_anomalies(spark, rows):
    schema = "job_name string, consumption double"
    history = spark.createDataFrame(
        [("dag_a", v) for v in (10.0, 11.0, 9.0, 10.0, 10.0)] + [("dag_b", v) for v in (9.0, 11.0, 10.0, 10.0, 10.0)], schema
    )
    current = spark.createDataFrame([("dag_a", 100.0), ("dag_b", 10.0)], schema)
    assert rows(costs.detect_cost_anomalies(current, history), "job_name") == [("dag_a",)]
    assert costs.detect_cost_anomalies(current, history.limit(0)).count() == 0
    assert costs.detect_cost_anomalies(current, history.limit(1)).count() == 0


def test_forest_finds_planted_outliers_whatever_the_partitioning(spark):
    rnd = random.Random(5)
    data = [(i, rnd.gauss(0, 1), rnd.gauss(0, 1)) for i in range(600)] + [(1000 + i, 9.0 + i, -9.0 - i) for i in range(3)]
    names = ["a", "b"]
    results = []
    for parts in (1, 5):
        df = spark.createDataFrame(data, "id long, a double, b double").repartition(parts)
        nodes = forest.fit(df, names, ["id"], trees=30, sample=128)
        sizes = [r["rows"] for r in nodes.where("node = 0").collect()]
        assert sizes == [128] * 30
        offset = forest.score_offset(df, nodes, names)
        raw = [r["raw_score"] for r in forest.raw_scores(df, nodes, names).collect()]
        assert offset.first()["offset"] == pytest.approx(np.quantile(raw, forest.CONTAMINATION), abs=1e-12)
        scored = forest.anomaly_scores(df, nodes, offset, names).collect()
        results.append({r["id"]: r["anomaly_score"] for r in scored})
    first, second = results
    assert np.allclose([first[k] for k in sorted(first)], [second[k] for k in sorted(second)])
    lowest = sorted(first, key=first.get)[:3]
    assert set(lowest) == {1000, 1001, 1002}
    assert 0.02 <= sum(v < 0 for v in first.values()) / len(first) <= 0.06


def test_insights_need_a_champion(spark):
    scored = spark.createDataFrame(
        [(i, "T", s) for i, s in enumerate([0.5, -0.3, -0.1, 0.2])], "row_index int, ticker string, anomaly_score double"
    )
    now = F.lit("2026-01-01").cast("timestamp")
    champion = spark.createDataFrame([("3",)], "version string")
    found = forest.insights(scored, champion, now, ["row_index"])
    assert found.count() == 2 and {r["model_version"] for r in found.collect()} == {"3"}
    assert forest.insights(scored, champion.limit(0), now, ["row_index"]).count() == 0


def test_promotion_candidates(spark):
    aliases = spark.createDataFrame(
        [("m1", "champion", 1), ("m1", "challenger", 2), ("m2", "challenger", 1), ("m3", "champion", 1),
         ("m3", "challenger", 1), ("m4", "champion", 1), ("m4", "challenger", 2)],
        "model_name string, alias string, version int",
    )
    scores = spark.createDataFrame([("m1", -1.0, 1.0), ("m2", 1.0, 1.0)], "model_name string, champion double, challenger double")
    found = drift.promotion_candidates(aliases, drift.shadow_comparison(scores, ["model_name"])).collect()
    got = {r["model_name"]: (r["note"], r["champion_anomaly_rate"]) for r in found}
    assert got == {"m1": (None, 1.0), "m2": ("no champion yet", None), "m4": ("no current data", None)}


def test_value_at_rank_against_sorting(spark):
    rnd = random.Random(4)
    values = [rnd.choice([0.5, 0.5, -3.0, rnd.gauss(0, 1), rnd.gauss(0, 1e-12), 1e9]) for _ in range(400)] + [5e-324, 0.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    ordered = sorted(v for v in values if v is not None)
    for rank in (0, 7, 133, 200, 399, 401):
        found, below = ordering.value_at_rank(df, "v", rank)
        assert found == ordered[rank] and below == sum(v < found for v in ordered)
    assert ordering.value_at_rank(df, "v", len(ordered)) is None and ordering.value_at_rank(df.limit(0), "v", 0) is None


def test_offset_is_the_interpolated_quantile(spark):
    scores = [round(math.sin(i) * 3, 1) for i in range(333)]
    df = spark.createDataFrame([(s,) for s in scores], "raw_score double")
    for share in (0.0, 0.05, 0.5, 0.731, 1.0):
        assert forest.offset_of(df, share) == pytest.approx(float(np.quantile(scores, share)))
