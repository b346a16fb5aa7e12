import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import keyed, metrics, quality
from siltstone.operators.ordering import lag_by_key, running_extremes, with_row_index
from siltstone.operators.skew import hot_keys, left_join_many, lookup_join, salted_join
from siltstone.plans.declared import PRODUCTS
from siltstone.session import is_small


def test_latest_by_key_keeps_first_arrival_on_ties(spark, rows):
    df = spark.createDataFrame(
        [("a", "10:00", 1, 0), ("a", "11:00", 2, 1), ("a", "11:00", 3, 2), ("b", "09:00", 4, 3)],
        "id string, at string, value int, arrival int",
    )
    assert rows(keyed.latest_by_key(df, ["id"], "at", ["arrival"]), "id", "value") == [("a", 2), ("b", 4)]


@pytest.mark.parametrize("row", [(None, "10:00"), ("a", None)])
def test_latest_by_key_fails_on_null(spark, row):
    df = spark.createDataFrame([(*row, 0)], "id string, at string, arrival int")
    with pytest.raises(Exception, match="cannot be null"):
        keyed.latest_by_key(df, ["id"], "at", ["arrival"]).collect()


def test_checks_ignore_rows_filtered_before(spark):
    df = spark.createDataFrame([("a", 1, 0), (None, 2, 1)], "id string, v int, n int").where("v < 2")
    assert keyed.latest_by_key(df, ["id"], "v", ["n"]).count() == 1


def test_merge_by_key(spark, rows):
    old = spark.createDataFrame([("a", 1), ("b", 5)], "id string, value int")
    new = spark.createDataFrame([("a", 2, 0), ("a", 3, 1), ("c", 9, 2)], "id string, value int, n int")
    assert rows(keyed.merge_by_key(old, new, "id", ["n"])) == [("a", 3), ("b", 5), ("c", 9)]
    bad = spark.createDataFrame([(None, 2, 0)], "id string, value int, n int")
    with pytest.raises(Exception, match="cannot be null"):
        keyed.merge_by_key(old, bad, "id", ["n"]).collect()


@pytest.mark.parametrize("limit", [1000, 0])
def test_upsert_null_keys_never_match(spark, rows, limit):
    old = spark.createDataFrame([("a", 1), (None, 7)], "id string, value int")
    new = spark.createDataFrame([(None, 8), (None, 9), ("a", None)], "id string, value int")
    merged = keyed.upsert(old, new, ["id"], [F.col("value").desc()], limit)
    assert rows(merged) == sorted([("a", None), (None, 7), (None, 8), (None, 9)], key=repr)


@pytest.mark.parametrize("limit", [1000, 0])
def test_insert_new_is_idempotent(spark, rows, limit):
    outbox = spark.createDataFrame([("k1",)], "key string")
    incoming = spark.createDataFrame([("k1", 0), ("k2", 1), ("k2", 2)], "key string, n int")
    fresh = keyed.insert_new(outbox, incoming, "key", ["n"], limit)
    assert rows(fresh) == [("k2", 1)]
    assert keyed.insert_new(outbox.unionByName(fresh.select("key")), incoming, "key", ["n"]).count() == 0


def test_hot_key_is_cut_before_the_exchange(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = keyed.first_per_key(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan") :]
    assert physical.count("WindowGroupLimit") == 2


def test_sum_and_count(spark, rows):
    df = spark.createDataFrame([("d", 2.0, "CAP-01"), ("d", 3.0, "CAP-01")], "day string, value double, cap string")
    assert rows(metrics.sum_by(df, ["day"], "value")) == [("d", 5.0)]
    assert rows(metrics.count_by(df, ["cap"])) == [("CAP-01", 2)]
    with pytest.raises(Exception, match="null value"):
        metrics.sum_by(spark.createDataFrame([("d", None)], "day string, value double"), ["day"], "value").collect()


def test_quality_reasons(spark):
    product = quality.Product("p", "id", "value", ("id", "value"))

    def report(data, spec=product):
        df = spark.createDataFrame(data, "id string, value int")
        return quality.quality_report(df, spec).first()

    assert tuple(report([("a", 1), ("b", 2)])) == ("p", 2, True, [])
    assert report([(None, 1)])["reason_codes"] == ["NULL_PRIMARY_KEY", "REQUIRED_COLUMN_NULL"]
    assert report([("a", None)])["reason_codes"] == ["REQUIRED_COLUMN_NULL"]
    assert report([("a", 1), ("a", 2)])["reason_codes"] == ["DUPLICATE_BUSINESS_KEY"]
    assert "DUPLICATE_BUSINESS_KEY" in report([(None, 1), (None, 2)])["reason_codes"]
    exposed = quality.Product("p", "id", "value", ("id", "value"), ("value",))
    assert report([("a", 1)], exposed)["reason_codes"] == ["SENSITIVE_COLUMN_IN_REQUIRED_SCHEMA"]
    assert tuple(report([])) == ("p", 0, True, [])
    with pytest.raises(Exception, match="QUALITY_FAILED:p:DUPLICATE_BUSINESS_KEY"):
        df = spark.createDataFrame([("a", 1), ("a", 2)], "id string, value int")
        quality.require_quality(df, product).collect()


def test_products_drop_undeclared_columns(spark):
    sale = [("s1", "2026-08-17", "sudeste", 4.0, "x@example.com", 0)]
    df = spark.createDataFrame(sale, "sale_id string, event_date string, region string, lost_value double, customer_email string, n int")
    built, report = quality.build_product(df, PRODUCTS["gold_lost_sales"], ["n"])
    assert built.columns == ["sale_id", "event_date", "region", "lost_value"] and report.first()["passed"]


def test_iso_interval(spark):
    got = spark.range(1).select(
        *[quality.iso_interval(t).alias(t) for t in ("PT5M", "P1D", "P1DT2H30M", "PT10S")]
    ).first()
    assert [v.total_seconds() for v in got] == [300, 86400, 95400, 10]


def hot_rows(n=900, seed=3):
    rnd = random.Random(seed)
    return [("hot" if i % 3 == 0 else f"k{rnd.randrange(20)}", rnd.randrange(10**6), float(i % 17), i) for i in range(n)]


def test_row_index_matches_a_sort(spark):
    data = hot_rows()
    df = spark.createDataFrame(data, "k string, at int, v double, i int").repartition(5)
    got = {r["i"]: r["row_index"] for r in with_row_index(df, ["at", "i"], partitions=6).collect()}
    expected = {row[3]: n for n, row in enumerate(sorted(data, key=lambda r: (r[1], r[3])))}
    assert got == expected


def test_lag_over_a_hot_key(spark):
    data = hot_rows()
    df = spark.createDataFrame(data, "k string, at int, v double, i int").repartition(5)
    found = lag_by_key(df, "k", ["at", "i"], "v", "prev", partitions=8)
    got = {r["i"]: r["prev"] for r in found.collect()}
    last, expected = {}, {}
    for k, _, v, i in sorted(data, key=lambda r: (r[1], r[3])):
        expected[i] = last.get(k)
        last[k] = v
    assert got == expected


def test_running_extremes(spark):
    data = [(g, float(i), random.Random(i).choice([-1.0, 1.0])) for g in "ab" for i in range(300)]
    df = spark.createDataFrame(data, "g string, o double, s double")
    got = {r["g"]: (r["high"], r["low"]) for r in running_extremes(df, "g", "o", F.col("s"), 7).collect()}
    for g in "ab":
        total, path = 0.0, []
        for _, _, s in sorted(r for r in data if r[0] == g):
            total += s
            path.append(total)
        assert got[g] == (max(path), min(path))


def test_salted_join_equals_plain_join(spark, rows):
    big = spark.createDataFrame(hot_rows(), "k string, at int, v double, i int")
    lookup = big.select("k").distinct().where("k <> 'k3'").withColumn("name", F.upper("k"))
    hot = hot_keys(big, ["k"], share=0.1).collect()
    assert [(r["k"], r["_slices"] >= 3) for r in hot] == [("hot", True)]
    for how in ("inner", "left"):
        salted = salted_join(big, lookup, ["k"], ["i"], how, share=0.1)
        assert rows(salted, "i", "name") == rows(big.join(lookup, "k", how), "i", "name")


def test_outer_join_to_a_hot_side(spark, rows):
    many = spark.createDataFrame(hot_rows(), "k string, at int, v double, i int")
    left = many.select("k").distinct().unionByName(spark.createDataFrame([("none",)], "k string")).withColumn("n", F.length("k"))
    expected = rows(left.join(many, "k", "left"), "k", "n", "i")
    for limit in (1000, 3):  # broadcast, then salted
        assert rows(left_join_many(left, many, ["k"], ["i"], limit), "k", "n", "i") == expected
    again = lookup_join(many, left, ["k"], ["i"], "left", limit=3)
    assert rows(again, "k", "n", "i") == rows(many.join(left, "k", "left"), "k", "n", "i")


def test_an_exploded_side_is_measured_before_it_is_broadcast(spark):
    wide = spark.range(10).select(F.explode(F.sequence(F.lit(0), F.lit(99))).alias("id"))
    assert is_small(wide, 1000) and not is_small(wide, 999)
    long_texts = spark.range(70).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    assert not is_small(long_texts)


def test_rows_without_a_key_are_spread(spark):
    from siltstone.operators.skew import hot_keys, salted_join

    big = spark.createDataFrame([(None if i % 2 else i % 5, i) for i in range(200)], "k int, id long")
    lookup = spark.createDataFrame([(0, "a"), (2, "b"), (None, "n")], "k int, v string")
    assert {r["k"] for r in hot_keys(big, ["k"], 0.3).collect()} == {None}
    for how in ("left", "inner"):
        got = [(r["id"], r["v"]) for r in salted_join(big, lookup, ["k"], ["id"], how, 0.01).collect()]
        plain = [(r["id"], r["v"]) for r in big.join(lookup, "k", how).collect()]
        assert sorted(map(str, got)) == sorted(map(str, plain))


def test_lag_by_key_is_one_exchange_and_takes_null_keys(spark):
    rows = [("a" if i % 3 else None, i, float(i) if i % 7 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, at int, v double").repartition(5)
    found = lag_by_key(df, "k", ["at"], "v", "prev", partitions=7)
    by_key, expected = {}, {}
    for k, at, v in rows:
        expected[at] = by_key.get(k)
        by_key[k] = v
    assert {r["at"]: r["prev"] for r in found.collect()} == expected
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()  # the one exchange lies before the checkpoint
    assert lag_by_key(df.limit(0), "k", ["at"], "v", "prev").count() == 0
