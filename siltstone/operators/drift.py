"""Distribution drift, shadow comparison and promotion candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.healing import event_log
from siltstone.operators.ordering import running_extremes

P_VALUE = 0.05  # fixed value: a feature has drifted below this p-value
_TERMS = 100


def kolmogorov_p_value(statistic: Column, n_base: Column, n_current: Column) -> Column:
    """Two-sided p-value from the Kolmogorov limit with the usual small-sample correction.

    lambda = D (sqrt(e) + 0.12 + 0.11 / sqrt(e)) with e = n m / (n + m), and
    p = 2 sum (-1)^(k-1) exp(-2 k^2 lambda^2). The series only settles for lambda away from 0,
    where p is 1.
    """
    root = F.sqrt(n_base.cast("double") * n_current / (n_base + n_current))
    lam = statistic * (root + 0.12 + 0.11 / root)
    term = lambda total, k: total + F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * lam * lam)
    series = F.aggregate(F.sequence(F.lit(1), F.lit(_TERMS)), F.lit(0.0), term)
    return F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series)))


def ks_two_sample(
    base: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    p_value: float = P_VALUE,
    partitions: int | None = None,
) -> DataFrame:
    """Kolmogorov-Smirnov distance per feature: feature, n_base, n_current, statistic, p_value, drifted.

    Values are counted first (partial counts on the map side), so a repeated value costs one
    row; the gap between the two distribution functions is a running total over the distinct
    values, taken per range partition and shifted by the totals before it. Fewer than two
    values on a side never drift.
    """
    def tall(df: DataFrame, is_current: int) -> DataFrame:
        pairs = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
        return df.select(F.inline(F.array(*pairs)), F.lit(is_current).alias("c")).where("value is not null")

    samples = tall(base, 0).unionByName(tall(current, 1))
    counts = samples.groupBy("feature", "value").agg(
        F.sum(1 - F.col("c")).alias("b"), F.sum("c").alias("c")
    )
    # One row per feature, from the same exchange as the counts.
    totals = counts.groupBy("feature").agg(F.sum("b").alias("n_base"), F.sum("c").alias("n_current"))
    weighted = counts.join(totals.hint("broadcast"), "feature")
    # Whole-number steps over the common denominator n_base * n_current add up exactly.
    step = F.col("b").cast("double") * F.col("n_current") - F.col("c").cast("double") * F.col("n_base")
    extremes = running_extremes(weighted, "feature", "value", step, partitions)
    area = F.col("n_base").cast("double") * F.col("n_current")
    gap = F.coalesce(F.try_divide(F.greatest(F.abs("high"), F.abs("low")), area), F.lit(0.0))
    enough = (F.col("n_base") >= 2) & (F.col("n_current") >= 2)
    return (
        totals.join(extremes, "feature")
        .select("feature", "n_base", "n_current", gap.alias("statistic"))
        .withColumn("p_value", kolmogorov_p_value(F.col("statistic"), F.col("n_base"), F.col("n_current")))
        .withColumn("drifted", enough & (F.col("p_value") < p_value))
    )


def any_drift(drift: DataFrame) -> DataFrame:
    """One row: whether any feature drifted, and the branch that follows."""
    drifted = F.coalesce(F.bool_or("drifted"), F.lit(False))
    return drift.agg(drifted.alias("drifted")).withColumn(
        "branch", F.when(F.col("drifted"), "retrain").otherwise("skip")
    )


def shadow_comparison(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of negative scores and mean score of champion and challenger; no scores give 0."""
    def rate(name: str) -> Column:
        return F.avg(F.when(F.col(name).isNotNull(), (F.col(name) < 0).cast("double")))

    measures = {
        "champion_anomaly_rate": rate("champion"),
        "challenger_anomaly_rate": rate("challenger"),
        "champion_mean_score": F.avg("champion"),
        "challenger_mean_score": F.avg("challenger"),
    }
    return scores.groupBy(*by).agg(*[F.coalesce(m, F.lit(0.0)).alias(n) for n, m in measures.items()])


def promotion_candidates(aliases: DataFrame, comparison: DataFrame) -> DataFrame:
    """Challengers that differ from their champion, with the comparison or the reason there is none.

    ``aliases``: model_name, alias, version (one row per alias). ``comparison``: one row per
    model_name from :func:`shadow_comparison` over current data.
    """
    versions = aliases.groupBy("model_name").agg(
        F.max(F.when(F.col("alias") == "champion", F.col("version"))).alias("champion_version"),
        F.max(F.when(F.col("alias") == "challenger", F.col("version"))).alias("challenger_version"),
    )
    new = F.col("challenger_version").isNotNull() & ~F.col("challenger_version").eqNullSafe(F.col("champion_version"))
    measures = [c for c in comparison.columns if c != "model_name"]
    joined = versions.where(new).join(comparison, "model_name", "left")
    note = F.when(F.col("champion_version").isNull(), "no champion yet").when(
        F.col(measures[0]).isNull(), "no current data"
    )
    known = [F.when(note.isNull(), F.col(m)).alias(m) for m in measures]
    return joined.select("model_name", "champion_version", "challenger_version", note.alias("note"), *known)


def promotion_events(candidates: DataFrame, source: Column, detected_at: Column) -> DataFrame:
    """Candidates as ``model_promotion`` events whose detail carries the versions and the comparison."""
    measures = [c for c in candidates.columns if c not in ("model_name", "champion_version", "challenger_version", "note")]
    comparison = F.when(F.col("note").isNotNull(), F.to_json(F.struct("note"))).otherwise(F.to_json(F.struct(*measures)))
    detail = F.concat(
        F.lit("model="), "model_name", F.lit(" challenger_version="), "challenger_version", F.lit(" comparison="), comparison
    )
    return event_log(candidates, source, "model_promotion", detail, detected_at)
