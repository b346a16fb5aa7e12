"""Isolation forest after Liu, Ting and Zhou (2008).

Training looks at a bounded sample by design: each tree sees at most ``sample`` rows. The
sample is chosen by hash order, so it does not depend on how the input is partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.ordering import value_at_rank
from siltstone.session import cut_lineage

# Trees, rows per tree, share flagged as anomalies, seed.
TREES = 100
SAMPLE = 256
CONTAMINATION = 0.05
SEED = 42

NODES = "tree int, node int, feature int, cut double, left int, right int, path double, rows int"
_COLUMNS = ["tree", "node", "feature", "cut", "left", "right", "path", "rows"]
_EULER = 0.5772156649015329


def mean_path(n: np.ndarray) -> np.ndarray:
    """c(n): average depth of an unsuccessful search in a binary search tree of n keys."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    long = 2.0 * (np.log(safe - 1.0) + _EULER) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def training_sample(df: DataFrame, row_key: Sequence[str], trees: int, sample: int, seed: int) -> DataFrame:
    """Rows for each tree: the ``sample`` rows of the whole table with the smallest hash of (row, tree).

    About ``2 * sample`` rows lie below a tree's hash level whatever the table's size, so a row names
    the trees that may want it and only those copies leave the scan. That fewer than ``sample`` rows
    lie below the level is rarer than one in 10^30; a table of few rows goes to every tree whole.
    """
    available = F.greatest(df.agg(F.count("*")).scalar(), F.lit(1))
    marked = df.withColumn("_draw", F.xxhash64(F.lit(seed), *row_key)).withColumn("_share", F.lit(2.0 * sample) / available)
    wanted = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda tree: F.xxhash64("_draw", tree) / F.lit(2.0**64) + F.lit(0.5) <= F.col("_share"),
    )
    near = marked.withColumn("tree", F.explode(wanted)).withColumn("_place", F.xxhash64("_draw", "tree"))
    rank = F.row_number().over(W.partitionBy("tree").orderBy("_place", *row_key))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= sample).drop("_draw", "_share", "_place", "_rank")


def fit(
    df: DataFrame,
    features: Sequence[str],
    row_key: Sequence[str],
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
) -> DataFrame:
    """Nodes of the fitted trees, one task per tree over at most ``sample`` rows."""
    columns = list(features)

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        x = rows.sort_values(list(row_key))[columns].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        limit = math.ceil(math.log2(max(len(x), 2)))
        nodes: list[list[float]] = []
        waiting = [(np.arange(len(x)), 0, -1, 0)]
        while waiting:
            rows_here, depth, parent, side = waiting.pop()
            here = len(nodes)
            if parent >= 0:
                nodes[parent][4 + side] = here
            low, high = x[rows_here].min(axis=0), x[rows_here].max(axis=0)
            usable = np.flatnonzero(np.isfinite(high - low) & (high > low))
            if depth >= limit or len(rows_here) <= 1 or len(usable) == 0:
                leaf = depth + float(mean_path(len(rows_here)))
                nodes.append([tree, here, -1, 0.0, -1, -1, leaf, len(rows_here)])
                continue
            pick = int(rng.choice(usable))
            cut = float(rng.uniform(low[pick], high[pick]))
            goes_left = x[rows_here, pick] < cut
            nodes.append([tree, here, pick, cut, -1, -1, 0.0, len(rows_here)])
            waiting.append((rows_here[~goes_left], depth + 1, here, 1))
            waiting.append((rows_here[goes_left], depth + 1, here, 0))
        return pd.DataFrame(nodes, columns=_COLUMNS)

    drawn = training_sample(df.select(*dict.fromkeys([*row_key, *columns])), row_key, trees, sample, seed)
    return drawn.groupBy("tree").applyInPandas(grow, NODES)


def raw_scores(df: DataFrame, nodes: DataFrame, features: Sequence[str], output: str = "raw_score") -> DataFrame:
    """Add -2^(-mean depth / c(rows per tree)); lower is more abnormal.

    The node table has at most ``2 * sample`` rows per tree and is sent to the tasks once.
    """
    model = nodes.orderBy("tree", "node").toPandas()  # bounded by trees * 2 * sample
    forest = [group.to_numpy(dtype=float) for _, group in model.groupby("tree")]
    seen = max((int(tree[0, 7]) for tree in forest), default=2)
    scale = float(mean_path(np.array(max(seen, 2))))
    shared = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            every = np.arange(len(x))
            depth = np.zeros(len(x))
            for tree in shared.value:
                at = np.zeros(len(x), dtype=np.int64)
                while True:
                    feature = tree[at, 2].astype(np.int64)
                    inner = feature >= 0
                    if not inner.any():
                        break
                    left = x[every, np.maximum(feature, 0)] < tree[at, 3]
                    at = np.where(inner, np.where(left, tree[at, 4], tree[at, 5]).astype(np.int64), at)
                depth += tree[at, 6]
            yield pd.Series(-np.exp2(-depth / max(len(shared.value), 1) / scale))

    return df.withColumn(output, score(*[F.col(f).cast("double") for f in features]))


def offset_of(scored: DataFrame, contamination: float = CONTAMINATION, score: str = "raw_score") -> float:
    """The exact ``contamination`` quantile of stored scores, interpolated between two ranks; 0 without rows."""
    total = scored.where(F.col(score).isNotNull()).count()
    at = max(total - 1, 0) * contamination
    found = value_at_rank(scored, score, math.floor(at))
    if found is None:
        return 0.0
    low, below = found
    if at == math.floor(at):
        return low
    same = scored.where(F.col(score) == low).count()
    high = low if math.ceil(at) < below + same else scored.where(F.col(score) > low).agg(F.min(score)).first()[0]
    return low + (high - low) * (at - math.floor(at))


def score_offset(train: DataFrame, nodes: DataFrame, features: Sequence[str], contamination: float = CONTAMINATION) -> DataFrame:
    """One row, fixed at training time: the exact ``contamination`` quantile of the training scores."""
    scored = cut_lineage(raw_scores(train, nodes, features).select("raw_score"))
    return train.sparkSession.createDataFrame([(offset_of(scored, contamination),)], "offset double")


def anomaly_scores(df: DataFrame, nodes: DataFrame, offset: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add ``anomaly_score``: the raw score less the training offset; negative means anomaly."""
    scored = raw_scores(df, nodes, features)
    return scored.withColumn("anomaly_score", F.col("raw_score") - offset.scalar()).drop("raw_score")


def fit_and_score(
    df: DataFrame, features: Sequence[str], row_key: Sequence[str], contamination: float = CONTAMINATION
) -> DataFrame:
    """Train on a table and add its ``anomaly_score``: nodes and scores are stored once, one scoring pass."""
    nodes = cut_lineage(fit(df, features, row_key))
    scored = cut_lineage(raw_scores(df, nodes, features))
    return scored.withColumn("anomaly_score", F.col("raw_score") - F.lit(offset_of(scored, contamination))).drop("raw_score")


def insights(scored: DataFrame, champion: DataFrame, generated_at: Column, key: Sequence[str]) -> DataFrame:
    """Flagged rows (``ticker``, ``anomaly_score``) as insight records; without a registered champion there are none.

    ``champion`` holds the version of the champion alias in zero or one row. Ids are hashes
    of the content, so a replay writes the same ids.
    """
    version = champion.limit(1).select("version").scalar()
    flagged = scored.where(F.col("anomaly_score") < 0).withColumn("model_version", version.cast("string"))
    return flagged.where(F.col("model_version").isNotNull()).select(
        F.sha2(F.concat_ws("|", "model_version", *[F.col(k).cast("string") for k in key]), 256).alias("insight_id"),
        F.col("ticker").alias("source_ticker"),
        "anomaly_score",
        "model_version",
        generated_at.alias("generated_at"),
    )
