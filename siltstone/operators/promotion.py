"""Compare-and-set of model aliases, many applications at once.

Applications to one alias take effect one after another: each is applied only if the alias
still has the version it expects. The order-dependent part is a map from the version before
to the version after, and such maps compose, so a busy alias is worked off slice by slice and the
slices' maps are composed in a tree.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.ordering import sorted_partitions
from siltstone.session import cut_lineage

_KEY = ["model_name", "alias"]
_MOVES = "_slice bigint, model_name string, alias string, befores array<string>, afters array<string>"
_NODE = "node bigint, model_name string, alias string, befores array<string>, afters array<string>"
_RESULT = (
    "application_id string, model_name string, alias string, status string, result_detail string, "
    "attempt_count bigint, version string"
)
_NO_VERSION = "\x01"  # stands for "no version" in the moves


def _net_moves(steps: Iterable[tuple[str, str]], moves: dict[str, set[str]]) -> None:
    """Extend ``moves`` (version reached -> starting versions that reach it) by ordered steps."""
    for expected, approved in steps:
        if expected == approved:
            continue
        movers = moves.setdefault(expected, {expected})
        moves.setdefault(approved, {approved}).update(movers)
        moves[expected] = set()


def _slice_moves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Net moves of each alias within one sorted slice."""
    found: dict[tuple, dict[str, set[str]]] = {}
    number = 0
    for batch in batches:
        if batch.empty:
            continue
        number = int(batch["_slice"].iloc[0])
        for key, rows in batch.groupby(_KEY, sort=False):
            steps = zip(rows["current_version"].fillna(_NO_VERSION), rows["approved_version"])
            _net_moves(steps, found.setdefault(key, {}))
    rows = []
    for (model, alias), moves in found.items():
        pairs = [(before, after) for after, befores in moves.items() for before in befores if before != after]
        rows.append((number, model, alias, [b for b, _ in pairs], [a for _, a in pairs]))
    if rows:
        yield pd.DataFrame(rows, columns=["_slice", *_KEY, "befores", "afters"])


def _compose(nodes: pd.DataFrame) -> pd.DataFrame:
    """The moves of one or two neighbouring nodes, one after the other, as their parent's."""
    ordered = nodes.sort_values("node")
    first = ordered.iloc[0]
    moves = dict(zip(first["befores"], first["afters"]))
    for i in range(1, len(ordered)):
        then = dict(zip(ordered["befores"].iloc[i], ordered["afters"].iloc[i]))
        moves = {**{b: a for b, a in then.items() if b not in moves}, **{b: then.get(a, a) for b, a in moves.items()}}
    moves = {b: a for b, a in moves.items() if b != a}
    row = (int(first["node"]) >> 1, first["model_name"], first["alias"], list(moves), list(moves.values()))
    return pd.DataFrame([row], columns=["node", *_KEY, "befores", "afters"])


def _starts(moves: DataFrame, aliases: DataFrame) -> DataFrame:
    """The version that an alias has at the start of each of its slices.

    Maps compose, so neighbouring slices are joined two by two up a tree, and versions are handed
    down it: the left child starts as its parent does, the right one behind the left one's moves. No
    group ever holds more than two nodes. Slices are ranges, so at most two of a slice's
    aliases go on in another slice; all others lie in one slice and need no tree.
    """
    known = aliases.select(*_KEY, F.coalesce("version", F.lit(_NO_VERSION)).alias("_version"))
    moves = cut_lineage(moves.withColumnRenamed("_slice", "node"))
    spans = cut_lineage(moves.groupBy(*_KEY).agg(F.min("node").alias("_first"), F.max("node").alias("_last")))
    several = spans.where("_first < _last").select(*_KEY)
    whole = spans.where("_first = _last").select(F.col("_first").alias("node"), *_KEY)
    nodes = [moves.join(several, _KEY, "left_semi")]
    highest = spans.where("_first < _last").agg(F.max("_last")).first()[0] or 0
    for _ in range(int(highest).bit_length()):  # as many rounds as the number of slices has bits
        nodes.append(cut_lineage(nodes[-1].groupBy(*_KEY, F.shiftright("node", 1)).applyInPandas(_compose, _NODE)))
    starts = nodes[-1].select("node", *_KEY).join(known, _KEY, "left")
    for level in reversed(nodes[:-1]):
        after_left = level.where("node % 2 = 0").select(F.col("node").alias("_left"), *_KEY, F.map_from_arrays("befores", "afters").alias("_moves"))
        above = starts.select(F.col("node").alias("_parent"), *_KEY, "_version")
        here = level.select("node", *_KEY, F.shiftright("node", 1).alias("_parent"), (F.col("node") - F.col("node") % 2).alias("_left"))
        joined = here.join(above, [*_KEY, "_parent"]).join(after_left, [*_KEY, "_left"], "left")
        begin = F.coalesce("_version", F.lit(_NO_VERSION))
        moved = F.when(F.col("node") % 2 == 1, F.coalesce(F.try_element_at("_moves", begin), begin)).otherwise(begin)
        starts = cut_lineage(joined.select("node", *_KEY, moved.alias("_version")))
    both = starts.unionByName(whole.join(known, _KEY, "left"))
    return both.select(F.col("node").alias("_slice"), *_KEY, F.coalesce("_version", F.lit(_NO_VERSION)).alias("_version"))


def _apply_slice(rows: pd.DataFrame) -> pd.DataFrame:
    """Outcome of each application of one alias within one slice."""
    ordered = rows.sort_values("_place")
    version = ordered["_version"].iloc[0]
    results = []
    for row in ordered.to_dict("records"):
        expected = _NO_VERSION if pd.isna(row["current_version"]) else row["current_version"]
        holds = expected == version
        version = row["approved_version"] if holds else version
        results.append(
            (
                row["application_id"], row["model_name"], row["alias"],
                "applied" if holds else "stale_precondition",
                "alias promoted" if holds else "alias changed since approval request",
                row["attempt_count"] + 1,
                None if version == _NO_VERSION else version,
            )
        )
    columns = ["application_id", *_KEY, "status", "result_detail", "attempt_count", "version"]
    return pd.DataFrame(results, columns=columns)


def apply_promotions(pending: DataFrame, aliases: DataFrame, partitions: int | None = None) -> DataFrame:
    """Outcome of all pending promotions in arrival order, with the alias version after each.

    ``pending``: application_id, action_type, status, attempt_count, model_name, alias,
    current_version (the one expected), approved_version, arrival. ``aliases``: model_name,
    alias, version. Slices are range partitions, so no task holds more than a slice.
    """
    due = pending.where((F.col("status") == "pending") & (F.col("action_type") == "promote_model")).select(
        "application_id", *_KEY, "arrival", "current_version", "approved_version", F.col("attempt_count").cast("long")
    )
    slices = sorted_partitions(due, [*_KEY, "arrival", "application_id"], partitions)
    moves = slices.select("_slice", *_KEY, "current_version", "approved_version").mapInPandas(_slice_moves, _MOVES)
    starts = _starts(moves, aliases)
    return slices.join(starts, ["_slice", *_KEY]).groupBy("_slice", *_KEY).applyInPandas(_apply_slice, _RESULT)


def promoted_aliases(aliases: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Alias table after the applied promotions; the last one per alias in arrival order counts.

    ``outcomes`` must carry ``arrival``; rows that changed nothing do not matter.
    """
    applied = outcomes.where(F.col("status") == "applied").groupBy(*_KEY).agg(
        F.max_by("version", F.struct("arrival", "application_id")).alias("_version")
    )
    joined = aliases.join(applied, _KEY, "full_outer")
    return joined.select(*_KEY, F.coalesce("_version", "version").alias("version"))
