"""N-gram Jaccard join by chosen paths.

Documents are sets of hashed word n-grams; equal sets are one class of copies and are joined once.
A run sends a set down a tree: at a node it follows those of its sampled tokens (minimum hashes) that
the node's hash chooses, 1/threshold of them on average, so that similar sets keep meeting on a path
while others part. Nodes that stay large are split again. Runs are repeated until a pair at the
threshold meets with the target recall. Sets that met, directly or through others, form a cell;
cells are compared by brute force on the exact sets, in blocks of bounded size, so every pair is
checked once, a dense group is spread over many tasks, and no pairs are written: a block reports the
number of links of each set and a spanning forest of them.

NULL and empty texts, and texts without words, have no n-grams: they are copies of each other without
links, each a group of its own. Texts of fewer words than an n-gram are one n-gram. Rows that repeat
are copies. Rows with a NULL id are not compared: their group is NULL. Empty tables give empty
results; other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import id_and_text, stored

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
DEPTH = 4
SAMPLED = 128
BUCKET = 256
MORE_LEVELS = 1
BLOCK = 256
# Rows that meet all coordinates at once: half a megabyte, so that steps stay in a core's cache and a worker stays small.
_PART = 512

_WORD = re.compile(r"\w+")
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
        return h ^ (h >> _U(33))


def shingles(text: str, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams."""
    words = _WORD.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(len(codes) - size + 1, 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(size, len(codes))):
            out = _mix(out + _STEP) + codes[i : i + n]
    return np.unique(_mix(out))


_SALTS = _mix(np.arange(1, SAMPLED + 1, dtype=np.uint64) * _STEP) | _U(1)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """For each sampled coordinate, 16 bits of the least hash over the set: a chance match only adds a meeting."""
    least = np.full(SAMPLED, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for part in range(0, len(tokens), _PART):
            own = tokens[part : part + _PART, None] * _SALTS[None, :]
            least = np.minimum(least, (own ^ (own >> _U(29))).min(axis=0))
        return (_mix(least) >> _U(48)).astype(np.uint16)


def set_key(tokens: np.ndarray) -> str:
    """128 bits of a set, as hex; empty for the empty set."""
    return xxhash.xxh3_128_hexdigest(tokens.tobytes()) if len(tokens) else ""


def document_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, set_key, sketch) of (doc_id, text)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, sketches = [], []
            for text in frame["text"]:
                tokens = shingles(text, size)
                keys.append(set_key(tokens))
                sketches.append(sketch(tokens).tobytes() if len(tokens) else b"")
            yield frame[["doc_id"]].assign(set_key=keys, sketch=sketches)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInPandas(run, f"doc_id {kind}, set_key string, sketch binary")


def runs_for(recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold has met with the probability ``recall``.

    At the threshold each node chooses one shared token on average; the chance that such a
    branching process with Poisson offspring lives for ``depth`` levels follows by iteration.
    """
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-alive)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - alive)))


def follow(paths: np.ndarray, owners: np.ndarray, sketches: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """One level down: (paths, owners) of the children that the nodes' hashes choose."""
    border = _U(int(2.0**64 / (threshold * SAMPLED)))
    out_paths, out_owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for part in range(0, len(paths), _PART):
        own, who = paths[part : part + _PART], owners[part : part + _PART]
        with np.errstate(over="ignore"):
            node = _mix(own[:, None] + _SALTS[None, :])
            row, coordinate = np.nonzero(node < border)
            value = sketches[who[row], coordinate].astype(np.uint64)
            out_paths.append(_mix(node[row, coordinate] ^ _mix(value + _STEP)))
        out_owners.append(who[row])
    return np.concatenate(out_paths), np.concatenate(out_owners)


def _sketch_rows(frame: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(frame["sketch"]), np.uint16).reshape(len(frame), SAMPLED)


def first_buckets(sets: DataFrame, threshold: float, recall: float, depth: int = DEPTH) -> DataFrame:
    """(bucket, node): the tree nodes at ``depth`` that each set reaches in all runs."""
    runs = runs_for(recall, depth + MORE_LEVELS)  # a pair that meets in a large bucket must live on below it

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for part in range(0, len(whole), 512):
                frame = whole.iloc[part : part + 512]
                own = _sketch_rows(frame)
                paths = np.repeat(_mix(np.arange(1, runs + 1, dtype=np.uint64) * _STEP), len(frame))
                owners = np.tile(np.arange(len(frame)), runs)
                for _ in range(depth):
                    paths, owners = follow(paths, owners, own, threshold)
                yield pd.DataFrame({"bucket": paths.view(np.int64), "node": frame["node"].to_numpy()[owners]})

    return sets.mapInPandas(run, "bucket long, node long")


def _next_buckets(rows: DataFrame, threshold: float) -> DataFrame:
    """Children of (bucket, node, sketch) rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            paths, owners = follow(frame["bucket"].to_numpy().view(np.uint64), np.arange(len(frame)), _sketch_rows(frame), threshold)
            yield pd.DataFrame({"bucket": paths.view(np.int64), "node": frame["node"].to_numpy()[owners]})

    return rows.mapInPandas(run, "bucket long, node long")


def meetings(sets: DataFrame, threshold: float, recall: float) -> DataFrame:
    """Edges (a, b), a > b, that connect all sets of a bucket with its least one."""
    found = []
    rows = stored(first_buckets(sets, threshold, recall), "path-rows")
    for level in range(MORE_LEVELS + 1):
        heads = rows.groupBy("bucket").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
        heads = stored(heads, "path-heads")
        last = level == MORE_LEVELS
        leaves = heads if last else heads.where(F.col("n") <= BUCKET)
        met = rows.join(leaves, "bucket").where(F.col("node") != F.col("head"))
        found.append(stored(met.select(F.col("node").alias("a"), F.col("head").alias("b")).distinct(), "path-met"))
        large = heads.where(F.col("n") > BUCKET).select("bucket")
        if last or large.isEmpty():
            break
        again = rows.join(large, "bucket", "left_semi").join(sets.select("node", "sketch"), "node")
        rows = stored(_next_buckets(again, threshold), "path-rows")
    return reduce(DataFrame.unionByName, found).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes of undirected edges (a, b); the root is the least node of its component.

    Large and small stars in turn: each round links nodes to the least one around them, until the
    edges are stars. All rounds are joins and sums; nothing is gathered.
    """
    flip = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = stored(edges.where("a != b").select(*flip).distinct(), "star")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "star-least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "star-large")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "star-least")
        small = large.join(least, "a")
        linked = small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(linked.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "star")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def links_between(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs with at least the threshold's Jaccard similarity, on the exact sets."""
    rows = left if right is None else left + right
    sizes = np.array([len(r) for r in rows])
    tokens, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), sizes)
    _, code, count = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = count[code] > 1
    code, owner = code[shared], owner[shared]
    ids = np.unique(code)
    code = np.searchsorted(ids, code)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    n_left = len(left)
    common = np.zeros((n_left, len(rows) - (0 if right is None else n_left)), np.float32)
    for start in range(0, len(ids), 4096):
        a, b = np.searchsorted(code, [start, start + 4096])
        grid = np.zeros((len(rows), min(4096, len(ids) - start)), np.float32)
        grid[owner[a:b], code[a:b] - start] = 1
        common += grid[:n_left] @ (grid if right is None else grid[n_left:]).T
    other = sizes if right is None else sizes[n_left:]
    union = sizes[:n_left, None] + other[None, :] - common
    similar = common >= threshold * union - 1e-6
    if right is None:
        np.fill_diagonal(similar, False)
    return similar


def _forest(similar: np.ndarray) -> list[int]:
    """For each node, the least node of its component."""
    label = np.arange(len(similar))
    while True:
        around = np.where(similar, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, around)
        new = new[new]
        if (new == label).all():
            return label.tolist()
        label = new


def _found(keys: list[str], links: np.ndarray, roots: list[str]) -> pd.DataFrame:
    return pd.DataFrame({"set_key": pd.Series(keys, dtype=object), "links": links, "root": pd.Series(roots, dtype=object)})


def verify(cells: DataFrame, sets: DataFrame, docs: DataFrame, size: int, threshold: float) -> DataFrame:
    """(set_key, links, root) of sets with links, one row per block that found some."""
    counted = stored(cells.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "cell-sizes")
    members = cells.join(counted, "root").select("node", F.col("root").alias("cell"), "n")
    named = stored(members.join(sets.select("node", "set_key", "rep_id"), "node"), "cell-members")
    # merged at every size, so that the cost does not jump where the members outgrow a broadcast
    texts = docs.join(named.hint("merge"), docs["doc_id"] == named["rep_id"]).select("cell", "n", "set_key", "text")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = texts.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "set_key", "text")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        # a row whose id is shared by another text is recognised by its set, a repeated row by its key
        frame = frame.drop_duplicates(["set_key", "text"])
        tokens = [shingles(t, size) for t in frame["text"]]
        good = [set_key(t) == k for t, k in zip(tokens, frame["set_key"], strict=True)]
        frame = frame[good].assign(tokens=[t for t, g in zip(tokens, good, strict=True) if g]).drop_duplicates("set_key")
        i, j = frame["i"].iloc[0] if len(frame) else 0, frame["j"].iloc[0] if len(frame) else 0
        frame = frame.sort_values(["own", "set_key"])
        left, right = frame[frame["own"] == i], frame[frame["own"] == j]
        if len(frame) < 2 or not len(left) or not len(right):
            return _found([], np.zeros(0, np.int64), [])
        if i == j:
            similar, keys = links_between(list(left["tokens"]), None, threshold), left["set_key"].tolist()
        else:
            cross = links_between(list(left["tokens"]), list(right["tokens"]), threshold)
            keys = left["set_key"].tolist() + right["set_key"].tolist()
            similar = np.zeros((len(keys), len(keys)), bool)
            similar[: len(left), len(left) :] = cross
            similar[len(left) :, : len(left)] = cross.T
        links, root = similar.sum(axis=1), _forest(similar)
        some = np.flatnonzero(links)
        return _found([keys[k] for k in some], links[some], [keys[root[k]] for k in some])

    return dealt.groupBy("cell", "i", "j").applyInPandas(compare, "set_key string, links long, root string")


def jaccard_join(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """One row per row of ``df``: doc_id, class_id, set_key, n_copies, n_links.

    ``class_id``: least id of the group joined by links and copies; ``n_copies``: rows with the same
    set; ``n_links``: other sets of at least the threshold's similarity.
    """
    docs = id_and_text(df, key, text)
    rows = stored(document_sets(docs, size), "path-sets")
    known = rows.where(F.col("doc_id").isNotNull() & (F.col("set_key") != ""))
    sets = known.groupBy("set_key").agg(
        F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("n_copies"), F.first("sketch").alias("sketch")
    )
    # a number for the tree; two sets with one number would only be compared in the same cell
    sets = stored(sets.withColumn("node", F.xxhash64("set_key")), "path-classes")
    met = meetings(sets, threshold, recall)
    found = stored(verify(components(met), sets, docs, size, threshold), "path-links")
    links = found.groupBy("set_key").agg(F.sum("links").alias("n_links"))
    roots = components(found.select(F.col("set_key").alias("a"), F.col("root").alias("b")))
    linked = links.join(roots.withColumnRenamed("node", "set_key"), "set_key")
    owned = sets.select("set_key", "rep_id", "n_copies").join(linked, "set_key", "left")
    owned = stored(owned.withColumn("root", F.coalesce("root", "set_key")), "path-owned")
    least = owned.groupBy("root").agg(F.min("rep_id").alias("class_id"))
    classes = stored(owned.join(least, "root").select("set_key", "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links")), "path-done")
    plain = rows.select("doc_id", "set_key")
    joined = plain.join(classes, "set_key", "left")
    alone = F.col("set_key") == ""
    return joined.select(
        "doc_id",
        F.when(alone | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        "set_key",
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.when(F.col("doc_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
    )
