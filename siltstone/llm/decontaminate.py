"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are word sequences. A shared run of ``seed`` words joins a document
with an item; for each such pair the longest common runs are marked again and again, found by a
running Karp-Rabin search whose length shrinks, so that no word is marked twice. The share of an
item's words under marks is its coverage: passages that were cut up and put in another order keep
a high coverage. A document is contaminated by the items whose coverage reaches the threshold.

The benchmark is a stated query set: it is taken in blocks of a bounded number of bytes, each of
which goes to all documents, so the joined side never grows with the data. Items of fewer words
than a seed match only as a whole; items without words match nothing. NULL texts count as empty,
rows that repeat are treated alike, rows with one id are one document, NULL ids are equal. Empty
tables give empty results, an empty benchmark contaminates nothing; other columns are never read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import id_and_text, stored

SEED_WORDS = 5
COVERAGE = 0.6
BLOCK_BYTES = 4 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_WORD = re.compile(r"\w+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes (mod 2^64) of all windows of ``size`` codes, by doubling the window."""
    if len(codes) < size or size < 1:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power, factor, done, out = codes.astype(np.uint64), _BASE, 0, None
        span = 1
        while size:
            if size & 1:
                if out is None:
                    out, done = power, span
                else:  # what is covered so far, then a stretch of ``span`` more
                    shift = np.uint64(pow(int(_BASE), span, 1 << 64))
                    n = min(len(out), len(power) - done)
                    out = out[:n] * shift + power[done : done + n]
                    done += span
            size >>= 1
            if size:
                n = len(power) - span
                power = power[:n] * factor + power[span : span + n]
                factor = factor * factor
                span *= 2
        return out


def _free_windows(marked: np.ndarray, size: int) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(marked)])
    return run[size:] == run[:-size]


def tile(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiles (start in item, start in doc, length), longest first, none shorter than ``least``."""
    in_item, in_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    tiles: list[tuple[int, int, int]] = []
    size = min(len(item), len(doc))
    while size >= least:
        longest = _longest_matches(item, doc, in_item, in_doc, size)
        marked = False
        for n, i, j in longest:
            if not in_item[i : i + n].any() and not in_doc[j : j + n].any():
                in_item[i : i + n] = in_doc[j : j + n] = True
                tiles.append((i, j, n))
                marked = True
        if not marked:  # what was covered by a longer tile is searched again at the same length
            size = size - 1 if size <= 2 * least else max(least, size // 2)
    return tiles


def _longest_matches(item, doc, in_item, in_doc, size: int) -> list[tuple[int, int, int]]:
    """Maximal unmarked matches of at least ``size`` words as (length, i, j), longest first."""
    own, there = window_hashes(item, size), window_hashes(doc, size)
    at = np.flatnonzero(_free_windows(in_item, size))
    starts = defaultdict(list)
    for i in at:
        starts[int(own[i])].append(int(i))
    spots = np.flatnonzero(_free_windows(in_doc, size) & np.isin(there, own[at]))
    ends: dict[int, int] = {}  # end in doc of the last match on each diagonal
    found = []
    for j in map(int, spots):
        for i in starts[int(there[j])]:
            if j < ends.get(i - j, -1) or not np.array_equal(item[i : i + size], doc[j : j + size]):
                continue
            n = size
            while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not in_item[i + n] and not in_doc[j + n]:
                n += 1
            ends[i - j] = j + n - size + 1
            found.append((n, i, j))
    return sorted(found, key=lambda m: (-m[0], m[1], m[2]))


class ItemBlock:
    """A bounded block of items: word codes, and the seeds that lead to them."""

    def __init__(self, rows: list[tuple], seed: int) -> None:
        self.codes: dict[str, int] = {}
        self.items: list[tuple] = []
        self.seeds: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in rows:
            found = np.array([self.codes.setdefault(w, len(self.codes) + 1) for w in words(text)], np.int64)
            if not len(found):
                continue
            least = min(seed, len(found))
            for h in set(window_hashes(found, least).tolist()):
                self.seeds[least][h].append(len(self.items))
            self.items.append((item_id, found, least))
        self.seeds = {n: dict(hashes) for n, hashes in self.seeds.items()}
        self.sorted = {n: np.array(sorted(hashes), np.uint64) for n, hashes in self.seeds.items()}

    def matches(self, text: str, threshold: float) -> list[tuple]:
        """(item_id, coverage, tiles) of the items whose coverage reaches the threshold."""
        get = self.codes.get
        doc = np.array([get(w, 0) for w in words(text)], np.int64)
        inside = doc > 0
        candidates: set[int] = set()
        for least, seeds in self.sorted.items():
            if len(doc) < least:
                continue
            at = np.flatnonzero(_free_windows(~inside, least))
            hashes = window_hashes(doc, least)[at]
            hit = seeds[np.minimum(np.searchsorted(seeds, hashes), len(seeds) - 1)] == hashes
            for h in set(hashes[hit].tolist()):
                candidates.update(self.seeds[least][h])
        out = []
        for n in sorted(candidates):
            item_id, item, least = self.items[n]
            tiles = tile(item, doc, least)
            coverage = sum(t[2] for t in tiles) / len(item)
            if coverage >= threshold:
                out.append((item_id, coverage, tiles))
        return out


def leaks(
    df: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    seed: int = SEED_WORDS,
    threshold: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Matches (doc_id, item_id, coverage, n_tiles), one row per document row and item above the threshold."""
    docs = id_and_text(df, key, text)
    items = id_and_text(benchmark, item_key, item_text).withColumnRenamed("doc_id", "item_id")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // block_bytes))
    spot = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = items.schema["item_id"].dataType.simpleString()
    columns = ["doc_id", "item_id", "coverage", "n_tiles"]

    def search(block) -> DataFrame:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = ItemBlock(block.value, seed)
            for frame in frames:
                out = [
                    (doc_id, item_id, coverage, len(tiles))
                    for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True)
                    for item_id, coverage, tiles in index.matches(text, threshold)
                ]
                yield pd.DataFrame(out, columns=columns)

        return docs.mapInPandas(run, f"doc_id {kind}, item_id {item_kind}, coverage double, n_tiles long")

    found = []
    for n in range(blocks):  # a block is about ``block_bytes`` of text, whatever the benchmark's size
        rows = [tuple(r) for r in items.where(spot == n).collect()]
        found.append(search(df.sparkSession.sparkContext.broadcast(rows)))
    return reduce(DataFrame.unionByName, found)


def decontaminate(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """One row per row of ``df``: doc_id, contaminated, coverage (of the best item, else 0), best_item, item_ids."""
    hits = stored(leaks(df, benchmark, key, **options), "leaks")
    best = F.max_by("item_id", F.struct("coverage", "item_id"))
    by_doc = hits.groupBy(F.col("doc_id").alias("hit_id")).agg(
        F.max("coverage").alias("coverage"), best.alias("best_item"), F.sort_array(F.collect_set("item_id")).alias("item_ids")
    )
    ids = df.select(df[key].alias("doc_id"))
    return ids.join(by_doc, ids["doc_id"].eqNullSafe(by_doc["hit_id"]), "left").select(
        "doc_id",
        F.col("coverage").isNotNull().alias("contaminated"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        "best_item",
        "item_ids",
    )
