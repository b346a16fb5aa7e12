"""Byte-level BPE encoding and decoding from a rank file.

A word (one match of the split pattern) is an array of bytes. A Spark ``aggregate`` folds the
merges over it: each step merges the leftmost pair of least rank, found in a literal rank map.

Words are counted over the whole corpus, and the most frequent ones (at most ``table_words``, so
the table has a proven size) are folded once in Spark. Words outside the table are folded by the same
rule in the task that meets them, once per task's memory: measured, the Spark fold takes about
170 microseconds a word, the task's own about 12, and half of all distinct words occur once. The
result does not depend on the size of the table. Decoding concatenates the pieces' bytes.

NULL and empty texts have no ids. Rows that repeat are encoded one by one; an empty table gives an
empty result; other columns are never read.
"""

from __future__ import annotations

import base64
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import id_and_text, stored

# Words in the word table at most, and UTF-8 bytes of one of them at most.
TABLE_WORDS = 1 << 17
TABLE_WORD_BYTES = 64
# Slots of the literal rank map; a pair of ranks lies in one of two slots.
_SLOTS = 524_287
_HASHES = ((31_337, 7), (11, 50_021))
_FLUSH = 200_000
# Words outside the table that a task remembers.
_REMEMBERED = 300_000


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Piece bytes to rank, from a file of base64 and rank per line."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
    if len(ranks) > 1 << 16 or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the rank file must hold all single bytes and at most 65,536 pieces")
    return ranks


@lru_cache(maxsize=4)
def _rank_map(path: str) -> str:
    """All pairs of pieces that make a piece, as the text of an array: left, right and rank in 16 bits each.

    Each pair is put into one of its two slots, pushing out what is there (cuckoo hashing).
    """
    ranks = load_ranks(path)
    table: list[int | None] = [None] * _SLOTS
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if left is None or right is None:
                continue
            entry, slot = left << 32 | right << 16 | rank, -1
            for _ in range(1000):
                both = [(m * (entry >> 32) + n * (entry >> 16 & 0xFFFF)) % _SLOTS for m, n in _HASHES]
                slot = both[1] if slot == both[0] else both[0]
                entry, table[slot] = table[slot], entry
                if entry is None:
                    break
            else:
                raise ValueError("the vocabulary has too many pairs for the rank map")
    return json.dumps(table)


@lru_cache(maxsize=4)
def _byte_ranks(path: str) -> np.ndarray:
    ranks = load_ranks(path)
    return np.array([ranks[bytes([b])] for b in range(256)], np.int64)


def byte_array(word: str, path: str) -> np.ndarray:
    """The bytes of a word, each as the rank of its piece."""
    return _byte_ranks(path)[np.frombuffer(word.encode(), np.uint8)]


def fold_merges(pieces: Column, path: str) -> Column:
    """The ranks (array of bigint) that are left of a word's byte array after all merges.

    The state is the pieces and, for each, the rank that it makes with the next one. A step merges
    the leftmost pair of least rank and looks up its two new neighbours only. The rank map is a
    literal: it stands in the plan once, is parsed when the plan is made and never grows with the data.
    """
    rank_map = F.from_json(F.lit(_rank_map(path)), "array<bigint>")
    return F.get(F.transform(F.array(rank_map), lambda slots: _folded(pieces, slots)), F.lit(0))


def _folded(pieces: Column, slots: Column) -> Column:
    def rank_of(left: Column, right: Column) -> Column:
        pair = left * 65536 + right
        entries = [F.get(slots, ((left * m + right * n) % _SLOTS).cast("int")) for m, n in _HASHES]
        found = F.when(F.shiftright(entries[0], 16) == pair, entries[0].bitwiseAND(65535))
        return found.when(F.shiftright(entries[1], 16) == pair, entries[1].bitwiseAND(65535))

    def merged(state: Column, best: Column, at: Column) -> Column:
        ids, ranks, size = state["ids"], state["ranks"], F.size(state["ids"])
        no_rank = F.array().cast("array<bigint>")
        before = F.when(at > 1, F.array(rank_of(F.get(ids, at - 2), best))).otherwise(no_rank)
        return F.struct(
            F.concat(F.slice(ids, 1, at - 1), F.array(best), F.slice(ids, at + 2, size)).alias("ids"),
            F.concat(
                F.slice(ranks, 1, F.greatest(at - 2, F.lit(0))), before, F.array(rank_of(best, F.get(ids, at + 1))), F.slice(ranks, at + 2, size)
            ).alias("ranks"),
        )

    def step(state: Column, best: Column) -> Column:
        # a one-element array binds a value, so that it is computed once per step
        at = F.array(F.array_position(state["ranks"], best).cast("int"))
        return F.get(F.transform(at, lambda p: merged(state, best, p)), F.lit(0))

    def fold(state: Column) -> Column:
        least = F.array(F.array_min(state["ranks"]))
        return F.get(F.transform(least, lambda best: F.when(best.isNull(), state).otherwise(step(state, best))), F.lit(0))

    start = F.struct(pieces.alias("ids"), F.transform(pieces, lambda x, i: rank_of(x, F.get(pieces, i + 1))).alias("ranks"))
    steps = F.array_repeat(F.lit(0), F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.aggregate(steps, start, lambda s, _: fold(s), lambda s: s["ids"])


# Letters, numbers and blanks among the first 256 code points: fixed values of the Unicode standard.
_LATIN = {r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ÿ", r"\p{N}": "0-9²³¹¼-¾", r"\s": "\t-\r \x85\xa0"}


@lru_cache(maxsize=4)
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of a split pattern; texts within Latin-1 take the faster standard module."""
    import regex

    whole = regex.compile(pattern).findall
    narrow = pattern
    for name, members in _LATIN.items():
        narrow = re.sub(r"\[[^]]*\]", lambda m, n=name, x=members: m[0].replace(n, x), narrow).replace(name, f"[{members}]")
    narrow = narrow.replace(r"\S", f"[^{_LATIN[chr(92) + 's']}]")
    if "\\" in narrow.replace("\\t", "").replace("\\r", ""):
        return whole  # other classes: no shortcut
    quick = re.compile(narrow).findall

    def split(text: str) -> list[str]:
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return whole(text)
        return quick(text)

    return split


def merge_bytes(pieces: list[int], rank_of: dict[int, int]) -> list[int]:
    """The same fold for one word: merge the leftmost pair of least rank until there is none."""
    if len(pieces) < 2:
        return pieces
    none = 1 << 62
    ranks = [rank_of.get(a << 16 | b, none) for a, b in zip(pieces, pieces[1:], strict=False)]
    while ranks and (best := min(ranks)) < none:
        at = ranks.index(best)
        pieces[at : at + 2] = [best]
        del ranks[at]
        if at < len(ranks):
            ranks[at] = rank_of.get(best << 16 | pieces[at + 1], none)
        if at:
            ranks[at - 1] = rank_of.get(pieces[at - 1] << 16 | best, none)
    return pieces


@lru_cache(maxsize=2)
def _pair_ranks(path: str) -> dict[int, int]:
    return {entry >> 16: entry & 0xFFFF for entry in json.loads(_rank_map(path)) if entry is not None}


def word_counts(df: DataFrame, pattern: str, text: str = "text") -> DataFrame:
    """(word, n) over all rows; each task sends what it has counted whenever its memory is full."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, seen = splitter(pattern), Counter()
        for frame in frames:
            for value in frame["text"]:
                seen.update(split(value))
                if len(seen) >= _FLUSH:
                    yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                    seen.clear()
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    texts = id_and_text(df, text, text).select("text")
    return texts.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = TABLE_WORDS) -> DataFrame:
    """Words of at most 64 bytes above the least count that leaves no more than ``most`` of them.

    The border comes from a histogram over eighths of powers of two, which has a few hundred rows.
    """
    short = counts.where(F.octet_length("word") <= TABLE_WORD_BYTES)
    level = F.floor(F.log2("n") * 8).cast("int")
    histogram = {r["level"]: r["words"] for r in short.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect()}
    border, total = max(histogram, default=0) + 1, 0
    while border > 0 and total + histogram.get(border - 1, 0) <= most:
        border -= 1
        total += histogram.get(border, 0)
    return short.where(level >= border)


class _Words(dict):
    """Word numbers: the shared table's first, then those of the words folded by this task."""

    def __init__(self, table: tuple, path: str) -> None:
        words, self.table_sizes, self.table_flat = table
        self.bytes_of, self.rank_of, self.words = _byte_ranks(path).tolist(), _pair_ranks(path), words.to_pylist()
        self.restart()

    def restart(self) -> None:
        self.clear()
        self.update(zip(self.words, range(len(self.words)), strict=True))
        self.sizes: list[int] = []
        self.flat: list[int] = []
        # all sizes, starts and ids as arrays, brought up to date before they are read
        self.known = [self.table_sizes, np.cumsum(self.table_sizes) - self.table_sizes, self.table_flat]
        self.filled = [len(x) for x in self.known]
        self.seen = [0, 0]

    def _catch_up(self) -> None:
        """Append what was folded since the last call; arrays double when they are full."""
        sizes, flat = np.array(self.sizes[self.seen[0] :], np.int64), np.array(self.flat[self.seen[1] :], np.int32)
        starts = self.filled[2] + np.cumsum(sizes) - sizes
        self.seen = [len(self.sizes), len(self.flat)]
        for i, more in enumerate((sizes, starts, flat)):
            end = self.filled[i] + len(more)
            if end > len(self.known[i]):
                wider = np.zeros(2 * end, self.known[i].dtype)
                wider[: self.filled[i]] = self.known[i][: self.filled[i]]
                self.known[i] = wider
            self.known[i][self.filled[i] : end] = more
            self.filled[i] = end

    def __missing__(self, word: str) -> int:
        pieces = merge_bytes([self.bytes_of[b] for b in word.encode()], self.rank_of)
        self.sizes.append(len(pieces))
        self.flat.extend(pieces)
        self[word] = number = len(self.words) + len(self.sizes) - 1
        return number

    def ids(self, numbers: list[np.ndarray]) -> pa.ListArray:
        """The ids of each text, given as arrays of word numbers."""
        self._catch_up()
        (sizes, starts, flat), out, ends = self.known, [np.zeros(0, np.int32)], [0]
        for own in numbers:
            size = sizes[own]
            before = np.cumsum(size) - size
            total = int(size.sum())
            out.append(flat[np.repeat(starts[own] - before, size) + np.arange(total)])
            ends.append(ends[-1] + total)
        return _lists(ends, pa.array(np.concatenate(out)))


def _lists(ends, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.asarray(ends, np.int32)), values)


def word_table(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", table_words: int = TABLE_WORDS) -> DataFrame:
    """(word, ids) of the most frequent words, folded by Spark."""

    @F.arrow_udf("array<bigint>")
    def byte_arrays(words: pa.Array) -> pa.Array:
        found = [byte_array(w, ranks_path) for w in words.to_pylist()]
        return _lists(np.cumsum([0, *map(len, found)]), pa.array(np.concatenate([np.zeros(0, np.int64), *found])))

    counts = stored(word_counts(df, pattern, text), "bpe-words")
    spread = frequent_words(counts, table_words).repartition(df.sparkSession.sparkContext.defaultParallelism)
    spelled = stored(spread.select("word", byte_arrays("word").alias("bytes")), "bpe-frequent")
    return stored(spelled.select("word", fold_merges(F.col("bytes"), ranks_path).alias("ids")), "bpe-table")


def encode(
    df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", table_words: int = TABLE_WORDS, decoded: bool = False
) -> DataFrame:
    """One row per row of ``df``: doc_id, ids (array of int), the token ids of the whole text.

    ``decoded`` adds the bytes that these ids decode to, made by the same Python worker: ``decode`` beside
    ``encode`` in one stage runs two workers per core.
    """
    rows = word_table(df, ranks_path, pattern, text, table_words).toArrow()  # at most ``table_words`` short words
    lists = rows["ids"].combine_chunks()
    sizes, flat = np.diff(np.asarray(lists.offsets)), np.asarray(lists.flatten()).astype(np.int32)
    shared = df.sparkSession.sparkContext.broadcast((rows["word"].combine_chunks(), sizes, flat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the task's own: a worker that outlives its task, idle or at work for other operators, holds no words
        words, split = _Words(shared.value, ranks_path), splitter(pattern)
        for batch in batches:
            for part in range(0, len(batch), 256):
                rows = batch.slice(part, 256)
                if len(words.sizes) > _REMEMBERED:
                    words.restart()
                numbers = [np.array(list(map(words.__getitem__, split(t))), np.int64) for t in rows["text"].to_pylist()]
                ids = words.ids(numbers)
                columns = {"doc_id": rows["doc_id"], "ids": ids} | ({"decoded": _decoded(ids, ranks_path)} if decoded else {})
                yield pa.RecordBatch.from_pydict(columns)

    pair = id_and_text(df, key, text)
    kind = pair.schema["doc_id"].dataType.simpleString()
    return pair.mapInArrow(run, f"doc_id {kind}, ids array<int>" + (", decoded binary" if decoded else ""))


def decode(ids: Column, ranks_path: str) -> Column:
    """The bytes of an array of token ids; NULL has none, and an id without a piece fails the query."""

    @F.arrow_udf("binary")
    def concatenated(lists: pa.Array) -> pa.Array:
        return _decoded(lists, ranks_path)

    return concatenated(F.coalesce(ids, F.array().cast("array<int>")))


def _decoded(lists: pa.Array, path: str) -> pa.Array:
    pieces = _pieces(path)
    return pa.array([b"".join(map(pieces.__getitem__, x.values.to_numpy().tolist())) for x in lists], pa.binary())


@lru_cache(maxsize=4)
def _pieces(path: str) -> dict[int, bytes]:
    return {rank: piece for piece, rank in load_ranks(path).items()}
