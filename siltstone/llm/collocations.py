"""Phrase collocations by direct-address tiling.

Words that occur often enough get ids in order of falling frequency, so frequent pairs lie near the
origin of the (left id, right id) plane. The plane is cut into square tiles: those near the origin
are dense and counted by ``bincount`` into arrays addressed by the pair itself; all other tiles are
sparse and kept as sorted coordinates with counts, merged run by run. Spark adds up what the tasks
have counted. Frequent pairs are then ranked again by frequency and take the place of left ids, which
counts phrases of three words, and so on: a phrase is only counted if the phrase without its last word
and the one without its first are frequent, which loses none.

Id tables hold at most ``table_size`` entries, so what the tasks receive has a proven size. Frequent
words and phrases beyond the table are found through a bit filter of fixed size (a false hit costs a
row and nothing else), counted under numbers of the task's own and sent as text. Results do not
depend on the size of the table.

A phrase's count takes all its contiguous occurrences within a piece, overlaps included. NULL and
empty texts have no words; NULL languages read ``und``. Rows that repeat count each time. Ties of score
and count are ordered by the phrase's UTF-8 bytes. Empty tables give empty results; other columns are
never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.llm.byte_bpe import TABLE_WORD_BYTES
from siltstone.llm.common import stored, whole_text

TABLE_SIZE = 1 << 18
FILTER_BITS = 1 << 23
TILE = 512
# Tile (i, j) is dense where (i + 1) * (j + 1) is at most this.
DENSE = 8
_FLUSH = 400_000
_PAIRS = 1 << 20
_RUNS = 2 << 20
_REMEMBERED = 300_000
_BLOCK = 1 << 16
_MIX = 1_540_483_477  # below 2^31, so that a product with 32 bits fits a signed long
_WORD_BITS = 32
# Piece borders, and the sign that stands for all of them among the words.
_BORDER = b"."
_PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BORDER * 10)


def words_of(text: str) -> list[bytes]:
    """The words in order, with a border sign between pieces; A-Z lower-cased, cut at blanks and tabs."""
    return text.encode().lower().translate(_PIECES).replace(_BORDER, b" . ").split()


def by_language(df: DataFrame, lang: str, text: str) -> DataFrame:
    return df.select(F.coalesce(df[lang].cast("string"), F.lit("und")).alias("lang"), whole_text(df, text).alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, phrase, n) of single words; each task sends what it has counted whenever its memory is full."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = defaultdict(Counter)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, own in seen.items():
                own.pop(_BORDER, None)
                words = pa.array(list(own), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own), pa.string()), words, pa.array(list(own.values()), pa.int64())], ["lang", "phrase", "n"]
                )
            seen.clear()

        for batch in batches:
            for part in range(0, len(batch), 64):
                some = batch.slice(part, 64)
                for lang, text in zip(some["lang"].to_pylist(), some["text"].to_pylist(), strict=True):
                    seen[lang].update(words_of(text))
                if sum(map(len, seen.values())) >= _FLUSH:
                    yield from rows()
        yield from rows()

    return texts.mapInArrow(count, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _mix(left: Column, right: Column) -> Column:
    return (left * F.lit(_MIX) + right).bitwiseAND(F.lit(0xFFFFFFFF))


def _filter_place(lang: Column, phrase: Column) -> Column:
    """The filter's bit of a phrase: checksums of its words, mixed from the left."""
    sums = F.transform(F.split(phrase, " "), lambda w: F.crc32(F.concat(lang, F.lit("\0"), w).cast("binary")))
    whole = F.aggregate(F.slice(sums, 2, F.size(sums)), F.get(sums, F.lit(0)), _mix)
    return F.shiftright(whole * F.lit(_MIX), 20).bitwiseAND(F.lit(FILTER_BITS - 1))


def _np_place(whole: np.ndarray) -> np.ndarray:
    return (whole * _MIX >> 20) & (FILTER_BITS - 1)


def frequent_border(frequent: DataFrame, most: int) -> int:
    """The least count that leaves at most ``most`` phrases: from a histogram over 32nds of powers of two."""
    level = F.floor(F.log2("n") * 32).cast("int")
    histogram = {r["level"]: (r["k"], r["n"]) for r in frequent.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n")).collect()}
    border, total = None, 0
    for at in sorted(histogram, reverse=True):  # a few thousand levels at most
        total += histogram[at][0]
        if total > most:
            break
        border = histogram[at][1]
    return border if border is not None else 1 << 62


def bit_filter(rest: DataFrame) -> bytes:
    """Bits of the phrases beyond a table; at most one row per block comes to the driver, 1 MB in all."""

    def block(frame: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(_BLOCK, np.uint8)
        bits[frame["place"].to_numpy() % _BLOCK] = 1
        return pd.DataFrame({"block": [int(frame["place"].iloc[0]) // _BLOCK], "bits": [np.packbits(bits).tobytes()]})

    places = rest.select(_filter_place(F.col("lang"), F.col("phrase")).alias("place")).distinct()
    rows = places.groupBy(F.floor(F.col("place") / _BLOCK)).applyInPandas(block, "block long, bits binary").collect()
    if not rows:
        return b""
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:
        at = r["block"] * _BLOCK // 8
        bits[at : at + _BLOCK // 8] = np.frombuffer(r["bits"], np.uint8)
    return bits.tobytes()


class Tables:
    """What tasks know: ranked words by language, ranked phrases of each further length, and the filters."""

    def __init__(self, langs: list[str], lang_of: np.ndarray, words: pa.Array, filters: list[bytes], phrases: list[np.ndarray]) -> None:
        self.langs, self.lang_of, self.words = langs, lang_of, words  # a word's place is its id
        self.filters = filters  # of words, pairs, ...; empty where the table holds all
        self.phrases = phrases  # of pairs, triples, ...: left id << 32 | word id, in order of rank


class Tiles:
    """Counts of id pairs: dense tiles by address, sparse ones as sorted coordinates."""

    def __init__(self) -> None:
        self.slots = np.full((DENSE + 1, DENSE + 1), -1, np.int64)
        near = [(i, j) for i in range(DENSE) for j in range(DENSE) if (i + 1) * (j + 1) <= DENSE]
        for slot, (i, j) in enumerate(near):
            self.slots[i, j] = slot
        self.corner = np.array(near, np.int64)
        self.dense: np.ndarray | None = None
        self.codes: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        slot = self.slots[np.minimum(left // TILE, DENSE), np.minimum(right // TILE, DENSE)]
        near = slot >= 0
        if near.any():
            address = (slot[near] * TILE + left[near] % TILE) * TILE + right[near] % TILE
            found = np.bincount(address, minlength=len(self.corner) * TILE * TILE)
            if self.dense is None:
                self.dense = found
            else:
                self.dense += found
        codes, counts = np.unique(left[~near] << _WORD_BITS | right[~near], return_counts=True)
        self.codes.append(codes)
        self.counts.append(counts)
        self.size += len(codes)

    def compact(self) -> None:
        """All sorted runs as one."""
        if len(self.codes) > 1:
            codes, counts = np.concatenate(self.codes), np.concatenate(self.counts)
            order = np.argsort(codes, kind="stable")  # runs are sorted: merged, not sorted anew
            codes, counts = codes[order], counts[order]
            first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            self.codes, self.counts = [codes[first]], [np.add.reduceat(counts, first)]
            self.size = len(first)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """All codes and counts; the tiles are empty afterwards."""
        self.compact()
        codes, counts = [*self.codes, np.zeros(0, np.int64)], [*self.counts, np.zeros(0, np.int64)]
        if self.dense is not None:
            at = np.flatnonzero(self.dense)
            slot, cell = at // (TILE * TILE), at % (TILE * TILE)
            left, right = self.corner[slot, 0] * TILE + cell // TILE, self.corner[slot, 1] * TILE + cell % TILE
            codes.append(left << _WORD_BITS | right)
            counts.append(self.dense[at])
        self.dense, self.codes, self.counts, self.size = None, [], [], 0
        return np.concatenate(codes), np.concatenate(counts)


class _Words(dict):
    """Word to id for one language: the table's, the task's own number beyond it, or -1 for rare ones."""

    def __init__(self, reader: Reader, lang: str) -> None:
        super().__init__()
        self.reader, self.lang = reader, lang

    def __missing__(self, word: bytes) -> int:
        return self.reader.number(self, word)


class Reader:
    """Turns texts into id pairs in one worker."""

    def __init__(self, tables: Tables) -> None:
        self.tables, self.size = tables, len(tables.words)
        self.spelled = [w.encode() for w in tables.words.to_pylist()]
        self.ids: dict[str, dict[bytes, int]] = {}
        langs = tables.langs
        for i, (lang, w) in enumerate(zip(tables.lang_of.tolist(), self.spelled, strict=True)):
            self.ids.setdefault(langs[lang], {})[w] = i
        sums = [zlib.crc32(langs[lang].encode() + b"\0" + w) for lang, w in zip(tables.lang_of.tolist(), self.spelled, strict=True)]
        self.table_sums = np.array(sums, np.int64)
        self.filters = [np.unpackbits(np.frombuffer(f, np.uint8)).astype(bool) if f else None for f in tables.filters]
        self.order = [np.argsort(p, kind="stable") for p in tables.phrases]
        self.sorted = [p[o] for p, o in zip(tables.phrases, self.order, strict=True)]
        self.restart()

    def restart(self) -> None:
        self.words: dict[str, _Words] = {}
        self.own: list[tuple[str, bytes]] = []
        self.own_sums: list[int] = []
        self.own_pairs: list[list[np.ndarray]] = [[] for _ in self.tables.phrases]
        self.own_size = [0] * len(self.tables.phrases)
        self.met = 0

    def number(self, into: _Words, word: bytes) -> int:
        if self.filters[0] is None:
            return -1  # the table holds all frequent words; nothing to remember
        whole = zlib.crc32(into.lang.encode() + b"\0" + word)
        found = -1
        if word != _BORDER and self.filters[0][_np_place(np.int64(whole))]:
            found = self.size + len(self.own)
            self.own.append((into.lang, word))
            self.own_sums.append(whole)
        into[word] = found
        self.met += 1
        return found

    def numbers(self, lang: str, texts: list[str]) -> np.ndarray:
        """Ids of all texts in a row, -1 for rare words and borders."""
        if lang not in self.words:
            self.words[lang] = _Words(self, lang)
            self.words[lang].update(self.ids.get(lang, {}))
        words = [w for t in texts for w in (*words_of(t), _BORDER)]
        return np.fromiter(map(self.words[lang].__getitem__, words), np.int64, len(words))

    def pairs(self, numbers: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(id of the phrase of ``level`` - 1 words, id of the next word) of all places that may hold a frequent phrase."""
        words = np.concatenate([numbers, np.full(level, -1, np.int64)])
        sums = np.concatenate([self.table_sums, np.array(self.own_sums, np.int64), [0]])[words]
        left, whole = words, sums
        for k in range(1, level):
            known = left >= 0
            at = np.flatnonzero(known[:-k] & np.concatenate([known[1:], [False]])[:-k] & (words[k:] >= 0))
            if k == level - 1:
                return left[at], words[at + k]
            left, whole = self._phrases(k - 1, len(words), at, left[at], words[at + k], whole[at], sums[at + k])
        raise ValueError("phrases have at least two words")

    def _phrases(
        self, table: int, size: int, at: np.ndarray, left: np.ndarray, right: np.ndarray, before: np.ndarray, last: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and checksums by place of the phrases that stand at ``at``, -1 where none is frequent."""
        codes, known = left << _WORD_BITS | right, self.sorted[table]
        ids, sums = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        mixed = (before * _MIX + last) & 0xFFFFFFFF
        if len(known):
            spot = np.minimum(np.searchsorted(known, codes), len(known) - 1)
            hit = known[spot] == codes
            ids[at[hit]] = self.order[table][spot[hit]]
        else:
            hit = np.zeros(len(codes), bool)
        sums[at] = mixed
        beyond = self.filters[table + 1]
        if beyond is not None:
            own = np.flatnonzero(~hit & beyond[_np_place(mixed)])
            if len(own):
                found, inverse = np.unique(codes[own], return_inverse=True)
                ids[at[own]] = len(known) + self.own_size[table] + inverse
                self.own_pairs[table].append(found)
                self.own_size[table] += len(found)
                self.met += len(found)
        return ids, sums

    def spell(self, level: int, number: int) -> tuple[str, bytes]:
        """(language, text) of a phrase of ``level`` words."""
        if level == 1:
            if number >= self.size:
                return self.own[number - self.size]
            return self.tables.langs[self.tables.lang_of[number]], self.spelled[number]
        codes, table = self.tables.phrases[level - 2], level - 2
        code = int(codes[number]) if number < len(codes) else int(self._own_code(table, number - len(codes)))
        lang, left = self.spell(level - 1, code >> _WORD_BITS)
        return lang, left + b" " + self.spell(1, code & 0xFFFFFFFF)[1]

    def _own_code(self, table: int, number: int) -> int:
        if len(self.own_pairs[table]) > 1:
            self.own_pairs[table] = [np.concatenate(self.own_pairs[table])]
        return self.own_pairs[table][0][number]

    def rows(self, codes: np.ndarray, counts: np.ndarray, level: int) -> Iterator[pa.RecordBatch]:
        """(code, lang, phrase, n): pairs of table ids by code, all others spelled out."""
        most = len(self.tables.phrases[level - 3]) if level > 2 else self.size
        inside = (codes >> _WORD_BITS < most) & (codes & 0xFFFFFFFF < self.size)
        for part in range(0, len(codes), 100_000):
            at = slice(part, part + 100_000)
            own, listed = codes[at], inside[at]
            if listed.all():
                lang = phrase = pa.nulls(len(own), pa.string())
            else:
                spelled = [
                    (None, None) if ok else (lang, f"{left.decode()} {self.spell(1, c & 0xFFFFFFFF)[1].decode()}")
                    for ok, c in zip(listed.tolist(), own.tolist(), strict=True)
                    for lang, left in ((None, b"") if ok else self.spell(level - 1, c >> _WORD_BITS),)
                ]
                lang, phrase = (pa.array(x, pa.string()) for x in zip(*spelled, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, mask=~listed), lang, phrase, pa.array(counts[at].astype(np.int64))], ["code", "lang", "phrase", "n"]
            )


_READERS: dict[str, Reader] = {}


def tile_counts(texts: DataFrame, tables: Tables, level: int, least: int) -> DataFrame:
    """(code, lang, phrase, n) of phrases of ``level`` words that occur at least ``least`` times."""
    shared = texts.sparkSession.sparkContext.broadcast(tables)
    own = uuid.uuid4().hex  # a worker that outlives its task keeps the tables of this call

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if own not in _READERS:
            _READERS.clear()
            _READERS[own] = Reader(shared.value)
        reader, tiles = _READERS[own], Tiles()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def settle() -> None:
            if held:
                left, right = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                tiles.add(left, right)
                if tiles.size >= _RUNS:
                    tiles.compact()

        def flush() -> Iterator[pa.RecordBatch]:
            settle()
            yield from reader.rows(*tiles.take(), level)
            reader.restart()

        for batch in batches:
            for part in range(0, len(batch), 64):
                rows = batch.slice(part, 64)
                texts_of: dict[str, list[str]] = defaultdict(list)
                for lang, text in zip(rows["lang"].to_pylist(), rows["text"].to_pylist(), strict=True):
                    texts_of[lang].append(text)
                for lang, some in texts_of.items():
                    held.append(reader.pairs(reader.numbers(lang, some), level))
                if sum(len(x) for x, _ in held) >= _PAIRS:
                    settle()
                if tiles.size >= _RUNS or reader.met >= _REMEMBERED:
                    yield from flush()
        yield from flush()

    made = texts.mapInArrow(count, "code long, lang string, phrase string, n long")
    summed = made.groupBy("code", "lang", "phrase").agg(F.sum("n").alias("n"))
    return summed.where(F.col("n") >= least)


def _ranked(frequent: DataFrame, most: int, *columns: str) -> tuple[pa.Table, bool]:
    """The most frequent rows in order of rank, at most ``most``, and whether others are left."""
    border = frequent_border(frequent, most)
    rows = frequent.where(F.col("n") >= border).select(*columns, "n").toArrow()  # at most ``most`` short rows
    order = [("n", "descending"), *((c, "ascending") for c in columns)]
    return rows.sort_by(order), frequent.where(F.col("n") < border).limit(1).count() > 0


def frequent_phrases(texts: DataFrame, max_words: int, least: int, table_size: int) -> tuple[list[DataFrame], DataFrame]:
    """Per length, (lang, phrase, n) of all phrases with at least ``least`` occurrences; and (lang, n) of all words."""
    spark = texts.sparkSession
    counts = stored(word_counts(texts), "phrase-words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    words = counts.where(F.col("n") >= least)
    short = F.octet_length("phrase") <= TABLE_WORD_BYTES
    rows, more = _ranked(words.where(short & (F.octet_length("lang") <= TABLE_WORD_BYTES)), table_size, "lang", "phrase")
    langs = rows["lang"].combine_chunks().dictionary_encode()
    lang_of = np.asarray(langs.indices.to_numpy(zero_copy_only=False), np.int32)
    tables = Tables(langs.dictionary.to_pylist(), lang_of, rows["phrase"].combine_chunks(), [], [])
    # words beyond the table: below its border, or too long for it
    named = spark.createDataFrame(rows.append_column("id", pa.array(np.arange(len(rows)))).select(["id", "lang", "phrase"])) if len(rows) else None
    listed = stored(named, "phrase-table") if named is not None else spark.createDataFrame([], "id long, lang string, phrase string")
    rest = words.join(F.broadcast(listed.select("lang", "phrase")), ["lang", "phrase"], "left_anti")
    tables.filters.append(bit_filter(rest))
    found, ids = [words.select("lang", "phrase", "n")], listed
    for level in range(2, max_words + 1):
        level_counts = stored(tile_counts(texts, tables, level, least), f"phrase-{level}")
        coded = level_counts.where("code IS NOT NULL").select("code", "n")
        # ids back to text: the word table has at most ``table_size`` short rows, and so has every table of phrases
        spelled = (
            coded.withColumn("left_id", F.shiftright("code", _WORD_BITS)).withColumn("right_id", F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)))
            .join(ids.select(F.col("id").alias("left_id"), "lang", F.col("phrase").alias("left_text")), "left_id")
            .join(F.broadcast(listed.select(F.col("id").alias("right_id"), F.col("phrase").alias("right_text"))), "right_id")
            .select("code", "lang", F.concat_ws(" ", "left_text", "right_text").alias("phrase"), "n")
        )
        whole = stored(spelled.unionByName(level_counts.where("code IS NULL")), f"phrase-text-{level}")
        found.append(whole.select("lang", "phrase", "n"))
        if level < max_words:
            rows, _ = _ranked(coded, table_size, "code")
            codes = np.asarray(rows["code"].combine_chunks(), np.int64)
            table = pa.table({"code": codes, "id": np.arange(len(codes))})
            ranks = stored(spark.createDataFrame(table), f"phrase-ranks-{level}") if len(codes) else spark.createDataFrame([], "code long, id long")
            tables.filters.append(bit_filter(whole.join(ranks, "code", "left_anti")))
            tables.phrases.append(codes)
            ids = whole.join(ranks, "code").select("id", "lang", "phrase")
    return found, totals


def _joined(words: Column, start: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def _score(a: Column, left: Column, right: Column) -> Column:
    big = "decimal(19,0)"
    over = (a.cast(big) * a.cast(big) * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)")
    return F.call_function("div", over, (left.cast(big) * right.cast(big)).cast("decimal(38,0)"))


def _cuts(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, a, k, side, part): both parts, l and r, of each cut after the first k words."""
    words, k = F.split("phrase", " "), F.col("k")
    cut = candidates.select("lang", "phrase", "size", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    sides = F.array(
        F.struct(F.lit("l").alias("side"), _joined(words, 1, k).alias("part")), F.struct(F.lit("r").alias("side"), _joined(words, k + 1, F.col("size")).alias("part"))
    )
    return cut.select("lang", "phrase", "a", "k", F.inline(sides))


def _with_counts(parts: DataFrame, phrases: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """``parts`` with the count n of each part.

    A word that holds over a thousandth of all words stands in many phrases: its rows are dealt to
    slices. All counts add up to the total, so there are fewer than a thousand such words.
    """
    border = F.greatest(totals.agg(F.sum("total")).scalar() / 1000, F.lit(100_000))
    hot = words.withColumn("border", border).where(F.col("n") > F.col("border"))
    hot = hot.select(F.col("lang").alias("hot_lang"), F.col("phrase").alias("hot"), F.ceil(F.col("n") / F.col("border")).cast("int").alias("slices"))

    def sliced(df: DataFrame, text: str) -> DataFrame:
        return df.join(F.broadcast(hot), (df["lang"] == hot["hot_lang"]) & (df[text] == hot["hot"]), "left").drop("hot_lang", "hot")

    slices = F.coalesce("slices", F.lit(1))
    left = sliced(parts, "part").withColumn("slice", F.pmod(F.xxhash64("phrase", "k"), slices).cast("int")).drop("slices")
    lookup = sliced(phrases.select("lang", F.col("phrase").alias("part"), "n"), "part")
    lookup = lookup.withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1))).drop("slices")
    return left.join(lookup, ["lang", "part", "slice"])


def _inside(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the phrases of two words and more inside longer candidates, with the count of those."""
    words, size = F.split("phrase", " "), F.col("size")
    spots = F.flatten(
        F.transform(F.sequence(F.lit(2), size - 1), lambda s: F.transform(F.sequence(F.lit(1), size - s + 1), lambda i: _joined(words, i, s)))
    )
    return candidates.where("size > 2").select("lang", F.explode(spots).alias("phrase"), F.col("n").alias("longer"))


def collocations(
    df: DataFrame,
    max_words: int = 3,
    least: int = 10,
    inside_percent: int = 50,
    best: int = 2000,
    lang: str = "lang",
    text: str = "text",
    table_size: int = TABLE_SIZE,
) -> DataFrame:
    """Each language's ``best`` phrases: lang, rank, phrase, a, l, r, n, score.

    The score of a cut is floor(10^6 a a / (l r)) in whole numbers, and the lowest of a phrase's
    cuts counts. A phrase is left out where a longer one that holds it has at least
    ``inside_percent`` per cent of its count.
    """
    found, totals = frequent_phrases(by_language(df, lang, text), max_words, least, table_size)
    candidates = stored(reduce(DataFrame.unionByName, [f.withColumn("size", F.lit(i + 2)) for i, f in enumerate(found[1:])]), "phrase-candidates")
    parts = _with_counts(_cuts(candidates), reduce(DataFrame.unionByName, found), found[0], totals)
    sides = [F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("n"))).alias(f"{side}{k}") for k in range(1, max_words) for side in "lr"]
    whole = parts.select("lang", "phrase", "a", "k", "side", "n", F.lit(None).cast("long").alias("longer")).unionByName(_inside(candidates), allowMissingColumns=True)
    joined = whole.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("longer").alias("longer"), *sides)
    # whole numbers of up to 38 digits; equal scores go to the shortest first part
    cuts = [F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, max_words)]
    low = F.array_min(F.filter(F.array(*cuts), lambda c: c["score"].isNotNull()))
    kept = joined.where(F.coalesce(100 * F.col("longer") < inside_percent * F.col("a"), F.lit(True)))
    kept = kept.select("lang", "phrase", "a", low.alias("low")).select("lang", "phrase", "a", "low.score", "low.l", "low.r")
    # the best of each slice first, so that no task orders more than a bounded number of rows of a language
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    some = kept.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(16)))
    some = some.withColumn("place", F.row_number().over(W.partitionBy("lang", "slice").orderBy(*order))).where(F.col("place") <= best)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), F.col("score").cast("long").alias("score")
    )


def collocations_sql(max_words: int = 3, least: int = 10, inside_percent: int = 50, best: int = 2000) -> str:
    """DuckDB SQL for the same rows of ``documents``, without ids, tiles or tables."""
    return rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[.,;:!?\x0A-\x0D]', chr(10), 'g'), chr(10))) AS piece
            FROM documents),
        listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        spots AS (
            SELECT lang, s AS size, unnest(list_transform(range(1, len(w) - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))) AS phrase
            FROM listed, (SELECT unnest(range(1, {max_words + 1})) AS s)),
        counted AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM spots GROUP BY ALL),
        totals AS (SELECT lang, sum(f) AS n FROM counted WHERE size = 1 GROUP BY lang),
        candidates AS (SELECT * FROM counted WHERE size >= 2 AND f >= {least}),
        parted AS MATERIALIZED (
            SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS first_part, array_to_string(w[k + 1:], ' ') AS other_part
            FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM candidates)),
        cuts AS (
            SELECT p.*, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
            FROM parted p JOIN counted x ON x.lang = p.lang AND x.phrase = first_part JOIN counted y ON y.lang = p.lang AND y.phrase = other_part),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inner_phrases AS (
            SELECT lang, f, array_to_string(w[i:i + s - 1], ' ') AS phrase
            FROM (SELECT *, unnest(range(1, size - s + 2)) AS i
                  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(2, size)) AS s FROM candidates))),
        covered AS (SELECT lang, phrase, max(f) AS longer FROM inner_phrases GROUP BY ALL),
        ranked AS (
            SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
            FROM lowest w LEFT JOIN covered v ON v.lang = w.lang AND v.phrase = w.phrase
            WHERE coalesce(100 * v.longer < {inside_percent} * a, true))
        SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM ranked JOIN totals USING (lang) WHERE rank <= {best}"""
