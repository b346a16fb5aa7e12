"""Quality by compression: zstandard dictionaries of good and of bad text.

One dictionary is built from pieces of texts labelled good, one from pieces of texts labelled bad.
A text is cut into blocks of 1 KB, since a dictionary helps most at the start of a frame, and every
block is compressed with both. The difference of the two sums over the text's bytes is positive
where the good dictionary knows the text better; near zero where neither is needed, as in text that
repeats itself. A monotone fit on labelled texts that no dictionary has seen turns it into a
probability.

Dictionaries and fit come from at most ``most_rows`` labelled training rows of each label, chosen by
a hash of the id, and at most ``most_pieces`` pieces of 2 KB each; every row of the table is scored
from its whole text. Rows of a label weigh as many as they stand for, so the scores keep the share
of labels.

NULL and empty texts have difference 0 and get a score like any other. Unlabelled rows, and rows
whose label is neither 0 nor 1, are scored but not learned from. Labels that repeat count each
time. Rows that repeat get equal scores. Without training rows of both labels the score is the share
of label 1 (0 without any rows). Empty tables give empty results; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import id_and_text, stored

# Documented bounds of the training sample, for each label.
MOST_ROWS = 10_000
MOST_PIECES = 4_096
PIECE_BYTES = 2_048
DICTIONARY_BYTES = 1 << 16
BLOCK_BYTES = 1_024
LEVEL = 3
_FOLDS = 3
_PARTS = 4  # part 0 of the sample is kept for the fit


def held_out(key: Column) -> Column:
    """Rows that are never learned from: remainder 1 of the id's checksum."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(_FOLDS)) == 1


def cut(text: str, size: int) -> list[bytes]:
    """The UTF-8 bytes of a text in pieces of ``size``."""
    whole = text.encode()
    return [whole[at : at + size] for at in range(0, len(whole), size)]


def build_dictionary(pieces: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; few pieces are taken as they are, since the trainer needs many."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-size:]


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes):
    import zstandard

    known = zstandard.ZstdCompressionDict(dictionary)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False)


def difference(text: str, good: bytes, bad: bytes) -> float:
    """Bytes that the good dictionary saves against the bad one, for each byte of the text."""
    blocks = cut(text, BLOCK_BYTES)
    with_good, with_bad = _compressor(good).compress, _compressor(bad).compress
    saved = sum(len(with_bad(b)) - len(with_good(b)) for b in blocks)
    return saved / max(sum(map(len, blocks)), 1)


@dataclass
class Calibration:
    """A non-decreasing fit through block means, straight between them."""

    at: np.ndarray
    value: np.ndarray
    slope: float

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Calibration:
        """Adjacent blocks that fall are pooled until none does; equal ``x`` share a block."""
        levels, inverse = np.unique(x, return_inverse=True)
        mass = np.bincount(inverse, weight)
        hits = np.bincount(inverse, weight * y)
        blocks: list[tuple[float, float, float]] = []  # mass, mass of label 1, mass times x
        for m, h, v in zip(mass.tolist(), hits.tolist(), levels.tolist(), strict=True):
            own = (m, h, m * v)
            while blocks and blocks[-1][1] * own[0] >= own[1] * blocks[-1][0]:
                own = tuple(a + b for a, b in zip(blocks.pop(), own, strict=True))
            blocks.append(own)
        m, h, v = (np.array(c) for c in zip(*blocks, strict=True))
        return Calibration(v / m, h / m, 1.0 / max(float(np.std(x)), 1e-9))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """The fit, with a little of the plain difference so that texts on a flat part keep their order."""
        fitted = np.interp(x, self.at, self.value)
        plain = 1.0 / (1.0 + np.exp(-np.clip(x * self.slope, -30, 30)))
        return np.clip(0.98 * fitted + 0.02 * plain, 0.0, 1.0)


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    calibration: Calibration | None
    share: float

    def score(self, df: DataFrame, others: list[str]) -> DataFrame:
        """``others`` and ``score`` of rows with a ``text`` column."""
        if self.calibration is None:
            return df.select(*others, F.lit(float(self.share)).alias("score"))
        model = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def scored(texts: pd.Series) -> pd.Series:
            own = model.value
            return pd.Series(own.calibration(np.array([difference(t, own.good, own.bad) for t in texts], np.float64)))

        return df.select(*others, scored("text").alias("score"))


def sample(docs: DataFrame, labels: DataFrame, most_rows: int) -> DataFrame:
    """(text, label, part, weight) of at most about ``most_rows`` labelled rows of each label, by a hash of the id."""
    usable = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.select("doc_id", F.col("label").cast("int").alias("label"))
    spot = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1_000_000))
    totals = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    share = F.lit(0.0)
    for label, n in totals.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, 0.97 * most_rows / n))).otherwise(share)
    chosen = usable.withColumn("share", share).where(spot < F.col("share") * 1_000_000)
    chosen = chosen.select(F.col("doc_id").alias("_label_id"), "label", (1 / F.greatest(F.col("share"), F.lit(1e-12))).alias("weight"))
    # at most twice ``most_rows`` ids: the documents are not shuffled
    found = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["_label_id"])
    part = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(_PARTS)).cast("int")
    return stored(found.select("text", "label", part.alias("part"), "weight"), "quality-sample")


def dictionaries(train: DataFrame, most_pieces: int = MOST_PIECES) -> dict[int, bytes]:
    """Label to dictionary, each built in one task from at most about ``most_pieces`` pieces of its texts."""

    @F.pandas_udf("array<binary>")
    def pieces(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: cut(t, PIECE_BYTES))

    cuts = train.select("label", F.explode(pieces("text")).alias("piece")).withColumn("spot", F.pmod(F.xxhash64("piece"), F.lit(1_000_000)))
    cuts = stored(cuts, "quality-pieces")
    totals = {r["label"]: r["n"] for r in cuts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in totals.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, 0.97 * most_pieces / n))).otherwise(share)

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        ordered = [bytes(x) for x in frame.sort_values(["spot", "piece"])["piece"]]
        return pd.DataFrame({"label": [int(frame["label"].iloc[0])], "dictionary": [build_dictionary(ordered)]})

    # a piece counts once, so a text copied many times does not fill the sample
    picked = cuts.where(F.col("spot") < share * 1_000_000).dropDuplicates(["label", "piece"])
    built = picked.groupBy("label").applyInPandas(build, "label int, dictionary binary")
    return {r["label"]: bytes(r["dictionary"]) for r in built.collect()}


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, most_pieces: int = MOST_PIECES) -> CompressionModel:
    """Learn from (doc_id, text) and (doc_id, label)."""
    train = sample(docs, labels, most_rows)
    both = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.sum("weight").alias("n")).collect()}
    share = both.get(1, 0.0) / max(sum(both.values()), 1.0)
    seen, unseen = train.where("part != 0"), train.where("part = 0")
    if len(both) < 2:
        return CompressionModel(b"", b"", None, share)
    if seen.select("label").distinct().count() < 2 or unseen.select("label").distinct().count() < 2:
        seen = unseen = train  # too few rows to keep some apart
    built = dictionaries(seen, most_pieces)
    if len(built) < 2:  # all texts of a label are empty
        return CompressionModel(b"", b"", None, share)
    good, bad = built[1], built[0]

    @F.pandas_udf("double")
    def plain(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: difference(t, good, bad))

    rows = unseen.select(plain("text").alias("x"), "label", "weight").toPandas()  # the bounded sample, three numbers a row
    calibration = Calibration.fit(rows["x"].to_numpy(), rows["label"].to_numpy(np.float64), rows["weight"].to_numpy())
    return CompressionModel(good, bad, calibration, share)


def compression_quality(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label_key: str = "doc_id",
    label: str = "quality",
    most_rows: int = MOST_ROWS,
) -> DataFrame:
    """One row per row of ``df``: doc_id, held_out, score, predicted."""
    docs = id_and_text(df, key, text)
    known = labels.select(labels[label_key].alias("doc_id"), labels[label].alias("label"))
    scored = fit(docs, known, most_rows).score(docs, ["doc_id"])
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
