"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

Features of a text are densities: words of a fixed lexicon, words of a lexicon learned from the
training labels, both near the second person, capitals, punctuation, and spellings that hide a
lexicon word (digits and signs for letters, letters torn apart or repeated). Trees and calibration
are fitted on at most ``most_rows`` labelled training rows, chosen by a hash of the id; the lexicon
is learned from the same rows. Every row of the table is scored from its whole text.

NULL and empty texts have all features 0 and get a score like any other. Unlabelled rows, and rows
whose label is neither 0 nor 1, are scored but not learned from. Rows that repeat get equal scores.
Without training rows of both labels the score is the share of label 1 (0 without any rows). Empty
tables give empty results; other columns are never read.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import id_and_text, stored

# The documented bound of the training sample, and of the learned lexicon.
MOST_ROWS = 20_000
LEARNED_WORDS = 200
_FOLDS = 5

# Common insults, and the second person in four languages.
INSULTS = (
    "idiot moron stupid loser pathetic trash scum worthless disgusting clown dumb fool jerk imbecile cretin pig garbage "
    "filth vermin bastard shut hate kill die ugly"
).split()
SECOND_PERSON = "you your yours u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes".split()
# Signs that stand for letters.
_SIGNS = str.maketrans("013457@$!|€", "oieastasiie")
_WORD = re.compile(r"\w+")
_TORN = re.compile(r"(?<!\w)(?:\w[\W_]{1,2}){3,}\w(?!\w)")
_MASKED = re.compile(r"(?<![\w@$!|])\w*?[@$!|013457][\w@$!|]*")
_SHOUTED = re.compile(r"(?<!\w)[A-Z]{3,}(?!\w)")
_REPEATED = re.compile(r"(\w)\1{2,}")
_NEAR = 6

FEATURES = (
    "log_words", "insult_rate", "insult_hits", "learned_rate", "learned_hits", "learned_weight", "near_second", "second_rate",
    "capital_rate", "shouted_rate", "punctuation_rate", "exclamation_rate", "hidden_rate", "torn_rate", "repeated_rate",
)


def held_out(key: Column) -> Column:
    """Rows that are never learned from: remainder 0 of the id's checksum."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(_FOLDS)) == 0


@lru_cache(maxsize=2)
def _lexicon(words: tuple[str, ...]) -> frozenset[str]:
    return frozenset(words)


def features(text: str, learned: dict[str, float]) -> list[float]:
    """The dense features of one text, in the order of :data:`FEATURES`."""
    if not text:
        return [0.0] * len(FEATURES)
    lower = text.lower()
    words = _WORD.findall(lower)
    n, size = max(len(words), 1), len(text)
    insults, second = _lexicon(tuple(INSULTS)), _lexicon(tuple(SECOND_PERSON))
    own = set(words)
    bad = (own & insults) | (own & learned.keys())
    found = [i for i, w in enumerate(words) if w in insults] if bad else []
    taught = [(i, learned[w]) for i, w in enumerate(words) if w in learned] if bad else []
    persons = np.flatnonzero(np.fromiter(map(second.__contains__, words), bool, len(words)))
    near = 0
    for i in sorted({*found, *(i for i, _ in taught)}):
        at = np.searchsorted(persons, i - _NEAR)
        near += at < len(persons) and persons[at] <= i + _NEAR
    hidden = 0
    for m in _MASKED.finditer(lower):
        plain = m[0].translate(_SIGNS)
        hidden += plain != m[0] and (plain in insults or plain in learned)
    torn = sum(re.sub(r"[\W_]", "", m[0]) in insults for m in _TORN.finditer(lower))
    repeated = 0
    for w in own:
        if _REPEATED.search(w):
            plain = _REPEATED.sub(r"\1", w)
            repeated += plain in insults or plain in learned
    signs = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    capitals, marks = int(signs[65:91].sum()), int(signs[list(b"!?.,;:*#%&$")].sum())
    shouted = len(_SHOUTED.findall(text)) if capitals > 2 else 0
    return [
        float(np.log1p(len(words))), len(found) / n, float(min(len(found), 20)), len(taught) / n, float(min(len(taught), 20)),
        float(sum(v for _, v in taught)) / n, near / n, len(persons) / n, capitals / size, shouted / n, marks / size,
        int(signs[33]) / size, hidden / n, torn / n, repeated / n,
    ]


def learn_lexicon(train: DataFrame, most: int = LEARNED_WORDS) -> dict[str, float]:
    """Words far likelier in toxic texts, with their log ratio: at most ``most``, from (text, label) rows."""
    total = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    word = F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))).alias("word")
    counts = train.select("label", word).where("word != ''").groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
    )
    bad, good = max(total.get(1, 0), 1), max(total.get(0, 0), 1)
    weight = F.log((F.col("toxic") + 0.5) / (bad + 1) / ((F.col("clean") + 0.5) / (good + 1)))
    rare = max(3, bad // 200)
    picked = counts.withColumn("weight", weight).where((F.col("toxic") >= rare) & (F.col("weight") > 2.0))
    rows = picked.orderBy((F.col("weight") * F.col("toxic")).desc(), "word").limit(most).collect()
    return {r["word"]: float(r["weight"]) for r in rows}


def with_features(df: DataFrame, learned: dict[str, float], others: list[str]) -> DataFrame:
    """The columns ``others`` and ``x``, the feature array of ``text``."""

    @F.pandas_udf("array<double>")
    def dense(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: features(t, learned))

    return df.select(*others, dense("text").alias("x"))


class ToxicityModel:
    """Trees and calibration; ``score`` adds a column to a table of texts."""

    def __init__(self, learned: dict[str, float], trees, calibration, share: float) -> None:
        self.learned, self.trees, self.calibration, self.share = learned, trees, calibration, share

    def score(self, df: DataFrame, others: list[str]) -> DataFrame:
        """``others`` and ``score`` of rows with a ``text`` column."""
        if self.trees is None:
            return df.select(*others, F.lit(float(self.share)).alias("score"))
        wide = with_features(df, self.learned, others).withColumn("x", array_to_vector("x"))
        raw = self.trees.transform(wide).withColumn("raw", vector_to_array("probability")[1])
        # the calibration is a step function with ties; a little of the raw score keeps their order
        step = self.calibration.transform(raw.select(*others, "raw"))
        return step.select(*others, F.least(F.greatest(F.col("prediction") * 0.98 + F.col("raw") * 0.02, F.lit(0.0)), F.lit(1.0)).alias("score"))


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> ToxicityModel:
    """Learn from (doc_id, text) and (doc_id, label): four fifths of the sample for the trees, one for calibration."""
    usable = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    spot = F.xxhash64("doc_id", F.lit(11))
    total = usable.count()
    if total > most_rows:  # a share of the hash range below the bound, not a prefix of the table
        usable = usable.where(F.pmod(spot, F.lit(1_000_000)) < int(1_000_000 * most_rows * 0.97 / total))
    chosen = usable.select(F.col("doc_id").alias("_label_id"), F.col("label").cast("int"))
    # at most ``most_rows`` ids: the documents are not shuffled
    train = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["_label_id"]).select("doc_id", "text", "label")
    train = stored(train, "toxicity-sample")
    both = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = both.get(1, 0) / max(sum(both.values()), 1)
    if len(both) < 2:
        return ToxicityModel({}, None, None, share)
    train = train.withColumn("part", F.pmod(spot, F.lit(5)))
    # with a label missing on one side, all rows serve for both
    apart = train.select("label", F.col("part") == 0).distinct().count() == 4
    learned = learn_lexicon(train.where("part != 0") if apart else train)  # words of the calibration's rows stay unknown
    wide = stored(with_features(train, learned, ["doc_id", "label", "part"]), "toxicity-features").withColumn("x", array_to_vector("x"))
    first, second = (wide.where("part != 0"), wide.where("part = 0")) if apart else (wide, wide)
    boosted = GBTClassifier(featuresCol="x", labelCol="label", maxIter=20, maxDepth=4, stepSize=0.2, seed=7, subsamplingRate=1.0)
    trees = boosted.fit(first.select("x", "label"))
    raw = trees.transform(second).select(vector_to_array("probability")[1].alias("raw"), F.col("label").cast("double").alias("label"))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw)
    return ToxicityModel(learned, trees, calibration, share)


def toxicity(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label_key: str = "doc_id", label: str = "toxic"
) -> DataFrame:
    """One row per row of ``df``: doc_id, held_out, score, predicted, text_sha256."""
    docs = id_and_text(df, key, text)
    known = labels.select(labels[label_key].alias("doc_id"), labels[label].alias("label"))
    model = fit(docs, known)
    scored = model.score(docs.withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256)), ["doc_id", "text_sha256"])
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "text_sha256"
    )
