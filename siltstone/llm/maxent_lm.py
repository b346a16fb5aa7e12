"""A hashed maximum-entropy language model with class-factored softmax.

The probability of a token is that of its class given the words before it, times that of the word
within its class. Classes of the most frequent words are cut from an order by the kind of document
they occur in and by frequency; all other words, known or not, form one class, within which they
have their smoothed unigram share, so the model is a proper distribution over all words. Features
are hashed: the previous word, the second and third before (skips), and the previous two together.

Counts cover every training row and are joined, not collected; only a table of frequent words of
bounded size goes to the tasks. The model is trained in rounds of distributed updates: each task
passes over its rows from the same weights with sparse adaptive gradient steps, and the changes of
each weight row are averaged over the tasks that touched it. All rows of a fold are used once.
Texts are split into words once for the counts and once into stored word numbers, which training and
scoring read. Scoring is one pass of sparse numpy batches.

Tokens are words between ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased, then one end. NULL and empty
texts have the end only. Rows that repeat count and are scored one by one; NULL ids are hashed as
empty text. Without training rows every token is unknown. Empty tables give empty results; other
columns are never read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.byte_bpe import frequent_words
from siltstone.llm.common import id_and_text, stored

END = "\n"  # no word holds a blank
TABLE_WORDS = 1 << 17
MODEL_WORDS = 4096
CLASSES = 32
KINDS = 16
ROUNDS = 2
# Input splits that one update task passes over, so that updates are few beside the text they come from.
_SPLITS_PER_UPDATE = 4
_CONTEXT_ROWS = 8192
_PAIR_ROWS = 16384
_INNER_ROWS = 256
_BATCH = 4096
_BLOCK_ROWS = 1024
_FLUSH = 200_000
_FEW = 6
_RATE = 0.25


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()  # bytes: A-Z and the six ASCII blanks only


def held_out(df: DataFrame) -> DataFrame:
    remainder = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5))
    return df.withColumn("held_out", remainder == 1)


def word_kinds(train: DataFrame) -> DataFrame:
    """(word, kind, n) of (text): a document's kind is a hash of its most frequent word."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, Counter] = defaultdict(Counter)
        size = 0

        def rows() -> pd.DataFrame:
            words = [w.decode() for count in seen.values() for w in count]
            kind = np.repeat(np.array(list(seen), np.int64), [len(count) for count in seen.values()])
            n = np.fromiter(chain.from_iterable(count.values() for count in seen.values()), np.int64, len(words))
            return pd.DataFrame({"word": words, "kind": kind, "n": n})

        for frame in frames:
            for text in frame["text"]:
                words = words_of(text)
                own = Counter(words)
                most = max(own.values(), default=0)
                kind = sum(max([w for w, n in own.items() if n == most], default=b"")) % KINDS
                into = seen[kind]
                size -= len(into)
                into.update(words)
                into[END.encode()] += 1
                size += len(into)
            if size >= _FLUSH:
                yield rows()
                seen.clear()
                size = 0
        if seen:
            yield rows()

    made = train.select("text").mapInPandas(run, "word string, kind long, n long")
    return made.groupBy("word", "kind").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """The bounded table of frequent words, the model's words first, and the classes of those."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int
    distinct: int
    class_of: np.ndarray  # of the model's words
    inner: np.ndarray  # position within the class
    members: list[np.ndarray]  # model words of each class

    @property
    def model_words(self) -> int:
        return len(self.class_of)

    @property
    def weight(self) -> float:
        """N + 0.5 (V + 1)"""
        return self.tokens + 0.5 * (self.distinct + 1)

    @property
    def rest_weight(self) -> float:
        return self.weight - float((self.counts[: self.model_words] + 0.5).sum())


def build_lexicon(kinds: DataFrame, counts: DataFrame) -> Lexicon:
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    rows = frequent_words(counts, TABLE_WORDS).collect()  # at most TABLE_WORDS short words
    rows.sort(key=lambda r: (r["word"] != END, -r["n"], r["word"]))
    chosen = [r["word"] for r in rows[:MODEL_WORDS]]
    number = {w: i for i, w in enumerate(chosen)}
    by_kind = np.zeros((max(len(chosen), 1), KINDS))
    if chosen:
        small = kinds.sparkSession.createDataFrame([(w,) for w in chosen], "word string")
        for r in kinds.join(F.broadcast(small), "word").collect():  # at most MODEL_WORDS * KINDS rows
            by_kind[number[r["word"]], r["kind"]] += r["n"]
    n = np.array([r["n"] for r in rows[:MODEL_WORDS]], np.float64)
    share = by_kind / np.maximum(by_kind.sum(axis=0), 1)
    order = sorted(range(len(chosen)), key=lambda i: (int(share[i].argmax()), -n[i], chosen[i]))
    members, own, mass = [], [], 0.0
    most, size = n.sum() / CLASSES, max(1, 2 * len(chosen) // CLASSES)
    for i in order:
        if own and (mass + n[i] > most or len(own) >= size) and len(members) < CLASSES - 1:
            members.append(np.array(own))
            own, mass = [], 0.0
        own.append(i)
        mass += n[i]
    if own:
        members.append(np.array(own))
    class_of, inner = np.zeros(len(chosen), np.int64), np.zeros(len(chosen), np.int64)
    for c, group in enumerate(members):
        class_of[group], inner[group] = c, np.arange(len(group))
    table = np.array([r["n"] for r in rows], np.float64)
    return Lexicon([r["word"].encode() for r in rows], table, int(total[0]), int(total[1]), class_of, inner, members)


def _log_chosen(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Natural log of the softmax at one column of each row."""
    logits -= logits.max(axis=1, keepdims=True)
    own = logits[np.arange(len(logits)), chosen]
    return own - np.log(np.exp(logits, out=logits).sum(axis=1))


def _slope(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The softmax of each row, less one at the chosen column."""
    logits -= logits.max(axis=1, keepdims=True)
    share = np.exp(logits, out=logits)
    share /= share.sum(axis=1, keepdims=True)
    share[np.arange(len(share)), chosen] -= 1
    return share


class Model:
    """Weights of the class factor (one row per hashed feature) and of the words within classes."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self.n_classes = len(lexicon.members) + 1  # the last one holds all other words
        mass = np.array([lexicon.counts[g].sum() + 0.5 * len(g) for g in lexicon.members] + [max(lexicon.rest_weight, 0.5)])
        self.bias = np.log(mass / mass.sum()).astype(np.float32)
        self.outer = np.zeros((3 * _CONTEXT_ROWS + _PAIR_ROWS, self.n_classes), np.float32)
        self.within = np.zeros((_INNER_ROWS, max(lexicon.model_words, 1)), np.float32)
        unigram = np.log(lexicon.counts[: lexicon.model_words] + 0.5)
        self.columns = np.concatenate([np.zeros(0, np.int64), *lexicon.members])  # words in the order of their classes
        self.starts = np.cumsum([0, *map(len, lexicon.members)])
        self.unigram = np.concatenate(
            [np.zeros(0), *(unigram[g] - np.log(np.exp(unigram[g]).sum()) for g in lexicon.members)]
        ).astype(np.float32)

    def features(self, numbers: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(outer rows, inner row) of each token; ``starts`` marks the first token of each text."""
        table = len(self.lexicon.words)
        code = np.where(numbers < 0, table, numbers) + 1
        since = np.arange(len(code)) - np.maximum.accumulate(np.where(starts, np.arange(len(code)), 0))

        def before(k: int) -> np.ndarray:
            out = np.zeros_like(code)
            out[k:] = code[:-k]
            return np.where(since >= k, out, 0)

        one, two, three = before(1), before(2), before(3)

        def spot(x: np.ndarray) -> np.ndarray:
            return np.where(x <= MODEL_WORDS, x, MODEL_WORDS + 1 + (x * 40_503 >> 4) % (_CONTEXT_ROWS - MODEL_WORDS - 1))

        pair = ((one * 1_000_003 + two) * 40_503 >> 7) % _PAIR_ROWS
        rows = np.stack([spot(one), _CONTEXT_ROWS + spot(two), 2 * _CONTEXT_ROWS + spot(three), 3 * _CONTEXT_ROWS + pair], axis=1)
        return rows, np.where(one < _INNER_ROWS // 2, one, _INNER_ROWS // 2 + one % (_INNER_ROWS // 2))

    def class_logits(self, rows: np.ndarray) -> np.ndarray:
        logits = self.bias + np.take(self.outer, rows[:, 0], axis=0)
        for k in range(1, rows.shape[1]):
            logits += np.take(self.outer, rows[:, k], axis=0)
        return logits

    def classes(self, numbers: np.ndarray) -> np.ndarray:
        model = (numbers >= 0) & (numbers < self.lexicon.model_words)
        out = np.full(len(numbers), self.n_classes - 1)
        out[model] = self.lexicon.class_of[numbers[model]]
        return out

    def inner_logits(self, c: int, rows: np.ndarray) -> np.ndarray:
        a, b = self.starts[c], self.starts[c + 1]
        return self.within[rows, a:b] + self.unigram[a:b]

    def inner_table(self) -> np.ndarray:
        """Natural log of the share within its class of each model word, by inner row."""
        table, rows = np.zeros_like(self.within), np.arange(_INNER_ROWS)
        for c, group in enumerate(self.lexicon.members):
            logits = self.inner_logits(c, rows)
            logits -= logits.max(axis=1, keepdims=True)
            table[:, group] = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return table

    def log_probabilities(self, numbers: np.ndarray, starts: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
        """Natural logs; a word outside the word table (-1) gets that of its class only. ``table``: the ``inner_table``, if at hand."""
        table = self.inner_table() if table is None else table
        lexicon, out = self.lexicon, np.zeros(len(numbers))
        rows, inner_rows = self.features(numbers, starts)
        classes = self.classes(numbers)
        for part in range(0, len(numbers), _BATCH):
            at = slice(part, part + _BATCH)
            out[at] = _log_chosen(self.class_logits(rows[at]), classes[at])
        rest = (classes == self.n_classes - 1) & (numbers >= 0)
        out[rest] += np.log(lexicon.counts[numbers[rest]] + 0.5) - np.log(lexicon.rest_weight)
        model = np.flatnonzero(classes < self.n_classes - 1)
        out[model] += table[inner_rows[model], numbers[model]]
        return out

    def train(self, numbers: np.ndarray, starts: np.ndarray, memory: tuple[np.ndarray, np.ndarray]) -> None:
        """One pass of adaptive gradient steps over the tokens; ``memory`` sums squared gradients."""
        rows, inner_rows = self.features(numbers, starts)
        classes = self.classes(numbers)
        for part in range(0, len(numbers), _BATCH):
            at = slice(part, part + _BATCH)
            slope = _slope(self.class_logits(rows[at]), classes[at])
            touched, total = _row_sums(rows[at].ravel(), slope)
            self._step(self.outer, memory[0], touched, total, np.take(self.outer, touched, axis=0), slice(None))
            order = np.argsort(classes[at].astype(np.uint8), kind="stable")
            ends = np.cumsum(np.bincount(classes[at], minlength=self.n_classes))
            for c, group in enumerate(self.lexicon.members):
                own = part + order[ends[c - 1] if c else 0 : ends[c]]
                if len(group) > 1 and len(own):
                    # tokens of one inner row have one softmax
                    uses = np.bincount(inner_rows[own], minlength=_INNER_ROWS)
                    touched = np.flatnonzero(uses)
                    place = np.cumsum(uses > 0) - 1
                    columns = slice(self.starts[c], self.starts[c + 1])
                    held = self.within[touched, columns]
                    logits = held + self.unigram[columns]
                    logits -= logits.max(axis=1, keepdims=True)
                    total = np.exp(logits, out=logits)
                    total *= (uses[touched] / total.sum(axis=1))[:, None].astype(np.float32)
                    spots = place[inner_rows[own]] * len(group) + self.lexicon.inner[numbers[own]]
                    np.subtract.at(total.reshape(-1), spots, np.float32(1))
                    self._step(self.within, memory[1], touched, total, held, columns)

    @staticmethod
    def _step(weights: np.ndarray, memory: np.ndarray, rows: np.ndarray, total: np.ndarray, held: np.ndarray, columns: slice) -> None:
        """One adaptive step of distinct rows, ``held`` as they are now, against the sums of their slopes."""
        seen = memory[rows] + np.einsum("ij,ij->i", total, total) / total.shape[1]
        memory[rows] = seen
        total *= (_RATE / np.sqrt(seen + 1.0))[:, None]
        held -= total
        weights[rows, columns] = held


def _row_sums(rows: np.ndarray, slope: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of ``rows``, of which each row of ``slope`` has an equal number, and the sums of their slopes."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")  # all row numbers are below 2^16; such are sorted by radix
    rows, owner = rows[order], order // (len(rows) // len(slope))
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    uses = np.diff(first, append=len(rows))
    total = np.take(slope, owner[first], axis=0)
    for k in range(1, _FEW):  # most rows are used a few times: add those uses one by one
        more = np.flatnonzero((uses > k) & (uses <= _FEW))
        total[more] += np.take(slope, owner[first[more] + k], axis=0)
    many = np.flatnonzero(uses > _FEW)
    if len(many):
        ends = np.cumsum(uses[many])
        spots = np.arange(ends[-1]) + np.repeat(first[many] - (ends - uses[many]), uses[many])
        total[many] = np.add.reduceat(np.take(slope, owner[spots], axis=0), ends - uses[many], axis=0)
    return rows[first], total


def _numbers(frame: pd.DataFrame, number: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, list[list[bytes]], np.ndarray]:
    """Word numbers of all texts in a row, marks of first tokens, words outside the table, tokens per text."""
    get, end = number.get, number.get(END.encode(), -1)
    flat: list[int] = []
    sizes, rest = [], []
    for text in frame["text"]:
        words = words_of(text)
        found = list(map(get, words, repeat(-1)))
        rest.append([w for w, i in zip(words, found, strict=True) if i < 0] if -1 in found else [])
        flat += found
        flat.append(end)
        sizes.append(len(found) + 1)
    sizes = np.array(sizes, np.int64)
    starts = np.zeros(len(flat), bool)
    starts[np.cumsum(sizes) - sizes] = True
    return np.array(flat, np.int64), starts, rest, sizes


def _slices(frame: pd.DataFrame, rows: int = 64) -> Iterator[pd.DataFrame]:
    for part in range(0, len(frame), rows):
        yield frame.iloc[part : part + rows]


def numbered(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(row, doc_id, held_out, spot, numbers, rest): the word numbers of each text in 32 bits each, and its words outside the table."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon.words)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = {w: i for i, w in enumerate(shared.value)}
        row = TaskContext.get().partitionId() << 33
        for whole in frames:
            for frame in _slices(whole):
                numbers, _, rest, sizes = _numbers(frame, number)
                each = np.split(numbers.astype(np.int32), np.cumsum(sizes)[:-1])
                yield frame[["doc_id", "held_out", "spot"]].assign(
                    row=np.arange(row, row + len(frame)),
                    numbers=pd.Series([x.tobytes() for x in each], index=frame.index, dtype=object),
                    rest=pd.Series([[w.decode() for w in x] for x in rest], index=frame.index, dtype=object),
                )
                row += len(frame)

    rows = docs.withColumn("spot", F.xxhash64("doc_id")).select("doc_id", "held_out", "spot", "text")
    return stored(rows.mapInPandas(run, f"doc_id {kind}, held_out boolean, spot long, row long, numbers binary, rest array<string>"), "lm-numbers")


def _stored_numbers(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts in a row, and where each text starts."""
    sizes = np.fromiter(map(len, frame["numbers"]), np.int64, len(frame)) // 4
    return np.frombuffer(b"".join(frame["numbers"]), np.int32).astype(np.int64), np.cumsum(sizes) - sizes


def _marks(first: np.ndarray, size: int) -> np.ndarray:
    starts = np.zeros(size, bool)
    starts[first] = True
    return starts


def train_model(train: DataFrame, model: Model, tasks: int, rounds: int = ROUNDS) -> Model:
    """``rounds`` distributed updates by ``tasks`` tasks, each over its own fold of the training rows (numbers, spot)."""
    context = train.sparkSession.sparkContext
    parts = (("outer", model.outer), ("within", model.within))
    for fold in range(rounds if model.lexicon.model_words else 0):
        shared = context.broadcast(model)

        def update(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            start = shared.value
            own = Model(start.lexicon)
            own.outer, own.within = start.outer.copy(), start.within.copy()
            memory = (np.zeros(len(own.outer), np.float32), np.zeros(len(own.within), np.float32))
            for whole in frames:
                for frame in _slices(whole):
                    numbers, first = _stored_numbers(frame)
                    own.train(numbers, _marks(first, len(numbers)), memory)
            salt, out = TaskContext.get().partitionId() % 32, []
            for name, old, new, seen in (("outer", start.outer, own.outer, memory[0]), ("within", start.within, own.within, memory[1])):
                for block in range(0, len(old), _BLOCK_ROWS):
                    at = slice(block, block + _BLOCK_ROWS)
                    touched = (seen[at] > 0).astype(np.float32)
                    if touched.any():
                        out.append((name, block, salt, False, (new[at] - old[at]).astype(np.float16).tobytes(), touched.astype(np.float16).tobytes()))
            yield pd.DataFrame(out, columns=["name", "block", "salt", "summed", "change", "touched"])

        def add(frame: pd.DataFrame) -> pd.DataFrame:
            def total(column: str) -> bytes:
                kind = np.float32 if frame["summed"].iloc[0] else np.float16  # sums have more digits than changes
                return np.sum([np.frombuffer(x, kind) for x in frame[column]], axis=0, dtype=np.float32).tobytes()

            first = frame.iloc[0]
            return pd.DataFrame(
                [(first["name"], first["block"], 0, True, total("change"), total("touched"))],
                columns=["name", "block", "salt", "summed", "change", "touched"],
            )

        schema = "name string, block long, salt long, summed boolean, change binary, touched binary"
        own = train.where(F.pmod("spot", F.lit(rounds)) == fold).select("numbers")
        changes = own.coalesce(tasks).mapInPandas(update, schema)
        some = changes.groupBy("name", "block", "salt").applyInPandas(add, schema)
        for r in some.groupBy("name", "block", "salt").applyInPandas(add, schema).collect():  # as large as the model
            weights = dict(parts)[r["name"]]
            touched = np.frombuffer(r["touched"], np.float32)
            change = np.frombuffer(r["change"], np.float32).reshape(len(touched), -1)
            weights[r["block"] : r["block"] + len(touched)] += change / np.maximum(touched, 1)[:, None]
    return model


def score(rows: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """Per row of ``numbered``: token counts, the base score and the model's, in log10."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    lexicon = model.lexicon
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        base = np.log10(np.concatenate([own.lexicon.counts, [0.0]]) + 0.5)
        table = own.inner_table()
        for whole in frames:
            for frame in _slices(whole):
                numbers, first = _stored_numbers(frame)
                known = numbers >= 0
                logs = own.log_probabilities(numbers, _marks(first, len(numbers)), table) / np.log(10)
                bases = np.where(known, base[numbers], 0.0)
                sizes = np.diff(first, append=len(numbers))
                yield frame[["row", "doc_id", "held_out"]].assign(
                    n_tokens=sizes, n_table=np.add.reduceat(known.astype(np.int64), first), base=np.add.reduceat(bases, first),
                    model=np.add.reduceat(logs, first), ends=(~known[first + sizes - 1]).astype(np.int64),
                )

    schema = f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_table long, base double, model double, ends long"
    scored = rows.select("row", "doc_id", "held_out", "numbers").mapInPandas(run, schema)
    # words outside the table meet their counts in a join; an unknown word and an unseen end count 0
    outside = rows.select("row", F.explode("rest").alias("word"))
    found = outside.join(counts, "word", "left").groupBy("row").agg(
        F.sum((F.col("n") > 0).cast("long")).alias("more_known"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"), F.count(F.lit(1)).alias("n_rest")
    )
    joined = scored.join(found, "row", "left").na.fill(0, ["more_known", "more", "n_rest"])
    extra = F.col("more") + F.col("ends") * float(np.log10(0.5))
    outside_words = F.col("n_rest") + F.col("ends")
    log_weight, log_rest = float(np.log10(lexicon.weight)), float(np.log10(max(lexicon.rest_weight, 0.5)))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_table") + F.col("more_known")).cast("long").alias("n_known"),
        F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + extra - F.col("n_tokens") * log_weight).alias("base_score"),
        (F.col("model") + extra - outside_words * log_rest).alias("score"),
    )


def language_model(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = held_out(id_and_text(df, key, text))
    kinds = stored(word_kinds(docs.where("not held_out")), "lm-kinds")
    counts = stored(kinds.groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    model = Model(build_lexicon(kinds, counts))
    rows = numbered(docs, model.lexicon)
    tasks = max(1, docs.rdd.getNumPartitions() // _SPLITS_PER_UPDATE)
    return score(rows, train_model(rows.where("not held_out"), model, tasks), counts)
