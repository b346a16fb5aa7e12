"""Alignment of two tokenizers over a corpus, with pair counts behind minimal perfect hashing.

A is a byte-level BPE of the tokenizers library, which gets a blank and the text; B is a sentencepiece
model, which puts the blank there itself. Both cut a text before a blank between other signs and around
a newline between other signs, so the stretches between such cuts are encoded one by one, each
distinct one once per worker's memory. Token ids of whole documents are written once; later passes align
them again by byte offsets, without tokenizing.

The distinct linked (A id, B id) pairs of the corpus get numbers from a minimal perfect hash, built
per bucket in Spark: a few keys share a pilot that sends all of them to free places. Keys are kept by
place, so a look-up is verified. Each task counts documents per pair in a dense vector by number,
the vectors are summed in two steps by block, and a last pass aligns each document again and looks up
its pairs. What tasks receive holds at most ``slice_keys`` pairs; where the corpus has more, the
pairs are counted and looked up slice by slice.

NULL and empty texts, and texts that either tokenizer does not give back byte for byte, have no tokens:
zeros and an empty digest. Rows that repeat count each time. An empty table gives an empty result;
other columns are never read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import id_and_text, stored
from siltstone.llm.token_counts import SPACE, _plain_encoder, prove_whole_tokens

# Pairs that are broadcast at once: about ten bytes each for keys, pilots and counts.
SLICE_KEYS = 1 << 22
_BUCKET_KEYS = 2048
_KEYS_PER_PILOT = 4
_PILOTS = 1 << 16
_BLOCK = 1 << 14
_MIX = 1_540_483_477  # below 2^31, so that a product with a pair of 32 bits fits a signed long
_REMEMBERED = 300_000
_REMEMBERED_IDS = 4_000_000
_KEYS = 1 << 21
# Input splits of a counting task, so that count vectors are few beside the documents they come from.
_SPLITS_PER_TASK = 4

# Longer stretches go to the tokenizers library, whose cost grows more slowly with their length.
_SHORT = 256
# Fixed value: the split pattern of byte-level pre-tokenizers.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_PLAIN = re.compile(r" ?[^ \n]+| |\n")
_NOT_PLAIN = re.compile(r"\s\s|[^\S \n]")
_CUT = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")


def stretches(text: str) -> list[str]:
    """A text in parts at whose borders both tokenizers cut."""
    return _CUT.split(text) if _NOT_PLAIN.search(text) else _PLAIN.findall(text)


def _byte_signs() -> dict[str, int]:
    """The signs by which byte-level vocabularies write bytes: printable ones stand for themselves, the rest follow 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def load_a(path: str):
    """(encoder of a list of stretches, bytes of each id) of a byte-level BPE; strings of special tokens are ordinary text.

    Merges whose results are numbered in order of merging rank like those results, which is proved here;
    such a vocabulary serves as ranks to the tiktoken library, which is faster on short stretches.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    kinds = (spec["pre_tokenizer"] or {}).get("type"), (spec["pre_tokenizer"] or {}).get("add_prefix_space"), spec["normalizer"]
    if kinds != ("ByteLevel", False, None) or len(spec["model"]["vocab"]) > 1 << 16:
        raise ValueError("A must be a byte-level BPE without normalizer, of at most 65,536 entries")
    tokenizer, signs = Tokenizer.from_file(path), _byte_signs()
    tokenizer.encode_special_tokens = True
    pieces = [b""] * (max(spec["model"]["vocab"].values()) + 1)
    for entry, number in spec["model"]["vocab"].items():
        pieces[number] = bytes(signs[c] for c in entry) if all(c in signs for c in entry) else b""
    vocabulary, special = spec["model"]["vocab"], {t["content"] for t in spec["added_tokens"]}
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
    ranks = {pieces[number]: number for entry, number in vocabulary.items() if entry not in special}
    if merged != sorted(set(merged)) or len(ranks) != len(merged) + 256:
        return lambda parts: [e.ids for e in tokenizer.encode_batch(parts, add_special_tokens=False)], pieces
    short = tiktoken.Encoding("ranks", pat_str=_BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(parts: list[str]) -> list[list[int]]:
        return [short(p) if len(p) <= _SHORT else tokenizer.encode(p, add_special_tokens=False).ids for p in parts]

    return encode, pieces


@lru_cache(maxsize=2)
def load_b(path: str):
    """(encoder without the blank it puts before a text, bytes of each id) of a sentencepiece model."""
    encoder = _plain_encoder(path)
    if encoder.get_piece_size() > 1 << 16:
        raise ValueError("B must have at most 65,536 entries")
    pieces = []
    for i in range(encoder.get_piece_size()):
        piece = encoder.id_to_piece(i)
        pieces.append(bytes([int(piece[3:5], 16)]) if encoder.is_byte(i) else piece.replace(SPACE, " ").encode())
    return encoder, pieces


class _Numbers:
    """An array that grows at its end."""

    def __init__(self, kind: type) -> None:
        self.room, self.size = np.zeros(1024, kind), 0

    def extend(self, more: list[int]) -> None:
        if self.size + len(more) > len(self.room):
            wider = np.zeros(2 * (self.size + len(more)), self.room.dtype)
            wider[: self.size] = self.room[: self.size]
            self.room = wider
        self.room[self.size : self.size + len(more)] = more
        self.size += len(more)


class _Side:
    """Token ids of all stretches, one after the other, with their starts and sizes."""

    def __init__(self) -> None:
        self.flat, self.starts, self.sizes = _Numbers(np.uint16), _Numbers(np.int64), _Numbers(np.int64)

    def extend(self, lists: list[list[int]]) -> None:
        sizes = list(map(len, lists))
        self.starts.extend([self.flat.size + x for x in accumulate(sizes, initial=0)][:-1])
        self.sizes.extend(sizes)
        self.flat.extend([i for own in lists for i in own])

    def gather(self, numbers: np.ndarray) -> bytes:
        """The ids of stretches in a row, as 16-bit numbers."""
        size = self.sizes.room[numbers]
        before = np.cumsum(size) - size
        return self.flat.room[np.repeat(self.starts.room[numbers] - before, size) + np.arange(int(size.sum()))].tobytes()


class _Stretches(dict):
    """Stretch to number; ids, groups and their text of all that this worker has met."""

    def __init__(self, a_path: str, b_path: str) -> None:
        super().__init__()
        self.a, self.a_bytes = load_a(a_path)
        self.b, self.b_bytes = load_b(b_path)
        self.a_sizes, self.b_sizes = list(map(len, self.a_bytes)), list(map(len, self.b_bytes))
        self.restart()

    def restart(self) -> None:
        self.clear()
        self.sides = (_Side(), _Side())
        self.groups = _Numbers(np.int64)
        self.written: list[bytes | None] = []  # None: not given back byte for byte

    def learn(self, new: list[str]) -> None:
        a_ids, b_ids = self.a(new), self.b.encode(new, num_threads=1)
        for side, lists in zip(self.sides, (a_ids, b_ids), strict=True):
            side.extend(lists)
        all_groups = []
        for stretch, a, b in zip(new, a_ids, b_ids, strict=True):
            whole = stretch.encode()
            same = b"".join(map(self.a_bytes.__getitem__, a)) == whole and b"".join(map(self.b_bytes.__getitem__, b)) == whole
            groups, written = _groups(a, b, self.a_sizes, self.b_sizes) if same else (0, None)
            self[stretch] = len(self.written)
            all_groups.append(groups)
            self.written.append(written)
        self.groups.extend(all_groups)

    @property
    def full(self) -> bool:
        return len(self.written) >= _REMEMBERED or sum(side.flat.size for side in self.sides) >= _REMEMBERED_IDS


def _groups(a: list[int], b: list[int], a_sizes: list[int], b_sizes: list[int]) -> tuple[int, bytes]:
    """The least runs of A and B tokens that end at the same byte, and their text; both sides have the same bytes."""
    out, a_end, b_end = [], 0, 0
    rest_a, rest_b = iter(a), iter(b)
    for x in rest_a:
        y = next(rest_b)
        a_end += a_sizes[x]
        b_end += b_sizes[y]
        if a_end == b_end:
            out.append(f"{x}|{y}")
            continue
        left, right = str(x), str(y)
        while a_end != b_end:
            if a_end < b_end:
                x = next(rest_a)
                a_end += a_sizes[x]
                left += f",{x}"
            else:
                y = next(rest_b)
                b_end += b_sizes[y]
                right += f",{y}"
        out.append(f"{left}|{right}")
    return len(out), ";".join(out).encode()


_MEMORY: dict[str, _Stretches] = {}


def encode_both(df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and the ids of both as 16-bit numbers."""
    own = uuid.uuid4().hex  # a worker that outlives its task keeps the stretches of this call
    prove_whole_tokens(b_path)  # also proves where no merge of B can cross

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if own not in _MEMORY:
            _MEMORY.clear()
            _MEMORY[own] = _Stretches(a_path, b_path)
        memory = _MEMORY[own]
        for batch in batches:
            for part in range(0, len(batch), 64):
                rows = batch.slice(part, 64)
                if memory.full:
                    memory.restart()
                parts = [stretches(" " + t) if t else [] for t in rows["text"].to_pylist()]
                new = [s for s in set(chain.from_iterable(parts)) if s not in memory]
                if new:
                    memory.learn(new)
                out: list[tuple] = []
                for own_parts in parts:
                    found = list(map(memory.__getitem__, own_parts))
                    written = list(map(memory.written.__getitem__, found))
                    if not written or None in written:
                        out.append((0, 0, 0, 0, "", b"", b""))
                        continue
                    numbers = np.array(found, np.int64)
                    a, b = (side.gather(numbers) for side in memory.sides)
                    n_a, n_b, n_groups = len(a) // 2, len(b) // 2, int(memory.groups.room[numbers].sum())
                    # each stretch between neighbouring ends of either side is one link
                    out.append((n_a, n_b, n_groups, n_a + n_b - n_groups, hashlib.sha256(b";".join(written)).hexdigest(), a, b))
                names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a_ids", "b_ids"]
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
                columns = [pa.array(list(x), k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([rows["doc_id"], *columns], ["doc_id", *names])

    pair = id_and_text(df, key, text)
    kind = pair.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a_ids binary, b_ids binary"
    return pair.mapInArrow(run, schema)


def align(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> np.ndarray:
    """All links of a run of bytes in order, as A id << 16 | B id; both sides end at the same byte."""
    a_ends, b_ends = np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b])
    total = int(a_ends[-1]) + 1 if len(a_ends) else 0
    by_a, by_b = np.zeros(total, bool), np.zeros(total, bool)
    by_a[a_ends] = True
    by_b[b_ends] = True
    ends = np.flatnonzero(by_a | by_b)
    by_a, by_b = by_a[ends], by_b[ends]
    return a[np.cumsum(by_a) - by_a].astype(np.int64) << 16 | b[np.cumsum(by_b) - by_b]


def _sizes(a_path: str, b_path: str) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array([len(p) for p in load(path)[1]], np.int64) for load, path in ((load_a, a_path), (load_b, b_path)))


def _aligned(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the encoded rows with the links of all their documents in a row."""
    a_sizes, b_sizes = _sizes(a_path, b_path)
    for batch in batches:
        for part in range(0, len(batch), 64):
            rows = batch.slice(part, 64)
            a, b = (np.frombuffer(b"".join(rows[c].to_pylist()), np.uint16) for c in ("a_ids", "b_ids"))
            yield rows, align(a, b, a_sizes, b_sizes)


def distinct_pairs(coded: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(pair) of all linked pairs of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, new, size = np.zeros(0, np.int64), [], 0
        for _, links in _aligned(batches, a_path, b_path):
            new.append(np.unique(links))
            size += len(new[-1])
            if size >= _KEYS:
                known = np.unique(np.concatenate([known, *new]))
                new, size = [], 0
                if len(known) >= _KEYS:
                    yield pa.RecordBatch.from_arrays([pa.array(known)], ["pair"])
                    known = known[:0]
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate([known, *new])))], ["pair"])

    return coded.select("a_ids", "b_ids").mapInArrow(run, "pair long").distinct()


def _spread(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of keys (finisher of a known mixer)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _place(hashes: np.ndarray, pilots: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """Place of each key among ``n``: the upper half of its hash, moved by its group's pilot."""
    with np.errstate(over="ignore"):
        x = (hashes ^ (pilots.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x >> np.uint64(33)) % np.asarray(n, np.uint64)).astype(np.int64)


def _group(hashes: np.ndarray, groups: np.ndarray | int) -> np.ndarray:
    return ((hashes & np.uint64(0xFFFFFFFF)) % np.asarray(groups, np.uint64)).astype(np.int64)


def _n_groups(n: np.ndarray | int) -> np.ndarray:
    return np.maximum(1, np.asarray(n) // _KEYS_PER_PILOT)


def build_perfect(keys: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(seed, pilots, keys by place) that send distinct keys one to one to 0 .. n - 1."""
    n, steps = len(keys), np.arange(_PILOTS)
    for seed in range(1000):
        hashes = _spread(keys, seed)
        group = _group(hashes, _n_groups(n))
        sizes = np.bincount(group, minlength=int(_n_groups(n)))
        members = np.split(np.argsort(group, kind="stable"), np.cumsum(sizes)[:-1])
        free, pilots, placed = np.ones(n, bool), np.zeros(len(sizes), np.uint16), np.zeros(n, np.int64)
        for g in np.argsort(-sizes, kind="stable").tolist():
            own = hashes[members[g]]
            if not len(own):
                break
            at, width, found = 0, 32, None
            while at < _PILOTS and found is None:
                tried = steps[at : at + width]
                places = _place(own[None, :], tried[:, None], n)
                good = free[places].all(axis=1)
                if len(own) > 1:
                    ordered = np.sort(places, axis=1)
                    good &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if good.any():
                    found = int(good.argmax())
                    pilots[g], where = tried[found], places[found]
                    free[where] = False
                    placed[where] = keys[members[g]]
                at, width = at + width, min(width * 4, 8192)
            if found is None:
                break
        if not free.any():
            return seed, pilots, placed
    raise ValueError("no seed places all keys")


@dataclass
class PairNumbers:
    """The perfect hash of one slice of pairs; the number of a pair is its place behind its bucket's start."""

    first_bucket: int
    all_buckets: int
    seeds: np.ndarray
    key_starts: np.ndarray
    pilot_starts: np.ndarray
    pilots: np.ndarray
    keys: np.ndarray

    def find(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the pairs lie in this slice, their numbers); the stored key must agree."""
        bucket = (pairs * _MIX >> 15) % self.all_buckets - self.first_bucket
        own = np.flatnonzero((bucket >= 0) & (bucket < len(self.seeds)))
        pairs, bucket = pairs[own], bucket[own]
        hashes = np.zeros(len(pairs), np.uint64)
        for seed in np.unique(self.seeds[bucket]).tolist():  # nearly all buckets take the first seed
            same = self.seeds[bucket] == seed
            hashes[same] = _spread(pairs[same], seed)
        n = np.diff(self.key_starts)[bucket]
        known = n > 0
        own, pairs, bucket, hashes, n = own[known], pairs[known], bucket[known], hashes[known], n[known]
        pilot = self.pilots[self.pilot_starts[bucket] + _group(hashes, _n_groups(n))]
        number = self.key_starts[bucket] + _place(hashes, pilot, n)
        right = self.keys[number] == pairs
        return own[right], number[right]


def number_pairs(pairs: DataFrame, slice_keys: int = SLICE_KEYS) -> list[PairNumbers]:
    """Perfect hashes of all pairs, each of at most about ``slice_keys``: built bucket by bucket in Spark."""
    total = pairs.count()
    buckets = max(1, -(-total // min(_BUCKET_KEYS, max(1, slice_keys // 2))))
    slices = max(1, -(-total // slice_keys))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        seed, pilots, keys = build_perfect(np.sort(frame["pair"].to_numpy(np.int64)))
        row = (int(frame["bucket"].iloc[0]), seed, pilots.tobytes(), keys.astype(np.uint32).tobytes())
        return pd.DataFrame([row], columns=["bucket", "seed", "pilots", "keys"])

    bucket = F.pmod(F.shiftright(F.col("pair") * F.lit(_MIX), 15), F.lit(buckets))
    built = pairs.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(build, "bucket long, seed long, pilots binary, keys binary")
    built = stored(built, "pair-hash")
    out = []
    for k in range(slices):
        first, last = buckets * k // slices, buckets * (k + 1) // slices
        rows = {r["bucket"]: r for r in built.where(F.col("bucket").between(first, last - 1)).collect()}  # one slice
        listed = [rows.get(i) for i in range(first, last)]
        sizes = np.array([len(r["keys"]) // 4 if r else 0 for r in listed], np.int64)
        widths = np.array([len(r["pilots"]) // 2 if r else 0 for r in listed], np.int64)
        joined = {c: b"".join(bytes(r[c]) for r in listed if r) for c in ("pilots", "keys")}
        out.append(
            PairNumbers(
                first, buckets, np.array([r["seed"] if r else 0 for r in listed], np.int64), np.concatenate([[0], np.cumsum(sizes)]),
                np.concatenate([[0], np.cumsum(widths)]), np.frombuffer(joined["pilots"], np.uint16), np.frombuffer(joined["keys"], np.uint32).astype(np.int64),
            )
        )
    return out


def _by_document(rows: pa.RecordBatch, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, links) of each distinct pair of each document of a slice of rows."""
    per = rows["n_links"].to_numpy(zero_copy_only=False)
    codes, times = np.unique(np.repeat(np.arange(len(per)), per) << 32 | links, return_counts=True)
    return codes >> 32, codes & 0xFFFFFFFF, times


def count_documents(coded: DataFrame, numbers: PairNumbers, a_path: str, b_path: str) -> np.ndarray:
    """Documents that hold each pair, by its number."""
    context = coded.sparkSession.sparkContext
    shared = context.broadcast(numbers)
    n = len(numbers.keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = shared.value, np.zeros(n, np.int32)
        for rows, links in _aligned(batches, a_path, b_path):
            pairs = _by_document(rows, links)[1]
            counts += np.bincount(own.find(pairs)[1], minlength=n).astype(np.int32)
        salt = TaskContext.get().partitionId() % 32
        blocks = [(at, salt, counts[at : at + _BLOCK].astype(np.int64).tobytes()) for at in range(0, n, _BLOCK) if counts[at : at + _BLOCK].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in blocks], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["block", "salt", "counts"]
        )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, np.int64) for x in frame["counts"]], axis=0).tobytes()
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "salt": [0], "counts": [total]})

    tasks = max(2 * context.defaultParallelism, coded.rdd.getNumPartitions() // _SPLITS_PER_TASK)
    schema = "block long, salt long, counts binary"
    vectors = coded.select("n_links", "a_ids", "b_ids").coalesce(tasks).mapInArrow(run, schema)
    some = vectors.groupBy("block", "salt").applyInPandas(add, schema)
    out = np.zeros(n, np.int64)
    for r in some.groupBy("block", "salt").applyInPandas(add, schema).collect():  # as large as the slice
        found = np.frombuffer(r["counts"], np.int64)
        out[r["block"] : r["block"] + len(found)] += found
    return out


def look_up(coded: DataFrame, numbers: PairNumbers, counts: np.ndarray, best: np.ndarray, a_path: str, b_path: str) -> DataFrame:
    """``coded`` with n_best and count_sum raised by the links whose pairs lie in this slice."""
    shared = coded.sparkSession.sparkContext.broadcast((numbers, counts, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, count_of, best_of = shared.value
        for rows, links in _aligned(batches, a_path, b_path):
            doc, pairs, times = _by_document(rows, links)
            at, number = own.find(pairs)
            doc, times, count = doc[at], times[at], count_of[number]
            raised = {"n_best": times * (count == best_of[pairs[at] >> 16]), "count_sum": times * count}
            first = np.searchsorted(doc, np.arange(len(rows) + 1))
            columns = []
            for name in rows.schema.names:
                column = rows[name]
                if name in raised:
                    total = np.concatenate([[0], np.cumsum(raised[name])])
                    column = pa.array(column.to_numpy(zero_copy_only=False) + total[first[1:]] - total[first[:-1]], pa.int64())
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, rows.schema.names)

    return coded.mapInArrow(run, coded.schema)


def token_alignment(df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", slice_keys: int = SLICE_KEYS) -> DataFrame:
    """One row per row of ``df``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    coded = stored(encode_both(df, a_path, b_path, key, text), "alignment-ids")
    slices = number_pairs(stored(distinct_pairs(coded, a_path, b_path), "alignment-pairs"), slice_keys)
    best, counts = np.zeros(len(load_a(a_path)[1]), np.int64), []
    for numbers in slices:
        counts.append(count_documents(coded, numbers, a_path, b_path))
        np.maximum.at(best, numbers.keys >> 16, counts[-1])
    out = coded.withColumn("n_best", F.lit(0).cast("long")).withColumn("count_sum", F.lit(0).cast("long"))
    for k, (numbers, found) in enumerate(zip(slices, counts, strict=True)):
        out = look_up(stored(out, "alignment-part") if k else out, numbers, found, best, a_path, b_path)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
