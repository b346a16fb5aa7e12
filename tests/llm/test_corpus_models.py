"""Compression classifier, collocations and token alignment: against brute force, SQL and the libraries."""

import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from siltstone.llm import collocations, compression_quality, token_alignment
from siltstone.llm.queries import SQL, op12_collocations
from tests_support import same_result

SF = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n string, score string, label int"
ODD = [
    "a  b\t\n\n  c's I'll ½ naïve 日本語 <s> x \x1c", "▁ x", "", "x" * 5000, "<|endoftext|> a", "  lead", "trail  \n", "\n", "　a b", " 's  's\n's\r\nq",
    "é́ 👩‍👩‍👧 .. !!\n\n\nA\n b \n",
]


def table(spark, rows):
    """(doc_id, text, lang) rows with further columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, lang, "s", "clash", "clash", 7) for i, t, lang in rows], SCHEMA).repartition(3)


# quality by compression


def test_isotonic_fit_equals_the_min_max_formula():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 12, 60) / 4
    y, weight = (rng.random(60) < x / 4).astype(float), rng.integers(1, 4, 60).astype(float)
    fit = compression_quality.Calibration.fit(x, y, weight)
    levels = np.unique(x)
    mean = lambda a, b: np.average(y[(x >= a) & (x <= b)], weights=weight[(x >= a) & (x <= b)])
    expected = [max(min(mean(a, b) for b in levels[levels >= v]) for a in levels[levels <= v]) for v in levels]
    blocks = sorted(set(np.round(expected, 9)))
    assert np.round(fit.value, 9).tolist() == pytest.approx(blocks)
    assert (np.diff(fit(np.linspace(-5, 9, 200))) >= 0).all() and 0 <= fit(np.array([-9.0]))[0] <= fit(np.array([9.0]))[0] <= 1


def test_difference_covers_the_whole_text():
    good, bad = compression_quality.build_dictionary([b"plain words in a row " * 40]), compression_quality.build_dictionary([b"!! ## $$ %% && " * 60])
    prose, junk = "plain words in a row " * 200, "!! ## $$ %% && " * 300
    assert compression_quality.difference(prose, good, bad) > 0 > compression_quality.difference(junk, good, bad)
    mixed = compression_quality.difference(prose + junk, good, bad)  # a prefix alone would look like prose
    assert mixed < compression_quality.difference(prose, good, bad)
    assert compression_quality.difference("", good, bad) == 0 and b"".join(compression_quality.cut("é" * 5000, 1024)) == ("é" * 5000).encode()


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    first = compression_quality.compression_quality(docs, labels).collect()
    marks = {r.doc_id: r.quality for r in labels.collect()}
    judged = [(r.score, r.predicted, marks[r.doc_id]) for r in first if r.held_out and r.doc_id in marks]
    assert sum(p == q for _, p, q in judged) >= 0.93 * len(judged)
    good, bad = ([s for s, _, q in judged if q == v] for v in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in first)


def test_quality_of_odd_rows(spark):
    rows = [(i, t, "en") for i, t in enumerate([*ODD, None, "same", "same", "word " * 50_000])] + [(None, "no id", None), (3, "x" * 5000, "en")]
    docs = table(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)] + [(0, 0), (2, 9), (None, 1)], "doc_id long, label int")
    found = compression_quality.compression_quality(docs, labels, label="label").collect()
    by_text = defaultdict(set)
    for r in found:
        by_text[dict((i, t) for i, t, _ in rows)[r.doc_id] or ""].add(r.score)
    assert len(found) == len(rows) and all(len(v) == 1 for v in by_text.values())
    one = compression_quality.compression_quality(docs, labels.where("label = 1"), label="label").collect()
    assert {r.score for r in one} == {1.0}
    none = compression_quality.compression_quality(docs, labels.where("false"), label="label")
    assert {r.score for r in none.collect()} == {0.0}
    assert compression_quality.compression_quality(docs.where("false"), labels, label="label").count() == 0


# collocations


def test_collocations_equal_the_sql(spark):
    assert same_result(spark, "op12_collocations", op12_collocations, SQL["op12_collocations"])


@pytest.mark.parametrize("table_size", [1 << 18, 20, 0])
def test_collocations_do_not_depend_on_the_table(spark, table_size):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    more = [(None, "The end of. The end of! the END of; of the end", None), (1, None, "en"), (2, "", "en"), (3, "a\tb c a\x0bb", "xx")]
    more += [(4, "the same row again " * 30, "en")] * 2 + [(5, "rep rep rep rep " * 9, None)]
    docs = table(spark, [tuple(r) for r in rows] + more)
    con = duckdb.connect()
    frame = docs.select("doc_id", "text", "lang").toArrow()  # noqa: F841 - read by the SQL
    con.execute("CREATE VIEW documents AS SELECT * FROM frame")
    asked = con.execute(collocations.collocations_sql(4, 5, 60, 100))
    names = [d[0] for d in asked.description]
    found = collocations.collocations(docs, 4, 5, 60, 100, table_size=table_size)
    assert sorted(tuple(r) for r in found.select(*names).collect()) == sorted(asked.fetchall())


def test_collocations_by_hand(spark):
    docs = table(spark, [(i, "big red dog. Dog big. red", "en") for i in range(10)] + [(50 + i, "big red", None) for i in range(12)])
    found = sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.collocations(docs).collect())
    # equal cuts: the shorter first part counts; big red and red dog lie inside as often and are left out in en
    assert found == [("en", 1, "big red dog", 10, 20, 10, 60, 500_000), ("en", 2, "dog big", 10, 20, 20, 60, 250_000), ("und", 1, "big red", 12, 12, 12, 24, 1_000_000)]
    assert collocations.collocations(docs.where("false")).count() == 0


def test_tiles_count_like_a_dictionary():
    rng, tiles, expected = np.random.default_rng(4), collocations.Tiles(), Counter()
    for _ in range(4):
        left, right = (np.minimum(rng.zipf(1.3, 5000), 9000).astype(np.int64) for _ in range(2))
        tiles.add(left, right)
        expected.update(zip(left.tolist(), right.tolist(), strict=True))
        tiles.compact()
    codes, counts = tiles.take()
    assert {(c >> 32, c & 0xFFFFFFFF): n for c, n in zip(codes.tolist(), counts.tolist(), strict=True)} == dict(expected)
    assert len(codes) == len(expected) and tiles.take()[0].size == 0


# token alignment


def brute_alignment(texts):
    """Rows from the libraries over whole texts, with ranges compared one by one."""
    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    signs, entry = token_alignment._byte_signs(), {v: k for k, v in a.get_vocab().items()}
    docs = []
    for text in texts:
        text = text or ""
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        a_parts = [bytes(signs[c] for c in entry[i]) for i in ids[0]]
        b_parts = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
        whole = (" " + text).encode()
        if not text or b"".join(a_parts) != whole or b"".join(b_parts) != whole:
            docs.append(None)
            continue
        ranges = []
        for parts in (a_parts, b_parts):
            ends = np.cumsum([len(p) for p in parts]).tolist()
            ranges.append(list(zip([0, *ends], ends, strict=False)))
        both = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
        groups = [[[], []] for _ in both]
        for side in (0, 1):
            at = 0
            for i, (_, end) in zip(ids[side], ranges[side], strict=True):
                groups[at][side].append(str(i))
                at += end == both[at]
        links, j = [], 0
        for i, (start, end) in zip(ids[0], ranges[0], strict=True):
            while ranges[1][j][1] <= start:
                j += 1
            k = j
            while k < len(ids[1]) and ranges[1][k][0] < end:
                links.append((i, ids[1][k]))
                k += 1
        written = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups)
        docs.append((len(ids[0]), len(ids[1]), len(both), links, hashlib.sha256(written.encode()).hexdigest()))
    count, best = Counter(p for d in docs if d for p in set(d[3])), defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if d is None
        else (d[0], d[1], d[2], len(d[3]), sum(count[p] == best[p[0]] for p in d[3]), sum(count[p] for p in d[3]), d[4])
        for d in docs
    ]


@pytest.mark.parametrize("slice_keys", [1 << 22, 4000])
def test_alignment_equals_brute_force(spark, slice_keys):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").limit(60).collect()]
    rows += [(10**6 + i, t, None) for i, t in enumerate(ODD)] + [(None, None, None), (7, "same", "en"), (7, "same", "en")]
    found = token_alignment.token_alignment(table(spark, rows), BYTES, PIECES, slice_keys=slice_keys)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    key = lambda r: (r[0] if r[0] is not None else -1, *r[1:])
    expected = [key((r[0], *e)) for r, e in zip(rows, brute_alignment([r[1] for r in rows]), strict=True)]
    assert sorted(key(tuple(r)) for r in found.collect()) == sorted(expected)


def test_alignment_of_an_empty_table(spark):
    assert token_alignment.token_alignment(table(spark, [(1, "", None)]).where("false"), BYTES, PIECES).count() == 0
    assert tuple(token_alignment.token_alignment(table(spark, [(1, None, None)]), BYTES, PIECES).first()) == (1, 0, 0, 0, 0, 0, 0, "")


def test_perfect_hash_is_one_to_one_and_knows_strangers():
    for n in (1, 2, 5, 300, 2500):
        keys = np.sort(np.random.default_rng(n).choice(1 << 31, n, replace=False))
        seed, pilots, placed = token_alignment.build_perfect(keys)
        assert sorted(placed.tolist()) == keys.tolist() and len(pilots) == max(1, n // 4)
        known = token_alignment.PairNumbers(0, 1, np.array([seed]), np.array([0, n]), np.array([0, len(pilots)]), pilots, placed)
        at, number = known.find(keys)
        assert sorted(number.tolist()) == list(range(n)) and (placed[number] == keys[at]).all()
        strangers = np.setdiff1d(np.arange(0, 1 << 31, 999_983), keys)
        assert len(known.find(strangers)[0]) == 0


def test_stretches_cut_only_where_both_tokenizers_do():
    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    encode_a, encode_b = token_alignment.load_a(BYTES)[0], token_alignment.load_b(PIECES)[0]
    rng = np.random.default_rng(6)
    for _ in range(400):
        text = "".join(rng.choice([" ", " ", "\n", "\t", "a", "B", "'s", "7", "é", "!", " ", "日", "the", "\r"], rng.integers(1, 14)))
        parts = token_alignment.stretches(" " + text)
        assert "".join(parts) == " " + text
        assert [i for x in encode_a(parts) for i in x] == a.encode(" " + text, add_special_tokens=False).ids, repr(text)
        assert [i for p in parts for i in encode_b.encode(p)] == b.encode(text), repr(text)
