"""Training-data operators on small fixtures, against brute force, the libraries and DuckDB."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from siltstone.llm import byte_bpe, chosen_path, decontaminate, exact_dedup, html_consensus, licenses, line_dedup, maxent_lm, token_counts, toxicity
from siltstone.llm.queries import SQL, op2_license_scan, op3_byte_bpe, op8_exact_dedup, op9_line_dedup
from tests_support import SF, same_result

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PROSE = "the quick brown fox jumps over the lazy dog while seven other foxes sleep under an old oak tree near the river"
LONG_LINE = "this very line is long enough to be looked at by the operator"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, batch string, set_key string, score int"
TEXTS = [
    (0, PROSE), (1, PROSE), (2, PROSE + " again"), (3, ""), (4, None), (5, "x" * 3000), (6, f"{LONG_LINE}\nb"), (7, f" {LONG_LINE.upper()} \nc"),
    (8, "a  b\t\n\n  c's I'll ½ naïve 日本語 <s> ▁x \x1c"), (9, PROSE), (None, PROSE), (9, PROSE),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, "s", None, "clash", "clash", 1) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("query", [op2_license_scan, op8_exact_dedup, op9_line_dedup])
def test_sql_twins(spark, query):
    assert same_result(spark, query.__name__, query, SQL[query.__name__])


def test_fuse_filter_knows_its_keys():
    others = np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64)
    for n in (1, 2, 7, 1000, 40_000):
        keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64))
        row = exact_dedup.build_fuse(keys)
        assert exact_dedup.fuse_contains(row, keys).all()
        assert exact_dedup.fuse_contains(row, others).mean() < 0.02


def test_exact_dedup_of_odd_rows(docs, empty):
    found = sorted((r.doc_id if r.doc_id is not None else -1, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs).collect())
    assert found[0] == (-1, 9, 5, False)
    assert (3, 4, 2, False) in found and (4, 4, 2, True) in found and found.count((9, 9, 5, True)) == 2
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_line_dedup_of_odd_rows(spark, docs, empty):
    rows = [(i, f"{i}\n{LONG_LINE}\n{LONG_LINE}", None, None, None, None, None, None) for i in range(10, 13)]
    more = docs.unionByName(spark.createDataFrame(rows, SCHEMA))
    found = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.line_dedup(more).collect()}
    assert found[6] == (2, 1, "b") and found[7] == (2, 1, "c") and found[10] == (3, 2, "10")
    assert found[12] == (3, 0, f"12\n{LONG_LINE}\n{LONG_LINE}") and found[4] == (1, 0, "")
    assert line_dedup.line_dedup(empty).count() == 0


def test_line_runs_know_what_is_new(spark):
    runs = line_dedup.LineRuns(spark)
    batches = [[b"a", b"b"], [b"b", b"c"], [b"a", b"d"]]
    fresh = [{bytes(r.line) for r in runs.add(spark.createDataFrame([(x, 1) for x in b], "line binary, doc_id long")).collect()} for b in batches]
    assert fresh == [{b"a", b"b"}, {b"c"}, {b"d"}]
    assert {bytes(r.line): r.n_docs for r in runs.totals().collect()} == {b"a": 2, b"b": 2, b"c": 1, b"d": 1}


def test_token_counts_equal_the_library(docs, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = token_counts.token_counts(docs, PIECES).collect()
    expected = sorted((len((t or "").encode()), len(library.encode(t or ""))) for _, t in TEXTS)
    assert sorted((r.n_bytes, r.n_tokens) for r in found) == expected
    assert token_counts.token_counts(empty, PIECES).count() == 0


def test_byte_bpe_equals_the_library_and_round_trips(docs, empty):
    ranks = byte_bpe.load_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = sorted((library.encode_ordinary(t or ""), (t or "").encode()) for _, t in TEXTS)
    for size in (1 << 17, 2):  # all words in the table, nearly none
        coded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, table_words=size)
        rows = coded.select("ids", byte_bpe.decode(F.col("ids"), RANKS).alias("back")).collect()
        assert sorted((list(r.ids), bytes(r.back)) for r in rows) == expected
    assert byte_bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_the_worker_that_encodes_decodes_too(spark, docs):
    ranks = byte_bpe.load_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, table_words=2, decoded=True).collect()
    assert sorted((list(r.ids), bytes(r.decoded)) for r in rows) == sorted((library.encode_ordinary(t or ""), (t or "").encode()) for _, t in TEXTS)
    coded = op3_byte_bpe(spark, SF)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan  # else each core runs two workers at once
    expected = {
        (r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode_bytes(ids)).hexdigest())
        for r in spark.read.parquet(f"{SF}/documents.parquet").collect()
        for ids in [library.encode_ordinary(r.text or "")]
    }
    assert {tuple(r) for r in coded.collect()} == expected


def test_reordered_passages_are_found(spark, docs, empty):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    words = item.split()
    cut = " ".join(words[8:]) + " and then " + " ".join(words[:8])
    rows = [(100, f"before {item} after"), (101, f"x {cut.upper()} y"), (102, " ".join(words[:5])), (103, " ".join(reversed(words)))]
    more = docs.unionByName(spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in rows], SCHEMA))
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "no match here at all folks")], "item_id long, text string")
    for block_bytes in (1 << 20, 64):
        found = decontaminate.decontaminate(more, items, block_bytes=block_bytes).where("contaminated").collect()
        assert sorted((r.doc_id, r.best_item, r.item_ids) for r in found) == [(100, 1, [1]), (101, 1, [1])]
    assert decontaminate.decontaminate(more, items.where("false")).where("contaminated").count() == 0
    assert decontaminate.decontaminate(empty, items).count() == 0


def test_tiles_never_overlap():
    rng = np.random.default_rng(3)
    for _ in range(50):
        item, doc = rng.integers(1, 4, 30), rng.integers(1, 4, 60)
        seen_item, seen_doc = set(), set()
        for i, j, n in decontaminate.tile(item, doc, 3):
            assert (item[i : i + n] == doc[j : j + n]).all() and n >= 3
            assert not seen_item & set(range(i, i + n)) and not seen_doc & set(range(j, j + n))
            seen_item |= set(range(i, i + n))
            seen_doc |= set(range(j, j + n))


def test_jaccard_join_against_brute_force(spark, docs, empty):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(5000, 80).astype(str)) for _ in range(30)]
    hot = texts[0].split()
    texts += [" ".join([*hot[: 79 - k % 5], f"w{k}"]) for k in range(300)]  # one group holds most rows
    rows = [(i, t, None, None, None, None, None, None) for i, t in enumerate(texts)]
    found = {r.doc_id: r for r in chosen_path.jaccard_join(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    sets = [set(chosen_path.shingles(t).tolist()) for t in texts]
    for a in range(0, len(texts), 7):
        links = {b for b, other in enumerate(sets) if other != sets[a] and len(sets[a] & other) >= 0.8 * len(sets[a] | other)}
        assert found[a].n_links == len({frozenset(sets[b]) for b in links})
        assert all(found[b].class_id == found[a].class_id for b in links)
    odd = {r.doc_id: (r.class_id, r.n_links) for r in chosen_path.jaccard_join(docs).collect()}
    assert odd[1] == (0, 1) and odd[2] == (0, 1) and odd[3] == (3, 0) and odd[4] == (4, 0) and odd[None] == (None, 0)
    assert chosen_path.jaccard_join(empty).count() == 0


def test_html_main_text(spark):
    body = "<h1>Title &amp; more</h1><p>First   paragraph with <b>bold</b>ness.<p>Second one<br>goes on, long enough to win."
    page = (
        "<html><head><title>t</title><script>var a='<p>no</p>'</script></head><body><nav><a href=/>menu</a></nav><header>top</header>"
        f"<div class='cookie-notice'>We use cookies</div><article class='post-%d'>{body}<aside>aside</aside></article>"
        "<div class='comments'><p>A reader says something quite long here, longer than all of the article taken together, "
        "and goes on about it, on and on.</p></div><form>mail</form><footer>end</footer></body></html>"
    )
    rows = [(i, "https://a.example/x", page % i) for i in range(5)] + [(9, None, None), (10, "b", ""), (11, "//c/d", "plain text")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_consensus.extract_pages(pages).collect()}
    expected = "Title & more\nFirst paragraph with boldness.\nSecond one goes on, long enough to win."
    assert [found[i] for i in range(5)] == [expected] * 5
    assert found[9] == "" and found[10] == "" and found[11] == "plain text"
    assert html_consensus.extract_pages(pages.where("false")).count() == 0


def test_html_loses_no_part_of_an_article():
    text = lambda n, word="word": (word + " ") * (n // (len(word) + 1))
    lead = f"<article><h1>Title here</h1><p>The lead.</p><div class=body><p>{text(3000)}</p><p>{text(900)}</p></div></article>"
    sections = f"<article><section class=a><p>{text(300, 'first')}</p></section><section class=b><p>{text(700, 'second')}</p></section></article>"
    wrapped = f"<div class=post><div class=lead>Short lead.</div><div class=body>{text(5000)}</div></div>"
    for shown, parts in ((lead, ("Title here", "The lead.", "word")), (sections, ("first", "second")), (wrapped, ("Short lead.", "word"))):
        for names in ("content has-sidebar", "post no-comments", "layout with-menu", "social-science", "sidebar"):
            html = f"<html><body><div class='{names}'>{shown}</div><div class='site-footer'>imprint</div><ul class=x><li><a href=/>more links</a></li></ul></body></html>"
            path = html_consensus.best_path(html_consensus.parse(html))[0]
            found = html_consensus.extract(html, [path])
            assert all(x in found for x in parts) and "imprint" not in found and "links" not in found


def test_language_model_base_and_probabilities(docs, empty):
    found = maxent_lm.language_model(docs).collect()
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    train = Counter(w for i, t in TEXTS if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1 for w in tokens(t))
    total, size = sum(train.values()), len(train)
    base = sorted(round(sum(math.log10((train[w] + 0.5) / (total + 0.5 * (size + 1))) for w in tokens(t)), 6) for _, t in TEXTS)
    assert sorted(round(r.base_score, 6) for r in found) == pytest.approx(base)
    assert all(r.train_tokens == total and r.score < 0 for r in found)
    assert maxent_lm.language_model(empty).count() == 0


def test_language_model_scores_from_stored_word_numbers(docs):
    lexicon = maxent_lm.Lexicon([b"\n", b"the"], np.array([2.0, 1.0]), 3, 2, np.zeros(0, int), np.zeros(0, int), [])
    rows = maxent_lm.numbered(maxent_lm.held_out(maxent_lm.id_and_text(docs, "doc_id", "text")), lexicon)
    expected = sorted(([*((1 if w == b"the" else -1) for w in maxent_lm.words_of(t or "")), 0]) for _, t in TEXTS)
    assert sorted(np.frombuffer(r.numbers, np.int32).tolist() for r in rows.collect()) == expected
    assert sorted(len(r.rest) for r in rows.collect()) == sorted(x.count(-1) for x in expected)
    scored = maxent_lm.language_model(docs)
    assert "text" not in scored._jdf.queryExecution().optimizedPlan().toString()  # texts are not split into words again


def test_language_model_is_a_distribution():
    words = [maxent_lm.END.encode(), *(f"w{i}".encode() for i in range(9))]
    counts = np.arange(20, 10, -1).astype(float)
    members = [np.array([0, 3]), np.array([1, 2, 4])]
    lexicon = maxent_lm.Lexicon(words, counts, int(counts.sum()), 10, np.array([0, 1, 1, 0, 1]), np.array([0, 0, 1, 1, 2]), members)
    model = maxent_lm.Model(lexicon)
    text = np.array([1, 4, 7, 3, 0] * 20)
    starts = np.arange(100) % 5 == 0
    before = model.log_probabilities(text, starts).sum()
    memory = (np.zeros(len(model.outer), np.float32), np.zeros(len(model.within), np.float32))
    for _ in range(5):
        model.train(text, starts, memory)
    assert model.log_probabilities(text, starts).sum() > before
    each = [np.exp(model.log_probabilities(np.array([2, w]), np.array([True, False]))[1]) for w in range(10)]
    unknown = np.exp(model.log_probabilities(np.array([2, -1]), np.array([True, False]))[1]) * 0.5 / lexicon.rest_weight
    assert sum(each) + unknown == pytest.approx(1, abs=1e-5)


def test_language_model_gives_4096_words_their_own_weights(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 4, 3500, 4)), None, None, None, None, None, None) for i in range(40)]
    train = spark.createDataFrame(rows, SCHEMA).select("text")
    kinds = maxent_lm.word_kinds(train).cache()
    model = maxent_lm.Model(maxent_lm.build_lexicon(kinds, kinds.groupBy("word").agg(F.sum("n").alias("n"))))
    assert model.lexicon.model_words == 3501 and len(model.outer) == 3 * 8192 + 16384 and len(model.within) == 256
    assert model.n_classes > 25  # the classes of words and that of all others


def test_licences_are_inherited(spark):
    apache = "/* Licensed under the Apache License, Version 2.0. */\ncode"
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.py", "code"), ("a/b/y.py", apache), ("z.py", None), ("a/b/q/r.py", ""), (None, "")]
    files = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "k long, path string, text string")
    found = {r.doc_id: (r.own_licence, r.licence, r.inherited_from) for r in licenses.scan(files, "k", "path").collect()}
    assert found[0] == ("MIT", "MIT", None) and found[2] == ("Apache-2.0", "Apache-2.0", None)
    assert found[1] == (None, "Apache-2.0", "a/b") and found[4] == (None, "Apache-2.0", "a/b")
    assert found[3] == (None, None, None) and found[5] == (None, None, None)
    assert licenses.scan(files.where("false"), "k", "path").count() == 0


def test_licence_files_come_before_headers(spark):
    gpl = "// This work is licensed under the GNU General Public License, version 3."
    rows = [
        ("a/LICENSE", "MIT License"), ("a/vendored.py", gpl), ("a/vendored.py", gpl), ("a/x.py", "code"), ("a/b/x.py", ""),
        ("c/COPYING", "nothing of the kind"), ("c/y.py", gpl), ("c/z.py", None), ("d/z.py", "word " * 200_000),
    ]
    # columns of the operator's own names, and rows that repeat
    files = spark.createDataFrame([(i, p, t, "x", 1.0) for i, (p, t) in enumerate(rows)], "k long, p string, t string, dir string, own double")
    scanned = licenses.scan(files, "k", "p", "t").collect()
    found = {r.doc_id: (r.own_licence, r.licence, r.inherited_from) for r in scanned}
    assert len(scanned) == len(rows)
    assert found[0][1] == found[3][1] == found[4][1] and found[3][2] == found[4][2] == "a"
    assert found[1] == found[2] and found[1][0] == found[1][1] and found[1][0] == "GPL-3.0" and found[3][1] == "MIT"
    assert found[5][2] == found[7][2] == "c" and found[7][1] == found[6][0] == found[1][0]  # a licence file that says nothing gives nothing
    assert found[8] == (None, None, None)


def test_licences_of_wrapped_and_inner_notices(spark):
    wrap = lambda text, mark="# ", n=9: "\n".join(mark + " ".join(text.split()[i : i + n]) for i in range(0, len(text.split()), n))
    gnu = {kind[0]: licenses._GNU.format(*kind[1:], ";", ";") for kind in licenses._GNU_KINDS}
    texts = {
        "MIT": "Copyright (c) 2020 Someone\n\n" + wrap(f"{licenses._MIT} {licenses._AS_IS}", ""),
        "BSD-3-Clause": "// Copyright (c) 2020 Someone\n// All rights reserved.\n//\n" + wrap(f"{licenses._BSD} {licenses._BSD_3} {licenses._BSD_AS_IS}", "// "),
        "BSD-2-Clause": wrap(f"{licenses._BSD} {licenses._BSD_AS_IS}", " * "),
        "ISC": wrap(licenses._ISC, "-- "),
        "Apache-2.0": "import os  # the code of this file is, as all of our project, Licensed under the Apache License, Version 2.0. and it goes on with other words",
        **{name: wrap(text) for name, text in gnu.items()},
    }
    files = spark.createDataFrame([(name, f"{name}/x.py", f"code\n{text}\nmore code = 1") for name, text in texts.items()], "k string, path string, text string")
    assert {r.doc_id: r.own_licence for r in licenses.scan(files, "k", "path").collect()} == {name: name for name in texts}
    notices = spark.createDataFrame([(text,) for _, text in licenses.NOTICES], "text string")
    assert notices.where(~F.col("text").rlike(licenses.NAMES_NOTICE)).count() == 0
    plain = spark.createDataFrame([(1, "a", "permission was given by the owner of this copyright for a walk")], "k long, path string, text string")
    assert licenses.scan(plain, "k", "path").first().own_licence is None


def test_toxicity_on_held_out_rows(spark, docs, empty):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = toxicity.toxicity(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in found) >= 0.9 * len(found)
    none = toxicity.toxicity(docs, labels.where("false")).collect()
    assert len(none) == len(TEXTS) and {r.score for r in none} == {0.0}
    assert toxicity.toxicity(empty, labels.where("false")).count() == 0


def test_pipeline_stages_keep_clean_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs, names = spark.read.parquet(f"{sf}/documents.parquet"), [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "jaccard_join", "decontamination", "byte_bpe"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    newest = {}
    for i, t in texts.items():
        newest[t] = max(i, newest.get(t, i))
    kept = {r.doc_id for r in corpus_pipeline.drop_copies(spark, docs, sf).collect()}
    assert kept == set(newest.values())
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = corpus_pipeline.drop_contaminated(spark, docs, sf)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, t in texts.items() if not any(x in t for x in items)}


def test_forms_around_the_whole_page_are_read():
    body = "A paragraph of the article that says enough to be read as text and not as the label of a field. " * 3
    menu = '<nav><a href="/">Home</a></nav>'
    comment = '<form class="comment-form"><label>Your name</label><textarea>x</textarea><p>Leave a reply below.</p></form>'
    for wrapper in ("form", "fieldset", "dialog", "aside"):
        html = f"<body><{wrapper}>{menu}<div><h1>Title</h1><p>{body}</p></div><footer>Contact</footer></{wrapper}></body>"
        assert html_consensus.extract(html, []) == f"Title\n{body.strip()}"
    assert html_consensus.extract(f"<body><article><p>{body}</p>{comment}</article></body>", []) == body.strip()
    assert html_consensus.extract("<body><form><label>User name</label><p>Password</p></form></body>", []) == ""
    wide = f"<form><p>{body * 5}</p></form>"  # a long form does not make the sidebar around it the article
    assert html_consensus.extract(f'<body><article><p>{body}</p></article><div class="sidebar"><p>Read more</p>{wide}</div></body>', []) == body.strip()
