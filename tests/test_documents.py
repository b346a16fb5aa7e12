import json
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.functions import text as tx
from siltstone.functions.guardrails import verdict
from siltstone.functions.redaction import redact_columns, redact_json, redact_json_checked
from siltstone.operators import documents, healing, retrieval


def chunks_of(spark, text, **options):
    df = spark.createDataFrame([("d", text)], "document_id string, text string")
    found = documents.chunk(df, **options).orderBy("chunk_index").collect()
    return [(r["chunk_index"], r["chunk_text"]) for r in found]


def plain_windows(text, size, overlap):
    pieces = [text[i : i + size] for i in range(0, len(text), size - overlap)]
    return list(enumerate(p for p in pieces if p.strip()))


@pytest.mark.parametrize("text", ["a" * 2500, "short text", "", " \n ", "x" * 800 + " " * 1800 + "y", "ação 😀\n" * 400, None])
def test_chunks(spark, text):
    assert chunks_of(spark, text) == (plain_windows(text, 1000, 200) if text else [])


@pytest.mark.parametrize(("size", "overlap"), [(10, 0), (10, 9), (10, 7), (7, 3), (1, 0)])
def test_chunk_sizes(spark, size, overlap):
    text = "".join(random.Random(size + overlap).choice("ab \n") for _ in range(95))
    assert chunks_of(spark, text, size=size, overlap=overlap) == plain_windows(text, size, overlap)


def test_overlap_must_be_smaller_than_size():
    with pytest.raises(ValueError):
        tx.windows(F.lit("x"), 10, 10)


def test_decode(spark):
    raw = [b"valid \xff\xfe bytes", "é€😀".encode(), b"\xc3", "� kept".encode(), b"\xe2\xef\xbf\xbd\xff", b""]
    df = spark.createDataFrame([(bytearray(b),) for b in raw], "content binary")
    assert [r[0] for r in df.select(tx.decode_utf8(F.col("content"))).collect()] == [b.decode("utf-8", "ignore") for b in raw]


def corpus(n=120, seed=2):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["the"] * 25
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 40))) for _ in range(n)]
    texts[7] = texts[3]  # an exact copy: a tie that the id must settle
    return texts


def brute_bm25(queries, texts, k):
    docs = [re.findall(r"\w+", t.lower()) for t in texts]
    mean = sum(map(len, docs)) / len(docs)
    result = set()
    for q, query in enumerate(queries):
        scored = []
        for d, words in enumerate(docs):
            counts, score = Counter(words), 0.0
            for term in set(query.split()):
                df = sum(term in w for w in docs)
                idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                score += idf * counts[term] * 2.2 / (counts[term] + 1.2 * (0.25 + 0.75 * len(words) / mean))
            if score > 0:
                scored.append((-round(score, 9), d))
        result |= {(q, d, n + 1) for n, (_, d) in enumerate(sorted(scored)[:k])}
    return result


@pytest.mark.parametrize("postings", [250_000, 7])
def test_bm25_matches_brute_force(spark, postings):
    texts, queries = corpus(), ["the w1 w2", "w3 w3 w9", "nothing here", texts_query()]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(5)
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id int, text string")
    found = retrieval.bm25_topk(asked, retrieval.text_index(docs), 6, postings)
    assert {(r["query_id"], r["id"], r["rank"]) for r in found.collect()} == brute_bm25(queries, texts, 6)


def test_bm25_with_missing_ids_ties_and_no_match(spark):
    docs = spark.createDataFrame([(n, "same words") for n in [None, *range(30, 0, -1)]] + [(99, None), (98, "")], "id long, text string")
    index = retrieval.text_index(docs).repartition(4)
    asked = spark.createDataFrame([("a", "words"), ("b", "other"), (None, "same"), ("c", None)], "query_id string, text string")
    for postings in (250_000, 5):
        found = retrieval.bm25_topk(asked, index, 4, postings).collect()
        assert sorted((r["query_id"] or "", r["rank"], r["id"]) for r in found) == [(q, n + 1, i) for q in ("", "a") for n, i in enumerate([None, 1, 2, 3])]
    assert retrieval.bm25_topk(asked.where("query_id = 'b'"), index, 4).count() == 0
    assert retrieval.bm25_topk(asked.limit(0), index.limit(0), 4).count() == 0


def test_text_index_counts_within_rows_without_an_exchange(spark, rows, capsys):
    texts = ["b a b B c", "x", "", None, "one " * 300 + "two"]
    index = retrieval.text_index(spark.createDataFrame(list(enumerate(texts)), "id long, text string"))
    counts = [(n, Counter((t or "").lower().split())) for n, t in enumerate(texts)]
    lengths = [None if t is None else len(t.split()) for t in texts]
    wanted = {(term, n, lengths[n], tf) for n, c in counts for term, tf in [(None, 1), *c.items()]}
    assert set(rows(index, "term", "id", "length", "tf")) == wanted
    assert index.count() == len(wanted)
    index.explain()
    assert "Exchange" not in capsys.readouterr().out


def texts_query():
    return corpus()[3]


@pytest.mark.parametrize("block", [4096, 2])
def test_vectors_match_brute_force(spark, block):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(90, 8)).round(3)
    base[50] = base[10]
    asked = base[:5] * 3
    corpus_df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(base)], "id long, vector array<float>")
    corpus_df = corpus_df.unionByName(spark.createDataFrame([(999, None)], "id long, vector array<float>")).repartition(4)
    queries = spark.createDataFrame([(f"q{i}", [float(x) for x in v]) for i, v in enumerate(asked)], "query_id string, vector array<double>")
    found = {(r["query_id"], r["id"], r["rank"]) for r in retrieval.vector_topk(queries, corpus_df, 7, block).collect()}
    vectors = base.astype(np.float32).astype(float)
    expected = set()
    for q, v in enumerate(asked):
        sims = np.round(vectors @ v / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(v)), 9)
        order = sorted(range(len(base)), key=lambda i: (-sims[i], i))[:7]
        expected |= {(f"q{q}", i, n + 1) for n, i in enumerate(order)}
    assert found == expected


def test_rerank(spark):
    df = spark.createDataFrame(
        [(1, "low", 1, 0.2), (1, "high", 2, 0.9), (1, "mid", 3, 0.5), (1, "mid2", 4, 0.5)],
        "query_id int, chunk_text string, rank int, score double",
    )
    kept = retrieval.rerank(df, "score", 3).orderBy("rank").collect()
    assert [r["chunk_text"] for r in kept] == ["high", "mid", "mid2"]
    assert retrieval.rerank(df.limit(0), "score").count() == 0
    with pytest.raises(Exception, match="needs a score"):
        retrieval.rerank(df.withColumn("score", F.lit(None).cast("double")), "score").collect()
    context = retrieval.context_text(retrieval.rerank(df, "score", 2).withColumn("source_path", F.lit("/p"))).first()
    assert context["context"] == "[/p] high\n\n[/p] mid"


@pytest.mark.parametrize(
    ("path", "diff", "reason"),
    [
        ("pipelines/rag/reports/x.md", "fine", None),
        ("./pipelines//rag/x.md", "fine", None),
        (".github/workflows/ci.yml", "fine", "out_of_scope_path:.github/workflows/ci.yml"),
        ("pipelines/rag/../../etc", "fine", "invalid_path:pipelines/rag/../../etc"),
        ("/pipelines/rag/x", "fine", "invalid_path:/pipelines/rag/x"),
        ("pipelines\\rag\\x", "fine", "invalid_path:pipelines\\rag\\x"),
        ("pipelines/rag/x", "os.system('rm')", r"dangerous_pattern:os\.system\("),
        ("pipelines/rag/x", "medieval(x)", None),
        ("pipelines/rag/x", "a drop\ttable b", r"dangerous_pattern:DROP\s+TABLE"),
        ("pipelines/rag/x", "delete from t ;", r"dangerous_pattern:DELETE\s+FROM\s+\w+\s*;"),
        ("pipelines/rag/x", "API_KEY = 'abc'", r"dangerous_pattern:(?i)(api[_-]?key|secret|password)\s*=\s*['\"][^'\"]+['\"]"),
        ("docs/x", "eval(x)", "out_of_scope_path:docs/x"),
    ],
)
def test_guardrails(spark, path, diff, reason):
    df = spark.createDataFrame([(path, diff)], "p string, d string")
    assert df.select(verdict(F.col("p"), F.col("d"))).first()[0] == reason


def test_scores_print_in_full(spark):
    from siltstone.functions.gates import outlier_query

    numbers = [0.0004, 0.00012345678901234567, 4e-05, -1.25e-07, 0.0, -0.3, 12.5, 12345678.9, 1e7, 1e16, -2.5e120, float(2**53)]
    rows = spark.createDataFrame([("T", v) for v in numbers], "t string, v double")
    assert [r[0] for r in rows.select(outlier_query(F.col("t"), F.col("v"))).collect()] == [f"T anomaly_score={v}" for v in numbers]
    assert rows.limit(1).select(outlier_query(F.col("t"), F.lit(None).cast("double"))).first()[0] == "T anomaly_score="


def test_score_gate(spark):
    drafts = spark.createDataFrame(
        [("i1", "text", 2, 0.9, 0.85), ("i2", "text", 2, 0.3, 0.4), ("i3", "t", 1, float("nan"), 0.9), ("i4", "t", 1, None, 0.9)],
        "insight_id string, draft string, documents int, faithfulness double, answer_relevancy double",
    )
    queued, rejected = healing.score_gate(drafts, F.lit("2026-01-02 03:04:05").cast("timestamp"))
    assert queued.count() == 1 and rejected.count() == 3
    payload = json.loads(queued.first()["detail"])
    assert payload["target_file"] == "pipelines/rag/reports/i1-20260102T030405.md" and payload["diff"] == "text"
    assert "faithfulness=0.90" in payload["explanation"]
    assert {r["rejection_reason"] for r in rejected.collect()} == {"low_ragas_score"}
    again, _ = healing.score_gate(drafts, F.lit("2026-01-02 03:04:05").cast("timestamp"))
    assert again.first()["event_id"] == queued.first()["event_id"]


def test_failure_feed_and_routing(spark):
    at = "timestamp'2026-01-02 03:04:05'"
    dlq = spark.sql(f"select 's' source, cast(null as string) _failure_reason, {at} detected_at")
    detail = json.dumps({"root_cause": "content_generation", "target_file": "f", "diff": "d", "explanation": "e"})
    events = spark.createDataFrame(
        [("e1", "execution", "x", "boom"), ("e2", "content_generation", "y", detail)],
        "event_id string, source_failure_type string, source string, detail string",
    ).withColumn("detected_at", F.expr(at))
    feed = healing.failure_feed(dlq, events)
    first = feed.where("source_failure_type = 'contract'").first()
    assert (first["event_id"], first["detail"], first["code_context"]) == (
        "dlq-s-2026-01-02T03:04:05+00:00", "unknown", "contracts/s.contract.yaml",
    )
    prepared, waiting = healing.route(feed)
    assert (prepared.first()["fix_type"], prepared.first()["target_file"]) == ("content", "f")
    assert sorted(r["event_id"] for r in waiting.collect()) == ["dlq-s-2026-01-02T03:04:05+00:00", "e1"]


def test_redaction(spark):
    df = spark.sql(
        "select 'abc' token, named_struct('password', 'x', 'note', 'use Bearer ghi now') nested, "
        "map('api_key', 'k', 'other', 'bearer a.b') m, array(named_struct('email', 'a@b', 'n', 1)) l, 5 n"
    )
    got = redact_columns(df).first()
    assert got["token"] == "[REDACTED]" and got["nested"]["password"] == "[REDACTED]"
    assert got["nested"]["note"] == "use Bearer [REDACTED] now" and got["n"] == 5
    assert got["m"] == {"api_key": "[REDACTED]", "other": "Bearer [REDACTED]"}
    assert got["l"][0]["email"] == "[REDACTED]" and got["l"][0]["n"] == 1
    value = {"a": [{"Token": {"deep": 1}}, "Bearer x", ["bearer y"], 3], "user-email": 1, "ok": None}
    row = spark.createDataFrame([(json.dumps(value),), (None,)], "j string").select(redact_json("j")).collect()
    masked = {"a": [{"Token": "[REDACTED]"}, "Bearer [REDACTED]", ["Bearer [REDACTED]"], 3], "user-email": "[REDACTED]", "ok": None}
    assert json.loads(row[0][0]) == masked and row[1][0] is None


def test_guardrails_refuse_missing_fields(spark):
    from siltstone.functions.guardrails import verdict

    rows = spark.createDataFrame([(None, "x"), ("pipelines/a.py", None), (None, None)], "path string, diff string")
    assert [r[0] for r in rows.select(verdict(rows["path"], rows["diff"])).collect()][::2] == ["invalid_path:"] * 2
    assert rows.where("path IS NOT NULL").select(verdict(rows["path"], rows["diff"])).first()[0] is not None


def test_one_bad_text_does_not_stop_the_others(spark):
    texts = ['{"password": 1, "a": ["Bearer abc.def"]}', '{"token": "x"', None, "", "[" * 100_000, '"Bearer q"']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, j string")
    found = [tuple(r.c) for r in df.select("i", redact_json_checked("j").alias("c")).orderBy("i").collect()]
    bad = ("[REDACTED]", "malformed_json")
    assert found == [('{"password": "[REDACTED]", "a": ["Bearer [REDACTED]"]}', None), bad, (None, None), bad, bad, ('"Bearer [REDACTED]"', None)]
    variant = df.where("i IN (0, 2)").select(F.expr("parse_json(j)").alias("v"))
    assert [r[0] for r in redact_columns(variant).select(F.to_json("v")).collect()] == ['{"a":["Bearer [REDACTED]"],"password":"[REDACTED]"}', None]
