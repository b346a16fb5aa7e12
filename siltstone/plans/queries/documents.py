"""Documents: chunks, search, reranking, the score gate, guardrails and the failure feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import gates
from siltstone.functions.guardrails import DANGEROUS_PATTERNS
from siltstone.functions.redaction import redact_columns, redact_json
from siltstone.operators import contracts, documents, healing, retrieval
from siltstone.plans.declared import CONTRACTS
from siltstone.plans.queries import MIDPOINT, MONTH_END, moment, register, table
from siltstone.plans.queries.ingest import CHECKED_SQL, checked_quotes
from siltstone.session import spread, work_path
from siltstone.sources.lake import incremental

CHUNKS_SQL = r"""
WITH w AS (SELECT doc_id, lang, source, text, unnest(generate_series(0, CAST(length(text) AS BIGINT) - 1, 800)) AS s FROM documents WHERE length(text) > 0),
c AS (SELECT doc_id, lang, source, s, substr(text, s + 1, 1000) AS chunk_text FROM w),
k AS (SELECT * FROM c WHERE regexp_matches(chunk_text, '\S'))
"""


def chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files whose bytes end in an invalid sequence, decoded and cut."""
    files = spread(table(spark, sf_dir, "documents")).select(
        "doc_id", "lang", "source", F.concat(F.encode("text", "utf-8"), F.unhex(F.lit("FFFE"))).alias("content")
    )
    return documents.chunk(documents.decode(files).drop("content"))


@register(
    CHUNKS_SQL
    + "SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS BIGINT) AS chunk_index, chunk_text FROM k"
)
def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_rows(spark, sf_dir).select("doc_id", "chunk_index", "chunk_text")


@register(
    CHUNKS_SQL
    + """SELECT CAST(count(DISTINCT doc_id) AS BIGINT) AS files_processed, CAST(count(*) FILTER (lang <> 'de') AS BIGINT) AS chunks_written,
  CAST(count(*) FILTER (lang = 'de') AS BIGINT) AS chunks_rejected FROM k"""
)
def chunk_ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks checked against their contract; German documents arrive without an id."""
    chunks = chunk_rows(spark, sf_dir)
    record = F.struct(
        F.when(F.col("lang") != "de", F.concat(F.lit("d"), "doc_id")).alias("document_id"),
        F.col("source").alias("source_path"),
        "chunk_index",
        "chunk_text",
        F.lit("2024-01-01T00:00:00Z").alias("updated_at"),
    )
    checked = contracts.check(chunks.select("doc_id", F.to_json(record).alias("payload")), CONTRACTS["sharepoint_documents"])
    accepted = F.col(contracts.REASON).isNull()
    return checked.agg(
        F.countDistinct("doc_id").alias("files_processed"),
        F.count_if(accepted).alias("chunks_written"),
        F.count_if(~accepted).alias("chunks_rejected"),
    )


def text_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def saved_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text index built once, saved and read back."""
    path = work_path(spark, "text-index")
    docs = spread(table(spark, sf_dir, "documents")).select(F.col("doc_id").alias("id"), "text")
    retrieval.text_index(docs).write.parquet(path)
    return spark.read.parquet(path)


def bm25_sql(k: int) -> str:
    return rf"""
qt AS (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) AS term FROM benchmark),
dt AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) AS term FROM documents),
dl AS (SELECT doc_id AS id, len(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) AS length FROM documents),
st AS (SELECT count(*) AS n, avg(length) AS mean FROM dl),
tf AS (SELECT id, term, count(*) AS tf FROM dt WHERE term IN (SELECT term FROM qt) GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
sc AS (SELECT query_id, id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))) AS score
  FROM qt JOIN tf USING (term) JOIN df USING (term) JOIN dl USING (id), st GROUP BY 1, 2),
bm AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM sc
  QUALIFY rank <= {k})"""


@register("WITH " + bm25_sql(10) + " SELECT query_id, id, round(score, 6) AS score, CAST(rank AS BIGINT) AS rank FROM bm")
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = retrieval.bm25_topk(text_queries(spark, sf_dir), saved_index(spark, sf_dir))
    return found.select("query_id", "id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@register(
    """WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
q AS (SELECT label, list(m ORDER BY i) AS v FROM (SELECT label, i, avg(x) AS m FROM e GROUP BY 1, 2) GROUP BY 1),
s AS (SELECT q.label AS query_id, vec_id AS id, list_cosine_similarity(v, embedding::DOUBLE[]) AS score FROM q, embeddings)
SELECT query_id, id, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS BIGINT) AS rank
FROM s QUALIFY rank <= 10"""
)
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest vectors of each label's centroid."""
    vectors = table(spark, sf_dir, "embeddings")
    parts = vectors.select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "m")))  # one entry per dimension
    centroids = means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(ordered, lambda e: e["m"]).alias("vector")
    )
    corpus = vectors.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = retrieval.vector_topk(centroids, corpus)
    return found.select("query_id", "id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@register(
    "WITH "
    + bm25_sql(50)
    + """, qv AS (SELECT item_id AS query_id, embedding::DOUBLE[] AS v FROM benchmark JOIN embeddings ON vec_id = item_id),
vs AS (SELECT query_id, vec_id AS id, list_cosine_similarity(v, embedding::DOUBLE[]) AS score FROM qv, embeddings),
vm AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM vs QUALIFY rank <= 50),
u AS (SELECT query_id, id, rank FROM bm UNION ALL SELECT query_id, id, rank FROM vm),
fu AS (SELECT query_id, id, sum(1.0::DOUBLE / (60 + rank)) AS score FROM u GROUP BY 1, 2)
SELECT query_id, id, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS BIGINT) AS rank
FROM fu QUALIFY rank <= 10"""
)
def hybrid_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as queries, each with the vector of its number; documents carry theirs the same way."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    queries = text_queries(spark, sf_dir).join(
        vectors.withColumnRenamed("id", "query_id"), "query_id", "left"
    )
    found = retrieval.hybrid_topk(queries, saved_index(spark, sf_dir), vectors)
    return found.select("query_id", "id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


def kept_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten candidates per query by text, four kept by a given relevance score."""
    found = retrieval.bm25_topk(text_queries(spark, sf_dir), saved_index(spark, sf_dir), retrieval.CANDIDATES)
    # written first, so that Spark knows the size of the candidates and need not shuffle all texts for a few
    path = work_path(spark, "candidates")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source", "text", "n_chars")
    scored = found.drop("score").join(docs, "id").withColumn("relevance", (F.col("n_chars") % 10) / F.lit(10.0))
    return retrieval.rerank(scored, "relevance", retrieval.KEPT)


KEPT_SQL = (
    "WITH "
    + bm25_sql(10)
    + """, cd AS (SELECT query_id, id, rank AS before, source, text, (n_chars % 10) / 10.0 AS relevance FROM bm JOIN documents ON doc_id = id),
kp AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC, before) AS rank FROM cd QUALIFY rank <= 4)
"""
)


@register(KEPT_SQL + "SELECT query_id, id, CAST(relevance AS DOUBLE) AS relevance, CAST(rank AS BIGINT) AS rank FROM kp")
def search_and_rerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_documents(spark, sf_dir).select("query_id", "id", "relevance", F.col("rank").cast("long").alias("rank"))


@register(
    KEPT_SQL
    + "SELECT query_id, string_agg('[' || source || '] ' || text, chr(10) || chr(10) ORDER BY rank) AS context FROM kp GROUP BY 1"
)
def context_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.context_text(kept_documents(spark, sf_dir), "source", "text")


@register(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE 'T' || user_id END || ' anomaly_score=' || CAST(value AS VARCHAR) AS query_text
FROM events"""
)
def outlier_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticker = F.when(F.col("event_type") != "error", F.concat(F.lit("T"), "user_id"))
    return table(spark, sf_dir, "events").select(
        "event_id", gates.outlier_query(ticker, F.col("value")).alias("query_text")
    )


def gate_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents as drafts with derived scores; one without labels has none and fails the gate."""
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    drafts = labelled.select(
        F.concat(F.lit("i"), "doc_id").alias("insight_id"),
        F.col("text").alias("draft"),
        F.lit(4).alias("documents"),
        (F.lit(0.5) + F.col("quality") * 0.25 + (F.col("n_chars") % 5) / 10.0).alias("faithfulness"),
        (F.lit(0.75) - F.col("toxic") * 0.25).alias("answer_relevancy"),
    )
    return healing.score_gate(drafts, moment(MONTH_END))


GATE_SQL = """
WITH g AS (SELECT 'i' || doc_id AS insight_id, text, CAST(0.5 + quality * 0.25 + (n_chars % 5) / 10.0 AS DOUBLE) AS f,
  CAST(0.75 - toxic * 0.25 AS DOUBLE) AS r FROM documents LEFT JOIN labels USING (doc_id))
"""


@register(
    GATE_SQL
    + """SELECT 'pipelines/rag/reports/' || insight_id || '-20240131T000000.md' AS target_file,
  printf('Report on outlier %s from 4 document(s). faithfulness=%.2f, answer_relevancy=%.2f (floors: 0.7/0.7).', insight_id, f, r) AS explanation,
  text AS diff FROM g WHERE f >= 0.7 AND r >= 0.7"""
)
def gated_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queued content events, read back through the feed's routing."""
    queued, _ = gate_split(spark, sf_dir)
    prepared, _ = healing.route(healing.execution_failures(queued))
    return prepared.select("target_file", "explanation", "diff")


@register(GATE_SQL + "SELECT 'low_ragas_score' AS rejection_reason, text AS proposed_diff FROM g WHERE NOT coalesce(f >= 0.7 AND r >= 0.7, false)")
def gate_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = gate_split(spark, sf_dir)
    return rejected.select("rejection_reason", "proposed_diff")


# One more rule than the fixed ones: the sample texts hold secrets of this shape.
RULES = (*DANGEROUS_PATTERNS, (r"token\s*=\s*['\"][^'\"]+['\"]", True))

PROPOSALS_SQL = """
WITH p AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'pipelines/rag/' || source || '.md' WHEN 1 THEN 'pipelines/rag/../' || source
    WHEN 2 THEN '/' || source WHEN 3 THEN 'docs/' || source WHEN 4 THEN './pipelines//finops/' || source WHEN 5 THEN 'pipelines\\' || source
    ELSE 'pipelines/ingestion/dags/' || source END AS target_file,
  text || CASE doc_id % 11 WHEN 0 THEN ' os.system(x)' WHEN 1 THEN ' drop  table t' WHEN 2 THEN ' eval(x)' WHEN 3 THEN ' medieval(x)'
    WHEN 4 THEN ' delete from t ;' WHEN 5 THEN ' API-KEY = ''abc''' WHEN 6 THEN ' subprocess.run' ELSE '' END AS diff FROM documents)
"""


def proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as proposed changes: paths and endings by document number."""
    n, source = F.col("doc_id"), F.col("source")
    path = (
        F.when(n % 7 == 0, F.concat(F.lit("pipelines/rag/"), source, F.lit(".md")))
        .when(n % 7 == 1, F.concat(F.lit("pipelines/rag/../"), source))
        .when(n % 7 == 2, F.concat(F.lit("/"), source))
        .when(n % 7 == 3, F.concat(F.lit("docs/"), source))
        .when(n % 7 == 4, F.concat(F.lit("./pipelines//finops/"), source))
        .when(n % 7 == 5, F.concat(F.lit("pipelines\\"), source))
        .otherwise(F.concat(F.lit("pipelines/ingestion/dags/"), source))
    )
    endings = {
        0: " os.system(x)", 1: " drop  table t", 2: " eval(x)", 3: " medieval(x)",
        4: " delete from t ;", 5: " API-KEY = 'abc'", 6: " subprocess.run",
    }
    ending = F.lit("")
    for remainder, text in endings.items():
        ending = F.when(n % 11 == remainder, text).otherwise(ending)
    return spread(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.concat(F.lit("e"), "doc_id").alias("event_id"),
        F.lit("contract").alias("source_failure_type"),
        path.alias("target_file"),
        F.concat("text", ending).alias("diff"),
    )


def _pattern_sql(pattern: str, fold: bool) -> str:
    text = pattern.replace("'", "''")
    return f"WHEN regexp_matches(diff, '{'(?i)' if fold else ''}{text}') THEN 'dangerous_pattern:{text}'"


@register(
    PROPOSALS_SQL
    + r"""SELECT doc_id, CASE WHEN target_file LIKE '%\%' OR target_file LIKE '/%' OR target_file LIKE '%..%' THEN 'invalid_path:' || target_file
  WHEN target_file LIKE 'docs%' THEN 'out_of_scope_path:' || target_file """
    + " ".join(_pattern_sql(p, fold) for p, fold in RULES)
    + " END AS rejection_reason FROM p"
)
def guardrail_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = healing.apply_guardrails(proposals(spark, sf_dir), patterns=RULES)
    return judged.select("doc_id", "rejection_reason")


FEED_SQL = (
    CHECKED_SQL
    + f""", d AS (SELECT 'dlq-b3_quotes-' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS event_id, 'contract' AS source_failure_type,
  'b3_quotes' AS source, reason AS detail, 'contracts/b3_quotes.contract.yaml' AS code_context,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS detected_at FROM q WHERE reason IS NOT NULL AND ts > TIMESTAMP '{MIDPOINT}'),
x AS (SELECT 'ev' || event_id, 'execution', 'u' || user_id, 'value=' || CAST(value AS VARCHAR), '', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00')
  FROM events WHERE event_type = 'error' AND ts > TIMESTAMP '{MIDPOINT}')
"""
)


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refused quotes and error events since the cursor."""
    since = moment(MIDPOINT)
    refused = checked_quotes(spark, sf_dir).where(F.col(contracts.REASON).isNotNull())
    dlq = refused.select(F.lit("b3_quotes").alias("source"), contracts.REASON, F.col("ts").alias("detected_at"))
    log = table(spark, sf_dir, "events").where("event_type = 'error'").select(
        F.concat(F.lit("ev"), "event_id").alias("event_id"),
        F.lit("execution").alias("source_failure_type"),
        F.concat(F.lit("u"), "user_id").alias("source"),
        F.concat(F.lit("value="), "value").alias("detail"),
        F.col("ts").alias("detected_at"),
    )
    return healing.failure_feed(incremental(dlq, "detected_at", since), incremental(log, "detected_at", since))


@register(FEED_SQL + "SELECT * FROM d UNION ALL SELECT * FROM x")
def failure_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir)


@register(
    """SELECT conv_id, turn, role, '[REDACTED]' AS api_key,
  regexp_replace(text || ' Bearer abc.' || conv_id || '/x=', '(?i)Bearer\\s+[A-Za-z0-9._~+/=-]+', 'Bearer [REDACTED]', 'g') AS note,
  '[REDACTED]' AS email, regexp_replace('bearer  ' || role || ' ' || text, '(?i)Bearer\\s+[A-Za-z0-9._~+/=-]+', 'Bearer [REDACTED]', 'g') AS inner_note
FROM conversations""".replace("\\\\", "\\")
)
def redacted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with bearer values and nested sensitive fields, masked by schema."""
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role",
        F.col("text").alias("api_key"),
        F.concat("text", F.lit(" Bearer abc."), "conv_id", F.lit("/x=")).alias("note"),
        F.struct(
            F.col("text").alias("user_email"), F.concat(F.lit("bearer  "), "role", F.lit(" "), "text").alias("note")
        ).alias("inner"),
    )
    return redact_columns(rows).select(
        "conv_id", "turn", "role", "api_key", "note",
        F.col("inner.user_email").alias("email"), F.col("inner.note").alias("inner_note"),
    )


@register(
    """SELECT page_id, '[REDACTED]' AS secret, regexp_replace('Bearer t' || page_id || ' ' || html, '(?i)Bearer\\s+[A-Za-z0-9._~+/=-]+', 'Bearer [REDACTED]', 'g') AS body,
  url AS nested_url FROM pages""".replace("\\\\", "\\")
)
def redacted_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as JSON of unknown shape, masked as text and read back."""
    body = F.concat(F.lit("Bearer t"), "page_id", F.lit(" "), "html")
    document = F.struct(
        F.struct(F.col("html").alias("x")).alias("client_secret"),
        F.array(F.struct(body.alias("body")), F.struct(F.col("url").alias("body"))).alias("items"),
    )
    masked = table(spark, sf_dir, "pages").select("page_id", redact_json(F.to_json(document)).alias("j"))
    return masked.select(
        "page_id",
        F.get_json_object("j", "$.client_secret").alias("secret"),
        F.get_json_object("j", "$.items[0].body").alias("body"),
        F.get_json_object("j", "$.items[1].body").alias("nested_url"),
    )
