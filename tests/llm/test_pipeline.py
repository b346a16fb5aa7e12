"""The corpus pipeline stage by stage and as a whole, against plain Python over a small table."""

import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from siltstone.llm import byte_bpe, chosen_path, toxicity
from siltstone.llm.queries import BYTE_RANKS

SF = "/root/testdata/sf0.01"
ODD = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "the same row, twice"), (10**6 + 2, "the same row, twice"), (10**6 + 3, "word " * 30_000)]


@pytest.fixture(scope="module")
def docs(spark):
    read = spark.read.parquet(f"{SF}/documents.parquet")
    more = spark.createDataFrame([(i, t, None, None, None) for i, t in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    return read.unionByName(more.select(*[more[c].cast(read.schema[c].dataType).alias(c) for c in read.columns])).repartition(4)


def near_copies(rows):
    """Rows whose id is not the least of their group of five-word sets linked at 0.8 or more."""
    sets = [set(chosen_path.shingles(t).tolist()) for _, t in rows]
    least = {i: i for i, _ in rows}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, (i, _) in enumerate(rows):
        for b in range(a):
            j = rows[b][0]
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((root(i), root(j)))
                least[high] = low
    return {i for i, _ in rows if root(i) != i}


def test_whole_chain(spark, docs):
    def rows(df):
        return sorted((r.doc_id, r.text or "") for r in df.collect())

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    toxic = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    expected = [r for r in rows(docs) if r[0] not in toxic]
    functions = dict(corpus_pipeline.STAGES)
    kept = functions["toxicity"](spark, docs, SF)
    assert rows(kept) == expected and toxic and kept.columns == docs.columns
    newest = {t: i for i, t in expected}
    expected = sorted({r for r in expected if newest[r[1]] == r[0]})
    kept = functions["exact_dedup"](spark, kept, SF)
    assert rows(kept) == expected and kept.columns == docs.columns
    assert expected.count((10**6 + 2, "the same row, twice")) == 1 and (10**6 + 1, "") in expected
    gone = near_copies(expected)
    expected = [r for r in expected if r[0] not in gone]
    kept = functions["jaccard_join"](spark, kept, SF)
    assert rows(kept) == expected and gone and kept.columns == docs.columns
    clean = [r for r in expected if not any(x in r[1] for x in items)]
    kept = functions["decontamination"](spark, kept, SF)
    expected = rows(kept)
    # every passage that stands in a text as it is goes; changed or cut ones may go as well
    assert set(expected) <= set(clean) and len(expected) >= 0.98 * len(clean) > 0 and kept.columns == docs.columns
    ranks = byte_bpe.load_ranks(public_tokenizers.path(BYTE_RANKS))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = {(r.doc_id, tuple(r.ids), r.n_tokens, r.decoded_sha256) for r in functions["byte_bpe"](spark, kept, SF).collect()}
    assert coded == {
        (i, tuple(ids), len(ids), hashlib.sha256(t.encode()).hexdigest()) for i, t in expected for ids in [library.encode_ordinary(t)]
    }


def test_texts_are_encoded_before_ids_are_decoded(spark, docs):
    coded = dict(corpus_pipeline.STAGES)["byte_bpe"](spark, docs, SF)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan  # else each core runs two workers at once


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, docs, name):
    assert dict(corpus_pipeline.STAGES)[name](spark, docs.where("false"), SF).count() == 0


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def left(df):
    return sorted((r.doc_id, r.text, r.source) for r in df.collect())


def test_copies_of_a_shared_id_go_without_its_other_text(spark):
    rows = [(1, "unique clean text", "a"), (1, "copy", "a"), (2, "copy", "b"), (2, "copy", "a"), (None, "copy", "c"), (3, None, "a"), (4, "", "a")]
    assert left(corpus_pipeline.drop_copies(spark, table(spark, rows), SF)) == [(1, "unique clean text", "a"), (2, "copy", "a"), (4, "", "a")]


def test_near_copies_of_a_shared_id_go_without_its_other_text(spark):
    words = [f"word{i}" for i in range(60)]
    near, other = " ".join(words), " ".join(["changed", *words[1:]])
    rows = [(1, near, "a"), (5, other, "a"), (5, "another text of five words or more", "a"), (7, other, "b")]
    assert left(corpus_pipeline.drop_near_copies(spark, table(spark, rows), SF)) == [(1, near, "a"), (5, "another text of five words or more", "a")]


def test_a_passage_goes_without_the_other_text_of_its_id(spark):
    item = max((r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()), key=len)
    rows = [(1, item, "a"), (1, "a clean text", "a"), (None, item, "a"), (None, None, "b")]
    kept = corpus_pipeline.drop_contaminated(spark, table(spark, rows), SF)
    assert {(r.doc_id, r.text, r.source) for r in kept.collect()} == {(1, "a clean text", "a"), (None, None, "b")}
