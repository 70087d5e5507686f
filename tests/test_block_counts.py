"""Pairs of queries and documents are counted block by block: no job's rows grow with queries × documents unless they are asked for."""

import numpy as np
import pytest

from listingguard.operators import retrieval


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in (("BLOCK_DOCS", 16), ("BLOCK_QUERIES", 8), ("STEP_QUERIES", 3), ("FEW", 4), ("STEP_PAIRS", 10)):
        monkeypatch.setattr(retrieval, name, value)


def _tables(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(30)] + ["deepw1", "xw22x", "q"]
    texts = [(i * 1_000_003, " ".join(rng.choice(words, rng.integers(1, 15)))) for i in range(90)] + [(7, None), (8, "")]
    asked = [(q, " ".join(rng.choice([*words, "none", "w"], rng.integers(1, 8)))) for q in range(40)] + [(99, "the")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    return texts, asked, docs, spark.createDataFrame(asked, "q long, text string")


def _want(texts, asked):
    want = {}
    for q, text in asked:
        terms = set(text.split()) - set(retrieval.STOP_WORDS)
        for d, body in texts:
            n = sum(any(t in w for w in (body or "").split()) for t in terms)
            if n:
                want[q, d] = (n, round(n / len(terms) + 1e-12, 4))
    return want


def test_pairs_and_best_by_blocks(spark, small_blocks):
    texts, asked, docs, queries = _tables(spark)
    want = _want(texts, asked)
    got = {(r["q"], r["doc_id"]): r["score"] for r in retrieval.scores(docs, queries, ["q"]).collect()}
    assert got == pytest.approx({k: s for k, (_, s) in want.items()}, abs=1e-9)
    best = {}
    for q, _ in asked:
        hits = sorted(((-n, d) for (a, d), (n, _) in want.items() if a == q))[:3]
        best |= {(q, i + 1): d for i, (_, d) in enumerate(hits)}
    found = retrieval.best_scores(docs, queries, ["q"], 3)
    assert {(r["q"], r["rank"]): r["doc_id"] for r in found.collect()} == best


def test_pairs_are_not_shuffled(spark, small_blocks):
    """The counting joins terms with tokens, never queries with documents by term."""
    _, _, docs, queries = _tables(spark)
    plan = retrieval.scores(docs, queries, ["q"])._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("MapInArrow")]
    assert "Aggregate" not in above and "_m" in above


def test_a_query_of_many_terms_is_counted_in_full(spark):
    many = " ".join(f"z{i:03d}" for i in range(300))
    docs = spark.createDataFrame([(1, many), (2, "z001")], "doc_id long, text string")
    queries = spark.createDataFrame([(1, many), (2, "z001 none")], "q long, text string")
    got = {(r["q"], r["doc_id"]): r["score"] for r in retrieval.scores(docs, queries, ["q"]).collect()}
    assert got == {(1, 1): 1.0, (1, 2): 0.0033, (2, 1): 0.5, (2, 2): 0.5}


def test_documents_without_an_id_count_as_one(spark):
    docs = spark.createDataFrame([(None, "red"), (None, "blue"), (3, "red")], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "red blue")], "q long, text string")
    got = {r["doc_id"]: r["score"] for r in retrieval.scores(docs, queries, ["q"]).collect()}
    assert got == {None: 1.0, 3: 0.5}


def test_prompts_read_the_index_they_are_given(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "red stone", "a"), (2, "blue stone", "b")], "doc_id long, text string, source string")
    talk = spark.createDataFrame([(1, 0, "user", "stone"), (1, 1, "assistant", "which"), (1, 2, "user", "blue")], "conv_id long, turn int, role string, text string")
    index = retrieval.build_index(docs)
    monkeypatch.setattr(retrieval, "build_index", None)
    got = {r["turn"]: r["context"] for r in retrieval.prompt_context(docs, talk, index=index).collect()}
    assert got[2].startswith("\n[Source 1: b]\nblue stone") and got[0].startswith("\n[Source 1: a]\nred stone")


def test_a_repeated_key_counts_its_terms_for_each_query(spark):
    docs = spark.createDataFrame([(1, "red stone"), (2, "red"), (3, "blue")], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "red stone"), (1, "red stone"), (None, "blue"), (2, "blue")], "q long, text string")
    got = {(r["q"], r["rank"]): (r["doc_id"], r["score"]) for r in retrieval.best_scores(docs, queries, ["q"], 2).collect()}
    assert got == {(1, 1): (1, 2.0), (1, 2): (2, 1.0), (None, 1): (3, 1.0), (2, 1): (3, 1.0)}
