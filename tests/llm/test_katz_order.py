"""The registered Katz query looks at contexts longer than one word."""

from listingguard.llm import katz, queries


def test_registered_order_tells_longer_contexts_apart(spark, tmp_path):
    # after "x", "c" follows "a" and "d" follows "b": pairs of words cannot tell which comes next
    rows = [(i, ("a x c" if i % 2 else "b x d")) for i in range(60)] + [(1000 + i, "a x d" if i % 2 else "a x c") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").where("doc_id < 1000 OR doc_id % 2 = 0").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.doc_id, r.score) for r in queries.op4_katz(spark, str(tmp_path)).collect())
    assert got == sorted((r.doc_id, r.score) for r in katz.held_out_score(docs, 3).collect())
    assert got != sorted((r.doc_id, r.score) for r in katz.held_out_score(docs, 2).collect())
