"""Packed blocks are rows of megabytes: few of them are held by a writer or a reader at once."""

from pyspark.sql import functions as F

from listingguard.operators import retrieval as re_


def test_stored_blocks_come_in_small_row_groups(spark, monkeypatch):  # F17, F19, F27
    import pyarrow.dataset as ds

    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.format_string("alpha%d beta gamma%d", F.col("id") % 7, F.col("id") % 11).alias("text"))
    queries = spark.range(40).select(F.col("id").alias("k"), F.format_string("alpha%d gamma%d", F.col("id") % 7, F.col("id") % 5).alias("text"))
    index = re_.build_index(docs)
    want = re_.best_scores(docs, queries, ["k"], 3, index=index).collect()
    kept = []
    store = re_.materialize

    def noted(df, name, *args, **kw):
        out = store(df, name, *args, **kw)
        kept.extend([out] if name.endswith("_blocks") else [])
        return out

    monkeypatch.setattr(re_, "materialize", noted)
    monkeypatch.setattr(re_, "BLOCK_DOCS", 4)
    monkeypatch.setattr(re_, "BLOCK_QUERIES", 5)
    monkeypatch.setattr(re_, "fits_broadcast", lambda *a: False)
    got = re_.best_scores(docs, queries, ["k"], 3, index=re_.build_index(docs)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert len(kept) == 2
    for stored in kept:
        groups = [g.num_rows for f in stored.inputFiles() for part in ds.dataset(f.removeprefix("file://")).get_fragments() for g in part.row_groups]
        assert max(groups) <= re_.GROUP_BLOCKS
