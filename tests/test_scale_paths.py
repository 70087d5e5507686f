"""The paths taken for large groups and large tables give the same results as the small ones."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from listingguard.config import LabelRules
from listingguard.operators import labelling as lab
from listingguard.operators import retrieval
from listingguard.operators.lookup import left_lookup
from listingguard.operators.ordered import exact_quantiles, group_quantiles, running_totals, smallest_by_hash, split_quantiles, value_bucket
from listingguard.operators.splits import _spread, group_folds
from listingguard.plans import catalog
from listingguard.sources.stage import materialize


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, another is constant, one is tiny; negative, zero and fractional values."""
    rng = np.random.default_rng(1)
    rows = [("hot", float(v)) for v in rng.normal(0, 50, 3000).round(2)]
    rows += [("flat", 5.0)] * 200 + [("tiny", -1.5), ("tiny", 2.5)] + [("empty", None)]
    rows += [(None, 1.0)] * 10
    return pd.DataFrame(rows, columns=["g", "v"])


def test_split_quantiles_match_numpy(spark, skewed):
    df = spark.createDataFrame(skewed.astype({"v": object}).where(skewed.notna(), None), "g string, v double")
    probs = {"a": 0.0, "b": 0.03, "c": 0.5, "d": 0.99, "e": 1.0}
    got = {r["g"]: r for r in split_quantiles(df, ["g"], "v", probs).collect()}
    limited = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", probs, group_limit=100).collect()}
    direct = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    assert set(got) == set(limited) == set(direct) == {"hot", "flat", "tiny"}
    for g, values in skewed.dropna().groupby("g")["v"]:
        for name, q in probs.items():
            want = np.quantile(values, q)
            for rows in (got, limited, direct):
                assert rows[g][name] == pytest.approx(want, abs=1e-9)
        assert got[g]["n"] == direct[g]["n"] == len(values)


def test_group_quantiles_paths_agree(spark, skewed):
    df = spark.createDataFrame(skewed.astype({"v": object}).where(skewed.notna(), None), "g string, v double")
    df = df.withColumn("w", F.col("v") * 2)
    wanted = {"mid": ("v", 0.5), "low": ("w", 0.03)}
    extra = [F.count("v").alias("n"), F.max("v").alias("top")]
    a, b = (group_quantiles(df, ["g"], wanted, extra, limit).orderBy("g").collect() for limit in (10**6, 10))
    assert len(a) == len(b) == 4
    for x, y in zip(a, b):
        assert x["g"] == y["g"] and x["n"] == y["n"] and x["top"] == y["top"]
        assert x["mid"] == pytest.approx(y["mid"]) and x["low"] == pytest.approx(y["low"])


def test_buckets_keep_order(spark):
    values = sorted([0.0, 1e-9, 0.5, 1.0, 1.0000001, 3.7, 99.0, 1e6, 2147483600.0, -0.2, -7.0, -1e9])
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", value_bucket("v").alias("b")).orderBy("v")
    buckets = [r["b"] for r in df.collect()]
    assert buckets == sorted(buckets)


def test_running_totals_match_pandas(spark, skewed):
    clean = skewed.dropna()
    counts = clean.groupby(["g", "v"]).size().reset_index(name="n")
    got = running_totals(spark.createDataFrame(counts), ["g"], "v", ["n"]).toPandas().sort_values(["g", "v"])
    want = counts.sort_values(["g", "v"])
    before = want.groupby("g")["n"].cumsum() - want["n"]
    assert got["before_n"].tolist() == before.tolist()


def test_smallest_by_hash_takes_exactly_the_smallest(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y"), F.md5(F.col("id").cast("string")).alias("h"))
    got = smallest_by_hash(df, "y", "h", F.floor(F.col("total_n") * 0.3)).toPandas()
    for y, part in got.groupby("y"):
        k = int(len(part) * 0.3)
        assert sorted(part.loc[part["_taken"], "h"]) == sorted(part["h"])[:k]


@pytest.mark.parametrize("freq", [None, "n"])
def test_salted_lookup_equals_broadcast(spark, freq):
    big = spark.range(2000).select(
        F.col("id").cast("string").alias("listing_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
    )
    table = big.groupBy("k").agg(F.count("*").alias("n"), F.max("listing_id").alias("top")).where("k is not null and k <> 'k3'")
    table = materialize(table if freq else table.drop("n"), "lookup_test")
    small = left_lookup(big, table, ["k"], freq=freq).select("listing_id", "k", "top").toPandas()
    large = left_lookup(big, table, ["k"], freq=freq, limit=1).select("listing_id", "k", "top").toPandas()
    order = ["listing_id"]
    pd.testing.assert_frame_equal(
        small.sort_values(order).reset_index(drop=True), large.sort_values(order).reset_index(drop=True)
    )


def test_group_folds_equal_the_greedy_rule(spark, sf_dir):
    rows = catalog.listings(spark, sf_dir)
    got = group_folds(rows).toPandas()
    assert got["city"].is_unique and got["group_size"].sum() == rows.count()
    loads = [0] * 5
    for size in sorted(got["group_size"], reverse=True):
        k = min(range(5), key=lambda i: loads[i])
        loads[k] += size
    assert sorted(got.groupby("fold")["group_size"].sum()) == sorted(loads)


def test_spread_bulk_equals_one_by_one():
    for loads, size, many in (([0, 0, 0], 4, 17), ([100, 3, 50], 2, 64), ([9, 9, 9, 1], 5, 11), ([0], 3, 5)):
        step, slow = list(loads), list(loads)
        given = _spread(step, size, many)
        for _ in range(many):
            slow[min(range(len(slow)), key=lambda i: slow[i])] += size
        assert sum(given) == many and sorted(step) == sorted(slow)


def test_retrieval_fills_and_falls_back(spark):
    docs = spark.createDataFrame(
        [(i, t, "s") for i, t in enumerate(["Alpha beta", "gamma", "alphabet soup", "delta", "café ÉTÉ", "x", "y", "z"])],
        "doc_id long, text string, source string",
    )
    queries = spark.createDataFrame(
        [(1, "the alpha soup"), (2, "what is the"), (3, "nothinghere"), (4, "café été a")], "q int, text string"
    )
    got = retrieval.retrieve(docs, queries, ["q"]).orderBy("q", "rank").collect()
    by_q = {q: [(r["doc_id"], r["score"], r["rank"]) for r in got if r["q"] == q] for q in (1, 2, 3, 4)}
    assert by_q[1] == [(2, 1.0, 1), (0, 0.5, 2), (1, 0.0, 3), (3, 0.0, 4)]
    assert by_q[2] == by_q[3] == [(i, 0.0, i + 1) for i in range(8)]
    assert by_q[4][0] == (4, 1.0, 1) and len(by_q[4]) == 4


def test_turns_before_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "TURN_CHUNK", 3)
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(11) if t not in (4, 5)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    got = {r["turn"]: r["history"] for r in retrieval.turns_before(df).collect()}
    turns = [r[1] for r in rows]
    for i, t in enumerate(turns):
        want = "".join(f"{'User' if p % 2 == 0 else 'Assistant'}: m{p}\n" for p in turns[max(0, i - 4) : i])
        assert got[t] == want


def test_hot_duplicate_key_and_zip(spark):
    """A third of the rows share one key; results equal a pandas transform."""
    n = 600
    rows = [
        (str(i), 100.0 + (i % 5 if i % 3 == 0 else 0), 3.0, 2.0, 1004.0 if i % 2 else 996.0, "hot" if i % 3 == 0 else f"z{i % 40}")
        for i in range(n)
    ] + [("a", 1.0, None, 2.0, 1000.0, "hot"), ("b", 2.0, 3.0, 2.0, 1000.0, None)]
    df = spark.createDataFrame(rows, "listing_id string, price double, bed double, bath double, house_size double, zip_code string")
    got = lab.flag_duplicates(df, LabelRules()).toPandas().set_index("listing_id")["rule_duplicate"]
    pdf = df.toPandas()
    pdf["s"] = (pdf["house_size"] / 10).round() * 10
    ok = pdf["zip_code"].map(pdf["zip_code"].value_counts()).ge(5)
    want = pdf[ok].groupby(["bed", "bath", "s", "zip_code"])["price"].transform("nunique").gt(1)
    want = want.reindex(pdf.index).eq(True).astype(int)
    want.index = pdf["listing_id"]
    assert got.sort_index().tolist() == want.sort_index().tolist()


def test_both_quantile_ways_agree_bitwise(spark):
    rng = np.random.default_rng(4)
    rows = [(f"g{g}", float(v)) for g in range(60) for v in np.exp(rng.normal(0, 2, 100))]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"a": 0.03, "b": 0.5, "c": 0.99, "d": 1 / 3}
    direct = {r["g"]: tuple(r) for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    split = {r["g"]: tuple(r) for r in exact_quantiles(df, ["g"], "v", probs, group_limit=10).collect()}
    assert direct == split


def test_a_full_bucket_is_cut_again(spark, monkeypatch):
    """Nine tenths of the distinct values lie in one bucket; no sorted piece exceeds the limit, and totals stay exact."""
    from listingguard.operators import ordered

    monkeypatch.setattr(ordered, "BUCKET_LIMIT", 500)
    near = [0.5 + i * 1e-9 for i in range(9000)]
    rest = [i / 1000 for i in range(1000)]
    df = spark.createDataFrame([("m", v, 1 + i % 3) for i, v in enumerate(sorted({*near, *rest}))], "g string, v double, n long")
    refined = ordered.refined_buckets(df, ["g"], "v")
    assert refined.groupBy("_bucket").count().agg(F.max("count")).first()[0] > 8000
    assert refined.groupBy("_bucket", "_sub").count().agg(F.max("count")).first()[0] <= 500
    got = running_totals(df, ["g"], "v", ["n"]).toPandas().sort_values("v")
    assert got["before_n"].tolist() == (got["n"].cumsum() - got["n"]).tolist()


@pytest.mark.parametrize("head", [2, 7])
def test_pruned_retrieval_equals_all_pairs(spark, head):
    """Best documents by the bar of a small head are those of the full pair scores, ties in corpus order."""
    rng = np.random.default_rng(9)
    words = [f"word{i}" for i in range(40)]
    share = 1 / (1 + np.arange(40))
    share = share / share.sum()
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words, 12, p=share))) for i in range(60)], "doc_id long, text string")
    queries = spark.createDataFrame([(q, " ".join(rng.choice([*words, "absent", "word"], 9))) for q in range(40)], "q long, text string")
    got = {(r["q"], r["rank"]): (r["doc_id"], r["score"]) for r in retrieval.best_scores(docs, queries, ["q"], 4, head).collect()}
    want = {}
    for q, part in retrieval.scores(docs, queries, ["q"]).toPandas().groupby("q"):
        best = part.sort_values(["score", "doc_id"], ascending=[False, True]).head(4)
        want |= {(q, i + 1): (d, s) for i, (d, s) in enumerate(zip(best["doc_id"], best["score"]))}
    assert got == want


def test_retrieval_from_a_stored_index(spark):
    """Short terms, terms inside tokens and terms of no document, all from one index that is built once, against plain loops."""
    rng = np.random.default_rng(3)
    pieces = ["ab", "a", "xyz", "abxyz", "qq7", "b", "yz", "deepab", "é1"]
    texts = [(i, " ".join(rng.choice(pieces, 4)) if i % 9 else None) for i in range(50)]
    asked = [(q, " ".join(rng.choice([*pieces, "x", "none", "z"], 5))) for q in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    queries = spark.createDataFrame(asked, "q long, text string")
    built = []

    def keep(name, build):
        built.append(name)
        return build()

    index = retrieval.build_index(docs, keep)
    want = {}
    for q, text in asked:
        terms = set(text.split()) - set(retrieval.STOP_WORDS)
        hits = [(d, sum(any(t in w for w in (body or "").split()) for t in terms)) for d, body in texts]
        best = sorted((h for h in hits if h[1]), key=lambda h: (-h[1], h[0]))[:4]
        want |= {(q, i + 1): d for i, (d, _) in enumerate(best)}
    for head in (4, 20):
        got = retrieval.best_scores(docs, queries, ["q"], 4, head, index)
        assert {(r["q"], r["rank"]): r["doc_id"] for r in got.collect()} == want
    assert built == ["index_documents", "index_postings", "index_grams"]
