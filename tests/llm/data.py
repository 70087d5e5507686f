"""Small tables with every awkward row: nulls, empty and long texts, ties, repeats, clashing extra columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, did string, rid int, taken int"


def texts(n=40, seed=3):
    rnd = random.Random(seed)
    base = [f"{a}{b}" for a in ("ka", "ro", "ti", "mel", "sun", "dor") for b in ("n", "st", "ver", "lo", "ix")]
    return [" ".join(rnd.choice(base) for _ in range(rnd.randint(5, 60))).capitalize() + "." for _ in range(n)]


def awkward():
    t = texts()
    shared = "This line stands on very many sites today."
    rows = [(i, f"{x}\n{shared}" if i % 3 == 0 else x, "en", f"s{i % 11}", len(x)) for i, x in enumerate(t)]
    rows += [(100, None, None, None, None), (101, "", "en", "s1", 0), (102, " \n\t ", "en", None, 4), (103, "one", "xx", "", 3)]
    rows += [(104, "É É Ü ß " * 20, "de", "s1", 160), (105, t[5], "en", "s2", len(t[5])), (106, t[5].upper(), "en", "s3", len(t[5]))]
    rows += [rows[5], rows[5], (None, t[7], "en", "s4", 9), (None, "id is null here as well", None, "s4", 9)]
    rows += [(107, ("long word " * 30_000) + "x" * 50_000, "en", "s5", 1), (7, "another text under a used id", "en", "s6", 3)]
    return [(*r, 0.5, "d", 1, 9) for r in rows]


def docs(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, DOCS).repartition(5)


def labels(spark):
    rows = [(i, int(i % 4 != 0), int(i % 5 == 0)) for i in range(40)] + [(None, 1, 1), (3, None, None), (3, 0, 1), (999, 1, 0)]
    return spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, quality int, toxic int, text string")


def benchmark(spark):
    t = texts()
    rows = [(1, t[2]), (2, None), (3, ""), (4, "one"), (5, "É É"), (1, t[2]), (None, " ".join(t[9].split()[:12]))]
    return spark.createDataFrame([(*r, 1) for r in rows], "item_id long, text string, rid int")
