"""Every operator and every stage on awkward rows and on empty tables; results against short plain versions."""

import random
import re
from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from listingguard.llm import decontaminate, katz, lengths, linespread, mixing, pivots, purisk, simhash, toxicity, warcstore
from listingguard.sources.stage import materialize
from tests.llm import data


def split(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_row(rows, value):
    return Counter(value(r) for r in rows)


def test_mixing(spark):
    rows = data.awkward()
    got = mixing.mix(data.docs(spark)).collect()
    assert by_row(got, lambda r: (r.doc_id, r.size)) == by_row(rows, lambda r: (r[0], len(split(r[1]))))
    total, taken, sizes, targets = sum(r.size for r in got), Counter(), Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        sizes[r.source] += r.size
        targets[r.source] = r.target
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    for s, t in targets.items():
        assert t <= 2 * sizes[s] + 1e-6 and abs(taken[s] - t) <= 1
    order = [*sorted(s for s in sizes if s is not None), None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, open_ = {}, set(order)
    while True:  # give by weight; those above their cap stop there and the rest shares again
        left = 1.5 * total - sum(want.values())
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not full:
            break
        want |= {s: 2 * sizes[s] for s in full}
        open_ -= full
    want |= {s: level * weight[s] for s in open_}
    assert targets == pytest.approx(want)
    assert Counter(got) == Counter(mixing.mix(data.docs(spark)).collect())


def test_buckets_of_a_source(spark, monkeypatch):
    """Many small buckets give the same mix as one."""
    whole = Counter(mixing.mix(data.docs(spark)).collect())
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 2)
    assert Counter(mixing.mix(data.docs(spark)).collect()) == whole


def test_lines(spark):
    rows = data.awkward()
    got = linespread.apply(data.docs(spark), min_sites=4)
    assert set(got.columns) == {"n_lines", "n_removed", *data.docs(spark).columns}
    places, first = defaultdict(set), {}
    for r in rows:
        for no, line in enumerate((r[1] or "").split("\n")):
            if len(split(line)) >= 3:
                places[line.strip(" ")] |= {r[3]} - {None}
                key = (r[0] is None, r[0] or 0, no)
                first[line.strip(" ")] = min(first.get(line.strip(" "), key), key)
    want = []
    for r in rows:
        kept = []
        for no, line in enumerate((r[1] or "").split("\n")):
            x = line.strip(" ")
            gone = len(split(line)) >= 3 and len(places[x]) >= 4 and first[x] != (r[0] is None, r[0] or 0, no)
            kept += [] if gone else [line]
        want.append((r[0], None if r[1] is None else "\n".join(kept)))
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(want)
    assert sum(r.n_removed for r in got.collect()) >= 12


def test_lines_near_threshold_are_exact(spark, monkeypatch):
    """With the whole range in the band, every decision is by the exact count."""
    sure = Counter((r.doc_id, r.text) for r in linespread.apply(data.docs(spark), min_sites=4).collect())
    monkeypatch.setattr(linespread, "BAND", 0.9)
    assert Counter((r.doc_id, r.text) for r in linespread.apply(data.docs(spark), min_sites=4).collect()) == sure


def plain_hits(rows, items, n=10):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for i, t in items:
        ws = split(t, pattern)
        k = min(n, len(ws))
        windows |= {("" if i is None else str(i), tuple(ws[a : a + k])) for a in range(len(ws) - k + 1) if k}
    out = []
    for r in rows:
        ws, hit, ids = split(r[1], pattern), set(), set()
        for i, w in windows:
            for a in range(len(ws) - len(w) + 1):
                if tuple(ws[a : a + len(w)]) == w:
                    hit |= set(range(a, a + len(w)))
                    ids.add(i)
        out.append((r[0], len(ws), len(hit), len(ids), bool(hit)))
    return Counter(out)


def test_decontamination(spark):
    rows = [r for r in data.awkward() if r[0] != 107]
    items = data.benchmark(spark)
    got = decontaminate.report(data.docs(spark, rows), items).collect()
    want = plain_hits(rows, [(r.item_id, r.text) for r in items.collect()])
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got) == want
    assert sum(r.contaminated for r in got) >= 4
    kept = decontaminate.clean(data.docs(spark, rows), items)
    assert kept.count() == sum(not r.contaminated for r in got) and kept.columns == data.docs(spark).columns


def test_overlapping_items_and_repeats(spark):
    """Items that overlap inside a text, repeat in it, and share windows."""
    ws = [f"w{i % 7}" for i in range(60)]
    rows = [(1, " ".join(ws), "", "", 0, 0.0, "", 0, 0), (2, " ".join(ws[3:14]) + " x " + " ".join(ws[:9]), "", "", 0, 0.0, "", 0, 0)]
    items = [(1, " ".join(ws[:25])), (2, " ".join(ws[5:16])), (3, "w1 w2"), (4, "x"), (5, "w0 w0")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.report(data.docs(spark, rows), table).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got) == plain_hits(rows, items)


def plain_near(rows, items, n=10, share=0.8, span=14):
    """(did, item) of every item window of which enough different words stand within a span of the document."""
    out = set()
    for i, text in items:
        ws = split(text, decontaminate.WORD)
        for at in range(max(1, len(ws) - n + 1) if ws else 0):
            asked = set(ws[at : at + n])
            need = -int(-round(len(asked) * share, 6) // 1)
            for did, doc in rows:
                words = split(doc, decontaminate.WORD)
                if any(len(asked & set(words[p : p + span])) >= need for p in range(len(words))):
                    out.add((did, "" if i is None else str(i)))
    return out


def test_proximity(spark):
    """Shifted, padded, reordered and scattered copies of parts of an item, and items and texts of all kinds, against brute force."""
    item = [f"t{i}" for i in range(30)]
    rows = [(s, " ".join(["z"] * 30 + item[s : s + 10] + ["z"] * 5)) for s in (0, 3, 5, 7, 10, 20)]
    rows += [(100 + s, " ".join(["z"] * s + item[s : s + 4] + ["pad", "t0"] + item[s + 4 : s + 9][::-1])) for s in range(0, 20, 3)]
    rows += [(200, " ".join(w + " z" * 40 for w in item)), (201, " ".join(w + " z" for w in item)), (202, None), (203, ""), (204, "t1 t2 T3"), (0, rows[0][1])]
    rnd = random.Random(5)
    rows += [(300 + i, " ".join(rnd.choice(item[:12] + ["z", "y"]) for _ in range(60))) for i in range(20)]
    items = [(1, " ".join(item)), (2, "t3 T1 t2"), (3, None), (4, ""), (None, "t5"), (5, "t1 t1 t2 t2 t7 t7 t7 t8 t8 t9 t11 t11"), (1, " ".join(item))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.near_matches(docs, table).collect()
    want = plain_near(rows, items)
    assert {(r.did, r.item_id) for r in found} == want
    assert {(s, "1") for s in (0, 3, 5, 7, 10, 20)} <= want and (200, "1") not in want
    near = Counter(did for did, _ in want)
    got = decontaminate.report(docs, table, near=True).collect()
    assert all(r.n_near == near[r.doc_id] and r.n_near >= r.n_items for r in got) and len(got) == len(rows)
    assert decontaminate.near_matches(docs.limit(0), table).count() == 0 and decontaminate.near_matches(docs, table.limit(0)).count() == 0


def test_simhash_classes(spark):
    rows = data.awkward()
    got = simhash.classes(data.docs(spark)).collect()
    prints = {(r[0], r[1]): simhash.fingerprint(r[1]) for r in rows}
    group = {k: k for k in prints}
    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = group[a], group[b]
                group = {k: x if v == y else v for k, v in group.items()}
    least = defaultdict(list)
    for k, g in group.items():
        least[g] += [k[0]] if k[0] is not None else []
    want = Counter((r[0], prints[r[0], r[1]], min(least[group[r[0], r[1]]], default=None)) for r in rows)
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == want
    kept = simhash.dedup(data.docs(spark))
    assert kept.columns == data.docs(spark).columns
    assert kept.count() == len({group[k] for k in group})


def test_lengths(spark):
    rows = data.awkward()
    with open(lengths.RANKS, "rb") as f:
        encode = lengths.encoder(f.read()).encode_ordinary
    sizes = [len(encode(r[1] or "")) for r in rows]
    table = lengths.report(data.docs(spark))
    got = table.collect()
    assert sorted(r.context for r in got) == sorted(set(sizes))
    for r in got:
        up = [x for x in sizes if x <= r.context]
        assert (r.docs, r.docs_up_to, r.tokens_up_to) == (sizes.count(r.context), len(up), sum(up))
        assert (r.docs_over, r.tokens_over) == (len(sizes) - len(up), sum(sizes) - sum(up))
        assert r.truncated_tokens == sum(min(x, r.context) for x in sizes)
    for limit in (0, 1, 33, 10**7):
        r = lengths.at_limit(table, limit).first()
        assert (r.docs_up_to, r.truncated_tokens) == (sum(x <= limit for x in sizes), sum(min(x, limit) for x in sizes))
    assert lengths.quantile(table, 0.5).first().length == sorted(sizes)[-(-len(sizes) // 2) - 1]


def test_classifiers_run_on_awkward_rows(spark):
    for model in (toxicity, purisk):
        got = model.score(data.docs(spark), data.labels(spark)).collect()
        assert by_row(got, lambda r: r.doc_id) == by_row(data.awkward(), lambda r: r[0])
        assert all(0 <= r.score <= 1 for r in got)
        same = {r.score for r in got if r.doc_id in (5, 105)}
        assert len(same) == 1  # equal texts, equal scores
    none = data.labels(spark).limit(0)
    assert {r.score for r in toxicity.score(data.docs(spark), none).collect()} == {0.0}
    assert {r.score for r in purisk.score(data.docs(spark), none).collect()} == {0.5}


def test_warc_round_trip(spark, tmp_path):
    long = "<p>payload é</p>" * 100
    rows = [(1, "http://a/", long), (2, "http://b/\r\nEvil: 1", long), (9, None, long), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "v", "short")]
    rows += [(9, None, long), (None, "n", long), (7, "w", "x" * 300_000)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, header string")
    warcstore.write(pages, str(tmp_path / "w"))
    back = warcstore.read(spark, str(tmp_path / "w")).collect()
    assert Counter((r.page_id, r.payload.decode()) for r in back) == Counter((r[0], r[2] or "") for r in rows)
    assert spark.read.parquet(str(tmp_path / "w/payloads")).count() == len({r[2] or "" for r in rows})
    said = {r.page_id: r for r in warcstore.summary(warcstore.read(spark, str(tmp_path / "w"))).collect()}
    assert {i: said[i].refers_to for i in said} == {1: 9, 2: 9, 9: None, 3: None, 4: None, 5: None, 6: None, None: 9, 7: None}
    assert said[1].record_type == "revisit" and said[9].record_type == "response" and said[1].payload_bytes == len(long.encode())
    for r in back:
        head, _, rest = r.record.partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert rest[:length] == (b"" if r.refers_to else r.payload) and rest[length:] == b"\r\n\r\n"
        assert b"Evil" not in head or b"\r\nEvil" not in head


def test_damaged_payload_is_found(spark, tmp_path):
    warcstore.write(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"), str(tmp_path / "w"))
    spark.read.parquet(str(tmp_path / "w/payloads")).selectExpr("address", "CAST('abd' AS BINARY) AS payload").write.parquet(str(tmp_path / "x/payloads"))
    spark.read.parquet(str(tmp_path / "w/records")).write.parquet(str(tmp_path / "x/records"))
    with pytest.raises(Exception, match="damaged payload"):
        warcstore.read(spark, str(tmp_path / "x")).collect()


def test_embeddings(spark):
    import math
    import random

    rnd = random.Random(5)
    rows = []
    for c in range(30):
        centre = [rnd.gauss(0, 1) for _ in range(16)]
        for _ in range(c % 5 + 1):
            rows.append([x + rnd.gauss(0, 0.05) for x in centre])
    rows += [rows[0], rows[0], [2 * x for x in rows[0]], [0.0] * 16, [float("nan")] * 16, None, [], [1.0, None] * 8, [1.0, 2.0], [math.inf] * 16]
    table = spark.createDataFrame([(i, r, "x") for i, r in enumerate(rows)], "vec_id long, embedding array<double>, node string")
    got = {r.vec_id: r for r in pivots.near_duplicates(table).collect()}
    assert len(got) == len(rows)

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))

    sound = {i: r for i, r in enumerate(rows) if r and len(r) == 16 and all(x is not None and math.isfinite(x) for x in r) and any(r)}
    for i in got:
        links = [j for j in sound if j != i and i in sound and cosine(sound[i], sound[j]) >= 0.9]
        assert got[i].n_links == len(links)
        assert got[i].component_id == min([i, *links]) and got[i].kept == (got[i].component_id == i)


def test_empty_tables(spark):
    none = data.docs(spark, [])
    assert mixing.mix(none).count() == linespread.apply(none).count() == simhash.classes(none).count() == lengths.report(none).count() == 0
    assert decontaminate.report(none, data.benchmark(spark)).count() == 0
    assert decontaminate.report(data.docs(spark), data.benchmark(spark).limit(0)).where("contaminated").count() == 0
    assert toxicity.score(none, data.labels(spark)).count() == purisk.score(none, data.labels(spark)).count() == 0
    assert katz.held_out_score(none).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert pivots.near_duplicates(vectors).count() == 0


def test_stages(spark, tmp_path):
    data.labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    data.benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (data.awkward(), []):
        data.docs(spark, rows).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert set(columns) <= set(out.columns)
            out.collect()
        done = corpus_pipeline.run(spark, str(tmp_path))
        assert done.count() <= len(rows)


def test_columns_with_the_names_of_helpers(spark, tmp_path):
    """Columns named as the operators' own helper columns stay, and the results are those without them."""
    data.labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    data.benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = materialize(data.docs(spark), "plain_docs")
    names = ["_llm_did", "_LLM_rid", "_llm_rid_", "_llm_gone", "_llm_taken"]
    clash = materialize(docs.withColumns({n: F.lit("kept") for n in names}), "clashing_docs")
    for _, stage in corpus_pipeline.STAGES:
        want, got = stage(spark, docs, str(tmp_path)), stage(spark, clash, str(tmp_path))
        assert set(names) <= set(got.columns) and all(r[n] == "kept" for r in got.collect() for n in names)
        rows = [Counter(tuple(map(str, r)) for r in df.select("doc_id", "text").collect()) for df in (want, got)]
        assert rows[0] == rows[1]
