"""Check SQL for the registered queries, written for DuckDB on the raw tables."""

from __future__ import annotations

from listingguard.config import BASE_COLUMNS, CATEGORICAL, DEDUP_KEY, FOLD_DEPENDENT, LISTING_TYPES, NUMERIC, RULES, STATELESS
from listingguard.operators.explore import ERFC
from listingguard.operators.retrieval import STOP_WORDS
from listingguard.plans.catalog import FOLD_OUT, LINEAR_BETA, PREP_COLUMNS
from listingguard.sources.tables import LISTINGS_SQL, SCORED_SQL

_TABLES = ("lineitem", "orders", "customer", "nation", "part")


def rnd(x: str, digits: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,8)), {digits}) AS double)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS double) / nullif(CAST({b} AS double), 0))"


CTE: dict[str, str] = {
    "listings": LISTINGS_SQL.format(**{t: t for t in _TABLES}),
    "scored": SCORED_SQL.format(listings="listings"),
}


def _label_ctes(fit: str, batch: str, p: str = "") -> dict[str, str]:
    """Label CTEs: statistics of table ``fit`` applied to table ``batch``; names carry the prefix ``p``."""
    total = " + ".join(RULES)
    return {
        f"{p}clip": f"""
SELECT quantile_cont(nullif(price, 0), 0.99) AS price_clip, quantile_cont(nullif(house_size, 0), 0.99) AS size_clip,
  median(nullif(price, 0)) AS raw_median, median(house_size) AS size_median FROM {fit}""",
        f"{p}clipped": f"""
SELECT city, state, nullif(CASE WHEN price IS NOT NULL THEN least(price, price_clip) END, 0) AS price,
  CASE WHEN house_size > 0 THEN least(house_size, size_clip) END AS size FROM {fit}, {p}clip""",
        f"{p}city": f"""
SELECT city, median(price) AS city_median, stddev_samp(price) AS city_std, quantile_cont(price / size, 0.03) AS city_ppsf_low
FROM {p}clipped WHERE city IS NOT NULL GROUP BY city HAVING count(price) >= 30""",
        f"{p}state": f"SELECT state, median(price) AS state_median FROM {p}clipped GROUP BY state HAVING count(price) >= 10",
        f"{p}national": f"SELECT median(price) AS national_median FROM {p}clipped",
        f"{p}batch_size": f"SELECT greatest(median(house_size), 1) AS size_median FROM {batch}",
        f"{p}enriched": f"""
SELECT b.*, coalesce(c.city_median, national_median) AS city_median,
  coalesce(c.city_std, 0.3 * coalesce(c.city_median, national_median)) AS city_std,
  coalesce(c.city_ppsf_low, national_median / z.size_median) AS city_ppsf_low,
  coalesce(s.state_median, national_median) AS state_median,
  CASE WHEN price IS NOT NULL THEN least(price, price_clip) END AS sp,
  CASE WHEN house_size > 0 THEN least(house_size, size_clip) END AS ss,
  count(*) OVER (PARTITION BY zip_code) AS zip_n, round_even(house_size / 10, 0) * 10 AS size10
FROM {batch} b CROSS JOIN {p}clip CROSS JOIN {p}national CROSS JOIN {p}batch_size z
LEFT JOIN {p}city c ON b.city = c.city LEFT JOIN {p}state s ON b.state = s.state""",
        f"{p}ruled": f"""
SELECT *, CAST(CASE WHEN sp < 0.3 * city_median THEN 1 ELSE 0 END AS int) AS rule_price_low,
  CAST(CASE WHEN sp > 4.0 * city_median THEN 1 ELSE 0 END AS int) AS rule_price_high,
  CAST(CASE WHEN sp / ss < city_ppsf_low THEN 1 ELSE 0 END AS int) AS rule_price_per_sqft,
  CAST(CASE WHEN bed > 20 OR bath > 15 OR acre_lot > 1000 THEN 1 ELSE 0 END AS int) AS rule_impossible_dims,
  CAST(CASE WHEN house_size > 5000 AND price < 50000 THEN 1 ELSE 0 END AS int) AS rule_size_disconnect,
  CAST(CASE WHEN bed IS NOT NULL AND bath IS NOT NULL AND size10 IS NOT NULL AND zip_code IS NOT NULL AND zip_n >= 5
    AND min(price) OVER k < max(price) OVER k THEN 1 ELSE 0 END AS int) AS rule_duplicate,
  CAST(CASE WHEN sp < 0.15 * state_median OR sp > 8.0 * state_median THEN 1 ELSE 0 END AS int) AS rule_state_anomaly
FROM {p}enriched WINDOW k AS (PARTITION BY bed, bath, size10, zip_code)""",
        f"{p}labeled": f"""
SELECT {', '.join(LISTING_TYPES)}, {', '.join(RULES)}, CAST({total} AS int) AS fraud_score,
  CAST(CASE WHEN {total} >= 2 THEN 1 ELSE 0 END AS int) AS is_fraud FROM {p}ruled""",
    }


CTE.update(_label_ctes("listings", "listings"))
_TEST = "substr(md5(concat_ws('|', listing_id, 'holdout')), 1, 1) IN ('0', '1', '2')"
CTE["fit_rows"] = f"SELECT * FROM listings WHERE NOT {_TEST}"
CTE["test_rows"] = f"SELECT * FROM listings WHERE {_TEST}"
CTE.update(_label_ctes("fit_rows", "test_rows", "h_"))
CTE["logs"] = """
SELECT l.listing_id AS id, CAST(coalesce(try_cast(prev_sold_date AS date), DATE '2024-01-01') AS timestamp) AS created_at,
  price, bed, bath, acre_lot, house_size, city, state, zip_code, status, p_a AS fraud_score, p_a >= 0.7 AS is_suspicious,
  CASE WHEN p_a >= 0.7 THEN 'HIGH' WHEN p_a >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier, '1.1.0' AS model_version,
  CAST(round(CAST(20 + 400 * p_b AS DECIMAL(38,8)), 2) AS double) AS latency_ms,
  substr(sha256(concat('key-', CAST(CAST(brokered_by AS int) AS string))), 1, 16) AS api_key_hash
FROM listings l JOIN scored s ON l.listing_id = s.listing_id"""
CTE["melted"] = "UNPIVOT (SELECT price, bed, bath, acre_lot, house_size FROM listings) ON COLUMNS(*) INTO NAME feature VALUE v"
CTE["lab_melted"] = (
    "UNPIVOT (SELECT is_fraud, price, bed, bath, acre_lot, house_size FROM labeled) "
    "ON COLUMNS(* EXCLUDE (is_fraud)) INTO NAME feature VALUE v"
)
CTE["ppsf_rows"] = "SELECT *, CASE WHEN house_size > 0 THEN price / house_size END AS ppsf FROM labeled"
CTE["ppsf_cut"] = "SELECT quantile_cont(ppsf, 0.01) AS lo, quantile_cont(ppsf, 0.99) AS hi FROM ppsf_rows"
CTE["ppsf_band"] = "SELECT p.* FROM ppsf_rows p, ppsf_cut WHERE ppsf >= lo AND ppsf <= hi"
CTE["long_scores"] = "SELECT 'p_a' AS model, y_true AS y, p_a AS p, fold FROM scored UNION ALL SELECT 'p_b', y_true, p_b, fold FROM scored"


def _curve(source: str, key: str) -> str:
    return f"""
SELECT {key}, p, n, pos, sum(pos) OVER ge AS tp, sum(n) OVER ge AS pred, sum(pos) OVER (PARTITION BY {key}) AS p_all,
  sum(n) OVER (PARTITION BY {key}) AS n_all
FROM (SELECT {key}, p, count(*) AS n, sum(y) AS pos FROM {source} GROUP BY {key}, p)
WINDOW ge AS (PARTITION BY {key} ORDER BY p DESC ROWS UNBOUNDED PRECEDING)"""


def _areas(source: str, key: str) -> str:
    return f"""
SELECT {key}, sum(CAST(pos AS double) / p_all * tp / pred) AS pr_auc,
  sum(CAST(n - pos AS double) * (tp - pos / 2.0)) / max(CAST(p_all AS double) * (n_all - p_all)) AS roc_auc,
  coalesce(max(CASE WHEN CAST(tp AS double) / pred >= 0.95 THEN CAST(tp AS double) / p_all END), 0) AS r95,
  coalesce(max(CASE WHEN CAST(tp AS double) / pred >= 0.90 THEN CAST(tp AS double) / p_all END), 0) AS r90
FROM {source} GROUP BY {key}"""


CTE["curve"] = _curve("long_scores", "model")
CTE["areas"] = _areas("curve", "model")
CTE["fold_curve"] = _curve("long_scores", "model, fold")
CTE["fold_areas"] = _areas("fold_curve", "model, fold")
_T7 = "(VALUES (0.3), (0.4), (0.5), (0.6), (0.7), (0.8), (0.9)) t(threshold)"
CTE["confusion"] = f"""
SELECT model, CAST(threshold AS double) AS threshold, count(*) AS n,
  sum(CASE WHEN p >= CAST(threshold AS double) AND y = 1 THEN 1 ELSE 0 END) AS tp,
  sum(CASE WHEN p >= CAST(threshold AS double) AND y = 0 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN p < CAST(threshold AS double) AND y = 1 THEN 1 ELSE 0 END) AS fn,
  sum(CASE WHEN p < CAST(threshold AS double) AND y = 0 THEN 1 ELSE 0 END) AS tn
FROM long_scores, {_T7} GROUP BY model, threshold"""
_P = "coalesce(CAST(tp AS double) / nullif(tp + fp, 0), 0)"
_R = "coalesce(CAST(tp AS double) / nullif(tp + fn, 0), 0)"
_F1 = "coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)"

# Feature CTEs.
CTE["stateless"] = """
SELECT * REPLACE (CAST(listing_id AS string) AS listing_id),
  ln(1 + greatest(coalesce(price, 0), 0)) AS price_log, ln(1 + greatest(coalesce(house_size, 0), 0)) AS house_size_log,
  ln(1 + greatest(coalesce(acre_lot, 0), 0)) AS acre_lot_log,
  CASE WHEN house_size > 0 THEN greatest(coalesce(price, 0), 0) / house_size END AS price_per_sqft,
  CASE WHEN bed > 0 THEN coalesce(bath, 0) / bed ELSE 0.0 END AS bath_per_bed,
  CAST(CASE WHEN house_size > 3000 THEN 1 ELSE 0 END AS int) AS is_large_property,
  CAST(CASE WHEN sold IS NULL THEN 9999 ELSE greatest(date_diff('day', sold, DATE '2024-01-01'), 0) END AS int) AS days_since_last_sale,
  CAST(coalesce(year(sold), 0) AS int) AS sold_year, CAST(coalesce(month(sold), 0) AS int) AS sold_month
FROM (SELECT *, try_cast(prev_sold_date AS date) AS sold FROM labeled)"""


def _fold_ctes(fit: str, batch: str, p: str = "") -> dict[str, str]:
    return {
        f"{p}f_city": f"""
SELECT city, median(price) AS city_median_price, avg(CAST(is_fraud AS double)) AS city_fraud_rate FROM {fit}
WHERE city IS NOT NULL GROUP BY city HAVING count(price) >= 30""",
        f"{p}f_state": f"SELECT state, median(price) AS state_median_price FROM {fit} GROUP BY state HAVING count(price) >= 10",
        f"{p}f_zip": f"SELECT zip_code, count(*) AS n FROM {fit} WHERE zip_code IS NOT NULL GROUP BY zip_code",
        f"{p}f_fall": f"""
SELECT (SELECT median(city_median_price) FROM {p}f_city) AS cm, (SELECT avg(city_fraud_rate) FROM {p}f_city) AS cr,
  (SELECT median(state_median_price) FROM {p}f_state) AS sm""",
        f"{p}folded": f"""
SELECT b.*, coalesce(c.city_median_price, cm) AS city_median_price,
  CASE WHEN coalesce(c.city_median_price, cm) > 0 THEN b.price / coalesce(c.city_median_price, cm) ELSE 1.0 END AS price_vs_city_median,
  coalesce(s.state_median_price, sm) AS state_median_price, coalesce(z.n, 0) AS zip_listing_count,
  coalesce(c.city_fraud_rate, cr) AS city_fraud_rate
FROM {batch} b CROSS JOIN {p}f_fall LEFT JOIN {p}f_city c ON b.city = c.city LEFT JOIN {p}f_state s ON b.state = s.state
LEFT JOIN {p}f_zip z ON b.zip_code = z.zip_code""",
    }


CTE.update(_fold_ctes("labeled", "stateless"))
CTE["lab_fit"] = f"SELECT * FROM labeled WHERE NOT {_TEST}"
CTE["lab_test"] = f"SELECT * FROM labeled WHERE {_TEST}"
CTE.update(_fold_ctes("lab_fit", "lab_test", "t_"))
_NUM19 = [*NUMERIC, *STATELESS, *FOLD_DEPENDENT]
CTE["full_medians"] = "SELECT " + ", ".join(f"median(CAST({c} AS double)) AS med_{c}" for c in _NUM19) + " FROM folded"
CTE["full_filled"] = (
    "SELECT listing_id, status, state, "
    + ", ".join(f"coalesce(CAST({c} AS double), med_{c}) AS {c}" for c in _NUM19)
    + " FROM folded, full_medians"
)
CTE["full_moments"] = (
    "SELECT " + ", ".join(f"avg({c}) AS mean_{c}, stddev_pop({c}) AS std_{c}" for c in _NUM19) + " FROM full_filled"
)
CTE["prep_medians"] = "SELECT " + ", ".join(f"median(CAST({c} AS double)) AS med_{c}" for c in PREP_COLUMNS) + " FROM stateless"
CTE["prep_filled"] = (
    "SELECT listing_id, " + ", ".join(f"coalesce(CAST({c} AS double), med_{c}) AS {c}" for c in PREP_COLUMNS) + " FROM stateless, prep_medians"
)
CTE["prep_moments"] = (
    "SELECT " + ", ".join(f"avg({c}) AS mean_{c}, stddev_pop({c}) AS std_{c}" for c in PREP_COLUMNS) + " FROM prep_filled"
)
CTE["beta"] = "SELECT * FROM (VALUES " + ", ".join(f"('{k}', CAST({v} AS double))" for k, v in LINEAR_BETA.items()) + ") t(feature, b)"
CTE["lin_long"] = (
    "UNPIVOT (SELECT listing_id, is_fraud, "
    + ", ".join(f"CAST({c} AS double) AS {c}" for c in LINEAR_BETA)
    + " FROM stateless) ON COLUMNS(* EXCLUDE (listing_id, is_fraud)) INTO NAME feature VALUE v"
)
CTE["lin_stats"] = "SELECT feature, avg(v) AS m, CASE WHEN stddev_pop(v) > 0 THEN stddev_pop(v) ELSE 1 END AS s FROM lin_long GROUP BY feature"
CTE["lin"] = (
    "SELECT l.listing_id, l.is_fraud, l.feature, l.v AS value, b.b * (l.v - s.m) / s.s AS impact "
    "FROM lin_long l JOIN lin_stats s ON l.feature = s.feature JOIN beta b ON l.feature = b.feature"
)
CTE["lin_ranked"] = (
    f"SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY floor(abs(impact) * 1e6 + 0.5) DESC, feature) AS rank FROM lin"
)
CTE["lin_total"] = f"SELECT listing_id, is_fraud, {rnd('sum(impact)', 6)} AS total FROM lin GROUP BY listing_id, is_fraud"
_TOP = f"""CAST(rank AS int) AS rank, feature, {rnd('impact', 4)} AS impact, {rnd('value', 4)} AS value,
  CASE WHEN {rnd('impact', 4)} > 0 THEN 'fraud' ELSE 'normal' END AS direction,
  {rnd(f"least(abs({rnd('impact', 4)}) / 2, 1.0)", 4)} AS bar"""

# Drift CTEs.
CTE["dated"] = "SELECT *, try_cast(prev_sold_date AS date) AS sold FROM listings WHERE try_cast(prev_sold_date AS date) IS NOT NULL"
CTE["before"] = "SELECT * FROM dated WHERE sold < DATE '1998-01-01'"
CTE["after"] = (
    "SELECT * REPLACE (CASE WHEN CAST(brokered_by AS bigint) % 4 = 0 THEN price * 1.5 ELSE price END AS price) "
    "FROM dated WHERE sold >= DATE '1998-01-01'"
)
_STATS = "median(price) AS median, {std} AS std, count(price) AS count"
CTE["drift_base"] = (
    "SELECT city, " + _STATS.format(std="coalesce(stddev_samp(price), 0.0)") + " FROM before WHERE city IS NOT NULL GROUP BY city HAVING count(price) > 0"
)
CTE["drift_now"] = "SELECT city, " + _STATS.format(std="stddev_samp(price)") + " FROM after WHERE city IS NOT NULL GROUP BY city"
CTE["drifted"] = f"""
SELECT n.city, {rnd('b.median', 2)} AS baseline_median, {rnd('n.median', 2)} AS current_median,
  {rnd('abs(n.median - b.median) / b.median * 100', 1)} AS pct_change,
  CASE WHEN n.median > b.median THEN 'UP' ELSE 'DOWN' END AS direction, n.count AS current_count
FROM drift_now n JOIN drift_base b ON n.city = b.city
WHERE n.count >= 10 AND b.median <> 0 AND abs(n.median - b.median) / b.median > 0.20"""
CTE["month_rows"] = "SELECT *, strftime(sold, '%Y-%m') AS month FROM after"
for _place in ("city", "state"):
    CTE[f"base_{_place}"] = f"SELECT {_place}, median(price) AS median FROM before GROUP BY {_place} HAVING count(price) > 0"
    CTE[f"month_now_{_place}"] = f"SELECT month, {_place}, median(price) AS median, count(price) AS n FROM month_rows GROUP BY month, {_place}"
    CTE[f"month_drift_{_place}"] = f"""
SELECT month, n.{_place}, n.median > b.median AS up, {rnd('abs(n.median - b.median) / b.median * 100', 1)} AS pct
FROM month_now_{_place} n JOIN base_{_place} b ON n.{_place} = b.{_place}
WHERE n >= 10 AND b.median <> 0 AND abs(n.median - b.median) / b.median > 0.20"""

# Retrieval CTEs.
_WORD = r"[\p{L}\p{N}_]+"
_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
CTE["turns"] = f"""
SELECT conv_id, turn, text, list_filter(list_distinct(regexp_extract_all(lower(text), '{_WORD}')), lambda w: w NOT IN ({_STOP})) AS terms
FROM conversations WHERE role = 'user'"""
CTE["low_docs"] = "SELECT doc_id, lower(text) AS low FROM documents"
CTE["pair_scores"] = f"""
SELECT conv_id, turn, doc_id, CASE WHEN len(terms) = 0 THEN 0.0 ELSE
  {rnd('CAST(len(list_filter(terms, lambda t: contains(low, t))) AS double) / len(terms)', 4)} END AS score
FROM turns, low_docs"""
CTE["pair_ranks"] = """
SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, doc_id) AS rank,
  max(score) OVER (PARTITION BY conv_id, turn) AS best FROM pair_scores"""
CTE["hits"] = "SELECT * FROM pair_ranks WHERE rank <= 4 OR best = 0"
CTE["turn_lines"] = "SELECT *, concat(CASE WHEN role = 'user' THEN 'User: ' ELSE 'Assistant: ' END, text, chr(10)) AS line FROM conversations"

# TF-IDF CTEs.


def _tfidf_ctes(p: str, source: str, id_col: str, text: str, top: int) -> dict[str, str]:
    return {
        f"{p}words": f"SELECT {id_col}, list_filter(regexp_extract_all(lower(coalesce({text}, '')), '{_WORD}'), lambda w: length(w) >= 2) AS w FROM {source}",
        f"{p}terms": f"""
SELECT {id_col}, unnest(w) AS term FROM {p}words UNION ALL
SELECT {id_col}, unnest(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1]))) FROM {p}words WHERE len(w) > 1""",
        f"{p}tf": f"SELECT {id_col}, term, count(*) AS tf FROM {p}terms GROUP BY {id_col}, term",
        f"{p}vocab": f"SELECT term, count(*) AS df FROM {p}tf GROUP BY term HAVING count(*) >= 5 ORDER BY sum(tf) DESC, term LIMIT {top}",
        f"{p}weights": f"""
SELECT t.{id_col}, t.term, (1 + ln(tf)) * (ln((1.0 + (SELECT count(*) FROM {source})) / (1 + v.df)) + 1) AS w
FROM {p}tf t JOIN {p}vocab v ON t.term = v.term""",
    }


CTE.update(_tfidf_ctes("d_", "listings", "listing_id", "description", 5000))
CTE.update(_tfidf_ctes("t_", "documents", "doc_id", "text", 5000))

# Out-of-fold CTEs: every row once per fold, statistics from the other folds.
CTE["fold_rows"] = "SELECT l.*, s.fold FROM labeled l JOIN scored s ON l.listing_id = s.listing_id"
_K5 = "(VALUES (0), (1), (2), (3), (4)) k(k)"
CTE["o_train"] = f"SELECT k, r.* FROM fold_rows r, {_K5} WHERE r.fold <> k"
CTE["o_city"] = (
    "SELECT k, city, median(price) AS cmp, avg(CAST(is_fraud AS double)) AS cfr FROM o_train "
    "WHERE city IS NOT NULL GROUP BY k, city HAVING count(price) >= 30"
)
CTE["o_state"] = "SELECT k, state, median(price) AS smp FROM o_train GROUP BY k, state HAVING count(price) >= 10"
CTE["o_zip"] = "SELECT k, zip_code, count(*) AS n FROM o_train WHERE zip_code IS NOT NULL GROUP BY k, zip_code"
CTE["o_fall"] = (
    "SELECT c.k, c.cm, c.cr, s.sm FROM (SELECT k, median(cmp) AS cm, avg(cfr) AS cr FROM o_city GROUP BY k) c "
    "JOIN (SELECT k, median(smp) AS sm FROM o_state GROUP BY k) s ON c.k = s.k"
)

# Registry CTEs.
CTE["registry"] = f"""
SELECT CAST(fold + 1 AS bigint) AS id, TIMESTAMP '2024-01-01' + fold * INTERVAL 1 DAY AS registered_at, 'weak' AS model_name,
  concat('1.0.', CAST(fold AS string)) AS version,
  CASE WHEN fold = 3 THEN 'Production' WHEN fold = 4 THEN 'Staging' ELSE 'Archived' END AS stage,
  {rnd('pr_auc', 6)} AS pr_auc, {rnd('r95', 6)} AS recall_at_95p, CAST(0.7 AS double) AS threshold, fold = 3 AS is_active,
  concat('models/weak/', CAST(fold AS string)) AS model_path, concat('run-', CAST(fold AS string)) AS run_id, CAST(NULL AS string) AS notes
FROM fold_areas WHERE model = 'p_b'"""
CTE["registered"] = f"""
SELECT id, registered_at, model_name, version, CASE WHEN stage = 'Production' AND is_active THEN 'Archived' ELSE stage END AS stage,
  pr_auc, recall_at_95p, threshold, CASE WHEN stage = 'Production' AND is_active THEN false ELSE is_active END AS is_active, model_path, run_id, notes FROM registry
UNION ALL SELECT 6, TIMESTAMP '2024-02-01', 'strong', '2.0.0', 'Production', {rnd('pr_auc', 6)}, {rnd('r95', 6)}, 0.7, true, 'models/strong', 'run-strong', 'all rows'
FROM areas WHERE model = 'p_a'"""


# Grouped folds: the largest group first, each to the lightest fold; groups of one size go to the folds in hash order.
CTE["deal_sizes"] = "SELECT coalesce(city, '__unknown__') AS city, count(*) AS group_size FROM listings GROUP BY 1"
CTE["deal_queue"] = "SELECT group_size, row_number() OVER (ORDER BY group_size DESC) AS i FROM deal_sizes"
CTE["dealt"] = """
SELECT CAST(0 AS bigint) AS i, CAST(0 AS bigint) AS group_size, CAST(-1 AS bigint) AS fold, [CAST(0 AS bigint), 0, 0, 0, 0] AS loads
UNION ALL
SELECT q.i, q.group_size, list_position(d.loads, list_min(d.loads)) - 1,
  list_transform(d.loads, lambda x, k: CASE WHEN k = list_position(d.loads, list_min(d.loads)) THEN x + q.group_size ELSE x END)
FROM dealt d JOIN deal_queue q ON q.i = d.i + 1"""
CTE["deal_runs"] = """
SELECT group_size, fold, CAST(sum(count(*)) OVER (PARTITION BY group_size ORDER BY fold) AS bigint) AS until, count(*) AS n
FROM dealt WHERE i > 0 GROUP BY group_size, fold"""
CTE["deal_ranked"] = "SELECT *, row_number() OVER (PARTITION BY group_size ORDER BY md5(city), city) AS rk FROM deal_sizes"


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it refers to, directly or through others."""
    import re

    def refs(text: str) -> set[str]:
        return {t for t in re.findall(r"\b[a-z][a-z0-9_]*\b", text) if t in CTE}

    need, todo = set(), refs(body)
    while todo:
        name = todo.pop()
        if name not in need:
            need.add(name)
            todo |= refs(CTE[name]) - need - {name}
    parts = [f"{n} AS ({CTE[n].strip()})" for n in CTE if n in need]
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


Q: dict[str, str] = {}
_BASE = ", ".join(BASE_COLUMNS)
_RULES = ", ".join(RULES)

Q["scan_typed"] = "SELECT " + ", ".join(c for c in LISTING_TYPES if c not in ("street", "brokered_by")) + " FROM listings"
Q["stats_roundtrip"] = f"""
SELECT 'city' AS kind, city AS key, {rnd('city_median', 4)} AS value_1, {rnd('city_std', 4)} AS value_2, {rnd('city_ppsf_low', 4)} AS value_3 FROM city
UNION ALL SELECT 'state', state, {rnd('state_median', 4)}, NULL, NULL FROM state
UNION ALL SELECT 'scalar', 'all', {rnd('price_clip', 4)}, {rnd('size_clip', 4)}, {rnd('national_median', 4)} FROM clip, national"""
_ST4 = f"{rnd('median', 4)} AS median, {rnd('std', 4)} AS std, count"
Q["drift_baseline"] = f"SELECT city, {_ST4} FROM drift_base"
Q["drift_current"] = f"SELECT city, {_ST4} FROM drift_now"
Q["drift_cities"] = "SELECT * FROM drifted"
Q["drift_report"] = """
SELECT count(*) AS drifted, count(*) > 5 AS retrain_recommended, first(city ORDER BY pct_change DESC, city) AS max_drift_place,
  coalesce(max(pct_change), 0.0) AS max_drift_pct, count(*) FILTER (direction = 'UP') AS places_up,
  count(*) FILTER (direction = 'DOWN') AS places_down FROM drifted"""
for _name, _place in (("drift_by_month", "city"), ("drift_by_month_and_state", "state")):
    Q[_name] = f"""
SELECT m.month, count(d.{_place}) AS drifted, count(*) FILTER (up) AS places_up, count(*) FILTER (NOT up) AS places_down,
  coalesce(max(pct), 0.0) AS max_drift_pct, count(d.{_place}) > 5 AS retrain_recommended
FROM (SELECT DISTINCT month FROM month_rows) m LEFT JOIN month_drift_{_place} d ON m.month = d.month GROUP BY m.month"""
Q["prediction_log_rows"] = "SELECT * FROM logs"
Q["corpus_load"] = "SELECT concat_ws('/', source, CAST(doc_id AS string)) AS source, text AS content FROM documents"
Q["model_projection"] = "SELECT " + ", ".join(c for c in LISTING_TYPES if c not in ("street", "brokered_by")) + ", is_fraud FROM labeled"
Q["fill_missing_columns"] = "SELECT listing_id, price, city, " + ", ".join(
    f"CAST(NULL AS {LISTING_TYPES[c]}) AS {c}" for c in BASE_COLUMNS if c not in ("price", "city")
) + " FROM listings"
_VALID = (
    "price > 0 AND price <= 100000000 AND coalesce(bed, 0) >= 0 AND coalesce(bath, 0) >= 0 AND coalesce(house_size, 0) >= 0 "
    "AND coalesce(acre_lot, 0) >= 0 AND coalesce(length(city), 0) <= 100 AND coalesce(length(state), 0) <= 50 "
    "AND coalesce(length(zip_code), 0) <= 20 AND coalesce(length(status), 0) <= 50"
)
Q["validate_listings"] = f"SELECT listing_id, {_BASE} FROM listings WHERE {_VALID}"
Q["rejected_listings"] = f"""
SELECT listing_id, price, concat_ws(',', CASE WHEN price IS NULL THEN 'price_missing' END, CASE WHEN price <= 0 THEN 'price_not_positive' END,
  CASE WHEN price > 100000000 THEN 'price_too_high' END, CASE WHEN bed < 0 THEN 'bed_negative' END,
  CASE WHEN bath < 0 THEN 'bath_negative' END, CASE WHEN house_size < 0 THEN 'house_size_negative' END,
  CASE WHEN acre_lot < 0 THEN 'acre_lot_negative' END) AS reasons
FROM listings WHERE ({_VALID}) IS NOT TRUE"""
Q["normalize_geo"] = """
SELECT listing_id, list_aggregate(list_transform(range(1, length(c) + 1), lambda i: CASE WHEN i > 1 AND
  regexp_matches(substr(c, CAST(i AS int) - 1, 1), '\\p{L}') THEN lower(substr(c, CAST(i AS int), 1)) ELSE upper(substr(c, CAST(i AS int), 1)) END), 'string_agg', '') AS city,
  upper(state) AS state
FROM (SELECT listing_id, concat_ws('-', description, city) AS c, state FROM listings)"""
Q["clip_p99"] = "SELECT listing_id, " + ", ".join(
    rnd(f"CASE WHEN {c} IS NOT NULL THEN greatest(least({c}, q_{c}), 0) END", 4) + f" AS {c}" for c in NUMERIC
) + " FROM listings, (SELECT " + ", ".join(f"quantile_cont({c}, 0.99) AS q_{c}" for c in NUMERIC) + " FROM listings)"
Q["ppsf_band"] = f"SELECT listing_id, {rnd('ppsf', 6)} AS ppsf FROM ppsf_band"
Q["history_filter"] = """
SELECT id, city, state, fraud_score, risk_tier FROM logs WHERE city ILIKE '%CITY_1%' AND state = 'NATION_1' AND fraud_score >= 0.4"""
Q["history_by_id"] = "SELECT id, city, fraud_score, risk_tier FROM logs WHERE id = (SELECT min(id) FROM logs)"
Q["history_display"] = """
SELECT id, created_at, city, state, CASE WHEN price IS NULL THEN 'N/A' ELSE concat('$', format('{:,}', CAST(round_even(price, 0) AS bigint))) END AS price,
  fraud_score, risk_tier, concat(format('{:,}', CAST(round_even(latency_ms, 0) AS bigint)), 'ms') AS latency FROM logs"""
Q["risk_tiers"] = """
SELECT listing_id, p_a, CASE WHEN p_a >= 0.7 THEN 'HIGH' WHEN p_a >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
  p_a >= 0.7 AS is_suspicious FROM scored"""
Q["hash_key"] = "SELECT listing_id, substr(sha256(listing_id), 1, 16) AS key_hash FROM listings"
_COARSE = "(SELECT * REPLACE (round(price / 10000) AS price, CAST(NULL AS string) AS city, CAST(NULL AS double) AS acre_lot) FROM listings)"
_KEY = ", ".join(DEDUP_KEY)
Q["dedup_listings"] = f"""
SELECT listing_id, {_BASE} FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY listing_id) AS rn FROM {_COARSE}) WHERE rn = 1"""
Q["dedup_report"] = f"""
SELECT CAST(sum(n) AS bigint) AS rows_before, count(*) AS rows_after, CAST(sum(n) - count(*) AS bigint) AS duplicates,
  {rnd('CAST(sum(n) - count(*) AS double) * 100 / CAST(sum(n) AS double)', 2)} AS duplicate_pct
FROM (SELECT count(*) AS n FROM {_COARSE} GROUP BY {_KEY})"""
_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{LISTING_TYPES[c]}' AS dtype, count(*) FILTER ({c} IS NULL) AS null_count, count(*) AS n FROM listings"
    for c in BASE_COLUMNS
)
_NPCT = rnd("CAST(null_count AS double) * 100 / n", 2)
Q["missing_profile"] = f"""
SELECT column_name, dtype, null_count, {_NPCT} AS null_pct,
  CASE WHEN {_NPCT} >= 80 THEN 'CRITICAL' WHEN {_NPCT} >= 30 THEN 'WARN' ELSE 'OK' END AS severity FROM ({_NULLS})"""


def _describe(v: str) -> str:
    return (
        f"count({v}) AS n_values, {rnd(f'avg({v})', 4)} AS mean, {rnd(f'stddev_samp({v})', 4)} AS std, {rnd(f'min({v})', 4)} AS min, "
        + ", ".join(f"{rnd(f'quantile_cont({v}, {q})', 4)} AS p{int(q * 100)}" for q in (0.25, 0.5, 0.75))
        + f", {rnd(f'max({v})', 4)} AS max"
    )


Q["describe_numeric"] = f"SELECT feature, {_describe('v')} FROM melted GROUP BY feature"
Q["describe_by_label"] = f"SELECT is_fraud, feature, {_describe('v')} FROM lab_melted GROUP BY is_fraud, feature"
Q["ppsf_by_label"] = f"SELECT is_fraud, 'ppsf' AS feature, {_describe('ppsf')} FROM ppsf_band GROUP BY is_fraud"
Q["cardinality"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique FROM listings" for c in ("status", "state", "city", "zip_code")
)
Q["skewness_profile"] = f"""
SELECT feature, {rnd('skewness(v)', 3)} AS skewness, abs({rnd('skewness(v)', 3)}) > 1 AS needs_log FROM melted GROUP BY feature"""
Q["price_profile"] = f"""
SELECT count(price) AS n_values, {rnd('avg(price)', 2)} AS mean, {rnd('stddev_samp(price)', 2)} AS std, {rnd('min(price)', 2)} AS min,
  {rnd('max(price)', 2)} AS max, {rnd('skewness(price)', 3)} AS skewness, {rnd('median(price)', 2)} AS median,
  {', '.join(f"{rnd(f'quantile_cont(price, {p / 100})', 2)} AS p{p}" for p in (1, 5, 10, 25, 50, 75, 90, 95, 99))},
  abs({rnd('skewness(price)', 3)}) > 1 AS log_recommended FROM listings"""
_ROLE = {
    "prev_sold_date": ("MEDIUM", "use its year and month"),
    **{c: ("MEDIUM", "encode per training fold") for c in ("city", "zip_code")},
    **{c: ("LOW", "scale") for c in NUMERIC},
    **{c: ("LOW", "encode by order") for c in CATEGORICAL},
}
Q["leakage_report"] = " UNION ALL ".join(
    [
        f"SELECT '{c}' AS column_name, '{LISTING_TYPES[c]}' AS dtype, count(DISTINCT {c}) AS n_distinct, "
        f"{rnd(f'CAST(count(*) FILTER ({c} IS NULL) AS double) * 100 / count(*)', 2)} AS null_pct, '{r}' AS leakage_risk, '{a}' AS action FROM listings"
        for c, (r, a) in _ROLE.items()
    ]
    + [f"SELECT '{c}', NULL, NULL, NULL, 'high: not used', 'left out of the model'" for c in ("street", "brokered_by")]
)
Q["quality_gates"] = f"""
SELECT count(*) AS rows_seen, CAST(1000 AS bigint) AS rows_required, CAST({len(LISTING_TYPES)} AS int) AS columns_seen,
  CAST({len(LISTING_TYPES)} AS int) AS columns_expected, count(*) >= 1000 AS passed FROM listings"""
Q["top_values"] = " UNION ALL ".join(
    f"(SELECT '{c}' AS column_name, {c} AS value, count(*) AS listings FROM listings WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 30)"
    for c in ("status", "state", "city", "zip_code")
)


def _hist(source: str, v: str, bins: int, by: str = "", where: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    key = f"{by}, " if by else ""
    return f"""
SELECT {key}bin, {rnd('mn + bin * w', 4)} AS bin_start, n, {rnd('n / (total * w)', 8)} AS density FROM (
  SELECT {key}bin, mn, w, total, count(*) AS n FROM (
    SELECT {key}mn, w, total, CAST(coalesce(least(floor((v - mn) / nullif(w, 0)), {bins - 1}), 0) AS bigint) AS bin FROM (
      SELECT {key}v, min(v) OVER ({part}) AS mn, (max(v) OVER ({part}) - min(v) OVER ({part})) / {bins} AS w, count(*) OVER ({part}) AS total
      FROM (SELECT {key}{v} AS v FROM {source} WHERE {v} IS NOT NULL)))
  GROUP BY {key}bin, mn, w, total)"""


_CUT = "CASE WHEN price IS NOT NULL THEN least(price, (SELECT quantile_cont(price, 0.99) FROM listings)) END"
Q["histogram_price"] = _hist(f"(SELECT {_CUT} AS x FROM listings)", "x", 60)
Q["histogram_log_price"] = _hist("(SELECT ln(1 + CASE WHEN price IS NOT NULL THEN greatest(price, 0) END) AS x FROM listings)", "x", 60)
Q["histogram_by_label"] = _hist(f"(SELECT is_fraud, {_CUT} AS x FROM labeled)", "x", 50, "is_fraud")
Q["score_histogram"] = _hist("logs", "fraud_score", 40)
Q["boxplot_stats"] = f"""
SELECT feature, {rnd('q1', 4)} AS q1, {rnd('med', 4)} AS median, {rnd('q3', 4)} AS q3,
  {rnd('min(x) FILTER (x >= q1 - 1.5 * (q3 - q1))', 4)} AS whisker_low, {rnd('max(x) FILTER (x <= q3 + 1.5 * (q3 - q1))', 4)} AS whisker_high,
  count(*) FILTER (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS outliers
FROM (SELECT m.feature, least(v, cut) AS x, q1, med, q3 FROM melted m JOIN (
  SELECT feature, quantile_cont(v, 0.25) AS q1, median(v) AS med, quantile_cont(v, 0.75) AS q3, quantile_cont(v, 0.99) AS cut FROM melted GROUP BY feature) s
  ON m.feature = s.feature WHERE v IS NOT NULL) GROUP BY feature, q1, med, q3"""
_FEATURE_TYPE = {
    **{c: "double" for c in _NUM19}, "is_large_property": "int", "days_since_last_sale": "int", "sold_year": "int",
    "sold_month": "int", "zip_listing_count": "bigint",
}
Q["feature_summary"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{_FEATURE_TYPE[c]}' AS dtype, {rnd(f'CAST(count(*) FILTER ({c} IS NULL) AS double) * 100 / count(*)', 2)} AS null_pct, "
    f"{rnd(f'avg({c})', 4)} AS mean, {rnd(f'stddev_samp({c})', 4)} AS std, {rnd(f'CAST(min({c}) AS double)', 4)} AS min, {rnd(f'CAST(max({c}) AS double)', 4)} AS max FROM folded"
    for c in _NUM19
)
Q["feature_null_check"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS missing FROM full_filled" for c in [*_NUM19, *CATEGORICAL]
)

# Labels.
Q["label_clip_points"] = f"""
SELECT {rnd('price_clip', 4)} AS price_clip, {rnd('size_clip', 4)} AS size_clip, {rnd('national_median', 4)} AS national_median,
  {rnd('size_median', 4)} AS size_median FROM clip, national"""
Q["label_city_stats"] = f"SELECT city, {rnd('city_median', 4)} AS city_median, {rnd('city_std', 4)} AS city_std, {rnd('city_ppsf_low', 4)} AS city_ppsf_low FROM city"
Q["label_state_stats"] = f"SELECT state, {rnd('state_median', 4)} AS state_median FROM state"
Q["label_enriched"] = "SELECT listing_id, " + ", ".join(
    f"{rnd(c, 4)} AS {c}" for c in ("city_median", "city_std", "city_ppsf_low", "state_median")
) + " FROM enriched"
for _r in RULES:
    Q[_r] = f"SELECT listing_id, {_r} FROM labeled"
Q["fraud_labels"] = f"SELECT listing_id, {_RULES}, fraud_score, is_fraud FROM labeled"
Q["stream_score_rules"] = Q["fraud_labels"]
Q["label_holdout"] = f"SELECT listing_id, {_RULES}, fraud_score, is_fraud FROM h_labeled"
Q["fraud_rate_check"] = f"""
SELECT {rnd('avg(CAST(is_fraud AS double))', 6)} AS fraud_rate, CASE WHEN avg(CAST(is_fraud AS double)) < 0.03 THEN 'BELOW'
  WHEN avg(CAST(is_fraud AS double)) > 0.08 THEN 'ABOVE' ELSE 'OK' END AS verdict FROM labeled"""
Q["rule_contribution"] = " UNION ALL ".join(
    f"SELECT '{r[5:]}' AS rule, CAST(sum({r}) AS bigint) AS fired, {rnd(f'CAST(sum({r}) AS double) * 100 / count(*)', 3)} AS pct FROM labeled" for r in RULES
)
Q["score_distribution"] = "SELECT fraud_score, count(*) AS listings FROM labeled GROUP BY fraud_score"
Q["label_totals"] = f"SELECT count(*) AS total_rows, CAST(sum(is_fraud) AS bigint) AS fraud_count, {rnd('avg(CAST(is_fraud AS double))', 6)} AS fraud_rate FROM labeled"
Q["rule_cooccurrence"] = " UNION ALL ".join(
    f"SELECT '{a}' AS rule_a, '{b}' AS rule_b, CAST(sum({a} * {b}) AS bigint) AS together FROM labeled" for a in RULES for b in RULES
)


def _rate(key: str, least: int, source: str = "labeled") -> str:
    return (
        f"SELECT {key}, count(is_fraud) AS total, CAST(sum(is_fraud) AS bigint) AS fraud, 100.0 * sum(is_fraud) / count(is_fraud) AS r "
        f"FROM {source} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(is_fraud) >= {least}"
    )


_NAT = "(SELECT avg(CAST(is_fraud AS double)) * 100 AS nat FROM labeled)"
Q["fraud_by_state"] = f"""
SELECT state, total, fraud, {rnd('r', 4)} AS fraud_rate, CASE WHEN r > nat * 1.5 THEN 'far_above' WHEN r > nat THEN 'above' ELSE 'normal' END AS level
FROM ({_rate('state', 50)}), {_NAT} ORDER BY r DESC, state LIMIT 30"""
Q["fraud_count_by_state"] = f"SELECT state, total, fraud, {rnd('r', 4)} AS fraud_rate FROM ({_rate('state', 50)}) ORDER BY fraud DESC, state LIMIT 15"
Q["fraud_by_city"] = f"""
SELECT city, total, fraud, {rnd('r', 4)} AS fraud_rate, CASE WHEN r > nat * 2 THEN 'far_above' ELSE 'high' END AS level
FROM ({_rate('city', 200)}), {_NAT} ORDER BY r DESC, city LIMIT 20"""
Q["fraud_by_small_city"] = Q["fraud_by_city"].replace(_rate("city", 200), _rate("city", 40))
Q["fraud_by_status"] = f"SELECT status, total, fraud, {rnd('r', 4)} AS fraud_rate FROM ({_rate('status', 0)})"
Q["fraud_by_sold_year"] = f"""
SELECT sold_year, total, fraud, {rnd('r', 4)} AS fraud_rate FROM ({_rate('sold_year', 100,
  '(SELECT *, CAST(year(try_cast(prev_sold_date AS date)) AS int) AS sold_year FROM labeled)')})"""
Q["bed_bath_distribution"] = """
SELECT m.feature, is_fraud, CAST(floor(least(v, cut)) AS bigint) AS bin, count(*) AS n FROM lab_melted m JOIN (
  SELECT feature, least(quantile_cont(v, 0.995), 20) AS cut FROM lab_melted GROUP BY feature) s ON m.feature = s.feature
WHERE m.feature IN ('bed', 'bath') AND v IS NOT NULL GROUP BY m.feature, is_fraud, bin"""
Q["fraud_vs_normal"] = f"""
SELECT feature, {rnd('n', 2)} AS normal_mean, {rnd('f', 2)} AS fraud_mean, {rnd('f / n', 3)} AS ratio, {rnd('(f - n) * 100 / n', 1)} AS diff_pct
FROM (SELECT feature, avg(v) FILTER (is_fraud = 1) AS f, avg(v) FILTER (is_fraud = 0) AS n FROM lab_melted GROUP BY feature)"""


def _corr(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, " + ("CAST(1.0 AS double)" if a == b else rnd(f"corr({a}, {b})", 6)) + f" AS r FROM {source}"
        + (" LIMIT 1" if False else (" WHERE listing_id = (SELECT min(listing_id) FROM listings)" if a == b else ""))
        for a in columns
        for b in columns
    )


_C6 = [*NUMERIC, "is_fraud"]
Q["correlation_matrix"] = _corr(_C6, "labeled")
Q["label_correlation"] = f"SELECT feature_a AS feature, r, abs(r) AS abs_r FROM ({_corr(_C6, 'labeled')}) WHERE feature_b = 'is_fraud' AND feature_a <> 'is_fraud'"
_COL = "(SELECT * REPLACE (house_size * 2 + coalesce(bath, 0) AS bath) FROM labeled)"
Q["collinear_pairs"] = f"SELECT * FROM ({_corr(_C6, _COL)}) WHERE feature_a < feature_b AND abs(r) > 0.8"
Q["mann_whitney"] = f"""
SELECT feature, {rnd('max(f)', 2)} AS fraud_median, {rnd('max(m)', 2)} AS normal_median, {rnd('max(f) / greatest(max(m), 1e-9)', 3)} AS ratio,
  sum(rk) FILTER (is_fraud = 1) - count(*) FILTER (is_fraud = 1) * (count(*) FILTER (is_fraud = 1) + 1) / 2.0 AS u_statistic
FROM (SELECT feature, is_fraud, rank() OVER (PARTITION BY feature ORDER BY v) + (count(*) OVER (PARTITION BY feature, v) - 1) / 2.0 AS rk,
  median(v) FILTER (is_fraud = 1) OVER (PARTITION BY feature) AS f, median(v) FILTER (is_fraud = 0) OVER (PARTITION BY feature) AS m
  FROM lab_melted WHERE v IS NOT NULL) GROUP BY feature"""
_T = "(1.0 / (1.0 + 0.5 * x))"
_POLY = "0.0"
for _c in reversed(ERFC):
    _POLY = f"({_POLY} * {_T} + ({_c}))"
Q["mann_whitney_p"] = f"""
SELECT feature, {rnd('p', 8)} AS p_value, p < 0.05 AS significant FROM (
  SELECT feature, least({_T} * exp({_POLY} - x * x), 1.0) AS p FROM (
    SELECT feature, coalesce(greatest(abs(u - m1 * m0 / 2.0) - 0.5, 0.0)
      / nullif(sqrt(greatest(m1 * m0 / 12.0 * ((m1 + m0 + 1) - coalesce(ties / nullif((m1 + m0) * (m1 + m0 - 1), 0), 0.0)), 0.0)), 0), 0.0) / sqrt(2.0) AS x
    FROM (SELECT feature, CAST(count(*) FILTER (is_fraud = 1) AS double) AS m1, CAST(count(*) FILTER (is_fraud = 0) AS double) AS m0,
        sum(rk) FILTER (is_fraud = 1) - count(*) FILTER (is_fraud = 1) * (count(*) FILTER (is_fraud = 1) + 1) / 2.0 AS u,
        sum(same * same - 1) AS ties
      FROM (SELECT feature, is_fraud, rank() OVER (PARTITION BY feature ORDER BY v) + (count(*) OVER (PARTITION BY feature, v) - 1) / 2.0 AS rk,
          CAST(count(*) OVER (PARTITION BY feature, v) AS double) AS same FROM lab_melted WHERE v IS NOT NULL) GROUP BY feature)))"""
Q["ppsf_top_cities"] = f"""
SELECT city, {rnd('median(ppsf)', 4)} AS median_ppsf, count(*) AS listings FROM ppsf_band WHERE city IS NOT NULL
GROUP BY city HAVING count(*) >= 100 ORDER BY median(ppsf) DESC, city LIMIT 20"""
Q["ppsf_top_small_cities"] = Q["ppsf_top_cities"].replace(">= 100", ">= 30")
Q["scatter_sample"] = f"""
SELECT listing_id, is_fraud, {rnd('ln(1 + greatest(price, 0))', 6)} AS log_price, {rnd('ln(1 + greatest(house_size, 0))', 6)} AS log_size
FROM labeled WHERE price IS NOT NULL AND house_size IS NOT NULL ORDER BY md5(concat_ws('|', listing_id, '42')) LIMIT 8000"""
Q["eda_summary"] = f"""
SELECT 'total_rows' AS metric, CAST(count(*) AS double) AS value FROM labeled
UNION ALL SELECT 'fraud_count', CAST(sum(is_fraud) AS double) FROM labeled
UNION ALL SELECT 'fraud_rate_pct', {rnd('avg(CAST(is_fraud AS double)) * 100', 2)} FROM labeled
UNION ALL SELECT concat('missing_pct_', column_name), {_NPCT} FROM ({_NULLS})
UNION ALL SELECT concat('skewness_', feature), {rnd('skewness(v)', 3)} FROM melted GROUP BY feature
""" + "".join(
    f"UNION ALL SELECT 'price_{n}', {rnd(rnd(x, 2), 0)} FROM listings\n"
    for n, x in {
        "mean": "avg(price)", "median": "median(price)", "std": "stddev_samp(price)", "p1": "quantile_cont(price, 0.01)",
        "p5": "quantile_cont(price, 0.05)", "p95": "quantile_cont(price, 0.95)", "p99": "quantile_cont(price, 0.99)",
    }.items()
) + f"""UNION ALL (SELECT concat('top_state_', state), {rnd('r', 2)} FROM ({_rate('state', 50)}) ORDER BY r DESC, state LIMIT 5)
UNION ALL (SELECT concat('top_city_', city), {rnd('r', 2)} FROM ({_rate('city', 200)}) ORDER BY r DESC, city LIMIT 5)
UNION ALL SELECT concat('significant_', feature), CAST(CASE WHEN abs(u - n1 * n0 / 2.0) - 0.5 > 1.959963985 *
  sqrt(n1 * n0 / 12.0 * (n1 + n0 + 1 - ties / ((n1 + n0) * (n1 + n0 - 1)))) THEN 1 ELSE 0 END AS double) FROM (
  SELECT feature, CAST(count(*) FILTER (is_fraud = 1) AS double) AS n1, CAST(count(*) FILTER (is_fraud = 0) AS double) AS n0,
    sum(rk) FILTER (is_fraud = 1) - count(*) FILTER (is_fraud = 1) * (count(*) FILTER (is_fraud = 1) + 1) / 2.0 AS u,
    sum(t * t - 1.0) AS ties FROM (
    SELECT feature, is_fraud, CAST(count(*) OVER (PARTITION BY feature, v) AS double) AS t,
      rank() OVER (PARTITION BY feature ORDER BY v) + (count(*) OVER (PARTITION BY feature, v) - 1) / 2.0 AS rk
    FROM lab_melted WHERE v IS NOT NULL) GROUP BY feature)"""

# Features.
Q["stateless_features"] = "SELECT listing_id, " + ", ".join(
    f"{rnd(c, 6)} AS {c}" for c in ("price_log", "house_size_log", "acre_lot_log", "price_per_sqft", "bath_per_bed")
) + ", is_large_property FROM stateless"
Q["temporal_features"] = "SELECT listing_id, days_since_last_sale, sold_year, sold_month FROM stateless"
Q["feature_city_stats"] = f"SELECT city, {rnd('city_median_price', 4)} AS city_median_price FROM f_city"
Q["feature_state_stats"] = f"SELECT state, {rnd('state_median_price', 4)} AS state_median_price FROM f_state"
Q["zip_frequency"] = "SELECT zip_code, n AS zip_listing_count FROM f_zip"
Q["city_target_encoding"] = f"SELECT city, {rnd('city_fraud_rate', 6)} AS city_fraud_rate FROM f_city"
_FOLD = ", ".join(f"{rnd(c, 6)} AS {c}" for c in FOLD_OUT) + ", zip_listing_count"
Q["fold_features"] = f"SELECT listing_id, {_FOLD} FROM folded"
Q["fold_features_holdout"] = f"SELECT listing_id, {_FOLD} FROM t_folded"
Q["oof_features"] = f"""
SELECT listing_id, fold, {rnd('cm1', 6)} AS city_median_price, {rnd('CASE WHEN cm1 > 0 THEN price / cm1 ELSE 1.0 END', 6)} AS price_vs_city_median,
  {rnd('sm1', 6)} AS state_median_price, {rnd('cr1', 6)} AS city_fraud_rate, zip_listing_count FROM (
  SELECT r.listing_id, r.fold, r.price, coalesce(c.cmp, f.cm) AS cm1, coalesce(c.cfr, f.cr) AS cr1, coalesce(s.smp, f.sm) AS sm1,
    coalesce(z.n, 0) AS zip_listing_count
  FROM fold_rows r JOIN o_fall f ON f.k = r.fold LEFT JOIN o_city c ON c.k = r.fold AND c.city = r.city
  LEFT JOIN o_state s ON s.k = r.fold AND s.state = r.state LEFT JOIN o_zip z ON z.k = r.fold AND z.zip_code = r.zip_code)"""
Q["impute_median"] = "SELECT listing_id, " + ", ".join(f"{rnd(c, 6)} AS {c}" for c in PREP_COLUMNS) + " FROM prep_filled"
Q["standard_scale"] = "SELECT listing_id, " + ", ".join(
    rnd(f"({c} - mean_{c}) / CASE WHEN std_{c} > 0 THEN std_{c} ELSE 1 END", 6) + f" AS {c}" for c in PREP_COLUMNS
) + " FROM prep_filled, prep_moments"
Q["impute_mode"] = "SELECT listing_id, " + ", ".join(
    f"coalesce({c}, (SELECT {c} FROM listings WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"
    for c in ("city", "zip_code")
) + " FROM listings"
Q["ordinal_encode"] = """
SELECT listing_id, CAST(coalesce(a.code, -1) AS double) AS status, CAST(coalesce(b.code, -1) AS double) AS state FROM listings l
LEFT JOIN (SELECT status, row_number() OVER (ORDER BY status) - 1 AS code FROM (SELECT DISTINCT status FROM listings WHERE status <> 'sold')) a ON l.status = a.status
LEFT JOIN (SELECT state, row_number() OVER (ORDER BY state) - 1 AS code FROM (SELECT DISTINCT state FROM listings WHERE status <> 'sold')) b ON l.state = b.state"""
Q["feature_matrix"] = "SELECT listing_id, " + ", ".join(
    rnd(f"({c} - mean_{c}) / CASE WHEN std_{c} > 0 THEN std_{c} ELSE 1 END", 5) + f" AS {c}" for c in _NUM19
) + """, CAST(a.code AS double) AS status, CAST(b.code AS double) AS state FROM full_filled f CROSS JOIN full_moments
JOIN (SELECT status, row_number() OVER (ORDER BY status) - 1 AS code FROM (SELECT DISTINCT status FROM listings)) a ON f.status = a.status
JOIN (SELECT state, row_number() OVER (ORDER BY state) - 1 AS code FROM (SELECT DISTINCT state FROM listings)) b ON f.state = b.state"""
Q["group_folds"] = """
SELECT s.city, s.group_size, CAST(r.fold AS int) AS fold FROM deal_ranked s
JOIN deal_runs r ON s.group_size = r.group_size AND s.rk <= r.until AND s.rk > r.until - r.n"""
Q["tfidf_weights"] = f"SELECT listing_id, term, {rnd('w / sqrt(sum(w * w) OVER (PARTITION BY listing_id))', 6)} AS weight FROM d_weights"
Q["tfidf_documents"] = f"SELECT doc_id, term, {rnd('w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))', 6)} AS weight FROM t_weights"
Q["text_disabled_zeros"] = "SELECT listing_id, CAST(50 AS int) AS dims, CAST(0 AS double) AS total FROM listings"
Q["stratified_sample"] = """
SELECT listing_id, is_fraud FROM (SELECT listing_id, is_fraud, row_number() OVER (PARTITION BY is_fraud ORDER BY md5(concat_ws('|', listing_id, '42'))) AS rn,
  count(*) OVER (PARTITION BY is_fraud) AS n FROM labeled) WHERE rn <= round_even(0.5 * n, 0)"""
Q["train_test_split"] = """
SELECT listing_id, is_fraud, CASE WHEN rn <= round_even(0.2 * n, 0) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT listing_id, is_fraud, row_number() OVER (PARTITION BY is_fraud ORDER BY md5(concat_ws('|', listing_id, '43'))) AS rn,
  count(*) OVER (PARTITION BY is_fraud) AS n FROM labeled)"""
Q["class_weights"] = f"""
SELECT {rnd('(n - p) / p', 2)} AS scale_pos_weight, {rnd('n / (2 * p)', 6)} AS weight_positive, {rnd('n / (2 * (n - p))', 6)} AS weight_negative
FROM (SELECT CAST(count(*) AS double) AS n, CAST(sum(is_fraud) AS double) AS p FROM labeled)"""
Q["score_correlation"] = f"SELECT {rnd('corr(p_a, p_b)', 6)} AS r FROM scored"
Q["model_comparison"] = f"""
SELECT f.model, {rnd('avg(f.pr_auc)', 6)} AS mean_pr_auc, {rnd('stddev_pop(f.pr_auc)', 6)} AS std_pr_auc, {rnd('avg(f.r95)', 6)} AS mean_recall_at_95p,
  {rnd('max(a.pr_auc)', 6)} AS oof_pr_auc, stddev_pop(f.pr_auc) > 0.05 AS unstable FROM fold_areas f JOIN areas a ON f.model = a.model GROUP BY f.model"""
Q["score_comparison"] = f"""
SELECT *, {rnd("oof_pr_auc - max(oof_pr_auc) FILTER (model = 'p_b') OVER ()", 6)} AS gain FROM ({Q["model_comparison"]})"""
# Metrics.
Q["pr_auc"] = f"SELECT model, {rnd('pr_auc', 6)} AS pr_auc FROM areas"
Q["roc_auc"] = f"SELECT model, {rnd('roc_auc', 6)} AS roc_auc FROM areas"
Q["recall_at_precision"] = f"SELECT model, {rnd('r95', 6)} AS recall_at_95p, {rnd('r90', 6)} AS recall_at_90p FROM areas"
Q["pr_curve"] = f"""
SELECT model, p AS threshold, {rnd('CAST(tp AS double) / pred', 6)} AS precision, {rnd('CAST(tp AS double) / p_all', 6)} AS recall FROM curve
UNION ALL SELECT DISTINCT model, CAST(NULL AS double), CAST(1 AS double), CAST(0 AS double) FROM long_scores"""
Q["metrics_at_threshold"] = f"SELECT model, threshold, {rnd(_P, 6)} AS precision, {rnd(_R, 6)} AS recall, {rnd(_F1, 6)} AS f1 FROM confusion WHERE threshold = CAST(0.7 AS double)"
_PER = "CAST(floor(CAST(fp AS double) / n * 1000) AS bigint) AS fp_per_1000, CAST(floor(CAST(fn AS double) / n * 1000) AS bigint) AS fn_per_1000"
Q["threshold_sweep"] = f"SELECT model, threshold, {rnd(_P, 4)} AS precision, {rnd(_R, 4)} AS recall, {rnd(_F1, 4)} AS f1, {_PER} FROM confusion"
Q["threshold_cost"] = f"""
SELECT *, threshold = first_value(threshold) OVER (PARTITION BY model ORDER BY cost, threshold) AS cheapest FROM (
  SELECT *, fn_per_1000 * 3 + fp_per_1000 AS cost FROM (SELECT model, threshold, {_PER} FROM confusion))"""
Q["tier_outcomes"] = """
SELECT model, CASE WHEN p >= 0.7 THEN 'HIGH' WHEN p >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier, count(*) AS listings,
  CAST(sum(y) AS bigint) AS fraud FROM long_scores GROUP BY 1, 2"""
Q["confusion_matrix"] = " UNION ALL ".join(
    f"SELECT model, CAST({y} AS int) AS y_true, CAST({p} AS int) AS y_pred, CAST({m} AS bigint) AS n FROM confusion WHERE threshold = CAST(0.7 AS double)"
    for y, p, m in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
)
_BINS = """SELECT model, CAST(least(greatest(ceil(p * 10) - 1, 0), 9) AS bigint) AS bin, count(*) AS n, avg(p) AS s, avg(CAST(y AS double)) AS f
  FROM long_scores GROUP BY 1, 2"""
Q["calibration_curve"] = f"SELECT model, bin, n, {rnd('s', 6)} AS mean_score, {rnd('f', 6)} AS fraction FROM ({_BINS})"
Q["calibration_error"] = f"SELECT model, {rnd('avg(abs(f - s))', 6)} AS mace FROM ({_BINS}) GROUP BY model"
Q["evaluate_models"] = f"""
SELECT a.model, threshold, {rnd('pr_auc', 6)} AS pr_auc, {rnd('roc_auc', 6)} AS roc_auc, {rnd('r95', 6)} AS recall_at_95p, {rnd('r90', 6)} AS recall_at_90p,
  {rnd(_P, 6)} AS precision, {rnd(_R, 6)} AS recall, {rnd(_F1, 6)} AS f1, pr_auc > 0.8 AS pr_auc_ok, r95 > 0.4 AS recall_ok
FROM areas a JOIN confusion c ON a.model = c.model WHERE threshold = CAST(0.7 AS double)"""

# Explanations.
Q["linear_contributions"] = f"SELECT listing_id, feature, {rnd('value', 6)} AS value, {rnd('impact', 6)} AS impact FROM lin"
_IMP = f"SELECT *, CAST(row_number() OVER (ORDER BY mean_impact DESC, feature) AS int) AS rank FROM (SELECT feature, {rnd('avg(abs(impact))', 6)} AS mean_impact FROM lin GROUP BY feature)"
Q["feature_importance"] = _IMP
Q["top3_explanations"] = f"SELECT listing_id, {_TOP} FROM lin_ranked WHERE rank <= 3"
Q["explain_cases"] = f"""
SELECT listing_id, total, {_TOP} FROM lin_ranked r JOIN (SELECT listing_id AS i, total FROM lin_total WHERE is_fraud = 1 ORDER BY total DESC, listing_id LIMIT 3)
ON listing_id = i WHERE rank <= 12"""
Q["explain_contrast"] = f"""
SELECT side, listing_id, total, {_TOP} FROM lin_ranked r JOIN (
  (SELECT 'fraud' AS side, listing_id AS i, total FROM lin_total WHERE is_fraud = 1 ORDER BY total DESC, listing_id LIMIT 1) UNION ALL
  (SELECT 'normal', listing_id, total FROM lin_total WHERE is_fraud = 0 ORDER BY total, listing_id LIMIT 1)) ON listing_id = i WHERE rank <= 10"""
Q["dependence_points"] = f"""
SELECT listing_id, any_value(is_fraud) AS is_fraud, {rnd("max(value) FILTER (feature = 'price_log')", 6)} AS value,
  {rnd("max(impact) FILTER (feature = 'price_log')", 6)} AS impact, {rnd("max(value) FILTER (feature = 'house_size_log')", 6)} AS interaction_value
FROM lin WHERE feature IN ('price_log', 'house_size_log') GROUP BY listing_id"""
Q["explanation_json"] = f"SELECT listing_id, feature, {rnd('value', 4)} AS value, {rnd('impact', 4)} AS impact, CAST(rank AS int) AS rank FROM lin_ranked WHERE rank <= 3"
Q["explain_insights"] = f"""
SELECT i.feature, rank, mean_impact, {rnd('f', 4)} AS fraud_mean, {rnd('m', 4)} AS normal_mean, {rnd('f / nullif(m, 0)', 4)} AS ratio,
  {rnd('(f - m) * 100 / nullif(m, 0)', 2)} AS diff_pct FROM ({_IMP}) i JOIN (
  SELECT feature, avg(value) FILTER (is_fraud = 1) AS f, avg(value) FILTER (is_fraud = 0) AS m FROM lin GROUP BY feature) s ON i.feature = s.feature WHERE rank <= 5"""

# Log and registry.
Q["history_page"] = "SELECT id, created_at, city, fraud_score, risk_tier FROM logs ORDER BY created_at DESC, id LIMIT 100 OFFSET 50"
Q["fraud_stats"] = f"""
SELECT count(*) AS total_predictions, count(*) FILTER (is_suspicious) AS suspicious_count,
  {rnd('CAST(count(*) FILTER (is_suspicious) AS double) / count(*)', 4)} AS fraud_rate, {rnd('avg(fraud_score)', 4)} AS avg_fraud_score FROM logs"""
Q["tier_counts"] = "SELECT risk_tier, count(*) AS n FROM logs GROUP BY risk_tier"
Q["top_fraud_cities"] = "SELECT city, count(*) AS n FROM logs WHERE is_suspicious AND city IS NOT NULL GROUP BY city ORDER BY count(*) DESC, city LIMIT 10"
Q["high_rate_by_state"] = f"""
SELECT state, total, suspicious, {rnd('r', 4)} AS fraud_rate FROM (SELECT state, count(fraud_score) AS total,
  count(*) FILTER (risk_tier = 'HIGH') AS suspicious, 100.0 * count(*) FILTER (risk_tier = 'HIGH') / count(fraud_score) AS r
  FROM logs WHERE state IS NOT NULL GROUP BY state HAVING count(fraud_score) >= 2) ORDER BY r DESC, state LIMIT 20"""
Q["latency_percentiles"] = f"""
SELECT {rnd('median(latency_ms)', 2)} AS p50_ms, {rnd('quantile_cont(latency_ms, 0.95)', 2)} AS p95_ms, {rnd('max(latency_ms)', 2)} AS max_ms,
  quantile_cont(latency_ms, 0.95) <= 500 AS within_target FROM logs"""
Q["registry_upsert"] = "SELECT * FROM registered"
Q["registry_active"] = "SELECT id, model_name, version, pr_auc FROM registered WHERE is_active ORDER BY registered_at DESC, id DESC LIMIT 1"

# Retrieval.
Q["query_terms"] = "SELECT conv_id, turn, coalesce(array_to_string(list_sort(terms), ' '), '') AS terms, CAST(len(terms) AS int) AS n_terms FROM turns"
Q["doc_relevance"] = "SELECT conv_id, turn, doc_id, score FROM pair_scores WHERE score > 0"
Q["retrieve_topn"] = "SELECT conv_id, turn, doc_id, score, CAST(rank AS int) AS rank FROM hits"
Q["chat_history_window"] = """
SELECT conv_id, CAST(count(*) AS int) AS turns, string_agg(line, '' ORDER BY turn) AS history FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM turn_lines) WHERE rn <= 4 GROUP BY conv_id"""
Q["prompt_context"] = """
SELECT t.conv_id, t.turn, t.text AS question, coalesce((SELECT string_agg(line, '' ORDER BY p.turn) FROM turn_lines p
    WHERE p.conv_id = t.conv_id AND p.turn < t.turn AND (SELECT count(*) FROM turn_lines x WHERE x.conv_id = t.conv_id AND x.turn < t.turn AND x.turn >= p.turn) <= 4), '') AS history,
  c.context FROM turns t JOIN (SELECT conv_id, turn, string_agg(concat(chr(10), '[Source ', CAST(rank AS string), ': ', source, ']', chr(10), substr(d.text, 1, 2000), chr(10)), '' ORDER BY rank) AS context
  FROM hits h JOIN documents d ON h.doc_id = d.doc_id WHERE rank <= 4 GROUP BY conv_id, turn) c ON t.conv_id = c.conv_id AND t.turn = c.turn"""

_BLOCK = """concat('Listing in question', chr(10), '- price: ', CASE WHEN price IS NULL THEN 'N/A' ELSE concat('$', format('{:,}', CAST(round_even(price, 0) AS bigint))) END,
  chr(10), '- city: ', coalesce(city, 'N/A'), chr(10), '- fraud score: ', coalesce(printf('%.4f', fraud_score), 'N/A'), chr(10), '- risk tier: ', coalesce(risk_tier, 'N/A'), chr(10))"""
Q["listing_blocks"] = f"SELECT id, {_BLOCK} AS listing FROM logs"
Q["prompt_texts"] = f"""
SELECT conv_id, turn, concat('Sources:', context, chr(10), listing, chr(10), 'Earlier turns:', chr(10), history, chr(10), 'Question: ', question, chr(10)) AS prompt
FROM ({Q["prompt_context"]}), (SELECT {_BLOCK} AS listing FROM logs ORDER BY fraud_score DESC, id LIMIT 1)"""

_V3 = f"printf('%.3f', CAST(round(CAST({rnd('value', 4)} AS DECIMAL(38,4)), 3) AS double))"
_I4 = rnd("impact", 4)
Q["explain_context"] = f"""
SELECT s.listing_id AS id, t.risk_tier, g.signals, c.context FROM scored s
JOIN (SELECT listing_id, CASE WHEN p_a >= 0.7 THEN 'HIGH' WHEN p_a >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier FROM scored) t ON t.listing_id = s.listing_id
JOIN (SELECT listing_id, string_agg(concat(chr(10), '  - ', feature, ' = ', {_V3}, CASE WHEN {_I4} > 0 THEN ' → fraud signal' ELSE ' → normal signal' END,
    ' (impact: ', printf('%+.4f', {_I4}), ')'), '' ORDER BY rank) AS signals FROM lin_ranked WHERE rank <= 3 GROUP BY listing_id) g ON g.listing_id = s.listing_id
LEFT JOIN (SELECT risk_tier, substr(string_agg(substr(d.text, 1, 1500), chr(10) ORDER BY rk), 1, 1000) AS context FROM (
    SELECT risk_tier, doc_id, row_number() OVER (PARTITION BY risk_tier ORDER BY {rnd("CAST(len(list_filter(terms, lambda t: contains(low, t))) AS double) / len(terms)", 4)} DESC, doc_id) AS rk
    FROM (SELECT risk_tier, list_filter(list_distinct(regexp_extract_all(lower(concat('threshold risk tier ', risk_tier, ' price anomaly fraud signal')), '{_WORD}')), lambda w: w NOT IN ({_STOP})) AS terms
      FROM (VALUES ('HIGH'), ('MEDIUM'), ('LOW')) v(risk_tier)), low_docs) h JOIN documents d ON h.doc_id = d.doc_id WHERE rk <= 2 GROUP BY risk_tier) c ON c.risk_tier = t.risk_tier"""

# The same results by other ways through the library.
for _name, _same in {
    "pipeline_label_holdout": "label_holdout",
    "pipeline_fold_features_holdout": "fold_features_holdout",
    "drift_jobs": "drift_by_month",
    "history_seek": "history_page",
    "log_append_repeated": "prediction_log_rows",
    "registry_committed": "registry_upsert",
}.items():
    Q[_name] = Q[_same]


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in Q.items()}
