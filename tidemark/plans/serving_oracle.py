"""SQL of the queries in ``serving``."""

from __future__ import annotations

from tidemark.plans.oracle import _BARS, _ENR, _LATEST, _MET, _ST, _TICKS, ORACLE

_PRICES = f"""{_TICKS}, lp AS (SELECT event_type AS instrument, max(ts) AS price_ts, arg_max(value, (ts, event_id)) AS price FROM events GROUP BY 1), """
_MARKET = _LATEST.replace(_MET, "").replace(
    "CASE WHEN s_acctbal > 0 THEN s_acctbal END AS price\n      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "instrument, price_ts, price\n      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey\n"
    "      LEFT JOIN lp ON lp.instrument = (['click', 'error', 'purchase', 'signup', 'view'])[s_suppkey % 5 + 1]",
)
_GAP = ORACLE["valuation_gap"].split(_LATEST)[1]
_HOURS = f"h AS ({_BARS.format(width='1 hour', where='')})"

SERVING: dict[str, str] = {
    "valuation_vs_market": f"WITH {_PRICES}{_MET}{_MARKET}{_GAP.split('SELECT company_id, peer_group')[0]} SELECT company_id, instrument, price_ts, round(price, 4) AS price, round(lo, 4) AS lo, round(mid, 4) AS mid, round(hi, 4) AS hi, CAST(len(vals) AS BIGINT) AS n_models, round((price - mid) / nullif(mid, 0), 4) AS gap FROM z",
    "valuation_residual_income": f"""WITH {_LATEST}, v AS (SELECT company_id, (equity + list_sum(list_transform(range(1, 6), lambda n: equity * (roe - 0.1::DOUBLE) / pow(1.1::DOUBLE, n)))) / nullif(shares, 0) AS x FROM l)
SELECT company_id, round(CASE WHEN x > 0 THEN x END, 4) AS value_residual FROM v""",
    "balance_rollup": "SELECT r_name, n_name, round(sum(s_acctbal), 4) AS balance, count(*) AS n, CAST(GROUPING(r_name, n_name) AS BIGINT) AS level FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)",
    "orders_cube": "SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(GROUPING(o_orderstatus, o_orderpriority) AS BIGINT) AS level FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)",
    "orders_grouping_sets": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())",
    "distinct_customers": "SELECT o_orderpriority, count(DISTINCT o_custkey) AS exact, true AS close FROM orders GROUP BY 1",
    "busiest_hours": f"""WITH {_HOURS} SELECT instrument, bar_start, volume, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank,
 ntile(4) OVER (PARTITION BY instrument, CAST(bar_start AS DATE) ORDER BY volume DESC, bar_start) AS quarter, round(cume_dist() OVER w, 6) AS cume_dist, round(percent_rank() OVER w, 6) AS percent_rank
 FROM h WINDOW w AS (PARTITION BY instrument, CAST(bar_start AS DATE) ORDER BY volume DESC)""",
    "volume_last_3h": f"""WITH {_HOURS} SELECT instrument, bar_start, CAST(sum(volume) OVER w AS BIGINT) AS volume_3h, count(*) OVER w AS bars
 FROM h WINDOW w AS (PARTITION BY instrument ORDER BY bar_start RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW)""",
    "statement_trend": f"""WITH {_ST} SELECT company_id, fiscal_year, CAST(round(revenue * 100) AS BIGINT) AS revenue_cents, CAST(sum(CAST(round(revenue * 100) AS BIGINT)) OVER w AS BIGINT) AS cents_to_date, row_number() OVER w AS n_years
 FROM st WINDOW w AS (PARTITION BY company_id ORDER BY fiscal_year) ORDER BY 1, 2""",
    "news_page": "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20 OFFSET 20",
    "nations_with_both": "SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier",
    "customers_without_orders": "SELECT c_custkey AS custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
    "nation_sides": """SELECT coalesce(c.nation, s.nation) AS nation, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers
 FROM (SELECT c_nationkey AS nation, count(*) AS customers FROM customer GROUP BY 1) c FULL JOIN (SELECT s_nationkey AS nation, count(*) AS suppliers FROM supplier GROUP BY 1) s ON c.nation = s.nation""",
    "news_enriched": "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "order_predicates": """SELECT CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 150000 THEN 'middle' ELSE 'large' END AS size, o_orderstatus, count(*) AS n FROM orders
 WHERE o_orderpriority LIKE '%-%' AND (o_totalprice BETWEEN 1000 AND 250000 OR o_orderstatus IS NULL) AND o_orderstatus NOT IN ('P') GROUP BY 1, 2""",
    "silver_ticks": """WITH t AS (SELECT event_id, lower(trim(event_type)) AS instrument, ts, value AS price, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS qty FROM events),
 f AS (SELECT *, CASE WHEN instrument IS NULL OR instrument = '' THEN 'no instrument' WHEN ts IS NULL THEN 'no time' WHEN price IS NULL OR NOT price > 0 THEN 'no price' WHEN qty IS NULL OR qty < 0 THEN 'no size' END AS fault FROM t),
 u AS (SELECT DISTINCT ON (event_id) * FROM f) SELECT instrument, fault, count(*) AS n, CAST(sum(qty) AS BIGINT) AS qty FROM u GROUP BY 1, 2""",
    "news_keywords": """WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS x FROM documents), c AS (SELECT doc_id, x, count(*) AS n FROM w GROUP BY 1, 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, x) AS k FROM c)
 SELECT d.doc_id, coalesce(string_agg(x, ',' ORDER BY k), '') AS keywords FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id AND k <= 3 GROUP BY 1""",
    "company_sentiment": f"""WITH {_ENR}, m AS ({ORACLE['news_company_map']}) SELECT company, count(*) FILTER (sentiment = 'positive') AS positive, count(*) FILTER (sentiment = 'neutral') AS neutral,
 count(*) FILTER (sentiment = 'negative') AS negative, count(*) FILTER (sentiment IS NULL) AS unlabelled FROM m JOIN e USING (doc_id) GROUP BY 1""",
    "gap_by_function": """SELECT s_suppkey AS company_id, round((CASE WHEN s_acctbal > 0 THEN s_acctbal END - 5000) / 5000, 4) AS gap, CASE WHEN s_acctbal > 0 THEN least(s_acctbal, 1000) END AS price
 FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "gold_sentiment": ORACLE["news_sentiment_mix"],
    "gold_dashboard": f"WITH o AS ({ORACLE['valuation_gap']}), k AS ({ORACLE['company_comparison']}) SELECT k.company_id, company, k.peer_group, fiscal_year, revenue, eps, roe, price, lo, mid, hi, gap, coalesce(abs(gap) <= 0.1, false) AS near FROM k JOIN o USING (company_id)",
    "company_document_roundtrip": "SELECT r_name AS region, n_name AS nation, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2",
    "clients_without_sales": "SELECT client_id FROM clients WHERE client_id NOT IN (SELECT client_id FROM sales WHERE client_id IS NOT NULL)",
    "bronze_rows_roundtrip": "SELECT event_type, count(*) AS n, round(sum(value), 4) AS value, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY 1",
    "formats_roundtrip": "SELECT n_nationkey, n_name, n_regionkey, format FROM nation, (VALUES ('csv'), ('json'), ('orc'), ('parquet'), ('xml')) f(format)",
    "stream_bars_1s": _BARS.format(width="1 second", where=""),
    "stream_bars_1m": _BARS.format(width="1 minute", where=""),
    "stream_vwap_5m": ORACLE["vwap_5m"],
    "stream_sliding_15m": f"""WITH {_TICKS} SELECT instrument, time_bucket(INTERVAL '5 minutes', ts) - k * INTERVAL '5 minutes' AS start, CAST(sum(qty) AS BIGINT) AS volume, count(*) AS trades FROM t, range(3) r(k) GROUP BY 1, 2""",
    "stream_sessions": f"""WITH {_TICKS}, g AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS new FROM t WINDOW w AS (PARTITION BY instrument ORDER BY ts)),
 s AS (SELECT *, sum(new) OVER (PARTITION BY instrument ORDER BY ts) AS session FROM g) SELECT instrument, min(ts) AS start, count(*) AS trades, CAST(sum(qty) AS BIGINT) AS volume FROM s GROUP BY instrument, session""",
    "stream_extremes": "SELECT event_type AS instrument, count(*) AS ticks, max(value) AS highest, min(value) AS lowest FROM events GROUP BY 1",
}
ORACLE.update(SERVING)
