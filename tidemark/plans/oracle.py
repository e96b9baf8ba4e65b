"""Each query again, as SQL for another engine on the same tables."""

from __future__ import annotations

_BARS = """
SELECT event_type AS instrument, time_bucket(INTERVAL '{width}', ts) AS bar_start,
       arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS volume, count(*) AS trades
FROM events {where} GROUP BY 1, 2"""
_TICKS = "t AS (SELECT event_type AS instrument, ts, event_id AS trade_id, value AS price, CAST(json_extract_string(props, '$.k') AS BIGINT) AS qty FROM events)"
_ST = """
st AS (SELECT *, assets - liabilities AS equity, net_income / nullif(shares, 0) AS eps FROM (
  SELECT l_suppkey AS company_id, CAST(year(l_shipdate) AS INTEGER) AS fiscal_year,
         sum(l_extendedprice * (1 - l_discount)) AS revenue, sum(l_extendedprice * (0.4::DOUBLE - l_discount)) AS operating_income,
         sum(l_extendedprice * (0.4::DOUBLE - l_discount - l_tax)) AS net_income, sum(l_extendedprice * (0.45::DOUBLE - l_discount - l_tax)) AS operating_cash_flow,
         sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * 0.1::DOUBLE ELSE 0 END) AS capex, sum(l_extendedprice * 2) AS assets,
         sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice * 1.2::DOUBLE ELSE l_extendedprice * 0.6::DOUBLE END) AS liabilities, sum(l_quantity) AS shares
  FROM lineitem GROUP BY 1, 2))"""
_MET = _ST + """,
m AS (SELECT a.*, a.operating_cash_flow - a.capex AS fcf,
  a.net_income / nullif((a.equity + b.equity) / 2, 0) AS roe, a.operating_income * 0.75::DOUBLE / nullif(a.liabilities + a.equity, 0) AS roic,
  (a.revenue - b.revenue) / nullif(abs(b.revenue), 0) AS revenue_growth,
  (a.operating_cash_flow - a.capex - (b.operating_cash_flow - b.capex)) / nullif(abs(b.operating_cash_flow - b.capex), 0) AS fcf_growth
  FROM st a LEFT JOIN st b ON b.company_id = a.company_id AND b.fiscal_year = a.fiscal_year - 1)"""
_LATEST = _MET + """,
c AS (SELECT s_suppkey AS company_id, s_name AS company, n_name AS exchange, r_name AS peer_group, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS price
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
l AS (SELECT * FROM m JOIN c USING (company_id) QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY fiscal_year DESC) = 1),
p AS (SELECT peer_group, median(CASE WHEN eps > 0 AND price > 0 THEN price / eps END) AS peer_pe_multiple,
             median(CASE WHEN equity / nullif(shares, 0) > 0 AND price > 0 THEN price / (equity / shares) END) AS peer_pb_multiple,
             count(CASE WHEN eps > 0 AND price > 0 THEN 1 END) AS n_peers FROM l GROUP BY 1)"""
_SERIES = "WINDOW w AS (PARTITION BY instrument ORDER BY ts, trade_id)"
_ENR = """e AS (SELECT d.*, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' WHEN quality IS NOT NULL OR toxic IS NOT NULL OR l.doc_id IS NOT NULL THEN 'neutral' END AS sentiment
  FROM documents d LEFT JOIN labels l USING (doc_id))"""

ORACLE: dict[str, str] = {
    "valuation_gap": f"""WITH {_LATEST},
g AS (SELECT *, greatest(least(coalesce(fcf_growth, 0), 0.2::DOUBLE), -0.2::DOUBLE) AS gr FROM l LEFT JOIN p USING (peer_group)),
v AS (SELECT *, (fcf * list_sum(list_transform(range(1, 6), lambda n: pow(1 + gr, n) / pow(1.1::DOUBLE, n)))
                 + fcf * pow(1 + gr, 5) * 1.02::DOUBLE / 0.08::DOUBLE / pow(1.1::DOUBLE, 5)) / nullif(shares, 0) AS dcf0,
       CASE WHEN eps > 0 THEN peer_pe_multiple * eps END AS pe0, CASE WHEN equity / nullif(shares, 0) > 0 THEN peer_pb_multiple * equity / shares END AS pb0 FROM g),
x AS (SELECT *, CASE WHEN dcf0 > 0 THEN dcf0 END AS a, CASE WHEN pe0 > 0 THEN pe0 END AS b, CASE WHEN pb0 > 0 THEN pb0 END AS c FROM v),
y AS (SELECT *, list_filter([a, b, c], lambda q: q IS NOT NULL) AS vals FROM x),
z AS (SELECT *, list_min(vals) AS lo, list_median(vals) AS mid, list_max(vals) AS hi FROM y)
SELECT company_id, peer_group, fiscal_year, round(a, 4) AS value_dcf, round(b, 4) AS value_peer_pe, round(c, 4) AS value_peer_pb,
       round(lo, 4) AS lo, round(mid, 4) AS mid, round(hi, 4) AS hi, CAST(len(vals) AS BIGINT) AS n_models, round(price, 4) AS price, round((price - mid) / nullif(mid, 0), 4) AS gap FROM z""",
    "statements_by_year": f"""WITH {_ST} SELECT company_id, fiscal_year, round(revenue, 4) AS revenue, round(operating_income, 4) AS operating_income, round(net_income, 4) AS net_income,
       round(operating_cash_flow, 4) AS operating_cash_flow, round(capex, 4) AS capex, round(assets, 4) AS assets, round(liabilities, 4) AS liabilities,
       round(shares, 4) AS shares, round(equity, 4) AS equity, round(eps, 4) AS eps FROM st""",
    "statements_pivot_common": """
SELECT 'kr' AS source, l_suppkey AS company_id, CAST(year(l_shipdate) AS INTEGER) AS fiscal_year,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, round(sum(l_extendedprice * l_tax), 4) AS operating_income FROM lineitem GROUP BY 1, 2, 3
UNION ALL SELECT 'us', o_custkey, CAST(year(o_orderdate) AS INTEGER), round(sum(o_totalprice), 4), NULL FROM orders GROUP BY 1, 2, 3""",
    "fcf_eps_roe_growth": f"""WITH {_MET} SELECT company_id, fiscal_year, round(fcf, 4) AS fcf, round(eps, 4) AS eps, round(roe, 4) AS roe, round(roic, 4) AS roic,
       round(revenue_growth, 4) AS revenue_growth, round(fcf_growth, 4) AS fcf_growth FROM m""",
    "peer_multiples": f"WITH {_LATEST} SELECT peer_group, round(peer_pe_multiple, 4) AS peer_pe_multiple, round(peer_pb_multiple, 4) AS peer_pb_multiple, n_peers FROM p",
    "company_comparison": f"""WITH {_LATEST} SELECT company_id, company, exchange, peer_group, round(revenue, 4) AS revenue, round(eps, 4) AS eps, round(roe, 4) AS roe,
       row_number() OVER (PARTITION BY peer_group ORDER BY round(eps, 4) DESC NULLS LAST, company_id) AS eps_rank,
       row_number() OVER (PARTITION BY peer_group ORDER BY round(roe, 4) DESC NULLS LAST, company_id) AS roe_rank FROM l""",
    "bars_1s": _BARS.format(width="1 second", where=""),
    "bars_1m": _BARS.format(width="1 minute", where=""),
    "bars_5m": _BARS.format(width="5 minutes", where=""),
    "bars_1h": _BARS.format(width="1 hour", where=""),
    "vwap_5m": f"""WITH {_TICKS} SELECT instrument, time_bucket(INTERVAL '5 minutes', ts) AS bar_start, round(sum(price * qty) / nullif(sum(qty), 0), 8) AS vwap,
       CAST(sum(qty) AS BIGINT) AS volume, count(*) AS trades FROM t GROUP BY 1, 2""",
    "returns": f"WITH {_TICKS} SELECT instrument, trade_id, round((price - lag(price) OVER w) / nullif(lag(price) OVER w, 0), 4) AS ret FROM t {_SERIES}",
    "moving_avg": f"WITH {_TICKS} SELECT instrument, trade_id, round(avg(price) OVER (PARTITION BY instrument ORDER BY ts, trade_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 8) AS ma FROM t",
    "volatility": f"""WITH {_TICKS}, r AS (SELECT *, (price - lag(price) OVER w) / nullif(lag(price) OVER w, 0) AS ret FROM t {_SERIES})
SELECT instrument, trade_id, round(stddev_samp(ret) OVER (PARTITION BY instrument ORDER BY ts, trade_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 4) AS vol FROM r""",
    "volume_change": f"""WITH {_TICKS} SELECT instrument, trade_id, qty - lag(qty) OVER w AS qty_change,
       round(qty / nullif(avg(qty) OVER (PARTITION BY instrument ORDER BY ts, trade_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 0), 8) AS qty_ratio FROM t {_SERIES}""",
    "rsi_sma": f"""WITH {_TICKS}, d AS (SELECT *, price - lag(price) OVER w AS mv, row_number() OVER w AS rn FROM t {_SERIES}),
a AS (SELECT *, avg(greatest(mv, 0)) OVER f AS g, avg(greatest(-mv, 0)) OVER f AS l FROM d WINDOW f AS (PARTITION BY instrument ORDER BY ts, trade_id ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT instrument, trade_id, round(CASE WHEN rn <= 14 THEN NULL WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END, 4) AS rsi FROM a""",
    "rsi_wilder": f"""WITH RECURSIVE {_TICKS}, d AS (SELECT *, price - lag(price) OVER w AS mv, row_number() OVER w AS rn FROM t {_SERIES}),
s AS (SELECT instrument, CAST(15 AS BIGINT) AS rn, sum(greatest(mv, 0)) / 14 AS g, sum(greatest(-mv, 0)) / 14 AS l FROM d WHERE rn BETWEEN 2 AND 15 GROUP BY 1
      UNION ALL SELECT d.instrument, d.rn, (s.g * 13 + greatest(d.mv, 0)) / 14, (s.l * 13 + greatest(-d.mv, 0)) / 14 FROM s JOIN d ON d.instrument = s.instrument AND d.rn = s.rn + 1)
SELECT d.instrument, d.trade_id, round(CASE WHEN s.rn IS NULL THEN NULL WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END, 4) AS rsi FROM d LEFT JOIN s USING (instrument, rn)""",
    "volume_surge_tod": f"""WITH {_TICKS}, h AS (SELECT instrument, CAST(ts AS DATE) AS day, hour(ts) AS hour, CAST(sum(qty) AS BIGINT) AS volume FROM t GROUP BY 1, 2, 3),
u AS (SELECT *, avg(volume) OVER (PARTITION BY instrument, hour ORDER BY day ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS usual FROM h)
SELECT instrument, day, hour, volume, round(usual, 8) AS usual, round(volume / nullif(usual, 0), 8) AS ratio, coalesce(volume / nullif(usual, 0) >= 2, false) AS surge FROM u""",
    "latest_price": f"WITH {_TICKS} SELECT instrument, max(ts) AS ts, arg_max(price, (ts, trade_id)) AS price FROM t GROUP BY 1",
    "price_fx_asof": f"""WITH {_TICKS}, fx AS (SELECT ts AS fx_ts, price AS fx FROM t WHERE instrument = 'view'),
px AS (SELECT * FROM t WHERE instrument <> 'view')
SELECT instrument, trade_id, fx, round(price * fx, 4) AS converted FROM px ASOF LEFT JOIN fx ON px.ts >= fx.fx_ts""",
    "news_dedup": "SELECT sha256(lower(trim(text, ' '))) AS text_sha256, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1",
    "news_company_map": """SELECT DISTINCT doc_id, company FROM documents,
 (VALUES ('alpha', 'thanedble'), ('alpha', 'erineha'), ('beta', 'license'), ('gamma', 'enleauxai'), ('gamma', 'nicht')) a(company, alias) WHERE contains(lower(text), alias)""",
    "news_unenriched": "SELECT doc_id, lang FROM documents ANTI JOIN labels USING (doc_id)",
    "news_sentiment_mix": f"""WITH {_ENR} SELECT lang, count(*) FILTER (sentiment = 'positive') AS positive, count(*) FILTER (sentiment = 'neutral') AS neutral,
       count(*) FILTER (sentiment = 'negative') AS negative, count(*) FILTER (sentiment IS NULL) AS unlabelled FROM e GROUP BY 1""",
    "top_issues": f"""WITH {_ENR} SELECT source, doc_id, sentiment, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank
 FROM e WHERE sentiment IS NOT NULL QUALIFY rank <= 3""",
    "macro_yoy": """WITH s AS (SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum(o_totalprice) AS value FROM orders GROUP BY 1, 2)
SELECT s.series_id, s.month, round(s.value, 4) AS value, round((s.value - b.value) / nullif(abs(b.value), 0), 4) AS yoy
FROM s LEFT JOIN s b ON b.series_id = s.series_id AND b.month = s.month - INTERVAL 12 MONTH""",
    "enabled_companies": """WITH c(place, company_id, name_ko, ticker, currency) AS (VALUES (0, 'samsung_electronics', '삼성전자', '005930', 'KRW'), (1, 'sk_hynix', 'SK하이닉스', '000660', 'KRW'))
 SELECT company_id, name_ko, ticker, currency, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN c ON o_custkey % 2 = place GROUP BY ALL""",
    "bronze_json_roundtrip": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '{\"k\":' || json_extract_string(props, '$.k') || '}' AS again FROM events",
    "stream_bars_5m_complete": _BARS.format(width="5 minutes", where=""),
    "stream_bars_5m_append": _BARS.format(width="5 minutes", where="WHERE time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' <= (SELECT max(ts) - INTERVAL '10 minutes' FROM events)"),
    "stream_volume_surge": f"""WITH {_TICKS}, h AS (SELECT instrument, time_bucket(INTERVAL '1 hour', ts) AS bar_start, CAST(sum(qty) AS BIGINT) AS volume FROM t GROUP BY 1, 2),
u AS (SELECT instrument, hour(bar_start) AS hr, avg(volume) AS usual FROM h GROUP BY 1, 2)
SELECT h.instrument, bar_start, volume, round(usual, 8) AS usual, coalesce(volume / nullif(usual, 0) >= 1.5, false) AS surge FROM h LEFT JOIN u ON u.instrument = h.instrument AND u.hr = hour(bar_start)""",
    "stream_dedup": "SELECT event_type AS instrument, count(DISTINCT event_id) AS n FROM events GROUP BY 1",
}
