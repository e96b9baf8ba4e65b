"""DuckDB SQL of the queries in ``stores``."""

from tidemark.plans.oracle import ORACLE

_J = "j AS (SELECT click_id, CASE WHEN props IS NULL THEN 'missing' WHEN NOT json_valid(props) THEN 'broken' END AS fault, CASE WHEN json_valid(props) THEN CAST(props AS JSON) END AS p FROM clicks)"
_F = """f AS (SELECT l_suppkey AS company_id, CAST(year(o_orderdate) AS INTEGER) AS fiscal_year, CAST(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH AS DATE) AS filed_from,
 CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3),
 v AS (SELECT company_id, fiscal_year, filed_from, lead(filed_from) OVER w AS filed_to, row_number() OVER w AS version, cents, lines FROM f WINDOW w AS (PARTITION BY company_id, fiscal_year ORDER BY filed_from))"""

STORES = {
    "clicks_by_device": f"""WITH {_J} SELECT json_extract_string(p, '$.device.os') AS system, fault, count(*) AS n, CAST(sum(TRY_CAST(json_extract_string(p, '$.k') AS BIGINT)) AS BIGINT) AS k FROM j GROUP BY 1, 2""",
    "clicks_keys": f"""WITH {_J}, k AS (SELECT p, unnest(json_keys(p)) AS key FROM j WHERE p IS NOT NULL)
 SELECT key, CASE json_type(p, '$."' || key || '"') WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'truth' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind, count(*) AS n FROM k GROUP BY 1, 2""",
    "clicks_items": f"""WITH {_J}, i AS (SELECT unnest(CAST(json_extract(p, '$.items') AS JSON[])) AS x FROM j WHERE json_type(p, '$.items') = 'ARRAY')
 SELECT CAST(x->>'$.sku' AS BIGINT) AS sku, count(*) AS n, CAST(sum(CAST(x->>'$.qty' AS BIGINT)) AS BIGINT) AS qty FROM i GROUP BY 1""",
    "statement_versions": f"WITH {_F} SELECT * FROM v",
    "statement_versions_merged": f"WITH {_F} SELECT * FROM v",
    "statements_as_filed": f"WITH {_F} SELECT company_id, fiscal_year, filed_from, version, cents FROM v WHERE filed_from <= DATE '1998-06-30' AND (filed_to IS NULL OR filed_to > DATE '1998-06-30')",
    "clients_as_of": """WITH c AS (SELECT * FROM client_changes WHERE valid_at <= TIMESTAMP '2024-02-15 12:00:00' QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY valid_at DESC, seq DESC, change_id DESC) = 1)
 SELECT client_id, seq, segment, city, balance FROM c WHERE op <> 'D'""",
    "client_tree": """WITH RECURSIVE c AS (SELECT client_id, max((master_id, CAST(round(coalesce(balance, 0) * 100) AS BIGINT))) AS r FROM clients WHERE client_id IS NOT NULL GROUP BY 1),
 n AS (SELECT client_id, r[1] AS up, r[2] AS cents FROM c),
 l AS (SELECT client_id, CASE WHEN up <> client_id AND up IN (SELECT client_id FROM n) THEN up END AS up, cents FROM n),
 t AS (SELECT client_id AS root, client_id, 0 AS depth FROM l WHERE up IS NULL UNION ALL SELECT root, l.client_id, depth + 1 FROM t JOIN l ON l.up = t.client_id),
 a AS (SELECT client_id AS node, client_id AS below FROM t UNION ALL SELECT a.node, l.client_id FROM a JOIN l ON l.up = a.below),
 s AS (SELECT node, count(*) AS members, CAST(sum(cents) AS BIGINT) AS total FROM a JOIN l ON l.client_id = a.below GROUP BY 1)
 SELECT l.client_id, root, CAST(depth AS BIGINT) AS depth, members, total FROM l LEFT JOIN t USING (client_id) LEFT JOIN s ON s.node = t.client_id""",
    "bucketed_sales": """SELECT segment, count(*) AS n, round(sum(total), 2) AS total FROM sales JOIN (SELECT client_id, max(segment) AS segment FROM clients GROUP BY 1) USING (client_id) GROUP BY 1""",
    "daily_drawdowns": """WITH t AS (SELECT event_type AS instrument, CAST(ts AS DATE) AS day, max(value) OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts) - value AS fall FROM events)
 SELECT instrument, day, count(*) AS n, round(max(fall), 4) AS drawdown FROM t GROUP BY 1, 2""",
    "weighted_median_price": """WITH g AS (SELECT item_id, amount, sum(quantity) AS w FROM sale_lines WHERE amount IS NOT NULL AND quantity > 0 GROUP BY 1, 2),
 t AS (SELECT *, sum(w) OVER (PARTITION BY item_id ORDER BY amount) AS upto, sum(w) OVER (PARTITION BY item_id) AS whole FROM g)
 SELECT i.item_id, round(min(amount) FILTER (2 * upto >= whole), 4) AS price FROM (SELECT DISTINCT item_id FROM sale_lines) i LEFT JOIN t ON t.item_id IS NOT DISTINCT FROM i.item_id GROUP BY 1""",
    "news_enriched_once": """WITH d AS (SELECT lang, CASE WHEN text IS NOT NULL THEN length(trim(text, ' ')) % 3 END AS k, sha256(lower(trim(text, ' '))) AS t FROM documents)
 SELECT lang, count(*) FILTER (k = 0) AS positive, count(*) FILTER (k = 1) AS neutral, count(*) FILTER (k = 2) AS negative, count(*) FILTER (k IS NULL) AS unlabelled, (SELECT count(DISTINCT t) FROM d) AS paid FROM d GROUP BY 1""",
}
ORACLE.update(STORES)
