"""DuckDB SQL of the queries in ``scale``."""

from tidemark.plans.oracle import ORACLE

_ALL = "w AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + {days} AS b FROM orders)"
_W = _ALL.replace("FROM orders", "FROM orders WHERE o_totalprice > 400000")

SCALE = {
    "shipments_in_order_windows": f"WITH {_W.format(days=7)} SELECT o_orderkey, count(*) AS lines, sum(l_quantity) AS quantity FROM w JOIN lineitem ON CAST(l_shipdate AS DATE) BETWEEN a AND b GROUP BY 1",
    "line_windows": f"WITH {_W.format(days=30)} SELECT l_returnflag, count(*) AS pairs, count(DISTINCT o_orderkey) AS windows FROM w JOIN lineitem ON CAST(l_shipdate AS DATE) BETWEEN a AND b GROUP BY 1",
    "overlapping_order_windows": f"""WITH {_ALL.format(days=3)}, {_ALL.format(days=10).replace('w AS', 'v AS')} SELECT w.o_orderkey, count(*) AS n, min(v.o_orderkey) AS least, max(v.o_orderkey) AS most
 FROM w JOIN v ON w.a <= v.b AND v.a <= w.b AND w.o_orderkey <> v.o_orderkey GROUP BY 1""",
    "news_aliases": r"""WITH b AS (SELECT item_id AS company, regexp_extract_all(lower(text), '[a-z]+') AS w FROM benchmark),
 n AS (SELECT company, unnest(w) AS alias FROM b UNION SELECT company, unnest(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) FROM b),
 a AS (SELECT * FROM n WHERE length(alias) >= 6 OR alias LIKE '% %'),
 d AS (SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w, string_split_regex(lower(text), '[\p{L}\p{N}_]+') AS g FROM documents WHERE text <> ''),
 t AS (SELECT DISTINCT uid, doc_id, unnest(w) AS alias FROM d UNION SELECT uid, doc_id, unnest(list_transform(list_filter(range(1, len(w)), lambda k: g[k + 1] = ' '), lambda k: w[k] || ' ' || w[k + 1])) FROM d)
 SELECT doc_id, company, count(*) AS aliases FROM t JOIN a USING (alias) GROUP BY 1, 2""",
    "price_quantiles": "SELECT l_returnflag, l_linestatus, count(*) AS n, round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM lineitem GROUP BY 1, 2",
    "price_sketches": "SELECT l_returnflag, l_linestatus, count(*) AS n, true AS within FROM lineitem GROUP BY 1, 2",
}
ORACLE.update(SCALE)
