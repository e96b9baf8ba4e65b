"""DuckDB SQL of the queries in ``live``."""

from tidemark.plans.oracle import _BARS, ORACLE

_PAIRS = """c AS (SELECT DISTINCT ON (click_id) click_id, client_id, kind, ts FROM clicks WHERE ts IS NOT NULL),
 p AS (SELECT sale_id, s.client_id, click_id, kind, epoch_us(sold_at) - epoch_us(ts) AS us_before FROM sales s JOIN c ON c.client_id = s.client_id AND ts BETWEEN sold_at - INTERVAL 30 MINUTE AND sold_at)"""

LIVE = {
    "stream_sales_after_clicks": f"WITH {_PAIRS} SELECT * FROM p",
    "stream_sales_without_clicks": f"""WITH {_PAIRS}, w AS (SELECT least((SELECT max(sold_at) FROM sales WHERE client_id IS NOT NULL), (SELECT max(ts) FROM clicks)) - INTERVAL 10 MINUTE AS upto)
 SELECT sale_id, client_id FROM sales, w WHERE client_id IS NOT NULL AND sold_at < upto AND sale_id NOT IN (SELECT sale_id FROM p)""",
    "stream_bars_chained": _BARS.format(width="5 minutes", where="WHERE time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' <= (SELECT max(ts) - INTERVAL '10 minutes' FROM events)"),
    "stream_silent_instruments": """WITH t AS (SELECT event_type AS instrument, ts, lead(ts) OVER (PARTITION BY event_type ORDER BY ts) AS nxt FROM events)
 SELECT instrument, epoch_us(ts) AS last_us FROM t WHERE coalesce(nxt - ts >= INTERVAL 45 MINUTE, true) AND ts + INTERVAL 45 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
    "stream_two_stores": """SELECT kind, count(*) AS n, count(DISTINCT click_id) AS clicks, round(sum(value), 4) AS value, store FROM clicks, (VALUES ('columns'), ('lines')) v(store) GROUP BY kind, store""",
}
ORACLE.update(LIVE)
