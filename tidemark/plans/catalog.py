"""Queries over the tables, by name.  Each takes (spark, base) and returns a frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import streaming
from tidemark.operators import macro, market, news, ranking, statements, valuation
from tidemark.sources.layers import payload_field
from tidemark.sources.registry import companies_frame
from tidemark.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: The demonstration alias list of the company map.
ALIASES = [("alpha", "thanedble"), ("alpha", "erineha"), ("beta", "license"), ("gamma", "enleauxai"), ("gamma", "nicht")]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _r(name: str, digits: int = 4) -> Column:
    return F.round(name, digits).alias(name)


def _ticks(spark: SparkSession, base: str) -> DataFrame:
    return market.ticks(table(spark, base, "events"))


def _statements(spark: SparkSession, base: str) -> DataFrame:
    return statements.yearly_statements(table(spark, base, "lineitem"))


def _companies(spark: SparkSession, base: str) -> DataFrame:
    """Company, its name, peer group (region) and price; a price that is not positive is missing."""
    s, n, r = (table(spark, base, t) for t in ("supplier", "nation", "region"))
    joined = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return joined.select(
        F.col("s_suppkey").alias("company_id"), F.col("s_name").alias("company"), F.col("n_name").alias("exchange"),
        F.col("r_name").alias("peer_group"), F.expr("case when s_acctbal > 0 then s_acctbal end").alias("price"),
    )


def _latest(spark: SparkSession, base: str) -> DataFrame:
    return statements.latest_statements(statements.with_metrics(_statements(spark, base))).join(_companies(spark, base), "company_id")


def _enriched(spark: SparkSession, base: str) -> DataFrame:
    """Stand-in results: quality 1 is positive, 0 neutral; toxic is negative."""
    labels = table(spark, base, "labels").select("doc_id", F.expr("case when toxic = 1 then 'negative' when quality = 1 then 'positive' else 'neutral' end").alias("sentiment"))
    return news.with_results(table(spark, base, "documents").select("doc_id", "lang", "source", "n_chars"), labels)


@query
def valuation_gap(spark, base):
    latest = _latest(spark, base)
    frame = latest.join(valuation.peer_multiples(latest), "peer_group", "left")
    out = valuation.value_range(valuation.value_with(frame))
    return out.select("company_id", "peer_group", "fiscal_year", _r("value_dcf"), _r("value_peer_pe"), _r("value_peer_pb"), _r("lo"), _r("mid"), _r("hi"), "n_models", _r("price"), _r("gap"))


@query
def statements_by_year(spark, base):
    return _statements(spark, base).select("company_id", "fiscal_year", *(_r(c) for c in (*statements.ITEMS, "equity")), _r("eps"))


@query
def statements_pivot_common(spark, base):
    line = table(spark, base, "lineitem").groupBy(F.col("l_suppkey").alias("company_id"), F.year("l_shipdate").alias("fiscal_year")).agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"), F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("op")
    )
    order = table(spark, base, "orders").groupBy(F.col("o_custkey").alias("company_id"), F.year("o_orderdate").alias("fiscal_year")).agg(F.sum("o_totalprice").alias("rev"))
    keys = ["company_id", "fiscal_year"]
    facts = [
        statements.long_facts(line, keys, "kr", {"ifrs-full_Revenue": F.col("rev"), "dart_OperatingIncomeLoss": F.col("op")}),
        statements.long_facts(order, keys, "us", {"Revenues": F.col("rev"), "OtherNote": F.lit(1.0)}),
    ]
    return statements.to_common_schema(facts).select("source", *keys, _r("revenue"), _r("operating_income"))


@query
def fcf_eps_roe_growth(spark, base):
    m = statements.with_metrics(_statements(spark, base))
    return m.select("company_id", "fiscal_year", _r("fcf"), _r("eps"), _r("roe"), _r("roic"), _r("revenue_growth"), _r("fcf_growth"))


@query
def peer_multiples(spark, base):
    return valuation.peer_multiples(_latest(spark, base)).select("peer_group", _r("peer_pe_multiple"), _r("peer_pb_multiple"), "n_peers")


@query
def company_comparison(spark, base):
    """Each company's place in its region; a region is never sorted in one task."""
    f = _latest(spark, base).select("company_id", "company", "exchange", "peer_group", _r("revenue"), _r("eps"), _r("roe"))
    for c in ("eps", "roe"):
        f = ranking.numbered_down(f, ["peer_group"], F.col(c), ["company_id"], f"{c}_rank")
    return f


def _bar_rows(frame: DataFrame) -> DataFrame:
    return frame.select("instrument", F.col("bar_start").cast("timestamp_ntz").alias("bar_start"), "open", "high", "low", "close", "volume", "trades")


@query
def bars_1s(spark, base):
    return _bar_rows(market.bars(_ticks(spark, base), "1 second"))


@query
def bars_1m(spark, base):
    return _bar_rows(market.bars(_ticks(spark, base), "1 minute"))


@query
def bars_5m(spark, base):
    return _bar_rows(market.bars(_ticks(spark, base), "5 minutes"))


@query
def bars_1h(spark, base):
    return _bar_rows(market.bars(_ticks(spark, base), "1 hour"))


@query
def vwap_5m(spark, base):
    return market.vwap(_ticks(spark, base), "5 minutes").select("instrument", "bar_start", _r("vwap", 8), "volume", "trades")


@query
def returns(spark, base):
    return market.returns(_ticks(spark, base)).select("instrument", "trade_id", _r("ret"))


@query
def moving_avg(spark, base):
    return market.moving_average(_ticks(spark, base)).select("instrument", "trade_id", _r("ma", 8))


@query
def volatility(spark, base):
    return market.volatility(_ticks(spark, base)).select("instrument", "trade_id", _r("vol"))


@query
def volume_change(spark, base):
    return market.volume_change(_ticks(spark, base)).select("instrument", "trade_id", "qty_change", _r("qty_ratio", 8))


@query
def rsi_sma(spark, base):
    return market.rsi_sma(_ticks(spark, base)).select("instrument", "trade_id", _r("rsi"))


@query
def rsi_wilder(spark, base):
    return market.rsi_wilder(_ticks(spark, base)).select("instrument", "trade_id", _r("rsi"))


@query
def volume_surge_tod(spark, base):
    out = market.volume_surge(_ticks(spark, base))
    return out.select("instrument", "day", F.col("hour").cast("long").alias("hour"), "volume", _r("usual", 8), _r("ratio", 8), "surge")


@query
def latest_price(spark, base):
    return market.latest_price(_ticks(spark, base))


@query
def price_fx_asof(spark, base):
    """Prices of every instrument but 'view' converted at the rate in force: the last 'view' tick no later.  Sorted by hours, rates carried over."""
    all_ticks = _ticks(spark, base)
    fx = all_ticks.where("instrument = 'view'").select(F.col("ts").alias("fx_ts"), F.col("price").alias("fx"))
    px = all_ticks.where("instrument <> 'view'").select("instrument", "ts", "trade_id", "price")
    out = market.as_of(px, fx, [], "ts", "fx_ts", "fx", "trade_id", salt="date_trunc('hour', _ts)")
    return out.select("instrument", "trade_id", "fx", F.round(F.col("price") * F.col("fx"), 4).alias("converted"))


@query
def news_dedup(spark, base):
    return news.dedup(table(spark, base, "documents"))


@query
def news_company_map(spark, base):
    return news.map_companies(table(spark, base, "documents"), ALIASES)


@query
def news_unenriched(spark, base):
    return news.unenriched(table(spark, base, "documents"), table(spark, base, "labels")).select("doc_id", "lang")


@query
def news_sentiment_mix(spark, base):
    return news.sentiment_mix(_enriched(spark, base), "lang")


@query
def top_issues(spark, base):
    return news.top_issues(_enriched(spark, base), "source", 3).select("source", "doc_id", "sentiment", "n_chars", F.col("rank").cast("long").alias("rank"))


@query
def macro_yoy(spark, base):
    out = macro.year_on_year(macro.monthly_totals(table(spark, base, "orders")))
    return out.select("series_id", F.col("month").cast("date").alias("month"), _r("value"), _r("yoy"))


@query
def enabled_companies(spark, base):
    """Orders of the enabled companies; an order's company is its customer's place in the registry (stand-in for a listing)."""
    companies = companies_frame(spark).where("enabled").withColumn("place", F.row_number().over(Window.orderBy("company_id")) - 1)
    orders = table(spark, base, "orders").withColumn("place", F.pmod("o_custkey", F.lit(companies.count())).cast("int"))
    return orders.join(F.broadcast(companies), "place").groupBy("company_id", "name_ko", "ticker", "currency").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query
def bronze_json_roundtrip(spark, base):
    return table(spark, base, "events").select("event_id", payload_field("props", "$.k", "BIGINT").alias("k"), F.to_json(F.struct(payload_field("props", "$.k", "BIGINT").alias("k"))).alias("again"))


@query
def stream_bars_5m_complete(spark, base):
    ticks = market.ticks(streaming.file_stream(spark, base, "events"))
    return _bar_rows(streaming.run_to_table(market.bars(ticks, "5 minutes"), "complete"))


@query
def stream_bars_5m_append(spark, base):
    ticks = market.ticks(streaming.file_stream(spark, base, "events"))
    return _bar_rows(streaming.run_to_table(streaming.windowed_bars(ticks, "5 minutes"), "append"))


@query
def stream_volume_surge(spark, base):
    """Hourly volume of the stream against the mean volume of that hour of day over the batch table."""
    history = market.hourly_volume(_ticks(spark, base))
    usual = history.groupBy("instrument", F.col("hour")).agg(F.avg("volume").alias("usual"))
    live = market.bars(market.ticks(streaming.file_stream(spark, base, "events")), "1 hour")
    out = streaming.run_to_table(streaming.surge_against(live, usual, 1.5), "complete")
    return out.select("instrument", F.col("bar_start").cast("timestamp_ntz").alias("bar_start"), "volume", _r("usual", 8), "surge")


@query
def stream_dedup(spark, base):
    events = streaming.file_stream(spark, base, "events")
    doubled = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    unique = streaming.deduplicated(doubled, "event_id")
    return streaming.run_to_table(unique.groupBy("event_type").agg(F.count("*").alias("n")), "complete").withColumnRenamed("event_type", "instrument")
