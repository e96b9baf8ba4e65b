"""Further queries: what the dashboard, the stores and the streams are served."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import streaming
from tidemark.functions import extensions
from tidemark.operators import market, news, statements, valuation
from tidemark.plans.catalog import ALIASES, _bar_rows, _companies, _enriched, _latest, _r, _statements, _ticks, query
from tidemark.session import shared_folder
from tidemark.sources import gold, layers, silver
from tidemark.sources.tables import read_any, table

#: The instrument whose price stands in for that of a company, by the company's number.
INSTRUMENTS = ("click", "error", "purchase", "signup", "view")


def _store(spark) -> layers.LakeStore:
    store = layers.LakeStore(spark, f"{shared_folder(spark)}/lake-{uuid.uuid4().hex}")
    store.create_layers()
    return store


@query
def valuation_vs_market(spark, base):
    """The valuation of every company against the latest traded price."""
    names = F.array(*map(F.lit, INSTRUMENTS))
    priced = _companies(spark, base).drop("price").withColumn("instrument", F.get(names, (F.col("company_id") % len(INSTRUMENTS)).cast("int")))
    prices = market.latest_price(_ticks(spark, base)).select("instrument", "price", F.col("ts").alias("price_ts"))
    latest = statements.latest_statements(statements.with_metrics(_statements(spark, base))).join(priced.join(prices, "instrument", "left"), "company_id")
    out = valuation.value_range(valuation.value_with(latest.join(valuation.peer_multiples(latest), "peer_group", "left")))
    return out.select("company_id", "instrument", "price_ts", _r("price"), _r("lo"), _r("mid"), _r("hi"), "n_models", _r("gap"))


@query
def valuation_residual_income(spark, base):
    """A further model from the registry, by itself."""
    models = {"residual": valuation.EXTRA["residual"]}
    return valuation.value_with(_latest(spark, base), models).select("company_id", _r("value_residual"))


@query
def balance_rollup(spark, base):
    """Balances by region and nation, with sub-totals."""
    s, n, r = (table(spark, base, t) for t in ("supplier", "nation", "region"))
    joined = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return joined.rollup("r_name", "n_name").agg(F.round(F.sum("s_acctbal"), 4).alias("balance"), F.count("*").alias("n"), F.grouping_id().cast("long").alias("level"))


@query
def orders_cube(spark, base):
    return table(spark, base, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("level"))


@query
def orders_grouping_sets(spark, base):
    o = table(spark, base, "orders")
    return o.groupingSets([[o.o_orderstatus], [o.o_orderpriority], []], o.o_orderstatus, o.o_orderpriority).agg(F.count("*").alias("n"))


@query
def distinct_customers(spark, base):
    """Distinct customers by priority, exact, and whether the sketch is within its error."""
    out = table(spark, base, "orders").groupBy("o_orderpriority").agg(F.countDistinct("o_custkey").alias("exact"), F.approx_count_distinct("o_custkey", 0.02).alias("approx"))
    return out.select("o_orderpriority", "exact", (F.abs(F.col("approx") - F.col("exact")) <= 0.1 * F.col("exact")).alias("close"))


def _hours(spark, base):
    return market.bars(_ticks(spark, base), "1 hour").withColumn("bar_start", F.col("bar_start").cast("timestamp_ntz"))


@query
def busiest_hours(spark, base):
    """The hours of a day by volume, ranked in every way."""
    day = Window.partitionBy("instrument", F.to_date("bar_start"))
    by, ties = day.orderBy(F.col("volume").desc()), day.orderBy(F.col("volume").desc(), "bar_start")
    long = lambda c: c.cast("long")
    return _hours(spark, base).select(
        "instrument", "bar_start", "volume", long(F.rank().over(by)).alias("rank"), long(F.dense_rank().over(by)).alias("dense_rank"),
        long(F.ntile(4).over(ties)).alias("quarter"), F.round(F.cume_dist().over(by), 6).alias("cume_dist"), F.round(F.percent_rank().over(by), 6).alias("percent_rank"),
    )


@query
def volume_last_3h(spark, base):
    """Volume of the last three hours by the clock (RANGE frame), whatever bars are missing."""
    seconds = F.unix_timestamp(F.col("bar_start").cast("timestamp"))
    w = Window.partitionBy("instrument").orderBy(seconds).rangeBetween(-7200, 0)
    return _hours(spark, base).select("instrument", "bar_start", F.sum("volume").over(w).alias("volume_3h"), F.count("*").over(w).alias("bars"))


@query
def statement_trend(spark, base):
    """Each company's years in order, with the running total.  Sums end on half cents, so rows are added up in the table's order."""
    st = statements.revenue_in_order(table(spark, base, "lineitem"), F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    w = Window.partitionBy("company_id").orderBy("fiscal_year")
    cents = F.round(F.col("revenue") * 100).cast("long")
    out = st.select("company_id", "fiscal_year", cents.alias("revenue_cents"), F.sum(cents).over(w).alias("cents_to_date"), F.row_number().over(w).cast("long").alias("n_years"))
    return out.orderBy("company_id", "fiscal_year")


@query
def news_page(spark, base):
    """The second page of the longest news (twenty a page)."""
    return table(spark, base, "documents").select("doc_id", "n_chars").orderBy(F.col("n_chars").desc(), "doc_id").offset(20).limit(20)


@query
def nations_with_both(spark, base):
    return table(spark, base, "customer").select(F.col("c_nationkey").alias("nation")).intersect(table(spark, base, "supplier").select(F.col("s_nationkey").alias("nation")))


@query
def customers_without_orders(spark, base):
    return table(spark, base, "customer").select(F.col("c_custkey").alias("custkey")).exceptAll(table(spark, base, "orders").select(F.col("o_custkey").alias("custkey")).distinct())


@query
def nation_sides(spark, base):
    """Customers and suppliers by nation, whichever side a nation has (full outer join)."""
    c = table(spark, base, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("customers"))
    s = table(spark, base, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("suppliers"))
    return c.join(s, "nation", "full").select("nation", F.coalesce("customers", F.lit(0)).alias("customers"), F.coalesce("suppliers", F.lit(0)).alias("suppliers"))


@query
def news_enriched(spark, base):
    """News that have results already (semi join)."""
    return table(spark, base, "documents").select("doc_id", "lang").join(table(spark, base, "labels"), "doc_id", "left_semi")


@query
def order_predicates(spark, base):
    """Three-valued logic, patterns, ranges and lists in one filter."""
    o = table(spark, base, "orders")
    kept = o.where(F.col("o_orderpriority").like("%-%") & (F.col("o_totalprice").between(1000, 250_000) | F.col("o_orderstatus").isNull()) & ~F.col("o_orderstatus").isin("P"))
    size = F.when(F.col("o_totalprice") < 50_000, "small").when(F.col("o_totalprice") < 150_000, "middle").otherwise("large")
    return kept.groupBy(size.alias("size"), "o_orderstatus").agg(F.count("*").alias("n"))


@query
def silver_ticks(spark, base):
    """Events typed, trimmed, checked and deduplicated; and why a row was turned away."""
    out = silver.clean_ticks(table(spark, base, "events"))
    return out.groupBy("instrument", "fault").agg(F.count("*").alias("n"), F.sum("qty").alias("qty"))


@query
def news_keywords(spark, base):
    """The three most frequent long words of each text."""
    return news.keywords(table(spark, base, "documents").select("doc_id", "text"), 3).select("doc_id", F.array_join("keywords", ",").alias("keywords"))


@query
def company_sentiment(spark, base):
    mapped = news.map_companies(table(spark, base, "documents"), ALIASES).join(_enriched(spark, base), "doc_id")
    return news.sentiment_mix(mapped, "company")


@query
def gap_by_function(spark, base):
    """The registered SQL functions at work."""
    extensions.register(spark)
    _companies(spark, base).createOrReplaceTempView("companies_now")
    return spark.sql("SELECT company_id, round(relative_gap(price, 5000D), 4) AS gap, clamped(price, 0D, 1000D) AS price FROM companies_now")


@query
def gold_sentiment(spark, base):
    """Written as a gold table, read back by SQL through the catalog."""
    gold.publish(news.sentiment_mix(_enriched(spark, base), "lang"), "sentiment_mix")
    return spark.sql(f"SELECT lang, positive, neutral, negative, unlabelled FROM {gold.DATABASE}.sentiment_mix")


@query
def gold_dashboard(spark, base):
    """The dashboard's company view over two gold tables."""
    f = _latest(spark, base)
    gold.publish(f.select("company_id", "company", "peer_group", "fiscal_year", _r("revenue"), _r("eps"), _r("roe")), "company_metrics")
    gold.publish(valuation.value_range(valuation.value_with(f.join(valuation.peer_multiples(f), "peer_group", "left"))).select("company_id", _r("lo"), _r("mid"), _r("hi"), _r("price"), _r("gap")), "valuation")
    gold.create_views(spark)
    return spark.table(f"{gold.DATABASE}.company_overview")


@query
def company_document_roundtrip(spark, base):
    """Nations by region as one JSON document in bronze (as many rows as there are nations), written, read back and joined to their customers."""
    store = _store(spark)
    rows = table(spark, base, "nation").join(table(spark, base, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "n_nationkey", "n_name").collect()
    document = {region: {r.n_name: r.n_nationkey for r in rows if r.r_name == region} for region in sorted({r.r_name for r in rows})}
    store.put_json(layers.Layer.BRONZE, "reference/nations.json", document)
    read = store.get_json(layers.Layer.BRONZE, "reference/nations.json")
    nations = spark.createDataFrame([(region, name, key) for region, names in read.items() for name, key in names.items()], "region string, nation string, c_nationkey int")
    return table(spark, base, "customer").join(F.broadcast(nations), "c_nationkey").groupBy("region", "nation").agg(F.count("*").alias("customers"))


@query
def clients_without_sales(spark, base):
    """Clients of whom no sale is known, each once."""
    return table(spark, base, "clients").select("client_id").exceptAll(table(spark, base, "sales").select("client_id").distinct())


@query
def bronze_rows_roundtrip(spark, base):
    """Raw events as JSON lines in bronze, read back under a schema, then Parquet in silver."""
    store = _store(spark)
    store.write_json_rows(layers.Layer.BRONZE, "events", table(spark, base, "events").select("event_id", "event_type", "value", "props"))
    read = store.read_json_rows(layers.Layer.BRONZE, "events", "event_id long, event_type string, value double, props string")
    store.write_rows(layers.Layer.SILVER, "events", read, ("event_type",))
    out = store.read_rows(layers.Layer.SILVER, "events").groupBy("event_type")
    return out.agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"), F.sum(layers.payload_field("props", "$.k", "BIGINT")).alias("k"))


@query
def formats_roundtrip(spark, base):
    """Nations through every file format."""
    folder, nations, out = f"{shared_folder(spark)}/formats-{uuid.uuid4().hex}", table(spark, base, "nation"), None
    for fmt, options in {"csv": {"header": "true"}, "json": {}, "orc": {}, "parquet": {}, "xml": {"rowTag": "row"}}.items():
        nations.write.format(fmt).options(**options).save(f"{folder}/{fmt}")
        read = read_any(spark, fmt, f"{folder}/{fmt}", "n_nationkey int, n_name string, n_regionkey int", **options).withColumn("format", F.lit(fmt))
        out = read if out is None else out.unionByName(read)
    return out


def _stream(spark, base):
    return market.ticks(streaming.file_stream(spark, base, "events"))


@query
def stream_bars_1s(spark, base):
    return _bar_rows(streaming.run_to_table(market.bars(_stream(spark, base), "1 second"), "complete"))


@query
def stream_bars_1m(spark, base):
    return _bar_rows(streaming.run_to_table(market.bars(_stream(spark, base), "1 minute"), "complete"))


@query
def stream_vwap_5m(spark, base):
    out = streaming.run_to_table(market.vwap(_stream(spark, base), "5 minutes"), "complete")
    return out.select("instrument", F.col("bar_start").cast("timestamp_ntz").alias("bar_start"), _r("vwap", 8), "volume", "trades")


@query
def stream_sliding_15m(spark, base):
    """Volume of the last fifteen minutes, every five."""
    out = _stream(spark, base).groupBy("instrument", F.window("ts", "15 minutes", "5 minutes").alias("w")).agg(F.sum("qty").alias("volume"), F.count("*").alias("trades"))
    return streaming.run_to_table(out.select("instrument", F.col("w.start").cast("timestamp_ntz").alias("start"), "volume", "trades"), "complete")


@query
def stream_sessions(spark, base):
    """Trading bursts: ticks less than ten minutes apart."""
    out = _stream(spark, base).groupBy("instrument", F.session_window("ts", "10 minutes").alias("w")).agg(F.count("*").alias("trades"), F.sum("qty").alias("volume"))
    return streaming.run_to_table(out.select("instrument", F.col("w.start").cast("timestamp_ntz").alias("start"), "trades", "volume"), "complete")


@query
def stream_extremes(spark, base):
    """Own state per instrument: ticks seen, highest and lowest price so far."""
    return streaming.run_to_table(streaming.extremes(_stream(spark, base)), "update", ["instrument"])
