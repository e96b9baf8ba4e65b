"""Queries over stored forms: variants, versions, trees, buckets, and functions over tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions import tables as table_functions
from tidemark.operators import hierarchy, news, versions
from tidemark.plans.catalog import _r, query
from tidemark.session import shared_folder
from tidemark.sources import gold, semi
from tidemark.sources.layers import Layer, LakeStore
from tidemark.sources.tables import table


def _bronze_clicks(spark, base):
    """Clicks with their props as a variant, written to bronze and read back."""
    store = LakeStore(spark, f"{shared_folder(spark)}/lake-{uuid.uuid4().hex}")
    store.write_rows(Layer.BRONZE, "clicks", semi.parsed(table(spark, base, "clicks").select("click_id", "kind", "props"), "props"))
    return store.read_rows(Layer.BRONZE, "clicks")


@query
def clicks_by_device(spark, base):
    """Typed fields of a variant, with what is missing or broken counted."""
    clicks = _bronze_clicks(spark, base)
    system = semi.field("props", "$.device.os", "string").alias("system")
    return clicks.groupBy(system, "fault").agg(F.count("*").alias("n"), F.sum(semi.field("props", "$.k", "bigint")).alias("k"))


@query
def clicks_keys(spark, base):
    """Which keys the props have, and of what kind their values are."""
    out = semi.exploded(_bronze_clicks(spark, base), "props")
    return out.groupBy("key", semi.kind_of(F.col("value")).alias("kind")).agg(F.count("*").alias("n"))


@query
def clicks_items(spark, base):
    """Quantities by article, from arrays inside the props."""
    clicks = _bronze_clicks(spark, base).select("click_id", F.try_variant_get("props", "$.items", "variant").alias("items"))
    rows = semi.exploded(clicks, "items")
    return rows.groupBy(semi.field("value", "$.sku", "bigint").alias("sku")).agg(F.count("*").alias("n"), F.sum(semi.field("value", "$.qty", "bigint")).alias("qty"))


KEYS = ["company_id", "fiscal_year"]


def _filings(spark, base):
    """Stand-in for filings: a company's sales of a fiscal year (that of the order), filed again after each quarter in which more of it was shipped."""
    line, order = table(spark, base, "lineitem"), table(spark, base, "orders")
    joined = line.join(order, line.l_orderkey == order.o_orderkey)
    filed = F.add_months(F.trunc("l_shipdate", "quarter"), 3).alias("filed_at")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return joined.groupBy(F.col("l_suppkey").alias("company_id"), F.year("o_orderdate").alias("fiscal_year"), filed).agg(F.sum(cents).alias("cents"), F.count("*").alias("lines"))


@query
def statement_versions(spark, base):
    """Every filing with the time it held, as one table."""
    return versions.versions(_filings(spark, base), KEYS, "filed_at", ["lines"]).select(*KEYS, versions.FROM, versions.TO, versions.NUMBER, "cents", "lines")


@query
def statement_versions_merged(spark, base):
    """The same table built in three merges, the middle quarters coming last."""
    filings = _filings(spark, base)
    part = lambda k: filings.where(F.pmod(F.quarter("filed_at") + F.year("filed_at"), F.lit(3)) == k)
    known = versions.versions(part(0), KEYS, "filed_at", ["lines"])
    for k in (2, 1):
        known = versions.merged(known, part(k), KEYS, "filed_at", ["lines"])
    return known.select(*KEYS, versions.FROM, versions.TO, versions.NUMBER, "cents", "lines")


@query
def statements_as_filed(spark, base):
    """What was known of each company's years in the middle of 1998."""
    known = versions.as_filed(versions.versions(_filings(spark, base), KEYS, "filed_at", ["lines"]), F.to_date(F.lit("1998-06-30")))
    return known.select(*KEYS, versions.FROM, versions.NUMBER, "cents")


@query
def clients_as_of(spark, base):
    """Clients as the change feed had them at noon of 15 February, without those deleted by then."""
    changes = table(spark, base, "client_changes").select("client_id", "valid_at", "seq", "change_id", "op", "segment", "city", "balance")
    known = versions.as_filed(versions.versions(changes, ["client_id"], "valid_at", ["seq", "change_id"]), F.lit("2024-02-15 12:00:00").cast("timestamp_ntz"))
    return known.where("op <> 'D'").select("client_id", "seq", "segment", "city", "balance")


@query
def client_tree(spark, base):
    """Balances rolled up to every master, at any depth."""
    c = table(spark, base, "clients").select("client_id", "master_id", F.round(F.coalesce("balance", F.lit(0.0)) * 100).cast("long").alias("cents"))
    return hierarchy.rolled_up(c, "client_id", "master_id", "cents")


@query
def bucketed_sales(spark, base):
    """Sales and clients stored in the same buckets, joined without a shuffle."""
    name = uuid.uuid4().hex
    gold.publish(table(spark, base, "sales").where("client_id IS NOT NULL"), f"sales_{name}", bucket_by=("client_id",))
    gold.publish(table(spark, base, "clients").groupBy("client_id").agg(F.max("segment").alias("segment")), f"clients_{name}", bucket_by=("client_id",))
    sales, clients = (spark.table(f"{gold.DATABASE}.{t}_{name}").hint("merge") for t in ("sales", "clients"))
    return sales.join(clients, "client_id").groupBy("segment").agg(F.count("*").alias("n"), F.round(F.sum("total"), 2).alias("total"))


@query
def daily_drawdowns(spark, base):
    """A table function over the ticks of each instrument's day."""
    table_functions.register(spark)
    table(spark, base, "events").selectExpr("event_type AS instrument", "to_date(ts) AS day", "ts", "value").createOrReplaceTempView("ticks_of_days")
    return spark.sql("SELECT instrument, day, n, round(drawdown, 4) AS drawdown FROM drawdowns(TABLE(ticks_of_days), 'value', 'ts', 'instrument', 'day')")


@query
def weighted_median_price(spark, base):
    """An aggregate over Arrow arrays: each item's price at half its quantity sold."""
    table_functions.register(spark)
    table(spark, base, "sale_lines").createOrReplaceTempView("lines_sold")
    return spark.sql("SELECT item_id, weighted_median(amount, quantity) AS price FROM lines_sold GROUP BY item_id").select("item_id", _r("price"))


def _by_length(texts: list[str]) -> list[dict]:
    """Stand-in for the outside service: an answer that depends on the text alone."""
    return [{"sentiment": ("positive", "neutral", "negative")[len(t.strip(" ")) % 3], "category": "news", "summary": t[:20]} for t in texts]


@query
def news_enriched_once(spark, base):
    """Half of the news enriched, then all of it over the same store: answers by language, and how many texts were paid for."""
    docs, folder = table(spark, base, "documents").select("doc_id", "lang", "text"), f"{shared_folder(spark)}/answers-{uuid.uuid4().hex}"
    news.enrich_once(docs.where(F.col("doc_id") % 2 == 0), folder, _by_length)
    out = news.enrich_once(docs, folder, _by_length)
    return news.sentiment_mix(out, "lang").crossJoin(F.broadcast(news.answers(spark, folder).agg(F.count("*").alias("paid"))))
