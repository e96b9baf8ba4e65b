"""Hand-computed cases of the transforms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.operators import macro, market, news, statements, valuation


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, 9, minute, second)


@pytest.fixture
def ticks(spark):
    rows = [("a", at(0), 1, 10.0, 2), ("a", at(0), 2, 12.0, 1), ("a", at(1), 3, 9.0, 0), ("a", at(6), 4, 9.0, 5), ("b", at(0), 5, 0.0, 1), ("b", at(2), 6, 3.0, None)]
    return spark.createDataFrame(rows, "instrument string, ts timestamp_ntz, trade_id long, price double, qty long")


def test_bars_break_ties_on_the_trade(ticks):
    got = {(r.instrument, r.bar_start.minute): r for r in market.bars(ticks, "5 minutes").collect()}
    first = got["a", 0]
    assert (first.open, first.high, first.low, first.close, first.volume, first.trades) == (10.0, 12.0, 9.0, 9.0, 3, 3)
    assert len(got) == 3


def test_five_minute_volume_is_the_sum_of_one_minute_volume(ticks):
    total = lambda w: {r.instrument: r.v for r in market.bars(ticks, w).groupBy("instrument").agg(F.sum("volume").alias("v")).collect()}
    assert total("1 minute") == total("5 minutes")


def test_vwap_without_volume_is_null(ticks):
    got = {(r.instrument, r.bar_start.minute): r.vwap for r in market.vwap(ticks, "1 minute").collect()}
    assert got["a", 1] is None and got["a", 0] == pytest.approx(32 / 3)


def test_return_from_zero_is_null(ticks):
    got = {r.trade_id: r.ret for r in market.returns(ticks).collect()}
    assert got[6] is None and got[2] == pytest.approx(0.2)


@pytest.mark.parametrize("kind", [market.rsi_sma, market.rsi_wilder])
def test_rsi_without_losses_is_100(spark, kind):
    rows = [("a", at(i), i, float(i), 1) for i in range(20)]
    frame = spark.createDataFrame(rows, "instrument string, ts timestamp_ntz, trade_id long, price double, qty long")
    got = {r.trade_id: r.rsi for r in kind(frame, 14).collect()}
    assert got[13] is None and got[14] == 100.0 and got[19] == 100.0


def test_as_of_carries_the_value_over_blocks(spark):
    left = spark.createDataFrame([(i, i * 7) for i in range(12)] + [(99, None)], "id long, t long")
    right = spark.createDataFrame([(8, 1.0), (9, 2.0), (41, None), (63, 3.0)], "rt long, v double")
    want = {i: max(((t, v) for t, v in [(8, 1.0), (9, 2.0), (41, None), (63, 3.0)] if t <= i * 7), default=(0, None), key=lambda x: x[0])[1] for i in range(12)} | {99: None}
    for salt in (None, "_ts div 10"):
        out = market.as_of(left, right, [], "t", "rt", "v", "id", salt)
        assert {r.id: r.v for r in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_block" in plan


def test_as_of_keeps_a_null_value_in_force(spark):
    left = spark.createDataFrame([("k", 5, 1), ("k", 1, 2), ("k", 9, 3)], "k string, t int, id int")
    right = spark.createDataFrame([("k", 2, 7.0), ("k", 6, None)], "k string, rt int, v double")
    got = {r.id: r.v for r in market.as_of(left, right, ["k"], "t", "rt", "v", "id").collect()}
    assert got == {1: 7.0, 2: None, 3: None}


def test_surge(spark):
    rows = [("a", dt.datetime(2024, 1, d, 9), d, 1.0, q) for d, q in ((1, 10), (2, 10), (3, 25))]
    frame = spark.createDataFrame(rows, "instrument string, ts timestamp_ntz, trade_id long, price double, qty long")
    assert {str(r.day): r.surge for r in market.volume_surge(frame).collect()} == {"2024-01-01": False, "2024-01-02": False, "2024-01-03": True}


def test_discounting(spark):
    value = spark.range(1).select(fn.discounted(F.lit(100.0), F.lit(0.0), 0.1, 2, 0.0)).first()[0]
    assert value == pytest.approx(100 / 1.1 + 100 / 1.21 + 100 / 0.1 / 1.21)


def test_clamp_keeps_null(spark):
    assert spark.range(1).select(fn.clamp(F.lit(None).cast("double"), -1, 1)).first()[0] is None


def test_range_skips_missing_models(spark):
    frame = spark.createDataFrame([(1, 10.0, None, 30.0, 40.0), (2, None, None, None, 5.0)], "company_id int, value_dcf double, value_peer_pe double, value_peer_pb double, price double")
    a, b = valuation.value_range(frame).orderBy("company_id").collect()
    assert (a.lo, a.mid, a.hi, a.n_models, a.gap) == (10.0, 20.0, 30.0, 2, 1.0)
    assert (b.lo, b.mid, b.hi, b.n_models, b.gap) == (None, None, None, 0, None)


def test_news_columns_may_not_enter_a_valuation(spark):
    with pytest.raises(ValueError, match="sentiment"):
        valuation.value_with(spark.createDataFrame([("x",)], "sentiment string"))


def test_losses_give_no_value(spark):
    frame = spark.createDataFrame([(-1.0, None, 10.0, -2.0, 5.0, 1.0, -3.0)], "fcf double, fcf_growth double, shares double, eps double, peer_pe_multiple double, peer_pb_multiple double, equity double")
    row = valuation.value_with(frame).first()
    assert (row.value_dcf, row.value_peer_pe, row.value_peer_pb) == (None, None, None)


def test_common_schema(spark):
    kr = spark.createDataFrame([(1, 2020, 5.0)], "company_id long, fiscal_year int, x double")
    facts = [statements.long_facts(kr, ["company_id", "fiscal_year"], "kr", {"ifrs-full_Revenue": F.col("x"), "unknown": F.col("x")})]
    row = statements.to_common_schema(facts).first()
    assert (row.revenue, row.operating_income) == (5.0, None)


def test_first_year_has_no_growth(spark):
    rows = [(1, 2020, *([1.0] * 9), 1.0), (1, 2021, 3.0, *([1.0] * 8), 1.0)]
    names = "company_id long, fiscal_year int, revenue double, operating_income double, net_income double, operating_cash_flow double, capex double, assets double, liabilities double, shares double, equity double, eps double"
    got = {r.fiscal_year: (r.revenue_growth, r.roe) for r in statements.with_metrics(spark.createDataFrame(rows, names)).collect()}
    assert got == {2020: (None, None), 2021: (2.0, 1.0)}


def test_company_map_and_dedup(spark):
    docs = spark.createDataFrame([(1, "Alpha wins"), (2, " alpha WINS "), (3, None), (4, "beta and alpha")], "doc_id long, text string")
    pairs = {tuple(r) for r in news.map_companies(docs, [("A", "alpha"), ("B", "beta")]).collect()}
    assert pairs == {(1, "A"), (2, "A"), (4, "A"), (4, "B")}
    assert {(r.doc_id, r.copies) for r in news.dedup(docs).collect()} == {(1, 2), (3, 1), (4, 1)}


def test_enrich_batches(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "doc_id long, text string")
    out = news.enrich(docs, lambda texts: [{"sentiment": "neutral", "category": "c", "summary": t} for t in texts], batch=2)
    assert {(r.doc_id, r.summary) for r in out.collect()} == {(i, f"t{i}") for i in range(5)}


def test_year_on_year(spark):
    rows = [("s", dt.date(2020 + m // 12, m % 12 + 1, 1), 10.0 + m) for m in range(13)]
    got = [r.yoy for r in macro.year_on_year(spark.createDataFrame(rows, "series_id string, month date, value double")).orderBy("month").collect()]
    assert got[:12] == [None] * 12 and got[12] == pytest.approx(1.2)


def _series(spark, n=400):
    import random

    rng = random.Random(4)
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.choice((0, 7, 90)) + 11 * k), k, float(rng.randint(1, 40)), rng.randint(0, 9)) for i in ("a", "b") for k in range(n)]
    return spark.createDataFrame(rows, "instrument string, ts timestamp_ntz, trade_id long, price double, qty long")


@pytest.mark.parametrize("kind", [market.returns, market.moving_average, market.volatility, market.volume_change, market.rsi_sma, market.rsi_wilder])
def test_pieces_of_a_series_give_the_same(spark, kind):
    frame = _series(spark)
    name = {"returns": "ret", "moving_average": "ma", "volatility": "vol", "volume_change": "qty_ratio"}.get(kind.__name__, "rsi")
    rows = lambda size: {(r.instrument, r.trade_id): r[name] for r in kind(frame, size=size).collect()}
    whole = rows(10_000)
    assert len(whole) == 800
    for size in (21, 50):
        got = rows(size)
        assert got.keys() == whole.keys() and all(got[k] == (None if v is None else pytest.approx(v, abs=1e-9)) for k, v in whole.items())


def test_wilder_by_its_recursion(spark):
    frame = _series(spark, 120)
    got = {r.trade_id: r.rsi for r in market.rsi_wilder(frame, size=30).where("instrument = 'a'").collect()}
    gain = loss = 0.0
    prices = [(r.price, r.trade_id) for r in frame.where("instrument = 'a'").orderBy("ts", "trade_id").collect()]
    for k, (price, trade) in enumerate(prices):
        move = price - prices[k - 1][0] if k else 0.0
        up, down = max(move, 0.0), max(-move, 0.0)
        gain, loss = (gain + up / 14, loss + down / 14) if k <= 14 else ((gain * 13 + up) / 14, (loss * 13 + down) / 14)
        assert got[trade] is None if k < 14 else got[trade] == pytest.approx(100 - 100 / (1 + gain / loss))


def test_a_missing_month_or_year_gives_no_change(spark):
    rows = [("s", dt.date(2020 + m // 12, m % 12 + 1, 1), 10.0 + m) for m in range(24) if m != 3]
    got = {r.month: r.yoy for r in macro.year_on_year(spark.createDataFrame(rows, "series_id string, month date, value double")).collect()}
    assert got[dt.date(2021, 4, 1)] is None and got[dt.date(2021, 5, 1)] == pytest.approx(12 / 14)
    names = "company_id long, fiscal_year int, revenue double, operating_income double, net_income double, operating_cash_flow double, capex double, assets double, liabilities double, shares double, equity double, eps double"
    years = [(1, y, *([float(y)] * 9), 1.0) for y in (2019, 2020, 2022)]
    growth = {r.fiscal_year: r.revenue_growth for r in statements.with_metrics(spark.createDataFrame(years, names)).collect()}
    assert growth[2020] is not None and growth[2022] is None
