"""Range joins, aliases and quantiles against plain Python."""

import datetime
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from tidemark.operators import aliases, quantiles, ranges, ranking
from tidemark.plans import ORACLE, QUERIES


def _tables(spark, seed):
    rng = random.Random(seed)
    points = [(n, rng.choice([7, 7, rng.randrange(-500, 500)]), rng.choice("ab")) for n in range(400)] + [(900, None, "a"), (901, 3, None), (901, 3, None)]
    spans = [(n, lo := rng.randrange(-500, 500), lo + rng.choice([0, 1, 5, 64, 900, -3]), rng.choice("ab")) for n in range(120)] + [(500, None, 5, "a"), (501, -(2**60), 2**60, "a"), (502, 7, 7, None)]
    return points, spans, spark.createDataFrame(points, "p long, at long, k string"), spark.createDataFrame(spans, "r long, lo long, hi long, k string")


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_points_in_ranges(spark, keys):
    points, spans, a, b = _tables(spark, 1)
    b = b if keys else b.withColumnRenamed("k", "k2")
    out = ranges.range_join(a, b, "at", "lo", "hi", keys)
    want = Counter((p, r) for p, at, k in points for r, lo, hi, k2 in spans if None not in (at, lo) and lo <= at <= hi and (not keys or (k is not None and k == k2)))
    assert Counter((x.p, x.r) for x in out.collect()) == want and len(want) > 1000
    plan = out._jdf.queryExecution().explainString(out._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert ranges.range_join(a, b.limit(0), "at", "lo", "hi", keys).count() == 0


def test_overlapping_ranges(spark):
    _, spans, _, b = _tables(spark, 2)
    other = b.select(F.col("r").alias("r2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    got = Counter((x.r, x.r2) for x in ranges.overlaps(b, other, ("lo", "hi"), ("lo2", "hi2")).collect())
    assert got == Counter((r, s) for r, lo, hi, _ in spans for s, lo2, hi2, _ in spans if lo is not None and lo2 is not None and max(lo, lo2) <= min(hi, hi2))


@pytest.mark.parametrize("limit", [1 << 20, 300])
def test_aliases(spark, limit):
    rows = [("acme", "Acme"), ("acme", "acme corp"), ("ab", "a.b"), ("x", "é"), ("y", "É"), ("acme", " ACME "), ("none", ""), ("none", None), (None, "void"), ("star", "*"), ("corp", "corp")]
    rows += [(f"many{n}", f"name{n}") for n in range(50)]
    texts = [(1, "Acme Corp's acme, acmeX _acme ACME2 void"), (2, None), (3, ""), (4, "é éa É. a.b xa.b a.bc"), (4, "*a* name7 name77 name4"), (None, "corp")]
    out = aliases.map_aliases(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(rows, "company string, alias string"), limit)
    got = Counter({(r.doc_id, r.company, r.alias): r.n for r in out.collect()})
    assert got == Counter({
        (1, "acme", "acme"): 2, (1, "acme", "acme corp"): 1, (1, "corp", "corp"): 1, (4, "x", "é"): 2, (4, "y", "é"): 2, (4, "ab", "a.b"): 1, (4, "star", "*"): 2, (4, "many7", "name7"): 1, (4, "many4", "name4"): 1, (None, "corp", "corp"): 1,
    })
    assert aliases.map_aliases(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([], "company string, alias string")).count() == 0


def test_exact_quantiles_by_narrowing(spark):
    rng = random.Random(8)
    groups = {"spread": [rng.gauss(0, 9) for _ in range(6000)], "ties": [rng.choice([1.0, 2.0]) for _ in range(5001)], "two": [1.0] * 3000 + [2.0] * 3000, "few": [3.0, 1.0], "one": [5.0], None: [rng.random() for _ in range(3000)]}
    rows = [(k, v) for k, x in groups.items() for v in x] + [("few", None), ("few", float("nan")), ("nothing", None)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "k string, v double")
    for q in (0.0, 0.37, 0.5, 1.0):
        got = {r.k: (r.n, r.quantile) for r in quantiles.quantile(frame, ["k"], F.col("v"), q, keep=200).collect()}
        assert got.keys() == groups.keys()
        for k, x in groups.items():
            assert got[k][0] == len(x) and got[k][1] == pytest.approx(np.quantile(x, q), abs=1e-12)
    assert quantiles.quantile(frame, [], F.lit(4.0), 0.5).first()["quantile"] == 4.0


def test_sketches_merge_within_their_error(spark):
    values = np.random.default_rng(2).permutation(40_000).astype(float)
    frame = spark.createDataFrame([(k % 2, v) for k, v in enumerate(values.tolist())], "k long, v double").repartition(16)
    for r in quantiles.approximate(frame, ["k"], F.col("v"), 0.3).collect():
        own = np.sort(values[r.k :: 2])
        assert r.n == len(own) and abs(np.searchsorted(own, r["quantile"]) / len(own) - 0.3) <= 2 * quantiles.rank_error()


@pytest.mark.parametrize("blocks", [2, 64])
def test_places_in_large_groups(spark, blocks):
    rng = random.Random(blocks)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice([None, 1.0, 2.0, rng.random() * 9]), n) for n in range(3000)] + [("z", None, 5000)]
    frame = spark.createDataFrame(rows, "k string, v double, id long").repartition(7)
    got = {r.id: r.place for r in ranking.numbered_down(frame, ["k"], F.col("v"), ["id"], "place", blocks).collect()}
    for k in ("a", "b", None, "z"):
        own = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        assert [got[r[2]] for r in own] == list(range(1, len(own) + 1))


def _crowded(spark, folder):
    """Orders and lines on few days, thousands of each; some without a day, flag or key, and a key twice."""
    rng = random.Random(4)
    day = lambda n: datetime.datetime(2000, 1, 1) + datetime.timedelta(days=n, hours=rng.randrange(24))
    dates = [rng.choice([0, 0, 2, 5, 13, 14, 40, 90]) for _ in range(3000)]
    orders = [(k, rng.choice([300_000.0, 500_000.0, 600_000.0]), day(d)) for k, d in enumerate(dates)]
    orders += [(7, 500_000.0, day(200)), (7, 500_000.0, day(0)), (None, 500_000.0, day(1)), (5000, 500_000.0, None), (5001, None, day(1)), (6000, 500_000.0, day(700))]
    lines = [(k, 1, rng.choice(["A", "N", "R", None]), day(rng.choice([1, 1, 3, 50, 100, 300]))) for k in range(3000)] + [(1, 2, "A", None), (1, 3, "Z", day(2000))]
    for name, rows, schema in (("orders", orders, "o_orderkey long, o_totalprice double, o_orderdate timestamp_ntz"), ("lineitem", lines, "l_orderkey long, l_linenumber int, l_returnflag string, l_shipdate timestamp_ntz")):
        pq.write_table(spark.createDataFrame(rows, schema).toArrow(), folder / f"{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["line_windows", "overlapping_order_windows"])
def test_crowded_days_are_not_paired(spark, tmp_path, monkeypatch, name):
    base, join, sizes = _crowded(spark, tmp_path), ranges.range_join, []

    def counted(*args):
        out = join(*args)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(ranges, "range_join", counted)
    frame = QUERIES[name](spark, base)
    assert 0 < sum(sizes) < 500
    assert difference(frame, connect(base), ORACLE[name]) == ([], [], [])


def test_others_that_overlap(spark):
    rng = random.Random(6)
    spans = lambda: [(rng.randrange(40), lo := rng.randrange(60), lo + rng.choice([0, 2, 9, -1])) for _ in range(150)] + [(41, 500, 501), (3, None, 5)]
    a, b = spans(), spans()
    out = ranges.overlapping_others(spark.createDataFrame(a, "k long, lo long, hi long"), spark.createDataFrame(b, "k2 long, lo2 long, hi2 long"), ("lo", "hi"), ("lo2", "hi2"), "k", "k2")
    want = {}
    for k, lo, hi in a:
        for k2, lo2, hi2 in b:
            if k != k2 and None not in (lo, lo2) and max(lo, lo2) <= min(hi, hi2):
                want.setdefault(k, []).append(k2)
    assert {r.k: (r.n, r.least, r.most) for r in out.collect()} == {k: (len(v), min(v), max(v)) for k, v in want.items()} and len(want) > 30


def test_half_cents_follow_the_order_of_the_rows(spark, tmp_path):
    """Sums that end on half cents, over files of unequal size; one thread of SQL adds rows in the table's order."""
    rng, folder = random.Random(14), tmp_path / "lineitem.parquet"
    folder.mkdir()
    for part, lines in enumerate((700, 3000, 1, 5000)):
        rows = [(rng.choice([*range(40), None]), rng.randrange(1, 10_000_000) / 100, rng.choice([0.5, 0.05]), datetime.datetime(rng.choice([1997, 1999]), 5, 6)) for _ in range(lines)]
        rows += [(50, None, 0.5, datetime.datetime(1997, 5, 6)), (51, 0.01, 0.5, None)]
        names, types = ("l_suppkey", "l_extendedprice", "l_discount", "l_shipdate"), (pa.int64(), pa.float64(), pa.float64(), pa.timestamp("us"))
        out = pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
        for name, value in {"l_tax": 0.0, "l_quantity": 1.0, "l_returnflag": "R", "l_linestatus": "O"}.items():
            out = out.append_column(name, pa.array([value] * len(rows)))
        pq.write_table(out, folder / f"part-{part}.parquet", row_group_size=900)
    con = duckdb.connect()
    con.execute("SET threads = 1")
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{folder}/*.parquet')")
    assert difference(QUERIES["statement_trend"](spark, str(tmp_path)), con, ORACLE["statement_trend"]) == ([], [], [])
