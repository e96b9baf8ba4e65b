"""Variants, versions, trees, buckets, table functions, files that are replaced whole."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.functions import tables as table_functions
from tidemark.operators import hierarchy, news, versions
from tidemark.sources import gold, layers, semi, serving


def test_variants_of_mixed_types(spark, tmp_path):
    rows = [(1, '{"k": 5, "a": [1, {"b": null}], "가": "x"}'), (2, '{"k": "7", "a": {"b": 1}}'), (3, '{"k": 1.5, "z": true}'), (4, '{"k": '), (5, None), (6, "[1, 2]"), (7, "3"), (8, '{"k": null}'), (9, "")]
    frame = semi.parsed(spark.createDataFrame(rows, "id int, props string"), "props")
    frame.write.parquet(f"{tmp_path}/v")
    back = spark.read.parquet(f"{tmp_path}/v")
    got = {r.id: (r.fault, r.k, r.b) for r in back.select("id", "fault", semi.field("props", "$.k", "bigint").alias("k"), semi.field("props", "$.a.b", "int").alias("b")).collect()}
    assert got == {1: (None, 5, None), 2: (None, 7, 1), 3: (None, 1, None), 4: ("broken", None, None), 5: ("missing", None, None), 6: (None, None, None), 7: (None, None, None), 8: (None, None, None), 9: ("broken", None, None)}
    keys = Counter((r.key, r.kind) for r in semi.exploded(back, "props").select("key", semi.kind_of(F.col("value")).alias("kind")).collect())
    assert keys == {("k", "number"): 2, ("k", "text"): 1, ("k", "null"): 1, ("a", "array"): 1, ("a", "object"): 1, ("z", "truth"): 1, ("가", "text"): 1, (None, "number"): 2}


D = datetime.date


def test_restatements_and_late_filings(spark):
    schema = "k string, y int, filed date, n int, v double"
    first = [("a", 1, D(2020, 3, 1), 1, 10.0), ("a", 1, D(2020, 9, 1), 2, 12.0), ("b", 1, D(2020, 5, 1), 1, 5.0), ("a", 1, D(2020, 9, 1), 1, 11.0), (None, 1, D(2020, 1, 1), 1, 0.5), ("c", 1, None, 1, 9.0)]
    late = [("a", 1, D(2020, 6, 1), 1, 99.0), ("a", 1, D(2020, 9, 1), 3, 13.0), ("d", 1, D(2019, 1, 1), 1, 7.0), ("a", 1, D(2020, 3, 1), 1, 10.0), (None, 1, D(2021, 1, 1), 1, None)]
    keys = ["k", "y"]
    known = versions.versions(spark.createDataFrame(first, schema), keys, "filed", ["n"])
    merged = versions.merged(known, spark.createDataFrame(late, schema), keys, "filed", ["n"])
    whole = versions.versions(spark.createDataFrame(first + late, schema), keys, "filed", ["n"])
    assert Counter(map(tuple, merged.select(*whole.columns).collect())) == Counter(map(tuple, whole.collect()))
    read = lambda t, d: {r.k: r.v for r in versions.as_filed(t, F.lit(d).cast("date")).collect()}
    assert read(merged, "2020-02-29") == {None: 0.5, "d": 7.0}  # nothing looks ahead
    assert read(known, "2020-08-31")["a"] == 10.0 and read(merged, "2020-08-31")["a"] == 99.0
    assert read(merged, "2020-09-01") == {"a": 13.0, "b": 5.0, "d": 7.0, None: 0.5} and read(merged, "2022-01-01")[None] is None
    assert [r.version for r in merged.where("k = 'a'").orderBy("filed_from").collect()] == [1, 2, 3]


def test_trees_of_any_depth(spark):
    rng = random.Random(6)
    up = {0: 0, 1: None, 2: 99_999} | {n: n - 1 for n in range(3, 200)}  # a chain of 198, two other roots
    up |= {n: rng.choice([5, 5, 5, rng.randrange(0, n)]) for n in range(200, 500)}  # a broad node
    up |= {600: 601, 601: 602, 602: 600, 603: 601, 604: 603}  # a cycle, and what hangs on it
    value = {n: rng.randrange(100) for n in up} | {7: None}
    rows = [(n, p, value[n]) for n, p in up.items()] + [(None, 3, 5), (8, 7, value[8])]
    got = {r.node: (r.root, r.depth, r.members, r.total) for r in hierarchy.rolled_up(spark.createDataFrame(rows, "node long, up long, v long"), "node", "up", "v").collect()}
    members, total, want = Counter(), Counter(), {}
    for n in up:
        path, at = [n], n
        while up.get(at) not in (None, at) and up[at] in up and len(path) < 600:
            at = up[at]
            path.append(at)
        want[n] = (at, len(path) - 1) if len(path) < 600 else (None, None)
        if len(path) < 600:
            members.update(path)
            total.update(dict.fromkeys(path, value[n] or 0))
    assert got == {n: (*want[n], members[n], total[n]) if want[n][0] is not None else (None,) * 4 for n in up}
    assert hierarchy.rolled_up(spark.createDataFrame([], "node long, up long, v long"), "node", "up", "v").count() == 0


def _plan(frame):
    return frame._jdf.queryExecution().explainString(frame._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_buckets_join_without_a_shuffle(spark):
    a = spark.createDataFrame([(n % 50, n) for n in range(500)], "k long, v long")
    b = spark.createDataFrame([(n, str(n)) for n in range(60)], "k long, name string")
    gold.publish(a, "many", bucket_by=("k",), buckets=4)
    gold.publish(b, "names", bucket_by=("k",), buckets=4)
    joined = spark.table(f"{gold.DATABASE}.many").hint("merge").join(spark.table(f"{gold.DATABASE}.names"), "k")
    assert "Exchange" not in _plan(joined) and "SortMergeJoin" in _plan(joined)
    assert Counter(map(tuple, joined.collect())) == Counter((n % 50, n, str(n % 50)) for n in range(500))


def test_readers_see_the_old_table_or_the_new(spark):
    frame = lambda n: spark.range(n).withColumn("n", F.lit(n))
    gold.publish(frame(3), "swapped")
    before = spark.table(f"{gold.DATABASE}.swapped")
    gold.publish(frame(5), "swapped")
    assert before.count() == 3 and spark.table(f"{gold.DATABASE}.swapped").count() == 5
    broken = frame(7).withColumn("n", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        gold.publish(broken, "swapped")
    assert spark.table(f"{gold.DATABASE}.swapped").count() == 5
    for n in (1, 2, 4):
        gold.publish(frame(n), "swapped")
    assert spark.table(f"{gold.DATABASE}.swapped").count() == 4 and len(gold._versions(spark, "swapped", gold.DATABASE)) == gold.KEPT


def test_documents_are_replaced_whole(spark, tmp_path):
    store = layers.LakeStore(spark, f"file://{tmp_path}")
    for value in ({"a": 1}, [2]):
        store.put_json(layers.Layer.BRONZE, "d/x.json", value)
    with pytest.raises(TypeError):
        store.put_json(layers.Layer.BRONZE, "d/x.json", {"a": object()})
    assert store.get_json(layers.Layer.BRONZE, "d/x.json") == [2]
    assert sorted(p.name for p in (tmp_path / "bronze/d").iterdir() if not p.name.endswith(".crc")) == ["x.json"]


def test_names_are_quoted():
    said = serving.upsert_statement('public.a"b', ["k", "select"], ["k"])
    assert said == 'INSERT INTO "public"."a""b" ("k", "select") VALUES (%s, %s) ON CONFLICT ("k") DO UPDATE SET "select" = excluded."select"'
    with pytest.raises(ValueError):
        serving.quoted("")


def test_functions_over_tables(spark):
    table_functions.register(spark)
    spark.createDataFrame([("a", 1, 5.0), ("a", 2, 9.0), ("a", 3, None), ("a", 4, 2.0), ("b", 1, None), (None, 2, 1.0)], "k string, t int, x double").createOrReplaceTempView("falls")
    got = {r.k: (r.n, r.drawdown) for r in spark.sql("SELECT * FROM drawdowns(TABLE(falls), 'x', 't', 'k')").collect()}
    assert got == {"a": (4, 7.0), "b": (1, None), None: (1, 0.0)}
    with pytest.raises(Exception, match="no column"):
        spark.sql("SELECT * FROM drawdowns(TABLE(falls), 'y', 't', 'k')")
    rows = spark.sql("SELECT k, weighted_median(x, t) AS m FROM falls GROUP BY k").collect()
    assert {r.k: r.m for r in rows} == {"a": 2.0, "b": None, None: 1.0}


def test_no_text_is_paid_for_twice(spark, tmp_path):
    log, folder = tmp_path / "sent", f"file://{tmp_path}/answers"
    log.touch()

    def service(texts):
        with log.open("a") as f:
            f.writelines(f"{t}\n" for t in texts)
        if any("bad" in t for t in texts):
            raise OSError("the service is down")
        return [{"sentiment": t.lower().strip(), "category": None} for t in texts]

    first = [(1, "One"), (2, "two"), (3, " one "), (4, None), (None, "two")]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.sentiment) for r in news.enrich_once(frame(first), folder, service).collect()}
    assert got == {(1, "one"), (3, "one"), (2, "two"), (None, "two"), (4, None)}
    assert len(log.read_text().split()) == 2
    news.enrich_once(frame([*first, (5, "three")]), folder, service)
    assert sorted(x.lower().strip() for x in log.read_text().splitlines()) == ["one", "three", "two"]
    with pytest.raises(Exception, match="down"):
        news.enrich_once(frame([(k, f"text {k}") for k in range(20)] + [(99, "bad")]), folder, service)
    paid = news.answers(spark, folder).count()
    news.enrich_once(frame([(k, f"text {k}") for k in range(20)]), folder, service)
    assert news.answers(spark, folder).count() == 23 and paid >= 3
