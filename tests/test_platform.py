"""Settings, layers, registry, feeds, command line, streams."""

import io
import json
import sqlite3
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import cli, logs, session, streaming
from tidemark.functions import extensions
from tidemark.settings import Settings
from tidemark.sources import feeds, layers, registry, serving, tables


def test_settings_from_file_and_environment(tmp_path):
    env = tmp_path / ".env"
    env.write_text("# comment\nTIDEMARK_LOG=debug\nexport TIDEMARK_FEED_LIVE_TRADES_KEY='k'\nTIDEMARK_FEED_LIVE_TRADES_URL_PAPER=p\nOTHER=1\n")
    got = Settings.load(env, {"TIDEMARK_STAGE": "test", "TIDEMARK_FEED_LIVE_TRADES_URL_LIVE": "u"})
    assert (got.stage, got.log, got.root, list(got.feeds)) == ("test", "debug", "lake", ["live_trades"])
    feed = got.feeds["live_trades"]
    assert feed.credentials == {"key": "k"} and "'k'" not in repr(got) and feed.url == "u"
    assert Settings.load(env, {"TIDEMARK_FEED_LIVE_TRADES_MODE": "paper"}).feeds["live_trades"].url == "p"
    with pytest.raises(ValueError):
        _ = Settings.load(env, {"TIDEMARK_FEED_LIVE_TRADES_MODE": "demo"}).feeds["live_trades"].url


def test_log_lines_are_json(spark):
    out = io.StringIO()
    log = logs.attach("info", out)
    log.info("wrote %d", 3, extra={"fields": {"layer": "gold"}})
    log.debug("not shown")
    line = json.loads(out.getvalue())
    assert (line["level"], line["from"], line["says"], line["layer"]) == ("INFO", "tidemark", "wrote 3", "gold")
    with pytest.raises(ValueError):
        logs.attach("loud")
    logs.quiet_spark(spark, "error")


@pytest.mark.parametrize(("name", "normal"), [("a.json", "a.json"), ("a/../b.json", "b.json"), ("x/./y", "x/y")])
def test_good_names(name, normal):
    assert layers.dataset_name(name) == normal


@pytest.mark.parametrize("name", ["", "../x", "/etc/passwd", "a/../../x", "a b", "..", "s3:x", "a/.."])
def test_bad_names(name):
    with pytest.raises(ValueError):
        layers.dataset_name(name)


@pytest.mark.parametrize("value", [{"한글": None, "n": [1, {"x": 2.5}]}, [1, 2], "text", None, 2**70])
def test_json_round_trip(spark, tmp_path, value):
    store = layers.LakeStore(spark, f"file://{tmp_path}")
    store.create_layers()
    uri = store.put_json(layers.Layer.BRONZE, "d/x.json", value)
    assert store.get_json(layers.Layer.BRONZE, "d/x.json") == value
    assert json.loads((tmp_path / "bronze/d/x.json").read_text("utf-8")) == value and uri.endswith("bronze/d/x.json")


def test_failed_write_keeps_the_old_document(spark, tmp_path):
    store = layers.LakeStore(spark, f"file://{tmp_path}")
    store.put_json(layers.Layer.SILVER, "x.json", 1)
    with pytest.raises(TypeError):
        store.put_json(layers.Layer.SILVER, "x.json", {1, 2})
    assert store.get_json(layers.Layer.SILVER, "x.json") == 1
    with pytest.raises(FileNotFoundError):
        store.get_json(layers.Layer.SILVER, "y.json")


def test_rows_round_trip(spark, tmp_path):
    store = layers.LakeStore(spark, f"file://{tmp_path}")
    frame = spark.createDataFrame([("005930", None), ("000660", "값")], "ticker string, note string")
    store.write_rows(layers.Layer.GOLD, "t", frame)
    assert {tuple(r) for r in store.read_rows(layers.Layer.GOLD, "t").collect()} == {tuple(r) for r in frame.collect()}
    store.write_json_rows(layers.Layer.GOLD, "j", frame)
    assert '"note":null' in "".join(p.read_text("utf-8") for p in (tmp_path / "gold/j").glob("*.json"))
    assert store.read_json_rows(layers.Layer.GOLD, "j", "ticker string, note string").count() == 2


def test_readers_refuse_inference(spark, tmp_path):
    (tmp_path / "t.csv").write_text("005930\n")
    with pytest.raises(ValueError):
        tables.read_any(spark, "csv", str(tmp_path / "t.csv"))
    assert tables.read_any(spark, "csv", str(tmp_path / "t.csv"), "ticker string").first()[0] == "005930"


def test_registry(spark, tmp_path):
    assert [r.ticker for r in registry.companies_frame(spark).orderBy("company_id").collect()] == ["005930", "000660"]
    good = {"name_ko": "가", "name_en": "A", "ticker": "1", "exchange": "X", "currency": "Y", "extra": 1}
    assert registry.parse_companies({"companies": {"a": good}})["a"].enabled is True
    for bad in (None, {}, {"companies": {"a": good | {"ticker": 432}}}, {"companies": {"a": good | {"enabled": "maybe"}}}):
        with pytest.raises(ValueError):
            registry.parse_companies(bad)


def test_paged_feed_ends_and_tries_again(spark, tmp_path):
    def fetch(url, page):
        seen = Path(url) / f"failed-{page}"
        if page == 2 and not seen.exists():
            seen.touch()
            raise ConnectionError("try later")
        return json.dumps({"list": [{"v": page}, {"v": None}] if page < 5 else []})

    spark.dataSource.register(feeds.paged_feed("recorded", fetch, pause=0.01))
    for lanes in ("1", "3"):
        bronze = spark.read.format("recorded").option("url", str(tmp_path)).option("lanes", lanes).load()
        assert sorted(r.v for r in feeds.records(bronze, "$.list", "v int").where("v is not null").collect()) == [0, 1, 2, 3, 4]
    with pytest.raises(ConnectionError):
        feeds.again(lambda url, page: (_ for _ in ()).throw(ConnectionError()), tries=2, pause=0)("u", 0)


def test_every_feed_has_typed_records(spark):
    assert len({f.name for f in feeds.FEEDS}) == 8
    rate = lambda v: {"series_id": "usdkrw", "date": "2024-01-02", "value": v}
    pages = [json.dumps({"rows": [rate(1300.5), {"series_id": "cpi", "date": "bad"}]}), json.dumps({"rows": [rate(1.0)]})]
    bronze = spark.createDataFrame([("macro_series", k, p) for k, p in enumerate(pages)], feeds.BRONZE_SCHEMA)
    got = {(r.series_id, str(r.date)): r.value for r in feeds.typed(bronze, "macro_series").collect()}
    assert got == {("usdkrw", "2024-01-02"): 1300.5, ("cpi", "None"): None}
    for f in feeds.FEEDS:
        frame = spark.createDataFrame([], feeds.LIVE_SCHEMA if f.path == "$" else feeds.BRONZE_SCHEMA)
        assert set(f.key) < set(feeds.typed(frame, f.name).columns)


def test_live_feed_is_read_on_after_a_restart(spark, tmp_path):
    log = tmp_path / "log"

    def tail(start, most):
        return log.read_text().splitlines()[start : start + most]

    spark.dataSource.register(feeds.live_feed("live_recorded", tail, 2))
    tick = lambda k: json.dumps({"ticker": "005930", "ts": "2024-01-02 09:00:00", "trade_id": k, "price": 10.0 + k, "qty": 1})
    out, n = tmp_path / "out", 0
    for upto in (3, 5):
        log.write_text("\n".join(tick(k) for k in range(upto)))
        stream = feeds.records(spark.readStream.format("live_recorded").load(), "$", feeds.feed("live_trades").schema)
        query = stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(tmp_path / "ckpt")).trigger(processingTime="0 seconds").start()
        query.processAllAvailable()
        query.stop()
        rows = spark.read.parquet(str(out)).collect()
        assert sorted(r.trade_id for r in rows) == list(range(upto)) and {r.ticker for r in rows} == {"005930"}
        n += 1
    assert n == 2


def test_serving_stores_ignore_a_replay(spark, tmp_path):
    path = str(tmp_path / "serving.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE metrics (instrument TEXT, minute INTEGER, price REAL, PRIMARY KEY (instrument, minute))")
    frame = spark.createDataFrame([("a", 1, 2.0), ("a", 2, None), ("b", 1, 4.0)], "instrument string, minute int, price double").repartition(1)
    sink = serving.database_upsert(lambda: sqlite3.connect(path), "metrics", ["instrument", "minute"], "?", batch=2)
    sink(frame)
    sink(frame.withColumn("price", F.col("price") + 1))
    with sqlite3.connect(path) as db:
        assert sorted(db.execute("SELECT * FROM metrics").fetchall(), key=str) == [("a", 1, 3.0), ("a", 2, None), ("b", 1, 5.0)]

    folder = tmp_path / "kv"
    folder.mkdir()

    class Client:
        def pipeline(self):
            self.held = []
            return self

        def hset(self, name, mapping):
            self.held.append((name, mapping))

        def execute(self):
            for name, mapping in self.held:
                (folder / name).write_text(json.dumps(mapping))

    for _ in range(2):
        serving.hash_upsert(Client, "bar", ["instrument", "minute"], batch=2)(frame)
    assert sorted(p.name for p in folder.iterdir()) == ["bar:a:1", "bar:a:2", "bar:b:1"] and json.loads((folder / "bar:a:1").read_text())["price"] == "2.0"


def test_functions_for_sql_users(spark):
    extensions.register(spark, {"shout": F.udf(lambda x: x.upper() if x else None)})
    row = spark.sql("SELECT relative_gap(12D, 10D) AS gap, clamped(NULL, 0D, 1D) AS c, shout('a') AS s").first()
    assert (round(row.gap, 6), row.c, row.s) == (0.2, None, "A")
    assert spark.sql("SELECT trimmed_mean(x) FROM (SELECT CAST(id AS DOUBLE) AS x FROM range(20))").first()[0] == 9.5
    assert [tuple(r) for r in spark.sql("SELECT * FROM words_of('one two')").collect()] == [("one", 0), ("two", 1)]


def test_folders_are_shared_or_refused(spark):
    assert session.shared_folder(spark).startswith("file://")


def test_cli(capsys):
    assert cli.main(["version"]) == 0 and capsys.readouterr().out.strip() == "0.1.0"
    assert cli.main([]) == 2
    assert cli.main(["queries"]) == 0 and "valuation_gap" in capsys.readouterr().out
    assert cli.main(["run", "nothing", "--data", "x"]) == 1


def test_two_sinks_ignore_a_replayed_batch(spark, tmp_path, data):
    stream = streaming.file_stream(spark, data, "events")
    seen = []
    sinks = {"files": streaming.parquet_sink(str(tmp_path / "out")), "list": lambda f: seen.append(f.count())}
    for _ in range(2):
        streaming.run_to_sinks(stream, sinks, str(tmp_path / "ckpt"), "append").awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == sum(seen) == 1000 and out.select(F.countDistinct("event_id")).first()[0] == 1000
