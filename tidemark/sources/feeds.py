"""External feeds as Spark data sources, landed unchanged in bronze.

``paged_feed`` is a Python data source over the pages of an HTTP API.  Executors fetch; a page is
tried again after a pause when the service fails, and a partition reads its pages until one has no records.
``live_feed`` is a streaming source over numbered messages (a socket's log, a broker's topic), which can be
read again from any number, as recovery needs; ``lane_feed`` is one whose messages executors fetch.  The fetch functions are injected, so both run
against recorded payloads without a network.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.error import HTTPError, URLError
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition, SimpleDataSourceStreamReader

BRONZE_SCHEMA = "source string, page int, payload string"
LIVE_SCHEMA = "source string, number long, payload string"
Fetch = Callable[[str, int], str]
Tail = Callable[[int, int], list[str]]


@dataclass(frozen=True)
class Feed:
    """Where a feed's records are in its payloads, what they hold, and how often it is read."""

    name: str
    mode: str  # batch, micro-batch or stream
    provides: str
    path: str
    schema: str
    key: tuple[str, ...]


_STATEMENT = "company_id string, fiscal_year int, fiscal_period string, filed_at date, account string, value double, currency string"
_NEWS = "news_id string, published_at timestamp, title string, body string, url string"
_SERIES = "series_id string, date date, value double"

#: The feeds the platform reads, with the record schema that silver expects of each.
FEEDS = (
    Feed("price_history", "batch", "daily OHLCV", "$.prices", "ticker string, date date, open double, high double, low double, close double, volume long", ("ticker", "date")),
    Feed("live_trades", "stream", "trade ticks", "$", "ticker string, ts timestamp, trade_id long, price double, qty long", ("ticker", "trade_id")),
    Feed("statements_kr", "batch", "domestic filings", "$.list", _STATEMENT, ("company_id", "fiscal_year", "fiscal_period", "account")),
    Feed("statements_us", "batch", "foreign filings", "$.facts", _STATEMENT, ("company_id", "fiscal_year", "fiscal_period", "account")),
    Feed("news_kr", "micro-batch", "domestic news", "$.items", _NEWS, ("news_id",)),
    Feed("news_global", "micro-batch", "global news", "$.articles", _NEWS, ("news_id",)),
    Feed("industry_series", "batch", "semiconductor indicators", "$.observations", _SERIES, ("series_id", "date")),
    Feed("macro_series", "batch", "exchange rates and macro series", "$.rows", _SERIES, ("series_id", "date")),
)


def feed(name: str) -> Feed:
    return next(f for f in FEEDS if f.name == name)


def http_fetch(url: str, page: int) -> str:
    with urlopen(Request(url.replace("{page}", str(page))), timeout=30) as reply:
        return reply.read().decode("utf-8")


def again(fetch: Fetch, tries: int = 4, pause: float = 1.0) -> Fetch:
    """``fetch`` with further tries, each after twice the pause, where the service failed or asked to wait."""

    def run(url: str, page: int) -> str:
        for k in range(tries):
            try:
                return fetch(url, page)
            except (URLError, TimeoutError, ConnectionError) as fault:
                if k == tries - 1 or (isinstance(fault, HTTPError) and fault.code < 500 and fault.code != 429):
                    raise
                time.sleep(pause * 2**k)
        raise AssertionError("unreachable")

    return run


def records_in(payload: str, path: str) -> int:
    """How many records a payload has at ``$.name``."""
    found = json.loads(payload)
    for part in path.removeprefix("$").strip(".").split("."):
        found = found.get(part) if part and isinstance(found, dict) else found
    return len(found) if isinstance(found, list) else int(found is not None)


class _Lane(InputPartition):
    def __init__(self, first: int, step: int) -> None:
        super().__init__(first)
        self.first, self.step = first, step


def paged_feed(name: str, fetch: Fetch = http_fetch, path: str = "$.list", pause: float = 1.0) -> type[DataSource]:
    """A data source class to register with ``spark.dataSource.register``.

    Options: ``url`` (with ``{page}``), ``lanes`` (partitions; each reads every so-manieth page until one is empty), ``pages`` (at most so many).
    """
    fetch = again(fetch, pause=pause)

    class Reader(DataSourceReader):
        def __init__(self, options: dict[str, str]) -> None:
            self.url, self.lanes, self.pages = options["url"], int(options.get("lanes", "1")), int(options.get("pages", str(2**31 - 1)))

        def partitions(self):
            return [_Lane(i, self.lanes) for i in range(self.lanes)]

        def read(self, partition) -> Iterator[tuple]:
            for page in range(partition.first, self.pages, partition.step):
                payload = fetch(self.url, page)
                if not records_in(payload, path):
                    return
                yield (name, page, payload)

    class PagedFeed(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return BRONZE_SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return Reader(dict(self.options))

    return PagedFeed


def live_feed(name: str, tail: Tail, most: int = 10_000) -> type[DataSource]:
    """A streaming data source over ``tail(start, most)``: the payloads of the messages from number ``start``, at most so many.

    The service keeps messages until they are read twice: once, and again if a batch is replayed.
    """

    class Reader(SimpleDataSourceStreamReader):
        def initialOffset(self) -> dict:
            return {"number": 0}

        def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
            first = start["number"]
            found = tail(first, most)
            return iter([(name, first + k, x) for k, x in enumerate(found)]), {"number": first + len(found)}

        def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
            first = start["number"]
            return iter([(name, first + k, x) for k, x in enumerate(tail(first, end["number"] - first))])

        def commit(self, end: dict) -> None:
            pass

    class LiveFeed(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return LIVE_SCHEMA

        def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
            return Reader()

    return LiveFeed


LaneTail = Callable[[str, int, int], list[str]]


def lane_feed(name: str, newest: Callable[[], dict[str, int]], tail: LaneTail, most: int = 10_000) -> type[DataSource]:
    """A streaming data source over a service with several numbered lanes (partitions of a topic, channels of a socket's log).

    The driver only asks ``newest`` for the number after each lane's last message.  Executors fetch: a lane's new numbers are cut into stretches of ``most`` and
    ``tail(lane, start, most)`` gives the payloads of one, so a batch of any size passes no single process.  A batch that is replayed fetches the same numbers again.
    A lane that appears later is read from its first message.
    """

    class Reader(DataSourceStreamReader):
        def initialOffset(self) -> dict:
            return {}

        def latestOffset(self) -> dict:
            return newest()

        def partitions(self, start: dict, end: dict) -> list[_Stretch]:
            return [_Stretch(lane, at, min(at + most, upto)) for lane, upto in sorted(end.items()) for at in range(start.get(lane, 0), upto, most)]

        def read(self, partition: _Stretch) -> Iterator[tuple]:
            at = partition.start
            while at < partition.end:
                found = tail(partition.lane, at, partition.end - at)
                if not found:
                    raise ValueError(f"{name}: {partition.lane} has no message {at} any more")
                yield from ((f"{name}/{partition.lane}", at + k, x) for k, x in enumerate(found))
                at += len(found)

        def commit(self, end: dict) -> None:
            pass

    class LaneFeed(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return LIVE_SCHEMA

        def streamReader(self, schema) -> DataSourceStreamReader:
            return Reader()

    return LaneFeed


@dataclass
class _Stretch(InputPartition):
    lane: str
    start: int
    end: int


def records(bronze: DataFrame, path: str, schema: str) -> DataFrame:
    """The records of an array inside each payload (``$.list``; ``$``: the payload is one record), typed by ``schema``."""
    if path == "$":
        return bronze.select(*(c for c in bronze.columns if c != "payload"), F.from_json("payload", schema).alias("r")).select("*", "r.*").drop("r")
    items = F.from_json(F.get_json_object("payload", path), f"array<struct<{schema}>>")
    return bronze.select("source", "page", F.explode(items).alias("r")).select("source", "page", "r.*")


def typed(bronze: DataFrame, name: str) -> DataFrame:
    """A feed's records by its own schema, one a key (the first in page order, ties by their JSON)."""
    spec = feed(name)
    order = next(c for c in ("page", "number") if c in bronze.columns)
    found = records(bronze, spec.path, spec.schema)
    rest = [c for c in found.columns if c not in (*spec.key, "source", order)]
    return found.groupBy(*spec.key).agg(F.min_by(F.struct(*rest), F.struct(order, F.to_json(F.struct(*rest)))).alias("r")).select(*spec.key, "r.*")


def kafka_ticks(spark: SparkSession, servers: str, topic: str, schema: str) -> DataFrame:
    """A topic's records; needs the Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")
