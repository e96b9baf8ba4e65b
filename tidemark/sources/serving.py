"""Serving stores that a replayed batch leaves as they are: rows are written under their key.

Connections are made on the executors, one a partition, by an injected factory, and rows go in batches.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

from pyspark.sql import DataFrame

BATCH = 500


def _batches(rows: Iterable, size: int) -> Iterator[list]:
    rows = iter(rows)
    while part := list(islice(rows, size)):
        yield part


def upsert_statement(target: str, columns: list[str], keys: list[str], mark: str = "%s") -> str:
    """INSERT that updates the row of an equal key, as PostgreSQL and SQLite have it."""
    rest = [quoted(c) for c in columns if c not in keys]
    update = f"DO UPDATE SET {', '.join(f'{c} = excluded.{c}' for c in rest)}" if rest else "DO NOTHING"
    table, names, unique = ".".join(map(quoted, target.split("."))), ", ".join(map(quoted, columns)), ", ".join(map(quoted, keys))
    return f"INSERT INTO {table} ({names}) VALUES ({', '.join([mark] * len(columns))}) ON CONFLICT ({unique}) {update}"


def quoted(name: str) -> str:
    """A name as SQL has it between quotes."""
    if not name or "\0" in name:
        raise ValueError(f"not a name: {name!r}")
    return '"' + name.replace('"', '""') + '"'


def database_upsert(connect: Callable[[], object], target: str, keys: list[str], mark: str = "%s", batch: int = BATCH) -> Callable[[DataFrame], None]:
    """A sink over any DB-API connection; ``keys`` must be unique in ``target``.  A partition is one transaction."""

    def write(frame: DataFrame) -> None:
        statement = upsert_statement(target, frame.columns, keys, mark)

        def send(rows) -> None:
            connection = connect()
            try:
                cursor = connection.cursor()
                for part in _batches(rows, batch):
                    cursor.executemany(statement, [tuple(r) for r in part])
                connection.commit()
            finally:
                connection.close()

        frame.foreachPartition(send)

    return write


def hash_upsert(client_factory: Callable[[], object], prefix: str, keys: list[str], batch: int = BATCH) -> Callable[[DataFrame], None]:
    """A sink into a key-value store's hashes, through any client with ``pipeline``, ``hset`` and ``execute``; one round trip a batch."""

    def write(frame: DataFrame) -> None:
        def send(rows) -> None:
            client = client_factory()
            for part in _batches(rows, batch):
                pipe = client.pipeline()
                for row in part:
                    values = row.asDict()
                    name = ":".join([prefix, *(str(values[k]) for k in keys)])
                    pipe.hset(name, mapping={k: json.dumps(v, default=str) for k, v in values.items()})
                pipe.execute()

        frame.foreachPartition(send)

    return write
