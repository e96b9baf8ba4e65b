"""Names of companies in texts, by a table of aliases: one pass over a text however many aliases there are.

The aliases become an Aho-Corasick automaton on every executor.  A table larger than ``LIMIT`` is cut into blocks by a hash of the alias and the texts are
read once a block, so what is broadcast stays within the limit at any size and the result is the same.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 32 << 20  # bytes of aliases and companies at once, with OVERHEAD each
OVERHEAD = 64
ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}  # what a company may be
_built: dict[str, ahocorasick.Automaton] = {}  # a worker keeps the last one


def normal(aliases: DataFrame) -> DataFrame:
    """(company, alias): in small letters, without space at the ends, each pair once; empty and null ones left out."""
    return aliases.select("company", F.lower(F.trim("alias")).alias("alias")).where("company IS NOT NULL AND alias <> ''").distinct()


def _automaton(key: str, rows: list[tuple[str, list]]) -> ahocorasick.Automaton:
    if key not in _built:
        _built.clear()
        automaton = ahocorasick.Automaton()
        for alias, companies in rows:
            automaton.add_word(alias, (alias, companies))
        automaton.make_automaton()
        _built[key] = automaton
    return _built[key]


def _inner(char: str) -> bool:
    return char.isalnum() or char == "_"


def mentions(text: str, automaton: ahocorasick.Automaton) -> Counter:
    """Alias to the number of places where it stands as a whole word: a letter, digit or underscore at its end has no other such beside it."""
    found, n = Counter(), len(text)
    for end, (alias, _) in automaton.iter(text):
        begin, after = end + 1 - len(alias), end + 1
        if (begin and _inner(alias[0]) and _inner(text[begin - 1])) or (after < n and _inner(alias[-1]) and _inner(text[after])):
            continue
        found[alias] += 1
    return found


def map_aliases(news: DataFrame, aliases: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(doc_id, company, alias, n): every alias in every text, for each company that has it; ``n`` places, overlapping ones too.

    Texts and aliases are compared in small letters.  Null texts have none; rows of ``news`` that share an id give rows each.
    """
    spark, table = news.sparkSession, normal(aliases)
    size = table.agg(F.sum(F.octet_length("alias") + F.octet_length(F.col("company").cast("string")) + OVERHEAD)).first()[0] or 0
    blocks = size // limit + 1
    company = dict(table.dtypes)["company"]
    schema = f"doc_id {dict(news.dtypes)['doc_id']}, company {company}, alias string, n long"
    texts = news.select("doc_id", F.lower("text").alias("text")).where("text <> ''")
    out = None
    for k in range(blocks):
        block = table.where(F.pmod(F.xxhash64("alias"), F.lit(blocks)) == k).groupBy("alias").agg(F.sort_array(F.collect_set("company")).alias("companies"))
        sent = spark.sparkContext.broadcast([(r.alias, r.companies) for r in block.collect()])

        def scan(batches: Iterator[pa.RecordBatch], sent=sent, key=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(key, sent.value) if sent.value else None
            companies = dict(sent.value)
            for batch in batches:
                rows = []
                for at, text in enumerate(batch.column(1).to_pylist()):
                    if automaton:
                        rows += [(at, c, alias, n) for alias, n in mentions(text, automaton).items() for c in companies[alias]]
                at, named, alias, n = zip(*rows, strict=True) if rows else ((), (), (), ())
                ids = batch.column(0).take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(named, ARROW[company]), pa.array(alias, pa.string()), pa.array(n, pa.int64())], names=["doc_id", "company", "alias", "n"])

        part = texts.mapInArrow(scan, schema)
        out = part if out is None else out.unionByName(part)
    return out
