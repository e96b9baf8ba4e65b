"""Secret scans: multipart credentials linked by interval joins within scopes.

Each text is scanned once, whole, for parts: identifiers, secrets and endpoints.  Strong parts (``BASE``) are reported wherever they stand; weak
ones (``WEAK``) could be anything, so they are reported only with what completes them:

- an identifier and a secret of one scope, at most ``reach`` code points apart, are a pair;
- a pair with a strong side is a credential, and its weak side is reported;
- a pair of two weak sides is one only with an endpoint within ``reach`` of both; endpoints that so complete a pair are reported.

A scope is a stretch of text without an empty line.  Pairs come from an interval join: spans are dealt to the bins of ``BIN`` code points that they
touch, so a key is one bin of one text and holds a bounded number of spans, however long the text or common the words.

Spans are code points, end exclusive.  A null text is empty; rows with equal or null ids stay rows of their own; an
empty table gives an empty result; other columns are ignored.  Weak candidates that touch a strong part, and weak secrets inside an endpoint, are dropped.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settled

# The strong kinds' patterns, least lengths and order.
_NAMED = r"""["']?\x20*[:=]\x20*["']?"""
BASE = {
    "assign": (re.compile(rf"(?:password|passwd|secret|token|api_?key){_NAMED}([A-Za-z0-9+/_.=-]+)", re.I | re.A), 8),
    "access": (re.compile(r"(AKIA[A-Z0-9]+)"), 16),
    "hex": (re.compile(r"([0-9a-f]+)"), 32),
}
#: What could be a part of a credential, with the least length of its value.
WEAK = {
    "identifier": (re.compile(rf"(?:user(?:name)?|login|account|client_?id|key_?id){_NAMED}([A-Za-z0-9_.@+-]+)", re.I | re.A), 3),
    "endpoint": (re.compile(r"(https?://[A-Za-z0-9._~:/?#@%&=+-]+)"), 11),
    "secret": (re.compile(r"([A-Za-z0-9+/_-]+)"), 16),
}
ORDER = ("assign", "access", "hex", "identifier", "secret", "endpoint")
IDENTIFIERS, SECRETS = ("access", "identifier"), ("assign", "hex", "secret")
SCOPE_END = re.compile(r"\n[\x20\t\r]*\n")
REACH = 200
BIN = 1024

_MIXED = tuple(map(re.compile, ("[a-z]", "[A-Z]", "[0-9]")))
_SPAN = pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("scope", pa.int64())])
SPANS = "array<struct<start:long,rank:int,end:long,scope:long>>"


def _matches(text: str, pattern: re.Pattern, least: int) -> list[tuple[int, int]]:
    return [m.span() for m in pattern.finditer(text) if m.end(1) - m.start(1) >= least]


def _apart(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those that touch none of ``taken``, which may overlap each other."""
    taken, reached, ends = sorted(taken), 0, []
    for _, end in taken:
        reached = max(reached, end)
        ends.append(reached)
    starts = [s for s, _ in taken]
    return [(a, b) for a, b in spans if not (k := bisect_right(starts, b - 1)) or ends[k - 1] <= a]


def parts_of(text: str) -> tuple[list[tuple], list[tuple]]:
    """(strong parts, all parts): (start, rank, end, scope); none in the second list where no pair is possible."""
    found = {kind: _matches(text, *rule) for kind, rule in BASE.items()}
    strong = [s for spans in found.values() for s in spans]
    found["identifier"] = _apart(_matches(text, *WEAK["identifier"]), strong)
    if any(found[k] for k in IDENTIFIERS):
        found["endpoint"] = _apart(_matches(text, *WEAK["endpoint"]), strong)
        mixed = [(a, b) for a, b in _matches(text, *WEAK["secret"]) if all(p.search(text, a, b) for p in _MIXED)]
        found["secret"] = _apart(mixed, strong + found["identifier"] + found["endpoint"])
    ends = [m.end() for m in SCOPE_END.finditer(text)]
    rows = sorted((a, ORDER.index(kind), b, bisect_right(ends, a)) for kind, spans in found.items() for a, b in spans)
    base = [r for r in rows if ORDER[r[1]] in BASE]
    possible = all(any(found.get(k) for k in kinds) for kinds in (IDENTIFIERS, SECRETS)) and len(base) < len(rows)
    return base, rows if possible else []


def find_parts(documents: DataFrame) -> DataFrame:
    """(uid, doc_id, base, parts), settled; ``uid`` names the row."""
    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, base {SPANS}, parts {SPANS}"
    names = [f.name for f in _SPAN]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_rows = lambda rows: pa.array([[dict(zip(names, r, strict=True)) for r in x] for x in rows], pa.list_(_SPAN))
        for batch in batches:
            found = [parts_of(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), as_rows(f[0] for f in found), as_rows(f[1] for f in found)], names=["doc_id", "base", "parts"])

    return settled(documents.select("doc_id", "text").mapInArrow(scan, schema).withColumn("uid", F.monotonically_increasing_id()))


def _in_bins(spans: DataFrame, lo: Column, hi: Column) -> DataFrame:
    return spans.withColumns({"lo": lo, "hi": hi}).withColumn("bin", F.explode(F.sequence(F.floor(F.col("lo") / BIN), F.floor(F.col("hi") / BIN))))


def _near(a: DataFrame, b: DataFrame) -> DataFrame:
    """Interval join: rows of ``a`` and ``b`` in one text and scope whose ranges lo..hi (both inclusive) meet; a pair is kept in the first bin both touch."""
    joined = a.alias("a").join(b.alias("b"), ["uid", "scope", "bin"]).where("a.lo <= b.hi AND b.lo <= a.hi")
    return joined.where(F.floor(F.greatest("a.lo", "b.lo") / BIN) == F.col("bin"))


def link(found: DataFrame, reach: int = REACH) -> DataFrame:
    """(uid, added): the weak spans that complete a credential, by row of ``find_parts``; rows without any are missing."""
    part = found.select("uid", F.inline("parts"))
    of = lambda *kinds: part.where(F.col("rank").isin(*(ORDER.index(k) for k in kinds)))
    span = F.struct("start", "rank", "end").alias("span")
    wide = _in_bins(of(*IDENTIFIERS), F.col("start") - reach, F.col("end") + reach).select("uid", "scope", "bin", "lo", "hi", span)
    narrow = _in_bins(of(*SECRETS), F.col("start"), F.col("end")).select("uid", "scope", "bin", "lo", "hi", span)
    pairs = _near(wide, narrow).select("uid", "scope", F.col("a.span").alias("i"), F.col("b.span").alias("s"))
    strong = [ORDER.index(k) for k in BASE]
    sure = pairs.where(F.col("i.rank").isin(strong) | F.col("s.rank").isin(strong)).select("uid", F.explode(F.array("i", "s")).alias("span"))
    both = _in_bins(pairs, F.greatest("i.start", "s.start") - reach, F.least("i.end", "s.end") + reach)
    ends = _in_bins(of("endpoint"), F.col("start"), F.col("end")).select("uid", "scope", "bin", "lo", "hi", span)
    whole = _near(both, ends).select("uid", F.explode(F.array("a.i", "a.s", "b.span")).alias("span"))
    added = sure.unionByName(whole).where(~F.col("span.rank").isin(strong)).distinct()
    return added.groupBy("uid").agg(F.collect_list("span").alias("added"))


def find_secrets(documents: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, base, spans), one row a document: arrays of (start, rank, end) by start and rank; ``rank`` counts ``ORDER``."""
    found = find_parts(documents)
    bare = F.transform("base", lambda p: F.struct(p["start"].alias("start"), p["rank"].alias("rank"), p["end"].alias("end")))
    none = F.array().cast("array<struct<start:long,rank:int,end:long>>")
    joined = found.select("uid", "doc_id", bare.alias("base")).join(link(found, reach), "uid", "left")
    return joined.select("doc_id", F.array_sort("base").alias("base"), F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the strong kinds, their hash, and all spans as text."""
    kinds = F.array(*map(F.lit, ORDER))
    text = lambda spans: F.array_join(F.transform(spans, lambda p: F.concat_ws(":", F.get(kinds, p["rank"]), p["start"], p["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda p: p["rank"] == ORDER.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(k) for k in BASE), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))
