"""Line deduplication: prefix doubling over line sequences, common-prefix intervals, maximal repeated runs.

Each document is the sequence of its lines that hold a word.  A line's number is its hash; the rank of 2k lines at a place is
the hash of the ranks of the k lines there and the k lines after them, so that equal ranks mean equal runs.  Places with a
common prefix of some length are an interval of the suffix array, a node of its tree of common prefixes.  Which intervals contain which is
needed, the order beside each other is not, so places are grouped by rank instead of sorted.

The first place of an interval in order (doc_id, text hash, line) stays; at every later place the lines are deleted, as judged on the
input.  A single line repeats on its own if it has at least ``min_words`` words, a run if it has at least ``min_lines`` lines; what goes are
the lines of all maximal runs, and lines without a word inside them.

A run is maximal if it has an earlier verbatim copy, one line more from the same place has none, and
no longer such run of the document contains it.  It can begin only where an earlier copy of its first ``min_lines`` lines follows another
line (or at the first line of the document).  The intervals of these places are parted: by 2, 4, 8, ... lines more while any agree, then by half of what
failed, down to one.  Places that agree go on as an interval of their own and leave their first one behind, which stands for all of them, so each
step has at most two rows a place, whatever the lengths; a text of one line repeated n times takes n log n work.

A null id comes after all others; a null or empty text has no lines; rows equal in id
and text count as one place; a very long text is one row of line numbers; other columns stay as they are; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Rounds, settled, spread_join

MIN_LINES, MIN_WORDS = 2, 5
_HAS_WORD = r"[^\x20\x09-\x0D]"
_NONE = "array<struct<a:int,b:int>>"
_LAST = 2**63 - 1
PLACE = ("ord", "u1", "u2", "idx")


def _uid() -> list[Column]:
    """A 128-bit name of a document's id and text."""
    return [F.xxhash64("doc_id", "text").alias("u1"), F.xxhash64(F.lit(7), "text", "doc_id").alias("u2")]


def _sequences(documents: DataFrame, min_words: int) -> DataFrame:
    """(u1, u2, ord, seq): per document its lines with words: place in the text, 96-bit number, whether it has enough words."""
    enough = r"^\s*(?:\S+\s+){%d}\S" % (min_words - 1)
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("x"))), lambda s: s["x"].rlike(_HAS_WORD))
    seq = F.transform(lines, lambda s: F.struct(s["line"].alias("line"), F.xxhash64(s["x"]).alias("h"), F.hash(s["x"]).alias("c"), s["x"].rlike(enough).alias("enough")))
    return documents.where("text is not null").select(*_uid(), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("ord"), seq.alias("seq"))


def _places(sequences: DataFrame, min_lines: int) -> DataFrame:
    """(ord, u1, u2, idx, a, b, h, c, before, run, left): single lines with enough words and runs of ``min_lines``, with the line before and the lines left."""
    kind = lambda run, h, c, b: F.struct(run.alias("run"), h.alias("h"), c.alias("c"), b.alias("b"))

    def at(line: Column, i: Column) -> Column:
        # within the row, so that a long document's sequence is not copied to each of its lines
        parts = [line, *(F.get("seq", i + k) for k in range(1, min_lines))]
        one = F.when(line["enough"], kind(F.lit(False), F.xxhash64(line["h"], F.lit("one")), line["c"], line["line"] + 1))
        two = F.when(i + min_lines <= F.size("seq"), kind(F.lit(True), F.xxhash64(*(x["h"] for x in parts)), F.hash(*(x["c"] for x in parts)), parts[-1]["line"] + 1))
        return F.struct(i.alias("idx"), line["line"].alias("a"), F.get("seq", i - 1)["h"].alias("before"), (F.size("seq") - i).alias("left"), F.array_compact(F.array(one, two)).alias("kinds"))

    rows = sequences.select("ord", "u1", "u2", F.inline(F.transform("seq", at)))
    rows = rows.select("ord", "u1", "u2", "idx", "a", "before", "left", F.explode("kinds").alias("k"))
    return rows.select("ord", "u1", "u2", "idx", "a", "k.b", "k.h", "k.c", "before", "k.run", "left")


def _place() -> Column:
    return F.struct(*PLACE)


def _starts(later: DataFrame) -> DataFrame:
    """Of the runs with an earlier copy, those at which a maximal one may begin."""
    runs = later.where("run")
    other = ~F.col("before").eqNullSafe(F.col("first.before"))
    second = runs.where(other).groupBy("h", "c").agg(F.min(_place()).alias("second"))
    sizes = runs.groupBy("h", "c").agg(F.count("*").alias("n"))
    second = settled(second.join(sizes, ["h", "c"]))
    sure = other | (F.col("idx") == 0)
    rest = spread_join(runs.where(~sure), second, ["h", "c"], "n", ["u1", "idx"]).where(F.col("second") < _place())
    keep = [*PLACE, "h", "c", "left"]
    return runs.where(sure).select(*keep).unionByName(rest.select(*keep))


def _split(entries: DataFrame, sequences: DataFrame, j: int, rounds: Rounds) -> DataFrame:
    """Each node's places (u1, u2, idx, n1, n2, cur, asks, members) parted by the 2^j lines after the ``cur`` lines that the node has in common.

    Places that agree with others make a node of their own (``grown``); of these the first also stays, for all of them.
    A node none of whose later places asks is left out.
    """
    step = 1 << j
    held = F.collect_list(F.struct("idx", "n1", "n2", "cur", "asks", "members")).alias("held")
    rows = entries.groupBy("u1", "u2").agg(held).join(sequences, ["u1", "u2"])

    def ranks(column: str, pair: Callable[[Column, Column], Column]) -> Column:
        # rank(2k, i) from rank(k, i) and rank(k, i + k); places with too few lines left are not asked for
        double = lambda r, k: F.zip_with(r, F.slice(r, k + 1, F.size("seq")), pair)
        return F.aggregate(F.array(*(F.lit(1 << k) for k in range(j))).cast("array<int>"), F.transform("seq", lambda s: s[column]), double)

    def name(r: Column, x: Column) -> Column:
        at = x["idx"] + x["cur"]
        fits = at + step <= F.size("seq")
        k1 = F.when(fits, F.xxhash64(x["n1"], F.get(r["h"], at))).otherwise(F.xxhash64("u1", x["idx"], x["n1"]))
        kept = (x[c].alias(c) for c in ("idx", "n1", "n2", "cur", "asks", "members"))
        return F.struct(*kept, fits.alias("fits"), k1.alias("k1"), F.hash(x["n2"], F.get(r["c"], at)).alias("k2"))

    # bound by a lambda, so that the ranks of a document are made once
    both = F.array(F.struct(ranks("h", lambda a, b: F.xxhash64(a, b)).alias("h"), ranks("c", lambda a, b: F.hash(a, b)).alias("c")))
    named = rounds.keep(rows.select("ord", "u1", "u2", F.inline(F.get(F.transform(both, lambda r: F.transform("held", lambda x: name(r, x))), F.lit(0)))))
    asking = F.sum(F.col("asks").cast("int"))
    groups = named.where("fits").groupBy("k1", "k2").agg(F.min(F.struct(*PLACE, "asks")).alias("first"), F.count("*").alias("n"), asking.alias("asking"))
    groups = rounds.keep(groups.where("n > 1").withColumn("alive", F.col("asking") > F.col("first.asks").cast("int")).drop("asking"))
    joined = spread_join(named, groups, ["k1", "k2"], "n", ["u1", "idx"], how="left")
    one = F.coalesce(F.struct(*(F.col(f"first.{c}") for c in PLACE)) == _place(), F.lit(False))
    alone = F.col("n").isNull()

    def row(n1: str, n2: str, cur: Column, asks: Column, members: Column, grown: bool) -> Column:
        return F.struct(F.col(n1).alias("n1"), F.col(n2).alias("n2"), cur.alias("cur"), asks.alias("asks"), members.alias("members"), F.lit(grown).alias("grown"))

    grown = F.when(F.col("alive"), row("k1", "k2", F.col("cur") + step, F.col("asks") & ~one, F.col("n"), True))
    stays = F.when(alone | (one & (F.col("n") != F.col("members"))), row("n1", "n2", F.col("cur"), F.col("asks"), F.lit(-1).cast("long"), False))
    return rounds.keep(joined.select("u1", "u2", "idx", F.inline(F.array_compact(F.array(grown, stays)))))


def _lengths(places: DataFrame, starts: DataFrame, sequences: DataFrame, min_lines: int) -> DataFrame:
    """(u1, u2, idx, size): the longest run from each start that has an earlier copy."""
    groups = starts.groupBy("h", "c").agg(F.lit(1).alias("_one"))
    sizes = places.where("run").groupBy("h", "c").agg(F.count("*").alias("members"))
    groups = settled(groups.join(sizes, ["h", "c"]).drop("_one"))
    mark = starts.select("u1", "u2", "idx", F.lit(True).alias("asks")).distinct()
    entries = spread_join(places.where("run").select("u1", "u2", "idx", "h", "c"), groups, ["h", "c"], "members", ["u1", "idx"]).join(mark, ["u1", "u2", "idx"], "left")
    rounds = Rounds(places.sparkSession)
    entries = rounds.keep(entries.select("u1", "u2", "idx", F.col("h").alias("n1"), F.col("c").alias("n2"), F.lit(min_lines).alias("cur"), F.coalesce("asks", F.lit(False)).alias("asks"), "members"))
    sequences = rounds.keep(sequences.join(entries.select("u1", "u2").distinct(), ["u1", "u2"], "left_semi"))
    # up: 2^j lines more as long as any agree; then down, for what failed at 2^j: 2^(j-1), 2^(j-2), ... lines more
    j, rising, failed = min_lines.bit_length() - 1, entries, {}
    while not rising.isEmpty():
        parted = _split(rising, sequences, j, rounds)
        failed[j - 1], rising = parted.where("not grown").drop("grown"), parted.where("grown").drop("grown")
        j += 1
    falling = entries.limit(0)
    for k in range(j - 2, -1, -1):
        falling = _split(falling.unionByName(failed[k]) if k in failed else falling, sequences, k, rounds).drop("grown")
    return rounds.last(falling.where("asks").select("u1", "u2", "idx", F.col("cur").alias("size")))


def _joined(ranges: Column) -> Column:
    """Sorted ranges with touching and overlapping ones made one."""
    start = F.array().cast(_NONE)

    def add(acc: Column, r: Column) -> Column:
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], r["b"]).alias("b"))))
        return F.when((F.size(acc) > 0) & (r["a"] <= F.coalesce(last["b"], F.lit(-1))), grown).otherwise(F.concat(acc, F.array(r)))

    return F.aggregate(ranges, start, add)


def repeated(documents: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(u1, u2, ranges, n_runs, longest_run): per text the line ranges to delete, sorted, disjoint, half open, and the maximal repeats they come from."""
    if min_lines < 2:
        raise ValueError("a run has two lines at least")
    sequences = settled(_sequences(documents, min_words).dropDuplicates(["u1", "u2"]))  # read by every step
    places = settled(_places(sequences, min_lines))
    first = settled(places.groupBy("h", "c").agg(F.min(F.struct(*PLACE, "before")).alias("first"), F.count("*").alias("n")).where("n > 1"))
    later = spread_join(places, first, ["h", "c"], "n", ["u1", "idx"])
    later = settled(later.where(F.struct(*(F.col(f"first.{c}") for c in PLACE)) < _place()).drop("n"))
    starts = settled(_starts(later))
    found = _lengths(places, starts, sequences, min_lines).unionByName(later.where("not run").select("u1", "u2", "idx", F.lit(1).alias("size")))
    # longest first at each place: what does not reach beyond all before it is contained
    before = Window.partitionBy("u1", "u2").orderBy("idx", F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("idx") + F.col("size")
    maximal = found.withColumn("reached", F.coalesce(F.max(end).over(before), F.lit(0))).where(end > F.col("reached"))
    runs = maximal.groupBy("u1", "u2").agg(F.array_sort(F.collect_list(F.struct("idx", "size"))).alias("runs"), F.count("*").alias("n_runs"), F.max("size").cast("long").alias("longest_run"))
    line = lambda i: F.get("seq", i)["line"]
    ranges = F.transform("runs", lambda r: F.struct(line(r["idx"]).alias("a"), (line(r["idx"] + r["size"] - 1) + 1).alias("b")))
    return runs.join(sequences, ["u1", "u2"]).select("u1", "u2", _joined(ranges).alias("ranges"), "n_runs", "longest_run")


def without_repeats(documents: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``documents`` with deleted lines cut from ``text``, and the columns ``ranges``, ``before`` (the text as it was), ``n_runs`` and ``longest_run``."""
    new = ("ranges", "before", "n_runs", "longest_run")
    found = repeated(documents, min_lines, min_words)
    found = found.withColumnsRenamed({c: f"_{c}" for c in found.columns})
    u1, u2 = _uid()
    joined = documents.withColumns({"_u1": u1, "_u2": u2}).join(found, ["_u1", "_u2"], "left")
    inside = lambda i: F.exists("_ranges", lambda r: (r["a"] <= i) & (i < r["b"]))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~inside(i)), "\n")
    names = [c for c in documents.columns if c not in ("text", *new)]
    return joined.select(
        *names, F.when(F.col("_ranges").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.coalesce("_ranges", F.array().cast(_NONE)).alias("ranges"), F.col("text").alias("before"),
        *(F.coalesce(f"_{c}", F.lit(0)).alias(c) for c in new[2:]),
    )


def _has_word(line: Column) -> Column:
    return line.rlike(_HAS_WORD)


def digest(deduplicated: DataFrame) -> DataFrame:
    """Per document: lines with words, those deleted, maximal runs with an earlier copy, the longest of them, and the digest of what is left."""
    n = lambda text: F.coalesce(F.size(F.filter(F.split(text, "\n"), _has_word)), F.lit(0)).cast("long")
    kept = F.when(F.size("ranges") > 0, n("text")).otherwise(n("before"))
    out = deduplicated.select("doc_id", n("before").alias("n_lines"), kept.alias("_kept"), "n_runs", "longest_run", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
    return out.select("doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), (F.col("n_lines") - F.col("_kept")).alias("n_removed"), "n_runs", "longest_run", "kept_sha256")


def dedup_stage(documents: DataFrame) -> DataFrame:
    """``documents`` without repeated lines; a document that loses all its words goes."""
    out = without_repeats(documents)
    out = out.where((F.size("ranges") == 0) | F.coalesce(F.col("text").rlike(_HAS_WORD), F.lit(False)))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.size("ranges") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*documents.columns)
