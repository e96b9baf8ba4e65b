"""Spelling variants against all pairs of words."""

import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from compare import difference
from pyspark.sql import functions as F

from tidemark.llm import spelling
from tidemark.llm.sql import SQL


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_pairs(rows):
    count = Counter()
    for d, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            at = h % len(run)
            count[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {w: (best if near[w] and n[best := min(near[w], key=lambda x: (-n[x], x))] >= 2 * n[w] else None) for w in n}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else 0) for w in n)


def some_rows(seed):
    """Families of misspelt words, runs of equal letters, words that share a half, accents, capitals, repeated rows."""
    rng, out = random.Random(seed), []
    letters = "abcé×ÿÀzz"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))) for _ in range(25)] + ["aaaaa", "aaaaaa", "zzzzzzz", "abcabcabcabc"]

    def misspelt(w):
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]])
        return rng.choice([w, w, w.upper() if w.isascii() else w])

    for k in range(160):
        words = [misspelt(rng.choice(stems)) for _ in range(25)] + ["interna" + "".join(rng.choice("abcd") for _ in range(5)) for _ in range(12)]
        out.append((k, rng.choice([" ", "-", "\n", "1"]).join(words)))
    return out + out[:3] + [(None, None), (None, ""), (None, " ".join(["nameless", "namelass"] * 4)), (7, "internaaaaaa" * 3), (901, "chainlink " * 64 + "chainlnk " * 16 + "chainlk " * 7 + "chanlk " * 3)]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_against_all_pairs_and_sql(spark, tmp_path, seed, monkeypatch):
    monkeypatch.setattr(spelling, "RECTANGLES", 50)
    rows = some_rows(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = spelling.variants(docs.withColumns({c: F.lit("x") for c in ("word", "n", "form", "run", "h", "side", "half", "size")}))
    got = sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in out.collect())
    assert got == by_pairs(rows)
    assert sum(r[1] != "" for r in got) > 100 and any(r[2] not in (r[0], r[1]) for r in got)
    docs.coalesce(1).write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    assert difference(out, con, SQL["op13_spelling"]) == ([], [], [])


def test_trees_report_what_a_search_finds():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 64, 100):
        values = rng.permutation(n)
        a, c = rng.integers(0, n + 1, (2, 200))
        b, d = np.minimum(n, a + rng.integers(0, n + 1, 200)), np.minimum(n, c + rng.integers(0, n + 1, 200))
        q, v = spelling.Tree(values).report(a, b, c, d)
        want = [(k, x) for k in range(200) for x in values[a[k] : b[k]] if c[k] <= x < d[k]]
        assert sorted(zip(q.tolist(), v.tolist(), strict=True)) == sorted((k, int(x)) for k, x in want)


def test_long_words_and_empty_table(spark):
    long, began = "ab" * 200_000, time.perf_counter()
    text = " ".join([long] * 6 + ["x" + long[1:]] * 3 + [long[:-1]] * 3 + [long[:1000] + long[1001:]] * 3)
    got = {(r.n, r.n_near, r.form_n, len(r.root)) for r in spelling.variants(spark.createDataFrame([(1, text), (2, "ab " * 9)], "doc_id long, text string")).collect()}
    assert got == {(6, 3, None, 400_000), (3, 1, 6, 400_000)} and time.perf_counter() - began < 60
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
