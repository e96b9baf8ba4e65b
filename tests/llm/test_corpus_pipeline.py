"""The pipeline's stages on a small table, each against what it must keep."""

import math
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import contamination, near_duplicates, quality

sys.path.insert(0, str(Path(__file__).parent))
import test_corpus_operators as plain  # noqa: E402


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    seen = [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, seen[-1], data).persist()
        assert out.columns == docs.columns and 0 < out.count() <= seen[-1].count(), (k, name)
        seen.append(out)
    ids = lambda frame: {r.doc_id for r in frame.select("doc_id").collect()}
    assert ids(seen[1]) == ids(quality.judge(docs).where("kept"))
    classes = near_duplicates.classes(seen[2])
    assert ids(seen[3]) == {r.class_id for r in classes.collect()}
    found = contamination.digest(contamination.find_overlaps(seen[3], spark.read.parquet(f"{data}/benchmark.parquet")))
    assert ids(seen[4]) == ids(found.where("not contaminated"))
    packed = corpus_pipeline.STAGES[-1][1](spark, seen[4], data)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids(seen[4])
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_run(spark, data):
    assert corpus_pipeline.run(spark, data).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified"]


def _kept_by_quality(rows):
    """Base rules and band, from the plain scores."""
    scores = plain._plain_scores([(lang, t) for _, t, lang in rows], 2, 2)
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _ in rows]

    def fails(w):
        seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        hit = {p for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for p in range(k, k + 8)}
        return len(w) < 20 or 100 * len(hit) > 30 * len(w)

    good = [k for k, w in enumerate(words) if not fails(w)]
    floor = lambda x: math.floor(x * quality.NAT + 1e-9)
    kept = []
    for lang in {rows[k][2] for k in good}:
        mine = [k for k in good if rows[k][2] == lang]
        size = {k: plain.real_words(rows[k][1]) + 1 for k in mine}
        score = {k: round(scores[k] * size[k] * quality.NAT) / quality.NAT / size[k] for k in mine}
        middle = np.percentile([floor(score[k]) for k in mine], 50) / quality.NAT
        z = {k: (score[k] - middle) / math.sqrt(1 + quality.SHORT / len(words[k])) for k in mine}
        q1, q3 = (np.percentile([floor(z[k]) for k in mine], q) / quality.NAT for q in (25, 75))
        spread = max(q3 - q1, 0.01)
        assert all(min(abs(z[k] + quality.BELOW * spread), abs(z[k] - quality.ABOVE * spread)) > 0.003 for k in mine), "too near to a band's edge to tell"
        kept += [k for k in mine if -quality.BELOW * spread <= z[k] <= quality.ABOVE * spread]
    return [rows[k] for k in sorted(kept)]


def _one_of_each(rows):
    sets = plain._sets([t for _, t, _ in rows])
    root = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(i):
                if rows[i][1] == rows[j][1] or (sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])):
                    root[i] = root[j] = min(root[i], root[j])
    return [r for k, r in enumerate(rows) if root[k] == k]  # rows stand in the order of their ids


def _clean(rows, items):
    out = []
    for r in rows:
        w, hit = plain._plain_words(r[1]), set()
        for item in items:
            q = plain._plain_words(item)
            n = min(13, len(q))
            grams = {tuple(q[k : k + n]) for k in range(len(q) - n + 1)} if n else set()
            hit |= {p for k in range(len(w) - n + 1) if n and tuple(w[k : k + n]) in grams for p in range(k, k + n)}
        if not (hit and 20 * len(hit) >= len(w)):
            out.append(r)
    return out


def test_run_by_plain_python(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(21)
    pool = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    line = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    text = lambda: "\n".join(line(rng.randint(4, 14)) for _ in range(rng.randint(4, 9)))
    items = [line(20), line(15), "alone"]
    rows = [(k, text(), "en") for k in range(24)]
    rows += [(24, rows[2][1], "en"), (25, rows[3][1].rsplit("\n", 1)[0] + "\n" + line(9), "en"), (26, text() + "\n" + items[0], "en"), (27, "| " * 60 + line(9), "en"), (28, None, "en"), (29, "too short", "en")]
    rows += [(30, text(), "en"), (30, text(), "en"), (None, text(), "en"), (None, text() + "\n" + items[1], "en"), (31, " ".join([line(8)] * 9), "en")]
    rows.sort(key=lambda r: 99 if r[0] is None else r[0])
    frame = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = _kept_by_quality(rows)
    assert 15 < len(kept) < len(rows)
    cut = plain._plain_runs([(k, r[1]) for k, r in enumerate(kept)])
    kept = [(r[0], cut[k][0], r[2]) for k, r in enumerate(kept) if cut[k][0].strip()]
    kept = _clean(_one_of_each(kept), items)
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((i, zlib.crc32(np.array([*model.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes())) for i, t, _ in kept)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == want and all(r.length <= 1024 for r in got)


def test_empty_documents(spark, tmp_path):
    frame = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "an item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
