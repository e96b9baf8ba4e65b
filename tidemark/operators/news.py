"""News: exact deduplication, company mapping, enrichment results, issues.

Enrichment results come from an outside service as a table; they stay in this
module's frames (see ``valuation.FORBIDDEN``).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import text_key
from tidemark.session import written_batches


def dedup(news: DataFrame) -> DataFrame:
    """The first item of each normalised text and how many there were.  Ties go to the smaller id."""
    return news.groupBy(text_key(F.col("text")).alias("text_sha256")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


def map_companies(news: DataFrame, aliases: list[tuple[str, str]]) -> DataFrame:
    """Rows (doc_id, company) where any alias occurs in the text.

    The alias list is configuration, so it becomes expressions: one pass, no join.
    """
    by_company: dict[str, list[str]] = {}
    for company, alias in aliases:
        by_company.setdefault(company, []).append(alias.lower())
    low = F.lower("text")
    hits = [F.when(F.exists(F.array(*map(F.lit, names)), lambda a: F.contains(F.col("_low"), a)), F.lit(company)) for company, names in by_company.items()]
    return news.select("doc_id", low.alias("_low")).select("doc_id", F.explode(F.array_compact(F.array(*hits))).alias("company"))


def keywords(news: DataFrame, k: int, letters: int = 6) -> DataFrame:
    """``news`` with ``keywords``: the ``k`` most frequent ASCII words of at least ``letters`` letters, ties in alphabetical order; no shuffle.

    Step by step in columns of their own, so that nothing is computed anew for every word.
    """
    out = news.withColumn("_words", F.array_sort(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{%d,}" % letters), F.lit(0))))
    # equal words stand together: a word's count is the distance of the places where runs begin
    pairs = F.zip_with("_words", F.concat(F.array(F.lit("")), "_words"), lambda w, before: F.struct(w.alias("w"), before.alias("before")))
    begins = F.filter(F.transform(pairs, lambda p, i: F.struct(p["w"].alias("w"), p["before"].alias("before"), i.alias("i"))), lambda p: p["w"].isNotNull() & (p["w"] != p["before"]))
    out = out.withColumn("_begins", begins)
    ends = F.concat(F.transform(F.slice("_begins", 2, F.greatest(F.size("_begins"), F.lit(1))), lambda p: p["i"]), F.array(F.size("_words")))
    counted = F.zip_with("_begins", ends, lambda p, e: F.struct((p["i"] - e).alias("n"), p["w"].alias("w")))
    top = F.slice(F.array_sort(F.filter(counted, lambda c: c["w"].isNotNull())), 1, k)
    return out.withColumn("keywords", F.transform(top, lambda c: c["w"])).drop("_words", "_begins")


def with_results(news: DataFrame, results: DataFrame) -> DataFrame:
    return news.join(results, "doc_id", "left")


def unenriched(news: DataFrame, results: DataFrame) -> DataFrame:
    """What still has to go to the enrichment service."""
    return news.join(results, "doc_id", "left_anti")


def sentiment_mix(enriched: DataFrame, by: str) -> DataFrame:
    n = lambda cond: F.count(F.when(cond, 1))
    return enriched.groupBy(by).agg(
        n(F.col("sentiment") == "positive").alias("positive"), n(F.col("sentiment") == "neutral").alias("neutral"),
        n(F.col("sentiment") == "negative").alias("negative"), n(F.col("sentiment").isNull()).alias("unlabelled"),
    )


def top_issues(enriched: DataFrame, by: str, k: int) -> DataFrame:
    """The ``k`` longest labelled items of each group (a top-k report); ties go to the smaller id."""
    w = Window.partitionBy(by).orderBy(F.col("n_chars").desc(), "doc_id")
    return enriched.where("sentiment is not null").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def enrich(news: DataFrame, call: Callable[[list[str]], list[dict]], batch: int = 32, key: str = "long") -> DataFrame:
    """Send texts in batches through ``call`` and keep its sentiment, category and summary."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                replies = call(part["text"].fillna("").tolist())
                columns = {c: [r.get(c) for r in replies] for c in ("sentiment", "category", "summary")}
                ids = part["doc_id"].reset_index(drop=True)
                yield pd.DataFrame({"doc_id": ids.astype(object) if key == "string" else ids} | {c: pd.Series(x, dtype=object) for c, x in columns.items()})

    return news.select("doc_id", "text").mapInPandas(run, f"doc_id {key}, sentiment string, category string, summary string")


def tried(call: Callable[[list[str]], list[dict]], tries: int = 4, pause: float = 0.5) -> Callable[[list[str]], list[dict]]:
    """``call``, asked again after a growing pause when it fails or answers for another number of texts."""

    def asked(texts: list[str]) -> list[dict]:
        for k in range(tries):
            try:
                answers = call(texts)
                if len(answers) != len(texts):
                    raise ValueError(f"{len(answers)} answers for {len(texts)} texts")
                return answers
            except Exception:
                if k + 1 == tries:
                    raise
                time.sleep(pause * 2**k)
        raise AssertionError

    return asked


ANSWER = "text_sha256 string, sentiment string, category string, summary string"


def answers(spark: SparkSession, folder: str) -> DataFrame:
    """Every answer in the store, one a text."""
    if not written_batches(spark, folder):
        return spark.createDataFrame([], ANSWER)
    return spark.read.schema(ANSWER).parquet(*written_batches(spark, folder).values())


def enrich_once(news: DataFrame, folder: str, call: Callable[[list[str]], list[dict]], batch: int = 32, rounds: int = 4) -> DataFrame:
    """``news`` (doc_id, text, ...) with the service's sentiment, category and summary; a text that the store in ``folder`` has an answer for is never sent again.

    Equal texts (``text_key``) are sent once.  New ones go in ``rounds``, by a hash of the text; each round's answers are a folder of their own, so after a failure
    what was paid for before it stays.  Runs over one store must not overlap.  Null texts are not sent and have no answer.
    """
    spark = news.sparkSession
    texts = news.where("text IS NOT NULL").groupBy(text_key(F.col("text")).alias("text_sha256")).agg(F.min("text").alias("text"))
    for k in range(rounds):
        done = written_batches(spark, folder)
        some = texts.where(F.pmod(F.xxhash64("text_sha256"), F.lit(rounds)) == k)
        todo = some.join(answers(spark, folder).select("text_sha256"), "text_sha256", "left_anti")
        paid = enrich(todo.withColumnRenamed("text_sha256", "doc_id"), tried(call), batch, "string").withColumnRenamed("doc_id", "text_sha256")
        paid.write.mode("overwrite").parquet(f"{folder}/{max(done, default=-1) + 1}")
    return news.withColumn("text_sha256", text_key(F.col("text"))).join(answers(spark, folder), "text_sha256", "left")
