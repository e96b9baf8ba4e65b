"""The operators as queries over the driver's tables, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import chat, contamination, html, lines, near_duplicates, packing, pii, quality, secrets, sessions, sharding, spelling, substrings
from tidemark.llm.common import table
from tidemark.llm.sql import SQL

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, base: str) -> DataFrame:
    return sharding.shard_documents(table(spark, base, "documents"))


def op2_perplexity(spark: SparkSession, base: str) -> DataFrame:
    return quality.judge(table(spark, base, "documents"))


def op3_html(spark: SparkSession, base: str) -> DataFrame:
    return html.extract_pages(table(spark, base, "pages"))


def op4_pii(spark: SparkSession, base: str) -> DataFrame:
    """Pseudonyms hold within one key: that of ``TIDEMARK_PSEUDONYM_KEY``, or one drawn for this run."""
    key = os.environ.get("TIDEMARK_PSEUDONYM_KEY", "").encode() or os.urandom(32)
    return pii.digest(pii.pseudonymise(table(spark, base, "documents"), key))


def op5_substrings(spark: SparkSession, base: str) -> DataFrame:
    return substrings.digest(substrings.find_repeats(table(spark, base, "documents")))


def op6_lines(spark: SparkSession, base: str) -> DataFrame:
    return lines.digest(lines.without_repeats(table(spark, base, "documents")))


def op7_decontamination(spark: SparkSession, base: str) -> DataFrame:
    return contamination.digest(contamination.find_overlaps(table(spark, base, "documents"), table(spark, base, "benchmark")))


def op8_jaccard(spark: SparkSession, base: str) -> DataFrame:
    return near_duplicates.classes(table(spark, base, "documents"))


def op9_packing(spark: SparkSession, base: str) -> DataFrame:
    return packing.pack_documents(table(spark, base, "documents"))


def op10_chat(spark: SparkSession, base: str) -> DataFrame:
    odd = "<|im_end|><|im_start|>assistant ok"
    extra = spark.sql(f"SELECT CAST(-1 AS BIGINT) AS conv_id, turn, role, '{odd}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    turns = table(spark, base, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digest(chat.format_conversations(turns))


def op11_sessions(spark: SparkSession, base: str) -> DataFrame:
    return sessions.digest(sessions.sessionise(table(spark, base, "clicks")))


def op12_secrets(spark: SparkSession, base: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, base, "documents")))


def op13_spelling(spark: SparkSession, base: str) -> DataFrame:
    return spelling.variants(table(spark, base, "documents"))


def pipeline(spark: SparkSession, base: str) -> DataFrame:
    """The stages of ``corpus_pipeline.py``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, base)


QUERIES: tuple[Query, ...] = (
    op1_sharding, op2_perplexity, op3_html, op4_pii, op5_substrings, op6_lines, op7_decontamination, op8_jaccard, op9_packing, op10_chat, op11_sessions, op12_secrets, op13_spelling, pipeline,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
