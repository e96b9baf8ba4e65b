"""Functions that SQL users get: SQL expressions, an aggregate over Arrow batches, a table function, and a hook for more.

Expressions are inlined by the optimizer and stay in the JVM; the Python ones are for what built-in functions cannot say.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructType

#: name(arguments) to the type it returns and its expression.
EXPRESSIONS = {
    "relative_gap(price DOUBLE, value DOUBLE)": ("DOUBLE", "try_divide(price - value, value)"),
    "clamped(x DOUBLE, low DOUBLE, high DOUBLE)": ("DOUBLE", "CASE WHEN x IS NOT NULL THEN least(greatest(x, low), high) END"),
}


@F.pandas_udf(DoubleType())
def trimmed_mean(values: pd.Series) -> float:
    """Mean without the lowest and highest tenth; null for no values."""
    kept = values.dropna().sort_values()
    cut = len(kept) // 10
    return float(kept.iloc[cut : len(kept) - cut].mean()) if len(kept) else None


@F.udtf(returnType=StructType().add("word", StringType()).add("place", IntegerType()))
class WordsOf:
    """A text's words with their places, one row each."""

    def eval(self, text: str) -> Iterator[tuple[str, int]]:
        yield from ((w, k) for k, w in enumerate((text or "").split()))


def register(spark: SparkSession, extra: dict[str, Callable] | None = None) -> None:
    """Make the functions known to ``spark.sql``; ``extra``: pandas or plain UDFs of the caller's by name."""
    for head, (kind, body) in EXPRESSIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
    spark.udf.register("trimmed_mean", trimmed_mean)
    spark.udtf.register("words_of", WordsOf)
    for name, function in (extra or {}).items():
        spark.udf.register(name, function)
