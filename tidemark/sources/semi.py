"""JSON text as variants: parsed once, stored typed, read by paths and by keys that only the data know."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(frame: DataFrame, column: str) -> DataFrame:
    """``frame`` with ``column`` as a variant, and ``fault``: why there is none (``missing`` or ``broken``), null where there is one."""
    value = F.try_parse_json(column)
    fault = F.when(F.col(column).isNull(), "missing").when(value.isNull(), "broken")
    return frame.withColumns({"fault": fault, column: value})


def field(column: str, path: str, kind: str) -> Column:
    """A typed field; null where the path is absent or its value doesn't convert to ``kind``."""
    return F.try_variant_get(column, path, kind)


def kind_of(value: Column) -> Column:
    """A variant's kind, whatever it holds: number, text, truth, object, array or null."""
    shape = F.schema_of_variant(value)
    named = F.when(shape.startswith("OBJECT"), "object").when(shape.startswith("ARRAY"), "array").when(shape == "STRING", "text").when(shape == "BOOLEAN", "truth")
    return named.when(shape == "VOID", "null").otherwise("number")


def exploded(frame: DataFrame, column: str) -> DataFrame:
    """A row for each key of an object, or each place of an array, in ``column``: with ``pos``, ``key`` and ``value``; other variants give none."""
    return frame.lateralJoin(frame.sparkSession.tvf.variant_explode(F.col(column).outer()))
