"""Table access.  Only the columns a query names reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def read_any(spark: SparkSession, fmt: str, path: str, schema: str | None = None, **options: str) -> DataFrame:
    """CSV, JSON, ORC, Parquet, text or XML with an explicit schema.

    Inference is refused for CSV and JSON because it drops the leading zeros of
    tickers and turns data-dependent keys into struct fields.
    """
    if fmt in ("csv", "json") and schema is None:
        raise ValueError(f"{fmt} needs an explicit schema")
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)
