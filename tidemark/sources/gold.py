"""Gold tables in the session's catalog, and the views that the dashboard reads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DATABASE = "tidemark_gold"

#: View name to its query over gold tables.
VIEWS = {
    "company_overview": """SELECT m.company_id, m.company, m.peer_group, m.fiscal_year, m.revenue, m.eps, m.roe, v.price, v.lo, v.mid, v.hi, v.gap,
  coalesce(abs(v.gap) <= 0.1D, false) AS near FROM {db}.company_metrics m JOIN {db}.valuation v ON v.company_id = m.company_id""",
}
KEPT = 2  # versions of a table that readers may still be reading


def publish(frame: DataFrame, name: str, database: str = DATABASE, bucket_by: tuple[str, ...] = (), buckets: int = 16) -> None:
    """Replace what ``name`` shows.  The rows go to a table of their own first, then the view ``name`` turns to it, so readers see the old rows or the new.

    With ``bucket_by`` rows are stored in ``buckets`` by those columns and sorted: tables with the same buckets are joined on them without a shuffle.
    """
    spark = frame.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    number = len(_versions(spark, name, database))
    table = f"{name}__{max([-1, *(v for v, _ in _versions(spark, name, database))]) + 1:08d}_{uuid.uuid4().hex[:8]}"
    if bucket_by:
        frame = frame.repartition(buckets, *bucket_by)  # a file a bucket
    writer = frame.write.format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(f"{database}.{table}")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {database}.{table}")
    if number >= KEPT:
        for _, old in _versions(spark, name, database)[:-KEPT]:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{old}")


def _versions(spark: SparkSession, name: str, database: str) -> list[tuple[int, str]]:
    """(number, table) of the tables behind a view, oldest first."""
    found = [t.name for t in spark.catalog.listTables(database, f"{name}__*") if t.tableType != "VIEW"]
    return sorted((int(t.removeprefix(f"{name}__").split("_")[0]), t) for t in found if t.removeprefix(f"{name}__")[:8].isdigit())


def create_views(spark: SparkSession, database: str = DATABASE) -> None:
    for name, sql in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {sql.format(db=database)}")
