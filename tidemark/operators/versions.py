"""Values that are filed again: who knew what when.

A version of a key holds from when it was filed until the next filing of that key.  Reading as of a date sees the versions filed by then and no later one,
so nothing looks ahead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FROM, TO, NUMBER = "filed_from", "filed_to", "version"


def versions(filings: DataFrame, keys: list[str], at: str, tie: list[str]) -> DataFrame:
    """``filings`` with ``filed_from``, ``filed_to`` (null: still holds) and ``version`` (from 1), in place of ``at``.

    Of filings of one key at one time the last by ``tie`` counts, so a filing that arrives twice is one.  Filings without a time are left out.
    """
    order = F.struct(*tie) if tie else F.lit(0)
    rest = [c for c in filings.columns if c not in (*keys, at)]
    one = filings.where(F.col(at).isNotNull()).groupBy(*keys, at).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, F.col(at).alias(FROM), "r.*")
    w = Window.partitionBy(*keys).orderBy(FROM)
    return one.select("*", F.lead(FROM).over(w).alias(TO), F.row_number().over(w).cast("long").alias(NUMBER))


def merged(known: DataFrame, filings: DataFrame, keys: list[str], at: str, tie: list[str]) -> DataFrame:
    """The version table with more filings in it, whenever those were filed: a late one splits the range it falls into.

    Only keys that are filed again are computed anew; the others pass as they are.
    """
    touched = filings.where(F.col(at).isNotNull()).select(*keys).distinct()
    same = lambda a, b: _all(a[k].eqNullSafe(b[k]) for k in keys)
    old = known.join(touched, same(known, touched), "left_semi").drop(TO, NUMBER).withColumnRenamed(FROM, at)
    again = versions(old.unionByName(filings.select(*old.columns)), keys, at, tie)
    return known.join(touched, same(known, touched), "left_anti").unionByName(again.select(*known.columns))


def as_filed(table: DataFrame, when: Column) -> DataFrame:
    """The versions in force at ``when``: each key's last one filed by then."""
    return table.where((F.col(FROM) <= when) & (F.col(TO).isNull() | (F.col(TO) > when)))


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out &= c
    return out
