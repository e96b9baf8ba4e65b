"""Company statements: two source layouts to one schema, and the metrics derived from it.

The driver's tables carry no filings, so a supplier is a company and its line
items of a calendar year are the statement of that fiscal year.  Each item is a
fixed linear form of the line items (``ITEMS``); everything after that is
independent of the stand-in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import change

#: Statement items as SQL over a line item.
ITEMS = {
    "revenue": "l_extendedprice * (1 - l_discount)",
    "operating_income": "l_extendedprice * (0.4 - l_discount)",
    "net_income": "l_extendedprice * (0.4 - l_discount - l_tax)",
    "operating_cash_flow": "l_extendedprice * (0.45 - l_discount - l_tax)",
    "capex": "case when l_returnflag = 'R' then l_extendedprice * 0.1 else 0 end",
    "assets": "l_extendedprice * 2",
    "liabilities": "case when l_linestatus = 'O' then l_extendedprice * 1.2 else l_extendedprice * 0.6 end",
    "shares": "l_quantity",
}
#: The second layout's account codes, mapped to the common items.
ACCOUNTS = {"ifrs-full_Revenue": "revenue", "dart_OperatingIncomeLoss": "operating_income", "Revenues": "revenue", "OperatingIncomeLoss": "operating_income"}


def yearly_statements(lineitem: DataFrame) -> DataFrame:
    """One row per company and fiscal year.  One shuffle, partial aggregation before it."""
    sums = [F.sum(F.expr(sql)).alias(name) for name, sql in ITEMS.items()]
    out = lineitem.groupBy(F.col("l_suppkey").alias("company_id"), F.year("l_shipdate").alias("fiscal_year")).agg(*sums)
    return out.withColumn("equity", F.col("assets") - F.col("liabilities")).withColumn("eps", F.try_divide("net_income", "shares"))


def revenue_in_order(lineitem: DataFrame, *position: Column) -> DataFrame:
    """Revenue by company and fiscal year, added up row by row in the order of ``position``.

    A floating sum depends on the order of addition, which shows where exact sums end on half of the digit they are rounded to.
    One shuffle and a sort that spills; the rows of a company's year meet in one task, since such a sum has no partial sums.
    """
    keys, places = ["company_id", "fiscal_year"], [f"place_{i}" for i in range(len(position))]
    rows = lineitem.select(
        F.col("l_suppkey").alias("company_id"), F.year("l_shipdate").alias("fiscal_year"), F.expr(ITEMS["revenue"]).alias("x"),
        *(p.alias(name) for p, name in zip(position, places, strict=True)),
    )
    w = Window.partitionBy(*keys).orderBy(*places)
    so_far, later = F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lead(F.lit(1)).over(w)
    return rows.select(*keys, so_far.alias("revenue"), later.alias("later")).where("later is null").drop("later")


def with_metrics(statements: DataFrame, tax_rate: float = 0.25) -> DataFrame:
    """FCF, EPS, ROE, ROIC and growth against the company's preceding fiscal year; null where that year is missing.

    ROIC uses liabilities plus equity as invested capital, since cash and debt are
    not reported separately.  A first year has no growth and no average equity.
    """
    w = Window.partitionBy("company_id").orderBy("fiscal_year")
    before = lambda name: F.when(F.lag("fiscal_year").over(w) == F.col("fiscal_year") - 1, F.lag(name).over(w))
    return statements.select(
        "*",
        (F.col("operating_cash_flow") - F.col("capex")).alias("fcf"),
        F.try_divide(F.col("net_income"), (F.col("equity") + before("equity")) / 2).alias("roe"),
        F.try_divide(F.col("operating_income") * (1 - tax_rate), F.col("liabilities") + F.col("equity")).alias("roic"),
        change(F.col("revenue"), before("revenue")).alias("revenue_growth"),
        change(F.col("operating_cash_flow") - F.col("capex"), before("operating_cash_flow") - before("capex")).alias("fcf_growth"),
    )


def latest_statements(metrics: DataFrame) -> DataFrame:
    """The latest year of each company, as an aggregate: no sort, no window."""
    rest = [c for c in metrics.columns if c not in ("company_id", "fiscal_year")]
    return metrics.groupBy("company_id").agg(F.max_by(F.struct("fiscal_year", *rest), F.col("fiscal_year")).alias("r")).select("company_id", "r.*")


def long_facts(frame: DataFrame, keys: list[str], source: str, accounts: dict[str, Column]) -> DataFrame:
    """One source's wide filing as long facts under that source's own account codes."""
    wide = frame.select(*keys, *(e.cast("double").alias(code) for code, e in accounts.items()))
    return wide.unpivot(keys, list(accounts), "account", "value").withColumn("source", F.lit(source))


def to_common_schema(facts: list[DataFrame], mapping: dict[str, str] = ACCOUNTS) -> DataFrame:
    """Union of long facts, account codes mapped to common items, one column an item.

    The mapping is code, not data, so it becomes a literal map and needs no join.
    """
    items = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    union = facts[0]
    for more in facts[1:]:
        union = union.unionByName(more, allowMissingColumns=True)
    named = union.withColumn("item", F.try_element_at(items, F.col("account"))).where("item is not null")
    return named.groupBy("source", "company_id", "fiscal_year").pivot("item", sorted(set(mapping.values()))).agg(F.sum("value"))
