"""A table function that declares its own columns, and an aggregate over Arrow arrays, for SQL users."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, arrow_udf, udtf
from pyspark.sql.types import DoubleType, LongType, StructType


@udtf
class Drawdowns:
    """Of each partition of a table: its keys, its rows, and the largest fall of a column below its highest value so far.

    ``drawdowns(TABLE(t), 'value', 'order', 'key', ...)``: the function itself asks for the table by keys and in order, and gives the keys' own types.
    """

    def __init__(self) -> None:
        self.keys, self.n, self.top, self.fall = None, 0, None, None

    @staticmethod
    def analyze(table: AnalyzeArgument, value: AnalyzeArgument, order: AnalyzeArgument, *keys: AnalyzeArgument) -> AnalyzeResult:
        if not table.isTable:
            raise ValueError("the first argument must be a table")
        schema, names = StructType(), [k.value for k in keys]
        for name in (*names, value.value, order.value):
            if name not in table.dataType.fieldNames():
                raise ValueError(f"the table has no column {name!r}")
        for name in names:
            schema = schema.add(name, table.dataType[name].dataType)
        schema = schema.add("n", LongType()).add("drawdown", DoubleType())
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn(n) for n in names], orderBy=[OrderingColumn(order.value)])

    def eval(self, row, value: str, order: str, *keys: str):
        self.keys = tuple(row[k] for k in keys)
        self.n += 1
        x = row[value]
        if x is not None:
            self.top = x if self.top is None else max(self.top, x)
            self.fall = max(self.fall or 0.0, float(self.top - x))

    def terminate(self):
        if self.keys is not None:
            yield (*self.keys, self.n, self.fall)


@arrow_udf(DoubleType())
def weighted_median(value: pa.Array, weight: pa.Array) -> float:
    """The least value that holds, with those below it, half of all weight; null values and weights that are not positive don't count."""
    keep = pc.and_kleene(pc.is_valid(value), pc.greater(weight, 0)).fill_null(False)
    x, w = value.filter(keep).to_numpy(zero_copy_only=False), weight.filter(keep).to_numpy(zero_copy_only=False)
    if not len(x):
        return None
    by = np.argsort(x, kind="stable")
    return float(x[by][np.searchsorted(2 * np.cumsum(w[by]), w.sum())])


def register(spark: SparkSession) -> None:
    spark.udtf.register("drawdowns", Drawdowns)
    spark.udf.register("weighted_median", weighted_median)
