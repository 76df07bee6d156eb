"""Work along an order without a task that sees all rows: ranges of the order, and what comes before each of them.

Rows are dealt into ranges by sampled bounds, each range is handled by itself, and what it needs to know of the rows before it
comes from one small row for each earlier range. Rows that are equal in the whole order share a range, so an order should end
with something that tells rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from potsherd.operators.hierarchy import written

#: Rows of a range, about.
ROWS = 1_000_000


def cut(df: DataFrame, *order: Column | str, rows: int = ROWS) -> DataFrame:
    """``df`` in ranges of about ``rows`` rows, with ``_range``, their numbers in order; not yet written."""
    n = max(1, -(-df.count() // rows))
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    return df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("_range", F.spark_partition_id())


def ranged(df: DataFrame, *order: Column | str, rows: int = ROWS) -> DataFrame:
    """As ``cut``, written, so that a range that is computed again holds the same rows."""
    return written(cut(df, *order, rows=rows))


def same(*columns: tuple[str, str]) -> Column:
    """Whether columns agree, nulls with nulls."""
    fits = F.lit(True)
    for a, b in columns:
        fits = fits & F.col(a).eqNullSafe(F.col(b))
    return fits


def sums_before(df: DataFrame, group: str, order: str, value: str, name: str) -> DataFrame:
    """``df`` (as ``ranged`` by group and order gives it) with ``name``, the sum of ``value`` over the rows before in the group."""
    within = Window.partitionBy(group, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("_g").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(F.col(group).alias("_g"), F.col("_range").alias("_r")).agg(F.sum(value).alias("_s"))
    before = sums.withColumn("_before", F.sum("_s").over(earlier)).drop("_s")
    placed = df.withColumn("_own", F.sum(value).over(within)).join(before, same((group, "_g"), ("_range", "_r")))
    return placed.withColumn(name, F.coalesce("_own", F.lit(0)) + F.coalesce("_before", F.lit(0))).drop("_own", "_before", "_g", "_r")
