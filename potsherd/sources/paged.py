"""Tables kept in the order of a view, so that any page costs its own rows: ranges of the order in folders of their own, and a
directory of how many rows come before each range."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from potsherd.operators.ranges import cut
from potsherd.operators.views import sorting
from potsherd.sources import versions

#: Rows of a range, about; a page reads one range or a few.
RANGE_ROWS = 100_000


def _rows(spark: SparkSession, root: str) -> DataFrame:
    told = versions.content(spark, root)
    if told is None:
        raise ValueError(f"no stored pages in {root}")
    kind = StructType.fromJson(told["schema"])
    return spark.read.schema(StructType([*kind.fields, StructField("_range", IntegerType())])).parquet(f"{root}/rows")


def store(df: DataFrame, root: str, *keys: tuple[str, bool], tie: str, rows: int = RANGE_ROWS) -> None:
    """Write ``df`` below ``root``, a new folder, in the order of (column, ascending) ``keys`` and ``tie``, as ``views.ordered`` has it.

    ``tie`` should tell rows apart: rows that are equal in the whole order share a range. Pages can be read once all is
    written; a write that dies is done again in another folder.
    """
    spark = df.sparkSession
    cut(df, *sorting(*keys, tie=tie), rows=rows).write.partitionBy("_range").parquet(f"{root}/rows")
    dealt = spark.read.schema("_range int").parquet(f"{root}/rows")  # from folders and footers alone
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).write.parquet(f"{root}/directory")
    versions.commit(spark, root, 0, {"schema": json.loads(df.schema.json())})


def page(spark: SparkSession, root: str, number: int, size: int, *keys: tuple[str, bool], tie: str) -> DataFrame:
    """Page ``number`` (from 0) of a stored table, equal to ``views.page`` of it; only the ranges that hold it are read."""
    begin = number * size
    holds: Column = (F.col("before") + F.col("n") > begin) & (F.col("before") < begin + size)
    hits = spark.read.parquet(f"{root}/directory").where(holds).select("_range", "before").collect()
    read = _rows(spark, root).where(F.col("_range").isin([r["_range"] for r in hits])).drop("_range")
    skipped = begin - min((r["before"] for r in hits), default=begin)
    return read.orderBy(*sorting(*keys, tie=tie)).offset(skipped).limit(size)


def total(spark: SparkSession, root: str) -> int:
    """All rows, from the directory."""
    return spark.read.parquet(f"{root}/directory").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
