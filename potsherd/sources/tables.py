"""Publishing typed tables, and reading and writing them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from potsherd.functions.values import to_date, to_flag, to_int


def coerced(value: Column, kind: T.DataType, length: int | None = None, nested: bool = False) -> Column:
    """A value as its target column takes it. What can't be read is null; texts are cut to ``length`` and empty instead of null."""
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return to_int(value).try_cast(kind.simpleString())
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return value.cast("string").try_cast(kind.simpleString())
    if isinstance(kind, T.BooleanType):
        return to_flag(value).cast("boolean")
    if isinstance(kind, T.DateType):
        return to_date(value.cast("string"))
    if isinstance(kind, T.StringType):
        text = F.coalesce(F.nullif(F.to_json(value) if nested else value.cast("string"), F.lit("nan")), F.lit(""))
        return F.substring(text, 1, length) if length else text
    return value


def declared(ddl: str) -> list[tuple[str, T.DataType, int | None]]:
    """Columns of a declaration such as ``putnr int, aard varchar(80), datum date``; a varchar's length is where its texts are cut."""
    lengths = {m[1]: int(m[2]) for m in re.finditer(r"(\w+)\s+varchar\((\d+)\)", ddl)}
    schema = T.StructType.fromDDL(re.sub(r"varchar\(\d+\)", "string", ddl))
    return [(f.name, f.dataType, lengths.get(f.name)) for f in schema.fields]


def conformed(df: DataFrame, ddl: str, keep_nested: bool = True) -> DataFrame:
    """The declared columns that ``df`` has, coerced. Nested columns stay as they are, or become JSON text."""
    kinds = dict(df.dtypes)
    out = []
    for name, kind, length in declared(ddl):
        if name in kinds:
            nested = kinds[name].startswith(("map", "struct", "array"))
            out.append(F.col(name) if nested and keep_nested else coerced(F.col(name), kind, length, nested).alias(name))
    return df.select(*out)


def column_report(df: DataFrame, ddl: str) -> dict[str, list[str]]:
    """Columns that both sides have, that only the data has, and that only the declaration has."""
    have, want = set(df.columns), {name for name, _, _ in declared(ddl)}
    return {"loaded": sorted(have & want), "undeclared": sorted(have - want), "absent": sorted(want - have)}


def publish(df: DataFrame, path: str, ddl: str | None = None, partition: str | None = None) -> None:
    """Write a table over its older version, which goes first; ``versions.publish`` keeps it until the new one is whole."""
    out = conformed(df, ddl) if ddl else df
    writer = out.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def read_table(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def export_csv(df: DataFrame, path: str) -> None:
    """Semicolons between values, a header, and double quotes doubled."""
    flat = df.select(*[F.to_json(c).alias(c) if kind.startswith(("map", "struct", "array")) else F.col(c) for c, kind in df.dtypes])
    flat.write.mode("overwrite").option("sep", ";").option("header", True).option("quote", '"').option("escape", '"').csv(path)
