"""Profiles of tables in one pass, by sketches that merge: different values, quantiles and frequent values.

A row of sketches for each part of a table (a day's load, a project) is small; the profile of any set of parts comes from
their rows, without reading the table again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, IntegerType, LongType, NumericType, StringType

#: Registers of the sketch of different values: 2^14, for a standard error of 0.65 %.
REGISTERS = 14
#: Size of the sketch of quantiles: a rank is off by less than 0.4 %, nearly always.
RANKS = 800
#: Values that are tracked as frequent. A column with at most three quarters as many different values is counted exactly.
TRACKED = 1024
QUANTILES = (0.0, 0.25, 0.5, 0.75, 1.0)
#: The column of sketches; no column of ``by`` may have its name.
PROFILE = "_profile"


def _hashed(name: str, kind: DataType) -> Column:
    return F.col(name) if isinstance(kind, (IntegerType, LongType, StringType, BinaryType)) else F.col(name).cast("string")


def sketches(df: DataFrame, columns: list[str], *by: str) -> DataFrame:
    """One row for each value of ``by`` (or one in all), with counts, bounds and sketches for each of ``columns``.

    Partial sketches are made before the shuffle, and no row is multiplied by the columns.
    """
    kinds = {c: df.schema[c].dataType for c in columns}

    def of(c: str) -> Column:
        number = F.col(c).cast("double") if isinstance(kinds[c], NumericType) else F.lit(None).cast("double")
        finite = F.when(~F.isnan(number), number)
        parts = [F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(c).isNull()).alias("nulls"), F.min(c).alias("low"), F.max(c).alias("high")]
        frequent = F.expr(f"approx_top_k_accumulate(CAST(`{c}` AS STRING), {TRACKED})")
        made = [F.hll_sketch_agg(_hashed(c, kinds[c]), F.lit(REGISTERS)).alias("distinct"), F.kll_sketch_agg_double(finite, F.lit(RANKS)).alias("ranks"), frequent.alias("frequent")]
        return F.struct(*parts, *made).alias(c)

    return df.groupBy(*by).agg(F.struct(*[of(c) for c in columns]).alias(PROFILE))


def merged(parts: DataFrame, columns: list[str], *by: str) -> DataFrame:
    """Rows of ``sketches`` merged into one for each value of ``by``, or one in all; no rows give none."""

    def of(c: str) -> Column:
        x = lambda f: F.col(f"{PROFILE}.`{c}`.{f}")
        frequent = F.expr(f"approx_top_k_combine({PROFILE}.`{c}`.frequent, {TRACKED})")
        bounds = [F.sum(x("n_rows")).alias("n_rows"), F.sum(x("nulls")).alias("nulls"), F.min(x("low")).alias("low"), F.max(x("high")).alias("high")]
        return F.struct(*bounds, F.hll_union_agg(x("distinct")).alias("distinct"), F.kll_merge_agg_double(x("ranks"), F.lit(RANKS)).alias("ranks"), frequent.alias("frequent")).alias(c)

    # grouped in any case: frequent values don't merge with what an ungrouped aggregate gives for an empty partition
    return parts.groupBy(*(by or [F.lit(0).alias("_all")])).agg(F.struct(*[of(c) for c in columns]).alias(PROFILE)).drop("_all")


def told(parts: DataFrame, columns: list[str], *by: str, most: int = 10) -> DataFrame:
    """(by,) attribute, n_rows, nulls, n_distinct, low, high, quantiles, frequent.

    ``quantiles`` (of numbers, null for other columns and for none but nulls) are the least value, the quartiles and the
    greatest; ``frequent`` holds up to ``most`` (item, count), more frequent ones first, equal ones by item. Of a column with
    more values than are counted exactly, only those that are surely frequent stand there, so it may be empty.
    """
    asked = F.array(*[F.lit(q) for q in QUANTILES])

    def of(c: str) -> Column:
        x = lambda f: F.col(f"{PROFILE}.`{c}`.{f}")
        some = F.kll_sketch_get_n_double(x("ranks")) > 0
        items = F.filter(F.expr(f"approx_top_k_estimate({PROFILE}.`{c}`.frequent, {TRACKED})"), lambda e: e["item"].isNotNull())
        ordered = F.array_sort(F.transform(items, lambda e: F.struct((-e["count"]).alias("n"), e["item"].alias("item"))))
        frequent = F.transform(F.slice(ordered, 1, most), lambda e: F.struct(e["item"].alias("item"), (-e["n"]).alias("count")))
        return F.struct(
            F.lit(c).alias("attribute"),
            x("n_rows").alias("n_rows"),
            x("nulls").alias("nulls"),
            F.hll_sketch_estimate(x("distinct")).alias("n_distinct"),
            x("low").cast("string").alias("low"),
            x("high").cast("string").alias("high"),
            F.when(some, F.kll_sketch_get_quantile_double(x("ranks"), asked)).alias("quantiles"),
            frequent.alias("frequent"),
        )

    return parts.select(*by, F.inline(F.array(*[of(c) for c in columns])))
