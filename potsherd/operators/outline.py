"""Indented lists: the names above each row, read along ranges of the list's order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from potsherd.operators.ranges import ROWS, ranged, same


def outline_paths(outline: DataFrame, levels: list[str], order: str, scheme: str | None = None, rows: int = ROWS) -> DataFrame:
    """``outline`` with ``uris``, the names from the top down to each row, and ``parent_uri``.

    A row of an indented list has a name in the column of its own level; a name counts for the rows below it until a row of
    the same or a higher level comes. ``scheme`` names a column that tells lists apart, each of which is read by itself.

    A list is dealt into ranges of about ``rows`` rows. Each range folds to the last name of every level in it, one row; the
    last names before a range come from these rows, and within the range from its own. So a long list is no single task.
    ``order`` should tell the rows of a list apart.
    """
    by = [scheme] if scheme else []
    dealt = ranged(outline, *by, order, rows=rows)
    # the place at which each level was last set, and the name that was set there
    set_at = {k: F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.col(order).alias("at"), F.col(f"`{c}`").alias("name"))) for k, c in enumerate(levels)}
    key = F.col(scheme) if scheme else F.lit(0)
    folded = dealt.groupBy(key.alias("_s"), F.col("_range").alias("_r")).agg(*[F.max(m).alias(f"_b{k}") for k, m in set_at.items()])
    earlier = Window.partitionBy("_s").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    carried = folded.select("_s", "_r", *[F.last(f"_b{k}", ignorenulls=True).over(earlier).alias(f"_b{k}") for k in set_at])
    both = dealt.withColumn("_scheme", key).join(carried, same(("_scheme", "_s"), ("_range", "_r")))
    upto = Window.partitionBy("_scheme", "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marks = {f"_l{k}": F.coalesce(F.last(m, ignorenulls=True).over(upto), F.col(f"_b{k}")) for k, m in set_at.items()}
    own = F.coalesce(*[F.when(F.col(f"`{c}`").isNotNull(), k) for k, c in reversed(list(enumerate(levels)))])
    placed = both.withColumns(marks).withColumn("_level", own)

    def current(k: int) -> Column:
        above = [F.col(f"_l{j}.at") for j in range(k)]
        newer = reduce(lambda x, y: x | y, [F.coalesce(a > F.col(f"_l{k}.at"), F.lit(False)) for a in above], F.lit(False))
        return F.when((F.col("_level") >= k) & ~newer, F.col(f"_l{k}.name"))

    path = F.filter(F.array(*[current(k) for k in range(len(levels))]), lambda x: x.isNotNull())
    return placed.withColumn("uris", path).withColumn("parent_uri", F.try_element_at("uris", F.lit(-2))).select(*outline.columns, "uris", "parent_uri")
