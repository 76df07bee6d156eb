"""Reports on what became of the data: reconciliation of stages, fill rates, profiles, near matches of names."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def two_levels(df: DataFrame, project: str, table: str, stage: str) -> DataFrame:
    """Per table: its projects as a list, rows, number of projects, and the name of the stage."""
    once = df.groupBy(project, table).agg(F.count(F.lit(1)).alias("n"))
    return once.groupBy(table).agg(F.array_sort(F.collect_list(project)).alias("projects"), F.sum("n").alias("n_rows"), F.count(project).alias("n_projects")).withColumn("stage", F.lit(stage))


def reconciled(stages: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows of each ``key`` in every stage, 0 where there are none. The stages are counted first, then joined."""
    counted = [df.groupBy(key).agg(F.count(F.lit(1)).alias(name)) for name, df in stages.items()]
    out = counted[0]
    for more in counted[1:]:
        out = out.join(more, key, "full")
    return out.select(key, *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in stages])


def mismatched(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Tuples that only one side has, and which one."""
    a = left.select(*columns).distinct().withColumn("_l", F.lit(1))
    b = right.select(*[F.col(c).alias(f"_{c}") for c in columns]).distinct().withColumn("_r", F.lit(1))
    on = F.lit(True)
    for c in columns:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    both = a.join(b, on, "full").where("_l IS NULL OR _r IS NULL")
    return both.select(*[F.coalesce(c, f"_{c}").alias(c) for c in columns], F.when(F.col("_l").isNull(), "right").otherwise("left").alias("side"))


def status(data: DataFrame, meta: DataFrame, keys: list[str]) -> DataFrame:
    """Whether each key has data, metadata or both."""
    a = data.select(*keys).distinct().withColumn("_d", F.lit(1))
    b = meta.select(*keys).distinct().withColumn("_m", F.lit(1))
    both = a.join(b, keys, "full")
    return both.select(*keys, F.when(F.col("_m").isNull(), "data").when(F.col("_d").isNull(), "meta").otherwise("both").alias("status"))


def fill_rates(df: DataFrame, columns: list[str], group: str | None = None) -> DataFrame:
    """(group,) attribute, filled, n_rows, fill_percent: how many rows have a value, rounded half to even."""
    by = [group] if group else []
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(F.col(c)).alias(c) for c in columns])
    long = wide.unpivot([*by, "n_rows"], columns, "attribute", "filled")
    return long.select(*by, "attribute", "filled", "n_rows", F.bround(100.0 * F.col("filled") / F.col("n_rows"), 0).alias("fill_percent"))


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: rows, nulls, different values, least and largest value as text."""
    told = [
        F.struct(
            F.lit(c).alias("attribute"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.countDistinct(F.col(c)).alias("n_distinct"),
            F.min(c).cast("string").alias("low"),
            F.max(c).cast("string").alias("high"),
        )
        for c in columns
    ]
    return df.agg(F.array(*told).alias("told")).select(F.inline("told"))


def pushed(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group its values in order, repeated ones included, their number and all rows."""
    return df.groupBy(group).agg(F.array_sort(F.collect_list(value)).alias("items"), F.count(F.lit(1)).alias("n")).withColumn("n_items", F.size("items"))


def remarked(df: DataFrame, group: str, lists: str, remark: str, between: str = ",") -> DataFrame:
    """Per group the different items of its lists, and its remarks as one text, both in order."""
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_list(lists))))
    return df.groupBy(group).agg(items.alias("items"), F.array_join(F.array_sort(F.collect_list(remark)), between).alias("remarks"))


def flattened(df: DataFrame, group: str, lists: str) -> DataFrame:
    """Per group the different items of its lists, in order. Items are told apart before they meet."""
    each = df.select(group, F.explode(lists).alias("item")).distinct()
    return each.groupBy(group).agg(F.array_sort(F.collect_list("item")).alias("items"))


def longest(df: DataFrame, group: str, text: str) -> DataFrame:
    """Per group its longest text; of equally long ones the first in order."""
    return df.groupBy(group).agg(F.min(F.when(F.col(text).isNotNull(), F.struct((-F.length(text)).alias("size"), F.col(text).alias("text")))).alias("best")).select(group, F.col("best.text").alias("longest"))


def frequencies(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *columns)


def near_names(names: DataFrame, name: str, known: DataFrame, known_name: str, most: int = 3) -> DataFrame:
    """(name, match, distance): known names of an edit distance under ``most``.

    Two names with a distance below k share one of the pieces that the known one falls into when cut into k parts, at nearly
    the same place; so names meet by pieces, and no name is compared with all others.
    """
    left = names.select(F.col(name).alias("name")).where("name IS NOT NULL").distinct()
    right = known.select(F.col(known_name).alias("match")).where("match IS NOT NULL").distinct()
    k = most  # parts: at most `most` - 1 edits leave one of them whole
    size = F.length("match")
    at = lambda i: F.floor(size * i / k).cast("int")
    pieces = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), at(i).alias("at"), F.substr("match", at(i) + 1, at(i + 1) - at(i)).alias("piece")) for i in range(k)]))
    cut = right.select("match", size.alias("length"), pieces.alias("p")).select("match", "length", "p.part", "p.at", "p.piece")
    # every length that a match may have, and the places at which its parts may then stand
    lengths = left.withColumn("length", F.explode(F.sequence(F.greatest(F.length("name") - (most - 1), F.lit(0)), F.length("name") + most - 1)))
    spots = lengths.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    begin = F.floor(F.col("length") * F.col("part") / k).cast("int")
    end = F.floor(F.col("length") * (F.col("part") + 1) / k).cast("int")
    moved = spots.select("name", "length", "part", begin.alias("at"), (end - begin).alias("width"), F.explode(F.sequence(F.greatest(begin - (most - 1), F.lit(0)), begin + most - 1)).alias("from"))
    keyed = moved.select("name", "length", "part", F.substr("name", F.col("from") + 1, F.col("width")).alias("piece")).distinct()
    met = keyed.join(cut, ["length", "part", "piece"]).select("name", "match").distinct()
    return met.withColumn("distance", F.levenshtein("name", "match")).where(F.col("distance") < most)


def close_matches(names: DataFrame, name: str, known: list[str], n: int = 3, cutoff: float = 0.6) -> DataFrame:
    """(name, match, ratio): the best ``n`` of a short list of known names by the ratio of matching blocks."""

    @F.pandas_udf("array<struct<match:string,ratio:double>>")
    def best(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def of(value: str | None) -> list[dict]:
            found = difflib.get_close_matches(value, known, n, cutoff) if value else []
            return [{"match": m, "ratio": difflib.SequenceMatcher(None, m, value).ratio()} for m in found]

        for batch in batches:
            yield batch.map(of)

    different = names.select(F.col(name).alias("name")).distinct()
    return different.select("name", F.inline(best("name")))


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key by ``order``."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("_k = 1").drop("_k")
