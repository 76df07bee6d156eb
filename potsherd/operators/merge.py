"""Merging duplicates, moving what needs no merge, and generating what is referred to but missing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_duplicates(df: DataFrame, keys: list[str], order: str = "_seq", lineage: list[str] | None = None, sources: str | None = None, null_keys: bool = False) -> DataFrame:
    """One row per key: of each field the last known value by ``order``, which tells rows apart.

    ``lineage`` columns are gathered as a set of structs ``lineage``, ``sources`` (the source row) as an array of the
    different ones, with their number as ``brondata_count``. Rows whose key isn't complete stay as they are, unless
    ``null_keys`` makes them one group, too.
    """
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    gathered = {*(lineage or []), *([sources] if sources else [])}
    fields = [c for c in df.columns if c not in {*keys, order, *gathered}]
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in fields]
    extra: list[Column] = [F.max(order).alias(order)]
    if lineage:
        extra.append(F.array_sort(F.collect_set(F.struct(*lineage))).alias("lineage"))
    if sources:
        # maps can't be grouped or told apart; their sorted entries can
        extra.append(F.array_sort(F.collect_set(F.array_sort(F.map_entries(sources)))).alias("_sources"))

    def grouped(rows: DataFrame, by: list[str]) -> DataFrame:
        out = rows.groupBy(*by).agg(*latest, *extra)
        if sources:
            out = out.withColumns({sources: F.transform("_sources", F.map_from_entries), "brondata_count": F.size("_sources")}).drop("_sources")
        return out

    if null_keys:
        return grouped(df, keys)
    whole = grouped(df.where(complete), keys)
    alone = df.where(~complete)
    singles = alone.select(*keys, *fields, order)
    if lineage:
        singles = alone.select(*keys, *fields, order, F.array(F.struct(*lineage)).alias("lineage"), *([sources] if sources else []))
    elif sources:
        singles = alone.select(*keys, *fields, order, sources)
    if sources:
        singles = singles.withColumns({sources: F.when(F.col(sources).isNotNull(), F.array(sources)).otherwise(F.array().cast(f"array<{dict(df.dtypes)[sources]}>"))}).withColumn("brondata_count", F.size(sources))
    return whole.unionByName(singles)


def lineage_set(df: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """Per key the different tuples of ``parts``, and their number."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct(*parts))).alias("lineage")).withColumn("brondata_count", F.size("lineage"))


def to_merge(excluded_tables: Iterable[str] = (), excluded_projects: Iterable[str] = (), artefact_table: str = "ARTEFACT") -> Column:
    """Which artefact rows are merged: those with a subnr, no source table of single artefacts, no excluded table or project."""
    table, project = F.coalesce(F.col("table"), F.lit("")), F.coalesce(F.col("projectcd"), F.lit(""))
    return F.col("subnr").isNotNull() & (table != artefact_table) & ~table.isin(*excluded_tables, "") & ~project.isin(*excluded_projects, "")


def to_move(excluded_tables: Iterable[str] = (), excluded_projects: Iterable[str] = (), artefact_table: str = "ARTEFACT") -> Column:
    """Which artefact rows move unmerged: all others, but for rows of the source table of single artefacts."""
    return ~to_merge(excluded_tables, excluded_projects, artefact_table) & (F.coalesce(F.col("table"), F.lit("")) != artefact_table)


def generate_missing(seen: DataFrame, existing: DataFrame, fields: list[str], key: Column, soort: str, not_zero: str, strict_reference: bool = False) -> DataFrame:
    """Rows for the different values of ``fields`` in ``seen`` whose key no row of ``existing`` has.

    A row needs a key and a value other than 0 in ``not_zero``. Null keys of either side are equal to each other.
    ``strict_reference`` gives no rows at all, as the literal rule matches nothing.
    """
    number = F.col(not_zero)
    wanted = seen.where(number.isNotNull() & (number.cast("string") != "0"))
    if strict_reference:
        wanted = wanted.where(F.lit(False))
    made = wanted.select(*fields).distinct().withColumn("key", key).withColumn("soort", F.lit(soort)).where("key IS NOT NULL")
    have = existing.where(F.col("soort") == soort).select(F.col("key").alias("_have")).distinct()
    missing = made.join(have, F.col("key").eqNullSafe(F.col("_have")), "left_anti")
    return missing.withColumn("herkomst", F.lit("Gegenereerd"))


def with_default(df: DataFrame, name: str, default: str) -> DataFrame:
    """``df`` with ``default`` where the column is null or empty."""
    return df.withColumn(name, F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(default)))


def merge_specific(specific: DataFrame, generic: DataFrame, key: str, order: str = "_seq") -> DataFrame:
    """Each specific row with what the first generic row of its key adds: the generic row's known values win."""
    shared = [c for c in specific.columns if c in generic.columns and c not in (key, order)]
    more = [c for c in generic.columns if c not in (*specific.columns, key, order)]
    packed = generic.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*shared, *more), order).alias("_generic")) if shared or more else None
    if packed is None:
        return specific
    both = specific.join(packed, F.col(key) == F.col("_key"), "left")
    chosen = [F.coalesce(F.col(f"_generic.{c}"), F.col(c)).alias(c) if c in shared else F.col(c) for c in specific.columns]
    return both.select(*chosen, *[F.col(f"_generic.{c}").alias(c) for c in more])
