"""Queries of a user interface: filters, pages, subtypes, counts and the map."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Filter = tuple[str, str, Any]

#: Filters by name; each takes a column and a value. Texts are compared in any case, as a search form does.
FILTERS: dict[str, Callable[[Column, Any], Column]] = {
    "equal": lambda c, v: c == v,
    "not_equal": lambda c, v: c != v,
    "starts_with": lambda c, v: F.startswith(F.lower(c), F.lit(str(v).lower())),
    "not_starts_with": lambda c, v: ~F.startswith(F.lower(c), F.lit(str(v).lower())),
    "ends_with": lambda c, v: F.endswith(F.lower(c), F.lit(str(v).lower())),
    "not_ends_with": lambda c, v: ~F.endswith(F.lower(c), F.lit(str(v).lower())),
    "contains": lambda c, v: F.contains(F.lower(c), F.lit(str(v).lower())),
    "not_contains": lambda c, v: ~F.contains(F.lower(c), F.lit(str(v).lower())),
    "greater": lambda c, v: c > v,
    "smaller": lambda c, v: c < v,
    "in": lambda c, v: c.isin(list(v)),
    "not_in": lambda c, v: ~c.isin(list(v)),
    "not_in_or_missing": lambda c, v: ~c.isin(list(v)) | c.isNull(),
    "exists": lambda c, v: c.isNotNull() if v else c.isNull(),
    "relation": lambda c, v: c == v,
    "not_relation": lambda c, v: c != v,
    "function": lambda c, v: c == v(),
    "matches": lambda c, v: F.coalesce(c.rlike(f"(?i){v}"), F.lit(False)),
}


def filtered(df: DataFrame, *filters: Filter) -> DataFrame:
    """The rows that fit all of (column, filter, value)."""
    for column, name, value in filters:
        df = df.where(FILTERS[name](F.col(column), value))
    return df


def related(df: DataFrame, pk: str, links: DataFrame, own: str, other: str, value: Any) -> DataFrame:
    """The rows that a link table ties to a row of the other side."""
    wanted = links.where(F.col(other) == value).select(F.col(own).alias("_own"))
    return df.join(wanted, F.col(pk) == F.col("_own"), "left_semi")


def sorting(*keys: tuple[str, bool], tie: str) -> list[Column]:
    return [*[F.asc_nulls_last(c) if ascending else F.desc_nulls_first(c) for c, ascending in keys], F.asc(tie)]


def ordered(df: DataFrame, *keys: tuple[str, bool], tie: str) -> DataFrame:
    """Sorted by (column, ascending); nulls are last when ascending and first when descending. ``tie`` decides between equal rows."""
    return df.orderBy(*sorting(*keys, tie=tie))


def page(df: DataFrame, number: int, size: int, *keys: tuple[str, bool], tie: str) -> DataFrame:
    """One page of the sorted rows, from page 0 on."""
    return ordered(df, *keys, tie=tie).offset(number * size).limit(size)


def page_with_total(df: DataFrame, number: int, size: int, *keys: tuple[str, bool], tie: str) -> tuple[int, DataFrame]:
    return df.count(), page(df, number, size, *keys, tie=tie)


def subtype(df: DataFrame, discriminator: str, kind: str, base: list[str], own: list[str]) -> DataFrame:
    """The rows of one kind, with the columns of all kinds and its own."""
    return df.where(F.col(discriminator) == kind).select(*base, *own)


def with_counts(parents: DataFrame, pk: str, children: DataFrame, reference: str, name: str) -> DataFrame:
    """``parents`` with the number of their children, 0 if none."""
    counts = children.where(F.col(reference).isNotNull()).groupBy(F.col(reference).alias("_ref")).agg(F.count(F.lit(1)).alias("_n"))
    joined = parents.join(counts, F.col(pk) == F.col("_ref"), "left")
    return joined.select(*[c for c in parents.columns if c != name], F.coalesce("_n", F.lit(0)).cast("bigint").alias(name))


def counts_by(df: DataFrame, *by: str, pk: str = "primary_key") -> DataFrame:
    """Rows of each value, as a chart shows them."""
    return df.groupBy(*by).agg(F.count(pk).alias("n"))


def map_counts(places: DataFrame, place_pk: str, located: Column, show: list[str], finds: DataFrame, reference: str, find_pk: str) -> DataFrame:
    """Finds of each located place, 0 for none; finds of no known place count for none."""
    both = finds.select(F.col(reference).alias("_ref"), F.col(find_pk).alias("_find")).join(places.withColumn("_located", located), F.col("_ref") == F.col(place_pk), "full")
    return both.where("_located").groupBy(*show).agg(F.count("_find").alias("n_finds"))


def markers(counts: DataFrame, n: str = "n_finds") -> DataFrame:
    """How a map shows the places: larger and red where there are finds."""
    some = F.col(n) > 0
    return counts.withColumns({"radius": F.when(some, 8).otherwise(4), "color": F.when(some, "red").otherwise("blue")})


def next_number(df: DataFrame, pk: str) -> DataFrame:
    """One row: the number that the next row gets."""
    return df.agg((F.coalesce(F.max(pk), F.lit(0)) + 1).cast("bigint").alias("next_number"))


def dated_by_context(artefacts: DataFrame, finds: DataFrame, traces: DataFrame) -> DataFrame:
    """Artefacts with the dates of their find and of its trace in columns of their own (no fallback between them)."""
    f = finds.select(F.col("primary_key").alias("_f"), F.col("spoorID").alias("_s"), "vondstdatering_vanaf", "vondstdatering_tot")
    s = traces.select(F.col("primary_key").alias("_t"), "spoordatering_vanaf", "spoordatering_tot")
    own = artefacts.drop("vondstdatering_vanaf", "vondstdatering_tot", "spoordatering_vanaf", "spoordatering_tot")
    joined = own.join(f, F.col("vondstID") == F.col("_f"), "left").join(s, F.col("_s") == F.col("_t"), "left").drop("_f", "_s", "_t")
    return joined.withColumns({"datering_vanaf": F.col("artefactdatering_vanaf"), "datering_tot": F.col("artefactdatering_tot")})


def from_json_rows(df: DataFrame, text: str, schema: str) -> DataFrame:
    """The rows of a column with JSON lists, as columns."""
    return df.select(F.inline(F.from_json(F.col(text), f"array<struct<{schema}>>")))


def material_faults(artefacts: DataFrame, allowed: DataFrame, kind: str = "artefactsoort", material: str = "abr_uri") -> DataFrame:
    """The artefacts whose material isn't among those that their kind allows. ``allowed``: kind, uri. Kinds without any are free."""
    bound = allowed.select(F.col("kind").alias("_kind")).distinct()
    fits = allowed.select(F.col("kind").alias("_k"), F.col("uri").alias("_u"))
    checked = artefacts.where(F.col(material).isNotNull()).join(bound, F.col(kind) == F.col("_kind"), "left_semi")
    return checked.join(fits, (F.col(kind) == F.col("_k")) & (F.col(material) == F.col("_u")), "left_anti")
