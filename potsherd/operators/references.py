"""Resolving references between entities: foreign keys from key columns, and updates by joins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potsherd.operators.hierarchy import written


def parents_by_key(parents: DataFrame, key: str = "key", number: str = "ID", order: str = "_seq") -> DataFrame:
    """(ref_key, ref_id, ref_n): one parent for each key, the last by ``order``, and how many there are."""
    last = F.max_by(number, F.struct(order, number)) if order in parents.columns else F.max(number)
    return parents.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("ref_key")).agg(last.alias("ref_id"), F.count(F.lit(1)).alias("ref_n"))


def set_reference(children: DataFrame, parents: DataFrame, ref_key: str, target: str, unique_only: bool = False, key: str = "key", number: str = "ID", order: str = "_seq", candidates: Column | None = None) -> DataFrame:
    """``children`` with ``target`` set to the parent's number where it is still null and ``ref_key`` meets a parent's key.

    With several parents of a key the last one counts; ``unique_only`` then sets nothing. Null keys meet none.
    ``candidates`` limits the rows that may be set.
    """
    known = parents_by_key(parents, key, number, order)
    if unique_only:
        known = known.where("ref_n = 1")
    old = F.col(target) if target in children.columns else F.lit(None).cast("bigint")
    may = candidates if candidates is not None else F.lit(True)
    joined = children.join(known, F.when(may, F.col(ref_key)) == F.col("ref_key"), "left")
    return joined.select(*[c for c in children.columns if c != target], F.coalesce(old, F.col("ref_id").cast("bigint")).alias(target))


def set_reference_fallback(children: DataFrame, parents: DataFrame, ref_keys: list[tuple[str, str, bool]], target: str, number: str = "ID", order: str = "_seq") -> DataFrame:
    """``target`` by the first of several (child's key, parent's key, unique_only) that finds a parent."""
    out = children
    for child_key, parent_key, unique_only in ref_keys:
        out = set_reference(out, parents, child_key, target, unique_only, parent_key, number, order)
    return out


@dataclass(frozen=True)
class Rule:
    """A reference: the child's key column, the parents' kind and key column, the column that gets the parent's number."""

    child_key: str
    kind: str
    parent_key: str
    target: str
    unique_only: bool = False


def set_all(rows: DataFrame, rules: list[Rule], kind: str = "soort", number: str = "ID", order: str = "_seq") -> DataFrame:
    """All references of a store in one pass, as ``set_reference`` would set them one rule after the other.

    Keys of all rules leave their rows as (row, rule, key), meet the parents' (kind, key, number) in one join, and come back
    to their rows together: the store itself is shuffled once, whatever the number of rules, and each key once. A key that
    very many rows refer to is one large partition of narrow rows, which Spark's skew join splits. Rows of a kind don't
    refer to their own kind. Of several rules of a target the first that meets a parent counts; numbers that a row has stay.
    """
    rules = [r for r in rules if r.child_key in rows.columns and r.parent_key in rows.columns]
    if not rules:
        return rows
    store = written(rows.withColumn("_row", F.monotonically_increasing_id()))
    ways = sorted({(r.kind, r.parent_key) for r in rules})
    asks = [F.struct(F.lit(n).alias("rule"), F.lit(ways.index((r.kind, r.parent_key))).alias("way"), F.col(r.child_key).cast("string").alias("key"), (F.col(kind) != r.kind).alias("may")) for n, r in enumerate(rules)]
    asked = store.select("_row", F.inline(F.array(*asks))).where("key IS NOT NULL AND may").drop("may")
    gives = [F.struct(F.lit(n).alias("way"), F.when(F.col(kind) == k, F.col(c).cast("string")).alias("key")) for n, (k, c) in enumerate(ways)]
    last = F.struct(order, number) if order in rows.columns else F.struct(number)
    given = store.select(last.alias("last"), F.inline(F.array(*gives))).where("key IS NOT NULL")
    parents = given.groupBy("way", "key").agg(F.max("last").getField(number).alias("number"), F.count(F.lit(1)).alias("n"))
    several = [n for n, r in enumerate(rules) if not r.unique_only]
    met = asked.join(parents, ["way", "key"]).where(F.col("number").isNotNull() & ((F.col("n") == 1) | F.col("rule").isin(several)))
    targets = list(dict.fromkeys(r.target for r in rules))
    best = [F.min_by("number", F.when(F.col("rule").isin([n for n, r in enumerate(rules) if r.target == t]), F.col("rule"))).cast("bigint").alias(f"_to_{t}") for t in targets]
    found = met.groupBy("_row").agg(*best)
    joined = store.join(found, "_row", "left")
    new = {t: F.coalesce(F.col(t), F.col(f"_to_{t}")) if t in rows.columns else F.col(f"_to_{t}") for t in targets}
    return joined.select(*[new.pop(c).alias(c) if c in new else F.col(c) for c in rows.columns], *[c.alias(t) for t, c in new.items()])


def update_join(rows: DataFrame, updates: DataFrame, keys: list[str], values: list[str], order: str = "_seq") -> DataFrame:
    """``rows`` with ``values`` of the matching update, nulls included; of several updates the last one counts. Null keys match none."""
    last = updates.groupBy(*[F.col(k).alias(f"_u_{k}") for k in keys]).agg(F.max_by(F.struct(*values), F.struct(order, *values)).alias("_new"))
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_u_{k}"))
    joined = rows.join(last, on, "left")
    kinds = dict(rows.dtypes)
    chosen = [F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}").cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in rows.columns]
    more = [F.col(f"_new.{c}").alias(c) for c in values if c not in rows.columns]
    return joined.select(*chosen, *more)


def several_parents(df: DataFrame, group: list[str], parent: str, strict_reference: bool = False) -> DataFrame:
    """(group, n_parents) of groups that have more than one parent. Rows without a group are left out, unless ``strict_reference`` makes them one."""
    rows = df if strict_reference else df.na.drop(subset=group)
    return rows.groupBy(*group).agg(F.countDistinct(parent).alias("n_parents")).where("n_parents > 1")


def uniqueness(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """(group, is_unique): whether no known value stands twice in a group."""
    return df.groupBy(*group).agg((F.count(value) == F.countDistinct(value)).alias("is_unique"))


def integrity(children: DataFrame, parents: DataFrame, target: str, number: str = "ID") -> DataFrame:
    """The children whose reference meets no parent."""
    have = parents.select(F.col(number).alias("_pk")).distinct()
    return children.where(F.col(target).isNotNull()).join(have, F.col(target) == F.col("_pk"), "left_anti")


def photo_merge(photos: DataFrame, links: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Photos with what the link table (by file name) and then the descriptions (by number and project, any case) tell.

    ``links``: bestandsnaam, abcd_nr, projectcd. ``descriptions``: pad, projectcd and more; its number is the last segment of
    ``pad``. Names that photos have already get ``_koppel`` or ``_beschrijving`` added.
    """
    named = links.select(*[F.col(c).alias(f"{c}_koppel" if c in photos.columns else c) for c in links.columns])
    linked = photos.join(named, F.col("fileName") == F.col("bestandsnaam"), "left")
    told = descriptions.select(*[F.col(c).alias(f"{c}_beschrijving" if c in linked.columns else c) for c in descriptions.columns])
    project = "projectcd_koppel" if "projectcd" in photos.columns else "projectcd"
    other = "projectcd_beschrijving" if "projectcd_beschrijving" in told.columns else "projectcd"
    number = F.lower(F.element_at(F.split(F.col("pad"), r"\\"), -1))
    return linked.join(told, (F.lower("abcd_nr") == number) & (F.lower(project) == F.lower(other)), "left")


def precedence(*dates: Column) -> Column:
    """The first date that is known and not zero: artefact, then find, then trace; the last one counts as it is."""
    return F.coalesce(*[F.nullif(d, F.lit(0)) for d in dates[:-1]], dates[-1])


def lookup(df: DataFrame, key: str, others: DataFrame, other_key: str, name: str) -> DataFrame:
    """``df`` with a list of the rows of ``others`` that have the same key; an empty list where there are none."""
    rows = F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in others.columns if c != other_key])))
    found = others.groupBy(F.col(other_key).alias("_key")).agg(rows.alias(name))
    joined = df.join(found, F.col(key) == F.col("_key"), "left").drop("_key")
    return joined.withColumn(name, F.coalesce(F.col(name), F.array().cast(found.schema[name].dataType)))


def without_in_list(lists: Column, names: tuple[str, ...], sentinels: tuple[str, ...] = ()) -> Column:
    """A list of maps without some entries, and without those that are null or say nothing."""
    keep = lambda k, v: ~k.isin(*names) & v.isNotNull() & ~F.coalesce(v.isin("", *sentinels), F.lit(False))
    return F.transform(lists, lambda m: F.map_filter(m, keep))
