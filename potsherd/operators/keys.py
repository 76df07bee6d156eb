"""Keys of entities and of what they refer to, built from segments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from potsherd.functions.values import text_of
from potsherd.operators.hierarchy import written
from potsherd.sources import versions


@dataclass(frozen=True)
class Segment:
    """A prefix and a field. Without the field an optional segment is empty, and a needed one makes the whole key null."""

    prefix: str
    field: str
    optional: bool = False

    def column(self) -> Column:
        value = F.concat(F.lit(self.prefix), text_of(F.col(self.field)))
        return F.coalesce(value, F.lit("")) if self.optional else value


@dataclass(frozen=True)
class IfFlag:
    """A segment that stands only where a flag is set; there it is needed."""

    flag: str
    segment: Segment

    def column(self) -> Column:
        return F.when(F.coalesce(F.col(self.flag).cast("boolean"), F.lit(False)), self.segment.column()).otherwise(F.lit(""))


def build(*segments: Segment | IfFlag) -> Column:
    return F.concat(*[s.column() for s in segments])


def parse(pattern: str) -> tuple[Segment | IfFlag, ...]:
    """Segments from text: ``P:projectcd [P:putnr] flag?P:putnr V:vondstnr``; brackets make one optional, ``flag?`` depend on a flag."""
    out: list[Segment | IfFlag] = []
    for part in pattern.split():
        flag, _, rest = part.rpartition("?")
        optional = rest.startswith("[")
        prefix, _, name = rest.strip("[]").partition(":")
        segment = Segment(prefix, name, optional)
        out.append(IfFlag(flag, segment) if flag else segment)
    return tuple(out)


def with_keys(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """``df`` with a key column for each pattern. A key that can't be built leaves an older value of its column alone."""
    fields = {s.segment.field if isinstance(s, IfFlag) else s.field for p in patterns.values() for s in parse(p)}
    flags = {s.flag for p in patterns.values() for s in parse(p) if isinstance(s, IfFlag)}
    have = df.withColumns({c: F.lit(None).cast("string") for c in sorted(fields | flags) if c not in df.columns})
    new = {name: build(*parse(p)) for name, p in patterns.items()}
    kept = have.withColumns({name: F.coalesce(key, F.col(name)) if name in df.columns else key for name, key in new.items()})
    return kept.select(*df.columns, *[n for n in patterns if n not in df.columns])


#: Rows whose order differs in these low bits only are numbered in one task.
RUN_BITS = 20


def with_surrogates(df: DataFrame, group: str = "soort", order: str = "_seq", own: str | None = None, start: int = 0) -> DataFrame:
    """``df`` with ``ID``: its own number if it has one, else its place in its group from ``start`` on.

    Rows are numbered within runs of ``order`` (its high bits), and the runs' sizes are summed up before them, so no group
    passes through one task. Rows of equal ``order`` follow their ``_id``, if there is one.
    """
    ties = [F.col(order), *([F.col("_id")] if "_id" in df.columns else [])]
    cut = df.withColumn("_run", F.shiftright(F.col(order).cast("bigint"), RUN_BITS))
    within = cut.withColumn("_at", F.row_number().over(Window.partitionBy(group, "_run").orderBy(*ties)))
    sizes = cut.groupBy(F.col(group).alias("_g"), F.col("_run").alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_g").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    placed = within.join(before, F.col(group).eqNullSafe(F.col("_g")) & F.col("_run").eqNullSafe(F.col("_r")))
    place = F.col("_at") + F.col("_before") - 1 + start
    number = F.coalesce(F.col(own).cast("bigint"), place) if own else place
    return placed.withColumn("ID", number.cast("bigint")).select(*[c for c in df.columns if c != "ID"], "ID")


#: New keys that are numbered in one task, nearly.
RANGE = 1_000_000


def with_registered(df: DataFrame, registry: str, run: int, group: str = "soort", key: str = "key", otherwise: str = "_id", start: int = 0) -> DataFrame:
    """``df`` with ``ID`` from a registry of keys that lasts from run to run: known keys keep their number, new ones follow.

    A row without a key is known by ``otherwise``. Rows of a key share its number. ``registry`` is a folder of versions;
    ``run`` is the version that this run writes, and a run that comes again finds what it wrote. Only new keys are numbered:
    they are dealt into ranges, each ordered by itself, and the ranges' sizes are summed up per group.
    """
    spark = df.sparkSession
    known_by = F.when(F.col(key).isNotNull(), F.concat(F.lit("k"), F.col(key).cast("string"))).otherwise(F.concat(F.lit("i"), F.col(otherwise).cast("string")))
    kind = f"`_group` {df.schema[group].dataType.simpleString()}, `_name` string, `ID` bigint"
    told = versions.content(spark, registry, before=run) or {"runs": []}
    known = spark.read.schema(kind).parquet(*[f"{registry}/data/{r}" for r in told["runs"]]) if told["runs"] else spark.createDataFrame([], kind)
    if versions.content(spark, registry, run) is None:
        asked = df.select(F.col(group).alias("_group"), known_by.alias("_name")).where("_name IS NOT NULL").distinct()
        same = lambda a, b: a["_group"].eqNullSafe(b["_group"]) & (a["_name"] == b["_name"])
        new = written(asked.join(known, same(asked, known), "left_anti"))
        ranges = max(1, -(-new.count() // RANGE))
        dealt = new.withColumn("_range", F.pmod(F.xxhash64("_name"), F.lit(ranges)))
        sizes = dealt.groupBy("_group", "_range").agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        last = known.groupBy(F.col("_group").alias("_g")).agg(F.max("ID").alias("_last"))
        first = F.coalesce(F.col("_last") + 1, F.lit(start)) + F.coalesce(F.sum("_n").over(before), F.lit(0))
        begin = sizes.join(last, F.col("_group").eqNullSafe(F.col("_g")), "left").select(F.col("_group").alias("_g"), F.col("_range").alias("_r"), first.alias("_first"))
        placed = dealt.withColumn("_at", F.row_number().over(Window.partitionBy("_group", "_range").orderBy("_name")))
        numbered = placed.join(begin, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r"))).select("_group", "_name", (F.col("_first") + F.col("_at") - 1).alias("ID"))
        numbered.write.mode("overwrite").parquet(f"{registry}/data/{run}")
        versions.commit(spark, registry, run, {"runs": [*told["runs"], run]})
    runs = versions.content(spark, registry, run)["runs"]
    entries = spark.read.schema(kind).parquet(*[f"{registry}/data/{r}" for r in runs])
    named = df.drop("ID").withColumn("_asked", known_by)
    met = named.join(entries, named[group].eqNullSafe(entries["_group"]) & (named["_asked"] == entries["_name"]), "left")
    return met.select(*[c for c in df.columns if c != "ID"], "ID")
