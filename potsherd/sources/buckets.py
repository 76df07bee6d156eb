"""Tables kept in buckets of their key: a change rewrites the buckets that it touches, and counts follow by differences.

A table's rows lie in folders by a hash of their key; a version names the folder of each bucket. Beside it lies a log of
signed counts per group, which grows with the changes and is summed up when it has grown long.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from potsherd.operators import writes
from potsherd.operators.hierarchy import written
from potsherd.sources import versions

#: Buckets of a new table, and entries of the log of counts that are summed up to one.
BUCKETS, LOG = 64, 16


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The bucket of a key; null keys have one, too."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read(spark: SparkSession, root: str, version: int | None = None, only: list[int] | None = None) -> DataFrame | None:
    """The table as a version has it, the last one if none is named; ``only`` some of its buckets."""
    told = versions.content(spark, root, version)
    return None if told is None else _rows(spark, root, told, only)


def _rows(spark: SparkSession, root: str, told: dict, only: list[int] | None = None) -> DataFrame:
    wanted = [b for b in told["buckets"] if only is None or int(b) in only]
    if not wanted:
        return spark.createDataFrame([], told["schema"])
    return spark.read.schema(told["schema"]).parquet(*[f"{root}/data/{told['buckets'][b]}/_bucket={b}" for b in wanted])


def counts(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """(by, n): the rows of each group, from the log of differences; groups without rows are left out."""
    told = versions.content(spark, root, version)
    if told is None or not told["by"]:
        return None
    return _summed(spark, root, told).where("n <> 0")


def _summed(spark: SparkSession, root: str, told: dict) -> DataFrame:
    return spark.read.parquet(*[f"{root}/counts/{v}" for v in told["log"]]).groupBy(*told["by"]).agg(F.sum("n").alias("n"))


def apply(changes: DataFrame, root: str, keys: list[str], order: str, version: int, deleted: str | None = None, by: list[str] | None = None, buckets: int = BUCKETS) -> bool:
    """Apply changed rows as version ``version``; false if that version, or a later one, is there already, as when a batch comes again.

    Of several rows of a key the last by ``order`` counts for each known value; a null never erases (``writes.upsert``). A
    key whose last row has ``deleted`` true goes. ``order`` is kept as a column. ``by`` are the columns that are counted.
    """
    spark = changes.sparkSession
    if any(v >= version for v in versions.versions(spark, root)):
        return False
    told = versions.content(spark, root, before=version)
    if told is None:
        kept = changes.drop(*[deleted] if deleted else [])
        told = {"buckets": {}, "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields), "n": buckets, "by": by or [], "log": []}
    new = changes
    if deleted:
        # rows before a key's last deletion say nothing about what comes after it
        marks = changes.where(F.col(deleted)).groupBy(*[F.col(k).alias(f"_d_{k}") for k in keys]).agg(F.max(order).alias("_until"))
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_d_{k}")) for k in keys])
        marked = changes.join(marks, on, "left")
        new = marked.where(F.col("_until").isNull() | (F.col(order) > F.col("_until"))).select(*[c for c in changes.columns if c != deleted])
        cleared = written(marks.select(*[F.col(f"_d_{k}").alias(k) for k in keys]))
    touched = sorted(r[0] for r in changes.select(bucket_of(keys, told["n"])).distinct().collect())
    old = _rows(spark, root, told, touched)
    base = old if not deleted else old.join(cleared, reduce(lambda a, b: a & b, [old[k].eqNullSafe(cleared[k]) for k in keys]), "left_anti")
    merged = writes.upsert(base, new, keys, order).select(*old.columns)
    merged.withColumn("_bucket", bucket_of(keys, told["n"])).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{root}/data/{version}")
    there = _buckets_there(spark, f"{root}/data/{version}", touched)
    folders = {b: v for b, v in told["buckets"].items() if int(b) not in touched} | {str(b): version for b in there}
    log = told["log"]
    if told["by"]:
        after = spark.read.schema(told["schema"]).parquet(*[f"{root}/data/{version}/_bucket={b}" for b in there]) if there else spark.createDataFrame([], told["schema"])
        signed = old.select(*told["by"], F.lit(-1).alias("s")).unionByName(after.select(*told["by"], F.lit(1).alias("s")))
        delta = signed.groupBy(*told["by"]).agg(F.sum("s").alias("n")).where("n <> 0")
        if len(log) + 1 > LOG:  # the whole log becomes one entry
            delta, log = _summed(spark, root, told).unionByName(delta).groupBy(*told["by"]).agg(F.sum("n").alias("n")).where("n <> 0"), []
        delta.coalesce(1).write.mode("overwrite").parquet(f"{root}/counts/{version}")
        log = [*log, version]
    versions.commit(spark, root, version, told | {"buckets": folders, "log": log})
    return True


def _buckets_there(spark: SparkSession, path: str, touched: list[int]) -> list[int]:
    """The buckets that still have rows."""
    return [b for b in touched if versions.exists(spark, f"{path}/_bucket={b}")]


def clean(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete the folders that none of the last ``keep`` versions names."""
    stay = versions.forget(spark, root, keep)
    used = {(f"{v}", b) for told in stay for b, v in told["buckets"].items()}
    logs = {str(v) for told in stay for v in told["log"]}
    for v in versions.folders(spark, f"{root}/data"):
        for name in versions.folders(spark, f"{root}/data/{v}"):
            if name.startswith("_bucket=") and (v, name.removeprefix("_bucket=")) not in used:
                versions.remove(spark, f"{root}/data/{v}/{name}")
    for v in versions.folders(spark, f"{root}/counts"):
        if v not in logs:
            versions.remove(spark, f"{root}/counts/{v}")
