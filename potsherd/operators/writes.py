"""The ways in which new rows meet a stored table, as new versions of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _on(keys: list[str]):
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return out


def _keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()


def replace(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows take the place of old ones with their key."""
    return old.join(_keys(new, keys), _on(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def keep_existing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Only new rows whose key is new are added."""
    return old.unionByName(new.join(_keys(old, keys), _on(keys), "left_anti"), allowMissingColumns=True)


def fail_existing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the new rows, which must have no key of the old ones: when the result is read, such a row raises an error."""
    met = new.join(_keys(old, keys).withColumn("_met", F.lit(True)), _on(keys), "left")
    checked = met.withColumn("_ok", F.assert_true(F.col("_met").isNull(), F.lit("a row with this key exists")))
    return old.unionByName(checked.where("_ok IS NULL").select(*new.columns), allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Known values of new rows are set, null ones never erase; rows with a new key are added. Of several new rows of a key the last by ``order`` counts."""
    values = [c for c in new.columns if c not in keys]
    latest = new.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) if order else F.max(c).alias(c) for c in values])
    renamed = latest.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_n_{c}") for c in values], F.lit(True).alias("_new"))
    both = old.withColumn("_old", F.lit(True)).join(renamed, _on(keys) & F.col("_old").isNotNull(), "full")
    out = [F.when(F.col("_old").isNull(), F.col(f"_k_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    out += [F.coalesce(f"_n_{c}", c).alias(c) if c in old.columns else F.col(f"_n_{c}").alias(c) for c in values]
    return both.select(*out, *[c for c in old.columns if c not in {*keys, *values}])
