"""Trees kept as (node, parent) rows."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoints(spark: SparkSession) -> str:
    """The checkpoint folder that the session names; only a local session may do without one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        place = spark.conf.get("spark.checkpoint.dir", None)
        if not place and not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(place or tempfile.mkdtemp(prefix="potsherd-"))
    return context.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """``df`` computed and written to the checkpoint folder."""
    checkpoints(df.sparkSession)
    return df.checkpoint()


def descendants(tree: DataFrame, roots: Column, node: str = "primary_key", parent: str = "parentID") -> DataFrame:
    """The rows below the rows that ``roots`` picks, themselves included, each once, with their least ``depth``.

    Level after level, each joined with the rows of the last one; nodes that were reached before are left out, so it ends
    where a table has a cycle, and whatever the depth.
    """
    edges = tree.select(F.col(node).alias("_node"), F.col(parent).alias("_parent"))
    level = written(tree.where(roots).select(F.col(node).alias("_node"), F.lit(0).alias("depth")).distinct())
    found, depth = level, 0
    while not level.isEmpty():
        depth += 1
        up = level.select(F.col("_node").alias("_up"))
        next_level = edges.join(up, F.col("_parent") == F.col("_up"), "left_semi").select("_node").distinct()
        level = written(next_level.join(found.select("_node"), "_node", "left_anti").withColumn("depth", F.lit(depth)))
        found = found.unionByName(level)
        if depth % 8 == 0:  # a plan of many levels takes long to make
            found = written(found)
    return tree.join(found, F.col(node) == F.col("_node")).drop("_node")


def below(df: DataFrame, reference: str, tree: DataFrame, roots: Column, node: str = "primary_key", parent: str = "parentID") -> DataFrame:
    """The rows of ``df`` that refer to a node below the roots."""
    wanted = descendants(tree, roots, node, parent).select(F.col(node).alias("_wanted"))
    return df.join(wanted, F.col(reference) == F.col("_wanted"), "left_semi")


def within(rows: DataFrame, uris: str, uri: Column) -> DataFrame:
    """The rows whose list of ancestors holds ``uri``."""
    return rows.where(F.array_contains(uris, uri))


def children(tree: DataFrame, of: int, parent: str = "parentID") -> DataFrame:
    return tree.where(F.col(parent) == of)


def with_parent(tree: DataFrame, columns: list[str], node: str = "primary_key", parent: str = "parentID") -> DataFrame:
    """``tree`` with columns of the parent row, named ``parent_...``."""
    up = tree.select(F.col(node).alias("_up"), *[F.col(c).alias(f"parent_{c}") for c in columns])
    return tree.join(up, F.col(parent) == F.col("_up"), "left").drop("_up")
