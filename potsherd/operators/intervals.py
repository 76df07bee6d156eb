"""Trees by intervals: each node gets its place in a walk from the top, and the last place below it.

What is below a node is then one range of places, which Parquet's statistics prune; no level has to be followed for a request.
The places are made once, by jumps that double: after k rounds a node knows its ancestor 2^k levels up, so a tree of depth d
takes about 2 log d rounds, whatever its width.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potsherd.operators import hierarchy
from potsherd.operators.hierarchy import written
from potsherd.operators.ranges import ROWS, ranged, sums_before

#: Roots of one request that become range conditions; with more of them the levels are followed.
ROOTS = 500


def numbered(tree: DataFrame, node: str = "primary_key", parent: str = "parentID", rows: int = ROWS) -> DataFrame:
    """``tree`` with ``first`` and ``last``, the places (from 1) of the node and of the last node below it, and ``depth`` (from 0).

    A row whose parent is null or no row of the table is a root; roots, and the children of a node, follow each other by
    ``node``. Of rows that repeat a node the one of the least parent counts, and all of them get its places. Rows without a
    node get none. A cycle raises.
    """
    known = tree.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("node")).agg(F.min(parent).alias("up"))
    present = known.select(F.col("node").alias("up"), F.lit(True).alias("_there"))
    edges = written(known.join(present, "up", "left").select("node", F.when(F.col("_there"), F.col("up")).alias("up")))
    sizes, rounds = subtree_sizes(edges)
    own = ranged(edges.join(sizes, "node"), "up", "node", rows=rows)
    steps = sums_before(own, "up", "node", "size", "_earlier").select("node", F.col("up").alias("jump"), (F.col("_earlier") + 1).alias("place"), F.lit(0).alias("depth"), "size")
    placed = written(steps)
    for _ in range(rounds):
        above = placed.select(F.col("node").alias("_n"), F.col("jump").alias("_jump"), F.col("place").alias("_place"), F.col("depth").alias("_depth"))
        met = placed.join(above, F.col("jump") == F.col("_n"), "left")
        add = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
        deeper = F.when(F.col("jump").isNotNull(), 1 + F.col("_depth")).otherwise(0)
        placed = written(met.select("node", F.col("_jump").alias("jump"), add("place", F.col("_place")), (F.col("depth") + deeper).cast("int").alias("depth"), "size"))
    found = placed.select(F.col("node").alias("_node"), F.col("place").cast("bigint").alias("first"), (F.col("place") + F.col("size") - 1).cast("bigint").alias("last"), "depth")
    return tree.join(found, F.col(node) == F.col("_node"), "left").drop("_node")


def subtree_sizes(edges: DataFrame) -> tuple[DataFrame, int]:
    """(node, size) with the node itself, and the rounds of doubling that reach the top from everywhere.

    A node's rows less than 2^k levels below it are those less than 2^(k-1) below it and below its descendants of just that
    distance; these are summed by their common ancestor, partly before the shuffle, so a node with very many children is no
    hot key there.
    """
    most = edges.count().bit_length() + 1
    state = edges.select("node", F.col("up").alias("jump"), F.lit(1).cast("bigint").alias("size"))
    rounds = 0
    while not state.where("jump IS NOT NULL").isEmpty():
        rounds += 1
        if rounds > most:
            raise ValueError("the tree has a cycle")
        more = state.where("jump IS NOT NULL").groupBy(F.col("jump").alias("_to")).agg(F.sum("size").alias("_more"))
        above = state.select(F.col("node").alias("_n"), F.col("jump").alias("_jump"))
        met = state.join(above, F.col("jump") == F.col("_n"), "left").join(more, F.col("node") == F.col("_to"), "left")
        state = written(met.select("node", F.col("_jump").alias("jump"), (F.col("size") + F.coalesce("_more", F.lit(0))).alias("size")))
    return state.select("node", "size"), rounds


def located(df: DataFrame, reference: str, numbers: DataFrame, node: str = "primary_key", name: str = "place") -> DataFrame:
    """``df`` with the place of the node that each row refers to, null for none; store it in this order to prune by it."""
    places = numbers.where(F.col(node).isNotNull()).select(F.col(node).alias("_node"), F.col("first").alias(name)).distinct()
    return df.join(places, F.col(reference) == F.col("_node"), "left").drop("_node")


def below(df: DataFrame, place: str, numbers: DataFrame, roots: Column, node: str = "primary_key", parent: str = "parentID") -> DataFrame:
    """The rows of ``df`` whose ``place`` is that of a root or of a node below one.

    Up to ``ROOTS`` roots are read and become range conditions. More of them are followed level after level instead.
    """
    picked = numbers.where(roots & F.col("first").isNotNull()).select("first", "last").distinct().limit(ROOTS + 1).collect()
    if len(picked) > ROOTS:
        wanted = hierarchy.descendants(numbers, roots, node, parent).select(F.col("first").alias("_wanted")).distinct()
        return df.join(wanted, F.col(place) == F.col("_wanted"), "left_semi")
    outer: list[tuple[int, int]] = []
    for first, last in sorted((r["first"], r["last"]) for r in picked):
        if not outer or first > outer[-1][1]:  # intervals lie within each other or apart
            outer.append((first, last))
    return df.where(reduce(lambda a, b: a | b, [F.col(place).between(*o) for o in outer], F.lit(False)))
