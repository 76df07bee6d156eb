"""What works along ranges: outlines, trees by intervals, stored pages; and profiles by sketches."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from potsherd.operators import hierarchy, intervals, outline, profiles, ranges, views
from potsherd.sources import paged, versions


def test_ranges_and_sums(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id").withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    dealt = ranges.ranged(df, "g", "id", rows=100)
    assert dealt.select("_range").distinct().count() > 5
    got = {(r.g, r.id): r.s for r in ranges.sums_before(dealt, "g", "id", "id", "s").collect()}
    sums = Counter()
    for i in range(1000):
        g = i % 3 or None
        assert got[(g, i)] == sums[g]
        sums[g] += i


def plain_outline(rows):
    """{order: path} of (order, level, name) rows of one list."""
    names, out = {}, {}
    for at, level, name in sorted(rows):
        names = {k: n for k, n in names.items() if k < level} | {level: name}
        out[at] = [names[k] for k in sorted(names)]
    return out


@pytest.mark.parametrize("scheme", [None, "s"])
def test_outline_over_ranges(spark, scheme):
    rng = random.Random(5)
    # a top level that is set once and holds for many ranges
    rows = [(i, 0 if i == 3 else rng.choice([1, 2, 2, 2]), f"n{i}", rng.choice("aab")) for i in range(3, 403)]
    df = spark.createDataFrame([(i, s, *[n if k == lv else None for k in range(3)]) for i, lv, n, s in rows], "o long, s string, l0 string, l1 string, l2 string")
    got = {r.o: r.uris for r in outline.outline_paths(df, ["l0", "l1", "l2"], "o", scheme, rows=40).collect()}
    lists = {s: [r[:3] for r in rows if scheme is None or r[3] == s] for s in ("ab" if scheme else "a")}
    assert got == {k: v for part in lists.values() for k, v in plain_outline(part).items()}
    assert outline.outline_paths(df.limit(0), ["l0", "l1", "l2"], "o", scheme).count() == 0


def plain_numbers(edges):
    kids, up = {}, dict(edges)
    for n, p in edges:
        kids.setdefault(p if p in up else None, []).append(n)
    out, place, stack = {}, 0, [(n, 0, False) for n in sorted(kids.get(None, []), reverse=True)]
    while stack:
        n, depth, done = stack.pop()
        if done:
            out[n] = (out[n][0], place, depth)
            continue
        place += 1
        out[n] = (place, None, depth)
        stack.append((n, depth, True))
        stack += [(k, depth + 1, False) for k in sorted(kids.get(n, []), reverse=True)]
    return out


@pytest.mark.parametrize("shape", ["deep", "bushy", "star", "empty"])
def test_intervals(spark, shape):
    rng = random.Random(7)
    make = {"deep": lambda i: i - 1 if i > 1 else None, "bushy": lambda i: rng.choice([None, 9999, *range(max(1, i // 3), i)]), "star": lambda i: 1 if i > 1 else None}
    names = list(range(1, {"deep": 70, "empty": 1}.get(shape, 200)))
    order = rng.sample(names, len(names))  # names say nothing of the places
    edges = [(order[i - 1], order[p - 1] if (p := make[shape](i)) and p < 9999 else p) for i in names]
    tree = spark.createDataFrame(edges, "primary_key long, parentID long")
    done = intervals.numbered(tree, rows=30)
    assert {r.primary_key: (r["first"], r["last"], r.depth) for r in done.collect()} == plain_numbers(edges)


def test_below_by_intervals(spark, monkeypatch):
    rng = random.Random(3)
    tree = spark.createDataFrame([(i, rng.randrange(i) or None) for i in range(1, 120)] + [(5, 1), (None, 4)], "primary_key long, parentID long").dropDuplicates(["primary_key"])
    finds = spark.createDataFrame([(k, rng.choice([None, 500, *range(1, 120)])) for k in range(400)], "k long, ref long")
    numbers = hierarchy.written(intervals.numbered(tree))
    placed = hierarchy.written(intervals.located(finds, "ref", numbers))
    assert placed.count() == 400
    for roots in (F.col("primary_key") == 2, F.col("primary_key").isin(2, 3, 7, 40), F.col("primary_key") == -1, F.col("primary_key") > 0):
        want = {r.k for r in hierarchy.below(finds, "ref", tree, roots).collect()}
        assert {r.k for r in intervals.below(placed, "place", numbers, roots).collect()} == want
    monkeypatch.setattr(intervals, "ROOTS", 2)
    many = F.col("primary_key").isin(2, 3, 7, 40)
    assert {r.k for r in intervals.below(placed, "place", numbers, many).collect()} == {r.k for r in hierarchy.below(finds, "ref", tree, many).collect()}
    with pytest.raises(ValueError, match="cycle"):
        intervals.numbered(spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, None)], "primary_key long, parentID long"))


def test_stored_pages(spark):
    rng = random.Random(11)
    df = spark.createDataFrame([(i, rng.choice([None, *"abc"]), rng.choice([None, 1, 2])) for i in range(1000)], "id long, a string, b long")
    root, keys = versions.scratch(spark, "paged"), (("a", True), ("b", False))
    paged.store(df, root, *keys, tie="id", rows=90)
    for number, size in ((0, 25), (3, 100), (39, 25), (40, 25), (9, 333), (0, 5000)):
        got = [tuple(r) for r in paged.page(spark, root, number, size, *keys, tie="id").collect()]
        assert got == [tuple(r) for r in views.page(df, number, size, *keys, tie="id").collect()]
    assert paged.total(spark, root) == 1000
    plan = paged.page(spark, root, 3, 25, *keys, tie="id")._jdf.queryExecution().executedPlan().toString()
    asked = re.search(r"PartitionFilters: \[(.*?)\], Pushed", plan).group(1)
    assert "_range" in asked and len(re.findall(r"\b\d+\b", asked.split("_range", 2)[-1])) <= 3  # one range or two, by folder
    empty = versions.scratch(spark, "paged")
    paged.store(df.limit(0), empty, *keys, tie="id")
    assert paged.total(spark, empty) == 0 and paged.page(spark, empty, 0, 10, *keys, tie="id").count() == 0


def test_profile_by_sketches(spark):
    rng = random.Random(2)
    rows = [(i, rng.gauss(0, 1) if i % 5 else None, "common" if i % 3 else f"w{i % 50}", None) for i in range(20000)]
    df = spark.createDataFrame(rows, "id long, x double, w string, none int").withColumn("part", F.col("id") % 4)
    columns = ["id", "x", "w", "none"]
    made = profiles.sketches(df, columns)
    assert "Expand" not in made._jdf.queryExecution().executedPlan().toString()
    for parts in (made, profiles.merged(profiles.sketches(df, columns, "part"), columns)):
        got = {r.attribute: r for r in profiles.told(parts, columns).collect()}
        assert [(got[c].n_rows, got[c].nulls) for c in columns] == [(20000, 0), (20000, 4000), (20000, 0), (20000, 20000)]
        assert (got["id"].low, got["id"].high, got["none"].low) == ("0", "19999", None)
        assert abs(got["id"].n_distinct - 20000) < 0.03 * 20000 and abs(got["x"].n_distinct - 16000) < 0.03 * 16000 and (got["w"].n_distinct, got["none"].n_distinct) == (51, 0)
        for c, at in (("id", 0), ("x", 1)):
            values = sorted(r[at] for r in rows if r[at] is not None)
            for q, v in zip(profiles.QUANTILES, got[c].quantiles):
                assert abs(sum(1 for x in values if x <= v) / len(values) - q) < 0.02
        assert got["w"].quantiles is None and got["none"].quantiles is None and got["none"].frequent == []
        counts = Counter(r[2] for r in rows)
        assert [(f["item"], f["count"]) for f in got["w"].frequent] == sorted(counts.items(), key=lambda p: (-p[1], p[0]))[:10]
    few = df.where("id < 8")
    spread = profiles.sketches(few.repartition(30), columns, "part")
    for parts in (profiles.merged(spread.repartition(30), columns), profiles.sketches(few.repartition(30), columns)):  # most partitions are empty
        got = {r.attribute: r for r in profiles.told(parts, columns).collect()}
        assert (got["id"].n_rows, got["id"].n_distinct, got["x"].nulls, got["none"].frequent) == (8, 8, 2, [])
    assert profiles.told(profiles.merged(spread.where("part > 9"), columns), columns).count() == 0
    by = {(r.part, r.attribute): r.n_rows for r in profiles.told(profiles.sketches(df, columns, "part"), columns, "part").collect()}
    assert by[(0, "id")] == 5000
    assert [r.n_rows for r in profiles.told(profiles.sketches(df.limit(0), columns), columns).collect()] == [0, 0, 0, 0]
