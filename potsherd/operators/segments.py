"""A stored full-text index in segments: a batch of changed rows writes postings of these rows only.

Each version adds a segment: the postings of its rows in buckets by a hash of the term, their lengths, and the keys whose
older postings hold no more. When four segments of a level have come together, they are merged to one of the next level, so
that a row is written again as often only as the number of levels grows. A query reads the buckets of its terms.

A row's words travel to their buckets together, as one text and its places; postings are made where they are written. The
number of words of a batch, which its lengths tell, gives the number of tasks: a bucket of many words is dealt to several by
the rows' keys, so that no task sorts more than memory holds.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from potsherd.operators import search
from potsherd.sources import versions

BUCKETS, FAN = 32, 4
#: Words of a task that writes postings, on average, and into how many pieces a row is dealt at most.
WORDS, PIECES = 2_000_000, 16


def bucket_of(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class Tasks:
    """The tasks that write ``words`` words: one, or ``slices``, for each group of buckets."""

    words: int

    @property
    def groups(self) -> int:
        return max(1, min(PIECES, -(-self.words // WORDS)))

    @property
    def slices(self) -> int:
        return max(1, -(-self.words // (WORDS * PIECES)))

    def group(self, term: Column) -> Column:
        return bucket_of(term) % self.groups

    def dealt(self, rows: DataFrame, group: Column) -> DataFrame:
        return rows.repartitionById(self.groups * self.slices, group * self.slices + F.pmod(F.xxhash64("pk"), F.lit(self.slices)).cast("int"))


def _postings(rows: DataFrame, pk: str, fields: list[str], table: str, tasks: Tasks) -> DataFrame:
    """The rows' postings, each in its task."""
    words = search.runs(search.placed(F.col("terms"), at=tasks.group), "at")  # the words of each group of buckets
    parts = search.fields_read(rows, pk, fields).select("pk", "field", "size", F.explode(words).alias("part"))
    packed = parts.select("pk", "field", "size", F.get("part", F.lit(0))["at"].alias("at"), F.array_join("part.term", " ").alias("words"), F.col("part.place").alias("places"))
    there = tasks.dealt(packed, F.col("at"))
    return search.by_term(there, F.arrays_zip(F.split("words", " ").alias("term"), F.col("places").alias("place")), table)


def apply(rows: DataFrame, root: str, pk: str, fields: list[str], version: int, table: str = "", deleted: str | None = None) -> bool:
    """Index changed rows as version ``version``; false if it, or a later one, is there already. Rows with ``deleted`` true go.

    A row replaces all postings of its key; of several rows of a key in one batch all count, so that a batch should hold
    the last one only. Rows with a null key are left out.
    """
    spark = rows.sparkSession
    if any(v >= version for v in versions.versions(spark, root)):
        return False
    told = versions.content(spark, root, before=version) or {"segments": [], "pk": rows.schema[pk].dataType.simpleString()}
    there = rows.where(F.col(pk).isNotNull())
    kept = there.where(~F.coalesce(F.col(deleted), F.lit(False))) if deleted else there
    name = f"{version}-0"
    _write(spark, root, name, lambda tasks: _postings(kept, pk, fields, table, tasks), search.lengths(kept, pk, fields, table), there.select(F.lit(table).alias("tbl"), F.col(pk).alias("pk")).distinct())
    segments = [*told["segments"], {"name": name, "level": 0}]
    while len(last := [s for s in segments if s["level"] == segments[-1]["level"]]) >= FAN:
        # the last ones of a level stand together, for levels fall from the oldest to the newest
        first = len(segments) - len(last)
        merged = {"name": f"{version}-{last[0]['level'] + 1}", "level": last[0]["level"] + 1}
        part = told | {"segments": last}
        gone = _gone(spark, root, part).select("tbl", "pk").distinct() if first else None  # the oldest segment has nothing older to take back
        live = _live(spark, root, part, "postings").drop("bucket")
        _write(spark, root, merged["name"], lambda tasks, live=live: tasks.dealt(live, tasks.group(F.col("term"))), _live(spark, root, part, "lengths"), gone)
        segments = [*segments[:first], merged]
    versions.commit(spark, root, version, told | {"segments": segments})
    return True


def _write(spark: SparkSession, root: str, name: str, postings: Callable[[Tasks], DataFrame], lengths: DataFrame, gone: DataFrame | None) -> None:
    place = f"{root}/segments/{name}"
    lengths.write.mode("overwrite").parquet(f"{place}/lengths")
    words = spark.read.schema(lengths.schema).parquet(f"{place}/lengths").agg(F.sum("size")).first()[0]
    bucketed = postings(Tasks(words or 0)).withColumn("bucket", bucket_of(F.col("term")))
    bucketed.sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(f"{place}/postings")
    if gone is not None:
        gone.write.mode("overwrite").parquet(f"{place}/gone")


def _schemas(told: dict) -> dict[str, str]:
    pk = told["pk"]
    return {
        "postings": f"tbl string, pk {pk}, field string, term string, tf bigint, size bigint, places array<int>, bucket int",
        "lengths": f"tbl string, pk {pk}, field string, size bigint",
        "gone": f"tbl string, pk {pk}",
    }


def _read(spark: SparkSession, root: str, told: dict, what: str) -> DataFrame:
    """What the segments hold, with the place ``at`` of its segment among them."""
    out = spark.createDataFrame([], _schemas(told)[what] + ", at int")
    for k, s in enumerate(told["segments"]):
        if versions.exists(spark, f"{root}/segments/{s['name']}/{what}"):
            out = out.unionByName(spark.read.schema(_schemas(told)[what]).parquet(f"{root}/segments/{s['name']}/{what}").withColumn("at", F.lit(k)))
    return out


def _gone(spark: SparkSession, root: str, told: dict) -> DataFrame:
    return _read(spark, root, told, "gone").groupBy("tbl", "pk").agg(F.max("at").alias("until"))


def _live(spark: SparkSession, root: str, told: dict, what: str, wanted: Column | None = None) -> DataFrame:
    """Rows that no later segment takes back."""
    read = _read(spark, root, told, what)
    read = read.where(wanted) if wanted is not None else read
    gone = _gone(spark, root, told)
    met = read.join(gone.select(F.col("tbl").alias("_t"), F.col("pk").alias("_p"), "until"), (F.col("tbl") == F.col("_t")) & (F.col("pk") == F.col("_p")), "left")
    return met.where(F.col("until").isNull() | (F.col("at") >= F.col("until"))).drop("_t", "_p", "until", "at")


def asked_for(query: str) -> Column | None:
    """The rows of the postings that a query needs: their buckets and terms; null if a wildcard may stand for any."""
    words = {w for p in search.parse(query) for w in p.words}
    if not words or any(re.search(r"[*?]", w) for w in words):
        return None
    spots = F.array(*[bucket_of(F.lit(w)) for w in sorted(words)])
    return F.array_contains(spots, F.col("bucket")) & F.col("term").isin(*sorted(words))


def postings(spark: SparkSession, root: str, query: str | None = None, version: int | None = None) -> DataFrame:
    """The index's postings; those that a query needs."""
    told = versions.content(spark, root, version)
    if told is None:
        raise ValueError(f"no index in {root}")
    return _live(spark, root, told, "postings", asked_for(query) if query else None).drop("bucket")


def lengths(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    told = versions.content(spark, root, version)
    if told is None:
        raise ValueError(f"no index in {root}")
    return _live(spark, root, told, "lengths")


def ranked(spark: SparkSession, root: str, query: str, fields: list[str] | None = None) -> DataFrame:
    """(pk, score) as ``search.ranked`` gives them from postings made anew."""
    return search.ranked(postings(spark, root, query), query, fields, sizes=lengths(spark, root))


def clean(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete the segments that none of the last ``keep`` versions names."""
    used = {s["name"] for told in versions.forget(spark, root, keep) for s in told["segments"]}
    for name in versions.folders(spark, f"{root}/segments"):
        if name not in used:
            versions.remove(spark, f"{root}/segments/{name}")
