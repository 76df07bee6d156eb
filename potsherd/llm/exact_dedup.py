"""Exact dedup by a heavy-hitter split.

Misra-Gries summaries of each partition find the digests that may be frequent, one exact count verifies them, and the
verified winners (their number is bounded by ``counters``) are broadcast, so that rows of a hot text are decided where
they are read. All other digests are grouped by an ordinary shuffle with partial aggregation.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potsherd.llm.common import Scratch, col, fresh, joinable, whole_text
from potsherd.llm.workers import thrifty

#: Each run of white space counts as one space.
SPACES = r"[\x20\x09-\x0D]+"
#: Counters of one summary: digests with over 2/(COUNTERS+1) of all rows are always found, and at most COUNTERS win.
COUNTERS = 999


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, " ")


def misra_gries(counts: Counter, counters: int) -> Counter:
    """Cut a summary down to ``counters`` entries; each entry loses the same count, which its error is bounded by."""
    if len(counts) <= counters:
        return counts
    off = sorted(counts.values(), reverse=True)[counters]
    return Counter({k: v - off for k, v in counts.items() if v > off})


def summaries(digests: DataFrame, name: str, counters: int) -> DataFrame:
    """One Misra-Gries summary for each partition, as rows (digest, n)."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            found = b.column(0).value_counts()
            counts.update(dict(zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True)))
            counts = misra_gries(counts, counters)
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], [name, "n"])

    return digests.select(name).mapInArrow(thrifty(summarise), f"{name} string, n long")


def heavy_winners(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest, keep_id, group_size) of the verified frequent digests; at most ``counters`` rows.

    ``digests`` has doc_id and digest and is a written table, for it is read twice.
    """
    total = digests.count()
    floor = total / (counters + 1)
    candidates = summaries(digests, "digest", counters).groupBy("digest").agg(F.sum("n").alias("n")).where(F.col("n") > floor).select("digest")
    # the summed lower bounds are at most `total`, so fewer than counters + 1 of them exceed the floor
    exact = digests.join(F.broadcast(candidates), "digest", "left_semi").groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return exact.where(F.col("group_size") > floor)


def annotate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", counters: int = COUNTERS, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, and empty texts equal each other. The smallest doc_id stays; a null doc_id loses to any
    other, and a group of null ids only has keep_id null and ``kept`` true. Rows that repeat both id and text are
    all marked like the first (``drop_duplicates`` leaves one of them). Extra columns play no part. No rows give no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    digests = scratch.keep(docs.select(col(doc_id).cast("long").alias("doc_id"), F.sha2(normalised(whole_text(text)), 256).alias("digest")))
    heavy = scratch.keep(heavy_winners(digests, counters))
    winners = F.broadcast(heavy)
    hot = digests.join(winners, "digest")
    rest = digests.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    groups = rest.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    marked = hot.unionByName(rest.join(groups, "digest"))
    return marked.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``: one row for each distinct text.

    Only (digest, doc_id) of the losers travels, and is broadcast if its measured size allows. Rows that repeat both
    id and text are cut down to one of them; null, empty and repeated values count as in ``annotate``.
    """
    digest, loser, lost = fresh(docs, "digest", "loser_id", "loser_digest")
    scratch = Scratch(docs.sparkSession)
    marked = scratch.keep(annotate(docs, text, doc_id, counters, scratch))
    losers = scratch.keep(marked.where(~F.col("kept")).select(F.col("text_sha256").alias(lost), F.col("doc_id").alias(loser)).distinct())
    again = scratch.keep(marked.where("kept").groupBy(F.col("text_sha256").alias(lost)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(lost))
    named = docs.withColumn(digest, F.sha2(normalised(whole_text(text)), 256))
    same = F.col(digest) == F.col(lost)
    stay = named.join(joinable(losers), same & col(doc_id).cast("long").eqNullSafe(F.col(loser)), "left_anti")
    if not again.isEmpty():
        lookup = joinable(again)
        stay = stay.join(lookup, same, "left_anti").unionByName(stay.join(lookup, same, "left_semi").dropDuplicates([digest]))
    return stay.select(*[col(c) for c in docs.columns])
