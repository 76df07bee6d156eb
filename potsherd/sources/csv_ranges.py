"""CSV files read in ranges: values in quotes may hold line breaks, and yet many tasks read one file.

Spark cuts a file into ranges of lines. Whether a range begins inside quotes depends on the number of quotes before it, so
a first pass counts them per range, and a sum over the ranges of each file tells where each one begins. With that every
range finds its own records; one that goes on in the next range is put together from its pieces.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from potsherd.operators.hierarchy import written

#: What a piece of a range is: a whole record, the begin of one, its end, or a range within one.
WHOLE, BEGIN, END, MIDDLE = 0, 1, 2, 3
SPLITS = "spark.sql.files.minPartitionNum"


@contextmanager
def same_ranges(spark: SparkSession) -> Iterator[None]:
    """Ranges don't follow the number of cores that there happen to be: both passes must cut alike."""
    before = spark.conf.get(SPLITS, None)
    spark.conf.set(SPLITS, before or str(max(1, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SPLITS)


def lines(spark: SparkSession, pattern: str, seed: int) -> DataFrame:
    """(path, start, block, line): the lines of files, each with its range and a number made of both."""
    read = spark.read.option("lineSep", "\n").text(pattern)
    place = read.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.make_valid_utf8("value").alias("line"))
    return place.select("path", "start", F.xxhash64(F.lit(seed), "path", "start").alias("block"), "line")


def runs(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, int]]:
    """(block, lines, offset) of each run of lines of one range."""
    blocks = batch.column("block").to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield int(blocks[a]), batch.column("line").slice(a, b - a), a


def quotes_and_blanks(found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return pc.count_substring(found, '"').to_numpy(zero_copy_only=False), pc.equal(pc.utf8_trim(found, " \r"), "").to_numpy(zero_copy_only=False)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range its quotes, and the records that begin in it if it begins outside quotes or inside."""
    block, path, start, total, begun = None, "", 0, 0, [0, 0]

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "path": [path], "start": pa.array([start], pa.int64()), "quotes": pa.array([total], pa.int64()), "outside": pa.array([begun[0]], pa.int64()), "inside": pa.array([begun[1]], pa.int64())})

    for batch in batches:
        for number, found, at in runs(batch):
            if number != block:
                if block is not None:
                    yield told()
                block, path, start, total, begun = number, batch.column("path")[at].as_py(), batch.column("start")[at].as_py(), 0, [0, 0]
            quotes, blank = quotes_and_blanks(found)
            before = (total + np.cumsum(quotes) - quotes) & 1
            for parity in (0, 1):
                begun[parity] += int(((before == parity) & ~blank).sum())
            total += int(quotes.sum())
    if block is not None:
        yield told()


def _pieces_of(odd: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(block, at, part, text) of the records; ``odd``: sorted numbers of the ranges that begin inside quotes."""

    def starts_inside(block: int) -> int:
        k = int(np.searchsorted(odd, block))
        return int(k < len(odd) and odd[k] == block)

    def rows(block: int, at: np.ndarray | list[int], part: int, text: pa.Array | list[str]) -> pa.RecordBatch:
        texts = text if isinstance(text, pa.Array) else pa.array(text, pa.string())
        n = len(texts)
        return pa.RecordBatch.from_pydict({"block": pa.array(np.full(n, block), pa.int64()), "at": pa.array(at, pa.int64()), "part": pa.array(np.full(n, part), pa.int32()), "text": texts})

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, inside, begun, held, held_at = None, 0, 0, [], -1

        def left() -> Iterator[pa.RecordBatch]:
            if inside and held:
                yield rows(block, [held_at], BEGIN if held_at >= 0 else MIDDLE, ["\n".join(held)])

        for batch in batches:
            for number, found, _ in runs(batch):
                if number != block:
                    yield from left()
                    block, inside, begun, held, held_at = number, starts_inside(number), 0, [], -1
                quotes, blank = quotes_and_blanks(found)
                after = (inside + np.cumsum(quotes)) & 1
                before = np.concatenate([[inside], after[:-1]])
                begins = (before == 0) & ~blank
                at = begun + np.cumsum(begins) - 1
                whole = np.flatnonzero(begins & (after == 0))
                if len(whole):
                    yield rows(block, at[whole], WHOLE, found.take(pa.array(whole)))
                ends = np.flatnonzero((before == 1) & (after == 0))
                first = 0
                if inside:  # a record that was open before these lines
                    stop = int(ends[0]) + 1 if len(ends) else len(found)
                    held += found.slice(0, stop).to_pylist()
                    first = 1
                    if len(ends):
                        yield rows(block, [held_at], WHOLE if held_at >= 0 else END, ["\n".join(held)])
                        held, held_at = [], -1
                opened = np.flatnonzero((before == 0) & (after == 1))
                joined, places = [], []
                for k, i in enumerate(opened.tolist()):
                    if k + first < len(ends):
                        joined.append("\n".join(found.slice(i, int(ends[k + first]) + 1 - i).to_pylist()))
                        places.append(int(at[i]))
                    else:
                        held, held_at = found.slice(i).to_pylist(), int(at[i])
                if joined:
                    yield rows(block, places, WHOLE, joined)
                inside, begun = int(after[-1]), int(begun + begins.sum())
        if block is not None:
            yield from left()

    return split


def records(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, file, at, n, text) of the records of all files that ``pattern`` names, written to the shared folder.

    ``at`` counts a file's records from 0, its header, on, blank lines left out; ``n`` is how many it has, and ``file``
    the place of its path among the others. A record without its last quote goes on to the end of its file. The driver
    holds eight bytes for each range that begins inside quotes, far less than Spark's own list of files and ranges.
    """
    with same_ranges(spark):
        for seed in range(8):
            read = lines(spark, pattern, seed)
            ranges = written(read.mapInArrow(_counts, "block long, path string, start long, quotes long, outside long, inside long"))
            if not ranges.groupBy("block").count().where("count > 1").limit(1).count():
                break
        else:
            raise ValueError("the numbers of the files' ranges are not distinct")
        earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        begun = ranges.withColumn("open", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
        own = F.when(F.col("open") == 1, F.col("inside")).otherwise(F.col("outside"))
        placed = written(begun.withColumn("own", own).withColumn("base", F.coalesce(F.sum("own").over(earlier), F.lit(0))).withColumn("n", F.sum("own").over(Window.partitionBy("path"))))
        odd = np.sort(np.array([r.block for r in placed.where("open = 1").select("block").collect()], np.int64))
        pieces = written(read.select("block", "line").mapInArrow(_pieces_of(odd), "block long, at long, part int, text string"))
    # files are numbered by their names: a listing is far smaller than what it lists
    files = placed.groupBy("path").agg(F.max("n").alias("n")).withColumn("file", F.row_number().over(Window.orderBy("path")).cast("bigint"))
    known = placed.select("block", "path", "start", "base").join(files, "path")
    met = pieces.join(known, "block", "left").withColumn("path", F.coalesce("path", F.raise_error(F.lit("a file's ranges changed while it was read"))))
    whole = met.where(F.col("part") == WHOLE).select("path", "file", (F.col("base") + F.col("at")).alias("at"), "n", "text")
    # a record of several ranges begins with its first piece and holds those up to the next such one
    upto = Window.partitionBy("path").orderBy("start", F.when(F.col("part") == BEGIN, 1).otherwise(0))
    parts = met.where(F.col("part") != WHOLE).withColumn("record", F.sum(F.when(F.col("part") == BEGIN, 1).otherwise(0)).over(upto))
    pieced = parts.groupBy("path", "file", "n", "record").agg(F.max(F.when(F.col("part") == BEGIN, F.col("base") + F.col("at"))).alias("at"), F.array_sort(F.collect_list(F.struct("start", "text"))).alias("pieces"))
    return whole.unionByName(pieced.select("path", "file", "at", "n", F.array_join(F.transform("pieces", lambda p: p.text), "\n").alias("text")))


def numbered_names(names: Column) -> Column:
    """Names of a header, each once: a repeated one gets the least number from 2 on that makes it new."""

    def added(have: Column, name: Column) -> Column:
        other = F.transform(F.sequence(F.lit(2), F.size(have) + 2), lambda k: F.concat(name, F.lit("_"), k.cast("string")))
        return F.concat(have, F.array(F.when(F.array_contains(have, name), F.get(F.filter(other, lambda x: ~F.array_contains(have, x)), F.lit(0))).otherwise(name)))

    return F.aggregate(names, F.array().cast("array<string>"), added)
