"""Substring dedup by content-defined chunking.

A gear rolling hash over the last sixteen characters cuts a text at ends of words: a text is cut where the hash is the
least of some ``WINDOW`` consecutive words, so cuts depend on what stands around them alone, an insertion shifts none but
its own, and no chunk has more than ``WINDOW`` words. Variable chunks (of ``LEAST`` words or more, shorter ones together
with the next) are compared by digest over the whole corpus. Around chunks that several documents have, all grams of
``WORDS`` words are compared, which gives the shared passages their exact edges. The document of smallest id keeps its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from potsherd.llm import chars
from potsherd.llm.common import Scratch, col, fresh, whole_text
from potsherd.llm.workers import give_back, thrifty

#: Words that a passage must have to be removed.
WORDS = 25
#: Each so many consecutive words have a cut among them; and words of a chunk at least.
WINDOW, LEAST = 12, 12
#: Words before and after a shared chunk that its passage may have beyond it: those whose hash looks beyond the passage, and a chunk.
REACH = 8 + WINDOW + LEAST
SEED = 0x5EED
#: Stands between texts: as many characters as the hash looks back, so that none sees the text before it. They count as blanks.
BETWEEN = "\0" * 16
#: Digest of a place where no gram begins, larger than all others.
NONE = np.uint64(2**64 - 1)
#: Ranges of scripts that are written without blanks; each of their characters is a word.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x312F), (0x31A0, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))


def gear() -> np.ndarray:
    """256 random numbers of the gear hash, by a rule."""
    return (chars.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(SEED)) >> np.uint64(48)).astype(np.uint16)


def gear_hashes(codes: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash ``h = 2 h + gear`` after each character; older characters have left it."""
    h = gear()[(codes ^ (codes >> 8)) & 255]
    for k in (1, 2, 4, 8):
        h[k:] += h[:-k] << k
    return h


def sliding(values: np.ndarray, size: int, least: np.ufunc) -> np.ndarray:
    """The minimum or maximum of each ``size`` consecutive values."""
    out, have = values, 1
    while have < size:
        step = min(have, size - have)
        out, have = least(out[: len(out) - step], out[step:]), have + step
    return out


class Texts:
    """The words of some texts in order: of each its text, begin and end (in characters of the text) and hash, and whether a chunk ends with it."""

    def __init__(self, texts: list[str]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.cumsum(sizes + len(BETWEEN)) - sizes
        codes = chars.code_points(BETWEEN.join(["", *texts, ""]))
        solid = (codes != 32) & ((codes < 9) | (codes > 13)) & (codes != 0)
        alone = np.zeros(len(codes), bool)
        if len(codes) and codes.max() >= UNSPACED[0][0]:
            for low, high in UNSPACED:
                alone |= (codes >= low) & (codes <= high)
        apart = ~solid | alone
        self.begins = np.flatnonzero(solid & (alone | np.r_[True, apart[:-1]]))
        self.ends = np.flatnonzero(solid & (alone | np.r_[apart[1:], True])) + 1
        self.text = np.searchsorted(starts, self.begins, "right") - 1
        self.hashes = chars.span_hashes(codes, self.begins, self.ends)
        # each run of blanks counts as one, whatever it is made of
        kept = solid | (codes == 0) | np.r_[True, solid[:-1]]
        low = gear_hashes(np.where(solid | (codes == 0), codes, 32)[kept])[np.cumsum(kept)[self.ends - 1] - 1]
        self.bounds = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self.begins, self.ends = self.begins - starts[self.text], self.ends - starts[self.text]
        # texts lie WINDOW words apart, so that their windows don't meet; at a text's edges shorter windows choose more
        at = np.arange(len(low)) + (self.text + 1) * WINDOW
        spread = np.full((len(texts) + 1) * WINDOW + len(low), 1 << 16, np.int32)
        spread[at] = low
        lows = sliding(spread, WINDOW, np.minimum)
        most = sliding(np.concatenate([np.zeros(WINDOW - 1, np.int32), np.where(lows == 1 << 16, 0, lows), np.zeros(WINDOW - 1, np.int32)]), WINDOW, np.maximum)
        self.cut = most[at] == low

    def chunks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, last, digest) of all chunks between cuts: numbers of their first word and of the word after them."""
        cuts = np.flatnonzero(self.cut)
        close = np.searchsorted(cuts, cuts + LEAST)
        whole = np.flatnonzero(close < len(cuts))
        first, last = cuts[whole] + 1, cuts[close[whole]] + 1
        inside = self.text[first - 1] == self.text[last - 1]
        first, last = first[inside], last[inside]
        return first, last, np.minimum(chars.span_hashes(self.hashes, first, last), NONE - np.uint64(1))

    def grams(self, words: int) -> np.ndarray:
        """The digest of the ``words`` words from each word on, NONE if its text ends before."""
        forward = chars.powers(words)[0]
        digests = np.full(len(self.text), NONE)
        whole = max(len(self.text) - words + 1, 0)
        rolled = np.zeros(whole, np.uint64)
        for k in range(words):
            rolled += self.hashes[k : k + whole] * forward[k]
        digests[:whole] = np.where(self.text[:whole] == self.text[len(self.text) - whole :], np.minimum(chars.mix(rolled), NONE - np.uint64(1)), NONE)
        return digests


def covered(begins: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Whether each of ``size`` places lies in some span."""
    return np.cumsum(np.bincount(begins, minlength=size + 1) - np.bincount(ends, minlength=size + 1))[:size] > 0


def near(texts: Texts, owner: np.ndarray, shared: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, digest) of the grams around the chunks whose digests are among those ``shared`` in their text."""
    first, last, digests = texts.chunks()
    hit = among(texts.text[first], digests, owner, shared)
    low, high = texts.bounds[texts.text[first[hit]]], texts.bounds[texts.text[first[hit]] + 1]
    begins, ends = np.maximum(first[hit] - REACH, low), np.minimum(last[hit] + REACH, high) - words + 1
    some = ends > begins
    keep = np.flatnonzero(covered(begins[some], ends[some], len(texts.text)))
    return texts.text[keep], texts.grams(words)[keep]


def among(text: np.ndarray, digests: np.ndarray, owner: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Whether each (text, digest) is one of the pairs (owner, wanted)."""
    both = lambda t, d: chars.mix(d + (t.astype(np.uint64) + np.uint64(1)) * np.uint64(chars.SPREAD))
    return np.isin(both(text, digests), both(owner, wanted)) & (digests != NONE)


def flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of the list, value) of all values of lists of digests; a null is an empty list."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy().view(np.uint64)


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about as much text as is handled together."""
    for a, b in chars.batches(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)):
        yield batch.slice(a, b - a)


def digested(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_key, digests) of each row of (doc_id, text_key, text): its chunks or, if there is a column ``shared``, the grams near a shared one."""
    around = "shared" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                texts = Texts(part.column("text").to_pylist())
                if around:
                    text, digests = near(texts, *flat(part.column("shared")), words)
                else:
                    first, _, digests = texts.chunks()
                    text = texts.text[first]
                offsets = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(digests.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), lists], ["doc_id", "text_key", "digests"])

    return docs.select("doc_id", "text_key", "text", *["shared"] * around).mapInArrow(thrifty(run), "doc_id long, text_key long, digests array<long>")


def met_again(parts: DataFrame, scratch: Scratch) -> DataFrame:
    """(known, first) of the digests that several documents have. A null id is the largest."""
    once = parts.select("doc_id", F.explode(F.array_distinct("digests")).alias("digest"))
    met = once.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.when(F.col("doc_id").isNull(), 1)).alias("nulls"))
    return scratch.keep(met.where("first < last OR (first IS NOT NULL AND nulls > 0)").select(F.col("digest").alias("known"), "first"))


def held(parts: DataFrame, known: DataFrame, later: bool, scratch: Scratch) -> DataFrame:
    """(id, key, digests) of the rows with their digests that are known, or only those that a smaller id has."""
    each = parts.select("doc_id", "text_key", F.explode(F.array_distinct("digests")).alias("digest"))
    on = F.col("digest") == F.col("known")
    if later:
        on = on & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first")))
    return scratch.keep(each.join(known, on).groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(F.collect_set("digest").alias("digests")))


def spans(texts: list[str], owner: np.ndarray, repeated: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin, end) in characters of the runs of words that stand in repeated grams."""
    read = Texts(texts)
    at = np.flatnonzero(among(read.text, read.grams(words), owner, repeated))
    inside = covered(at, at + words, len(read.text))
    new = np.diff(read.text, prepend=-1) != 0  # a run ends with its text
    opens = np.flatnonzero(inside & (new | ~np.r_[False, inside[:-1]]))
    closes = np.flatnonzero(inside & np.r_[new[1:] | ~inside[1:], True])
    return read.text[opens], read.begins[opens], read.ends[closes]


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS) -> DataFrame:
    """``docs`` with ``text`` cleaned, and two more columns: removed (array of begin, end in the old text), removed_chars.

    A passage that a document shares with one of smaller id goes, from its first word to its last, if it has ``words`` words
    and a whole chunk lies in it: one of ``8 + 2 WINDOW + LEAST`` words nearly always has. Words are compared as they stand,
    blanks between them may differ, and the blanks around a passage stay; in scripts without blanks each character is a
    word. Nothing goes that isn't part of ``words`` equal words. Texts are read whole, however long.

    A column of ``docs`` with the name of a new one is left out of the result. A null text stays null and an empty one
    empty; a text may become empty. Rows that repeat both id and text are one document, so none of them loses its text to
    the other. Of equal passages the smallest doc_id keeps its own; passages that repeat only within a document stay. No
    rows give no rows.
    """
    scratch = Scratch(docs.sparkSession)
    keyed = docs.select(col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")).withColumn("text_key", F.xxhash64("text"))
    sparse = scratch.keep(digested(keyed, words))
    shared = held(sparse, met_again(sparse, scratch), False, scratch).withColumnRenamed("digests", "shared")
    one = F.col("text_key") == F.col("key")
    around = keyed.join(shared, one & F.col("doc_id").eqNullSafe(F.col("id"))).select("doc_id", "text_key", "text", "shared")
    dense = scratch.keep(digested(around, words))
    scratch.drop(sparse)
    found = held(dense, met_again(dense, scratch), True, scratch)
    scratch.drop(dense)
    return cleaned(docs, found, words, text, doc_id)


def cleaned(docs: DataFrame, found: DataFrame, words: int, text: str, doc_id: str) -> DataFrame:
    """``docs`` without the passages whose grams ``found`` (id, key, digests) holds."""
    names = [c for c in docs.columns if c.lower() not in ("removed", "removed_chars")]
    own_id, own_key, there, key, digests = fresh(docs, "own_id", "own_key", "id", "key", "digests")
    marks = found.select(F.col("id").alias(there), F.col("key").alias(key), F.col("digests").alias(digests))
    named = docs.select(*[col(c) for c in names]).withColumn(own_id, col(doc_id).cast("long")).withColumn(own_key, F.xxhash64(whole_text(text)))
    joined = named.join(marks, (F.col(own_key) == F.col(key)) & F.col(own_id).eqNullSafe(F.col(there)), "left")

    @F.arrow_udf("array<struct<begin:int,end:int>>")
    def removed(text: pa.Array, repeated: pa.Array) -> pa.Array:
        out = []
        for part in parts(pa.RecordBatch.from_arrays([pc.fill_null(text, ""), repeated], ["text", "repeated"])):
            of, begins, ends = spans(part.column("text").to_pylist(), *flat(part.column("repeated")), words)
            each = pa.StructArray.from_arrays([pa.array(begins, pa.int32()), pa.array(ends, pa.int32())], ["begin", "end"])
            out.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(part.num_rows + 1)).astype(np.int32)), each))
        give_back()
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.struct({"begin": pa.int32(), "end": pa.int32()})))

    judged = joined.withColumn("removed", removed(F.when(F.col(digests).isNotNull(), whole_text(text)), F.col(digests)))
    size = F.length(whole_text(text))
    begins = F.concat(F.array(F.lit(0)), F.transform("removed", lambda s: s.end))
    stays = F.concat(F.transform("removed", lambda s: s.begin), F.array(size))
    clean = F.array_join(F.zip_with(begins, stays, lambda a, b: F.substr(whole_text(text), a + 1, b - a)), "")
    clear = F.when(F.size("removed") > 0, clean).otherwise(col(text))
    gone = F.aggregate("removed", F.lit(0), lambda n, s: n + s.end - s.begin)
    return judged.select(*[clear.alias(c) if c == text else col(c) for c in names], "removed", gone.alias("removed_chars"))
