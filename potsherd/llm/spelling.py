"""Spelling variants: words within one edit of each other, found by even partition, and the form that each is a variant of.

A word is cut into two halves. One edit leaves one of them whole: the first at the word's begin, or the second at its end.
So words are joined by (length, half, its letters) with words of the same length or one longer, whose second half begins one
letter later. Where many words share a half, the other half, in which the edit must lie, is cut again in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from potsherd.llm.common import Scratch, col, whole_text

#: Words of at least so many letters that occur at least so often; a form occurs at least so many times as often as its variant.
LETTERS, OCCURRENCES, TIMES = 7, 2, 10
#: A shared half of more words than this is cut again.
CROWD = 48
#: A word of this number's multiples, by its checksum, loses a letter.
ODD = 31
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", letters: int = LETTERS, occurrences: int = OCCURRENCES) -> DataFrame:
    """word, n: the distinct words of whole texts with their numbers of occurrences, each row with its own checksum's deletions."""
    runs = F.regexp_extract_all(whole_text(text), F.lit(rf"[A-Za-zÀ-ÿ]{{{letters},}}+"), F.lit(0))
    found = docs.select(F.coalesce(col(doc_id).cast("string"), F.lit("")).alias("doc_id"), F.explode(runs).alias("run"))
    each = found.select("doc_id", F.translate("run", CAPITALS, SMALL).alias("run"))
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    read = each.select(F.when(h % ODD == 0, less).otherwise(F.col("run")).alias("word")).where(F.length("word") >= letters)
    return read.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= occurrences)


def _cut(entries: DataFrame) -> DataFrame:
    """Both ways to keep one half of the part in which the edit may lie: ``at`` its begin, ``m`` its letters in the shorter word, ``more`` those of a longer one besides."""
    half = F.floor(F.col("m") / 2).cast("int")
    ahead = F.substr("word", F.col("at") + 1, half)
    ways = F.array(
        F.struct(F.concat("path", F.lit("1")).alias("path"), (F.col("at") + half).alias("at"), (F.col("m") - half).alias("m"), F.col("skipped")),
        F.struct(F.concat("path", F.lit("2")).alias("path"), F.col("at"), half.alias("m"), F.concat("skipped", F.array(ahead)).alias("skipped")),
    )
    cut = entries.select("word", "n", "size", "more", F.explode(ways).alias("way")).select("word", "n", "size", "more", "way.*")
    rest = F.substr("word", F.col("at") + F.col("m") + F.col("more") + 1)
    return cut.withColumn("key", F.concat(F.substr("word", F.lit(1), F.col("at")), F.lit("_"), rest))


def _met(index: DataFrame, probe: DataFrame) -> DataFrame:
    """The pairs of one edit among words with equal keys, each once: by the first way that brings them together."""
    a, b = index.alias("a"), probe.alias("b")
    apart = F.forall(F.zip_with("a.skipped", "b.skipped", lambda x, y: x != y), lambda x: x)
    same = [F.col(f"a.{x}") == F.col(f"b.{x}") for x in ("size", "path", "key")]
    candidates = a.join(b, [*same, (F.col("b.more") == 1) | (F.col("a.word") < F.col("b.word")), apart])
    return candidates.where(F.levenshtein("a.word", "b.word", 1) == 1).select(F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n"))


def pairs(vocabulary: DataFrame, scratch: Scratch, crowd: int = CROWD) -> DataFrame:
    """word, n, near, near_n: each pair of words of one edit once. ``vocabulary`` is a written table of distinct words and n."""
    of = lambda more: vocabulary.select("word", "n", (F.length("word") - more).alias("size"), F.lit(more).alias("more"), F.lit("").alias("path"), F.lit(0).alias("at"), (F.length("word") - more).alias("m"), F.array().cast("array<string>").alias("skipped"))
    index, probe, found = of(0), of(0).unionByName(of(1).where("size > 0")), None
    by = ["size", "path", "key"]
    while True:
        index, probe = scratch.keep(_cut(index)), scratch.keep(_cut(probe))
        crowded = scratch.keep(index.where("m > 1").groupBy(*by).agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > crowd).drop("held"))
        if crowded.isEmpty():
            met = scratch.keep(_met(index, probe))
            scratch.drop(index, probe)
            return met if found is None else found.unionByName(met)
        met = scratch.keep(_met(index.join(crowded, by, "left_anti"), probe.join(crowded, by, "left_anti")))
        found = met if found is None else found.unionByName(met)
        rest = [scratch.keep(x.join(crowded, by, "left_semi")) for x in (index, probe)]
        scratch.drop(index, probe)
        index, probe = rest


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", times: int = TIMES, crowd: int = CROWD) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of at least LETTERS letters and OCCURRENCES occurrences.

    Words are maximal runs of Latin-1 letters, only A-Z made small; a run whose checksum with its document's id 31 divides
    loses the letter that the checksum points to. Near are words of exactly one inserted, deleted or replaced code point.
    The form is the near word of most occurrences (ties: the smallest in code points) if these are ten times the word's own
    at least; the root is where forms lead. Null and empty texts have no words; a null id is written as nothing before the
    colon; each row counts, repeated ones too; extra columns play no part; no documents give no rows. Texts and runs of any
    length are read whole. A word's occurrences are summed before they are shuffled; no task holds all words of a half.
    """
    scratch = Scratch(docs.sparkSession)
    vocabulary = scratch.keep(words(docs, doc_id, text))
    met = pairs(vocabulary, scratch, crowd)
    turned = F.array(
        F.struct(F.col("word").alias("word"), F.col("near").alias("near"), F.col("near_n").alias("near_n")),
        F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    both = met.select(F.inline(turned))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = vocabulary.join(best, "word", "left")
    has = -F.col("best.less") >= times * F.col("n")
    formed = scratch.keep(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.near")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n")))
    roots = follow(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), scratch)
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def follow(links: DataFrame, scratch: Scratch) -> DataFrame:
    """word, root: where links lead at last. Each step doubles the way; links rise in occurrences, so there are few and no circles."""
    links = scratch.keep(links)
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = scratch.keep(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")))
        went = not further.where("went").isEmpty()
        scratch.drop(links)
        links = further.drop("went")
        if not went:
            return links
