"""Line dedup by a log-template tree, with DataFrame functions only.

A line's tokens with digits are variable fields. The tree has a fixed depth: a line goes to the leaf of its token count
and its leading tokens. In a leaf, the most frequent token at each place makes a template; the lines that agree with it in
most places belong to it, whatever they hold elsewhere. If these stand for less than half of the leaf, it holds several
templates, and the lines left over are told apart by the place with the fewest tokens. So it goes on until no leaf is left
that could give a template. Lines that agree with none are templates of their own. Templates that recur in enough
documents are boilerplate, and their lines are dropped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potsherd.llm.common import Scratch, col, fresh, joinable, whole_text

#: Leading tokens that lead to a leaf.
DEPTH = 3
#: Share of the places in which a line must agree with a leaf's template.
ALIKE = 0.7
#: Documents in which a template recurs.
DOCUMENTS = 10
#: Shorter lines (tokens) are never dropped; lines of fewer than the second number are not generalised.
SHORT, GENERAL = 3, 6

FIELD = "<*>"


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def masked(text: Column) -> Column:
    """Array of a text's lines: tokens with one space between, those with digits as a field.

    All lines are masked together, for a regular expression costs far more to begin than to go on.
    """
    single = F.regexp_replace(text, r"[ \t\x0B\f\r]{2,}|[\t\x0B\f\r]", " ")
    plain = F.trim(F.replace(F.replace(single, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n")))
    # a token is entered at its first character only
    field = F.when(text.rlike("[0-9]"), F.regexp_replace(plain, r"(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*+", FIELD)).otherwise(plain)
    return lines(field)


def count_tokens(mask: Column) -> Column:
    return F.when(mask == "", 0).otherwise(F.octet_length(mask) - F.octet_length(F.replace(mask, F.lit(" "), F.lit(""))) + 1)


def parsed(masks: Column) -> Column:
    """Array of (line, leaf) as hashes, one for each masked line; null for lines that are too short to be dropped, leaf 0 for those that aren't generalised."""
    counted = F.transform(masks, lambda m: F.struct(m.alias("mask"), count_tokens(m).alias("n")))
    leaf = lambda c: F.when(c.n >= GENERAL, F.xxhash64(c.n, F.substring_index(c.mask, " ", DEPTH))).otherwise(F.lit(0).cast("long"))
    return F.transform(counted, lambda c: F.when(c.n >= SHORT, F.struct(F.xxhash64(c.mask).alias("line"), leaf(c).alias("leaf"))))


def tree(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text_key, parsed) of each row: its lines in order, as hashes."""
    return scratch.keep(docs.select("doc_id", "text_key", parsed(masked(F.col("text"))).alias("parsed")))


def templates(docs: DataFrame, parsed_docs: DataFrame, documents: int, scratch: Scratch) -> DataFrame:
    """The lines (hashes) whose templates recur in ``documents`` rows."""
    in_doc = parsed_docs.select("doc_id", "text_key", F.explode(F.array_distinct(F.filter("parsed", lambda p: p.isNotNull()))).alias("p")).select("doc_id", "text_key", "p.line", "p.leaf")
    counts = scratch.keep(in_doc.groupBy("line", "leaf").agg(F.count(F.lit(1)).alias("docs")))
    recurring = counts.where(F.col("docs") >= documents).select("line")
    leaves = counts.where("leaf != 0").groupBy("leaf").agg(F.sum("docs").alias("docs"), F.count(F.lit(1)).alias("n")).where((F.col("docs") >= documents) & (F.col("n") > 1))
    leaves = scratch.keep(leaves.select(F.col("leaf").alias("hot")))
    if leaves.isEmpty():
        return scratch.keep(recurring)

    masks = docs.select(masked(F.col("text")).alias("masks"))
    said = masks.select(F.explode(F.arrays_zip(F.col("masks").alias("mask"), parsed(F.col("masks")).alias("p"))).alias("x"))
    told = said.where("x.p.leaf != 0").select("x.p.line", "x.p.leaf", "x.mask")
    few = told.join(joinable(leaves), F.col("leaf") == F.col("hot"), "left_semi").groupBy("line", "leaf").agg(F.min("mask").alias("mask"))
    left = scratch.keep(few.join(counts.select("line", "docs"), "line").select("line", "leaf", "docs", F.split("mask", " ").alias("tokens")))
    members = []
    while not left.isEmpty():
        led = scratch.keep(leaders(left))
        judged = scratch.keep(judge(left, led, len(members)))
        members.append(judged.where("member").select("line", "template"))
        left = rest(judged, documents, scratch)
    if not members:
        return scratch.keep(recurring)
    belongs = scratch.keep(reduce(DataFrame.unionByName, members).withColumnRenamed("line", "m"))
    held = in_doc.join(joinable(belongs), F.col("line") == F.col("m"))
    often = held.select("template", "doc_id", "text_key").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= documents)
    found = belongs.join(joinable(scratch.keep(often.select("template"))), "template", "left_semi").select(F.col("m").alias("line"))
    return scratch.keep(recurring.unionByName(found).distinct())


def leaders(left: DataFrame) -> DataFrame:
    """(led, total, leading, fork) of each leaf: its weight, its most frequent token at each place (the larger one of a tie), and the first of the places that tell its lines apart by the fewest tokens."""
    each = left.select("leaf", "docs", F.posexplode("tokens").alias("place", "token"))
    votes = each.groupBy("leaf", "place", "token").agg(F.sum("docs").alias("docs"))
    best = votes.groupBy("leaf", "place").agg(F.max(F.struct("docs", "token")).alias("best"), F.sum("docs").alias("total"), F.count(F.lit(1)).alias("kinds"))
    fork = F.min(F.when(F.col("kinds") > 1, F.struct("kinds", "place")))
    return best.groupBy(F.col("leaf").alias("led")).agg(F.max("total").alias("total"), F.transform(F.array_sort(F.collect_list(F.struct("place", "best.token"))), lambda x: x.token).alias("leading"), fork.alias("fork")).withColumn("fork", F.col("fork.place"))


def judge(left: DataFrame, led: DataFrame, turn: int) -> DataFrame:
    """The lines with whether they are members of their leaf's template; the others with the leaf that they go to if there is no better one."""
    both = left.join(joinable(led), F.col("leaf") == F.col("led"))
    same = F.size(F.filter(F.zip_with("tokens", "leading", lambda t, m: t == m), lambda x: x))
    apart = F.xxhash64("leaf", F.lit(turn), F.coalesce(F.get("tokens", "fork"), F.lit("")))
    return both.select("line", "leaf", "docs", "tokens", "total", (same >= ALIKE * F.size("tokens")).alias("member"), F.xxhash64("leaf", F.lit(turn)).alias("template"), apart.alias("apart"))


def rest(judged: DataFrame, documents: int, scratch: Scratch) -> DataFrame:
    """The lines of the leaves that may still give a template: of several lines, in enough documents together."""
    taken = judged.groupBy(F.col("leaf").alias("of")).agg(F.coalesce(F.sum(F.when(F.col("member"), F.col("docs"))), F.lit(0)).alias("taken"))
    both = judged.where("NOT member").join(joinable(scratch.keep(taken)), F.col("leaf") == F.col("of"))
    moved = scratch.keep(both.select("line", F.when(2 * F.col("taken") < F.col("total"), F.col("apart")).otherwise(F.col("leaf")).alias("leaf"), "docs", "tokens"))
    enough = moved.groupBy(F.col("leaf").alias("of")).agg(F.sum("docs").alias("docs"), F.count(F.lit(1)).alias("n")).where((F.col("docs") >= documents) & (F.col("n") > 1)).select("of")
    return scratch.keep(moved.join(joinable(scratch.keep(enough)), F.col("leaf") == F.col("of"), "left_semi"))


def annotate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", documents: int = DOCUMENTS) -> DataFrame:
    """``docs`` with three more columns: n_lines, dropped (array of line numbers from 0), clean_text.

    A template is boilerplate if its lines stand in ``documents`` rows. Lines of fewer than SHORT tokens are never dropped;
    lines of fewer than GENERAL tokens are dropped only where they recur as they are, digits apart.

    A column of ``docs`` with such a name is left out of the result. A null or empty text is one empty line, which is
    too short to be dropped; so are blank lines. Long texts and lines are read whole. Repeated rows count as documents each
    and are cleaned alike, ties between tokens go to the larger one, and no rows give no rows.
    """
    scratch = Scratch(docs.sparkSession)
    keyed = docs.select(col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")).withColumn("text_key", F.xxhash64("text"))
    parsed_docs = tree(keyed, scratch)
    boilerplate = templates(keyed, parsed_docs, documents, scratch)
    each = parsed_docs.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), F.posexplode("parsed").alias("at", "p")).where("p IS NOT NULL").select("id", "key", "at", F.col("p.line").alias("line"))
    hits = each.join(joinable(boilerplate.select(F.col("line").alias("b"))), F.col("line") == F.col("b"), "left_semi")
    drops = scratch.keep(hits.groupBy("id", "key").agg(F.array_sort(F.collect_set("at")).alias("dropped")))
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "dropped", "clean_text")]
    own, own_id, key, there = fresh(docs, "text_key", "own_id", "key", "id")
    marks = drops.select(F.col("id").alias(there), F.col("key").alias(key), F.col("dropped").alias("dropped"))
    named = docs.select(*[col(c) for c in names]).withColumn(own, F.xxhash64(whole_text(text))).withColumn(own_id, col(doc_id).cast("long"))
    joined = named.join(joinable(marks), (F.col(own) == F.col(key)) & F.col(own_id).eqNullSafe(F.col(there)), "left")
    none = F.array().cast("array<int>")
    gone = F.coalesce(F.col("dropped"), none)
    said = lines(whole_text(text))
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(said) - 1), gone), lambda k: F.get(said, k)), "\n")
    return joined.select(*[col(c) for c in names], F.size(said).alias("n_lines"), gone.alias("dropped"), F.when(F.col("dropped").isNull(), whole_text(text)).otherwise(kept).alias("clean_text"))


def summary(annotated: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return annotated.select(col(doc_id).alias("doc_id"), F.col("n_lines").cast("long").alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped"), "clean_text")
