"""Full-text search: postings, ranking by BM25, a subset of the usual query language, and highlights."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potsherd.functions.values import bind

#: Ranking parameters, and columns that are never searched.
K1, B = 1.2, 0.75
SKIPPED = ("_id", "herkomst", "key", "brondata", "vindplaats")
#: Hits of a query.
HITS = 1000


def searchable(df: DataFrame, skipped: tuple[str, ...] = SKIPPED) -> list[str]:
    """The text columns that are searched."""
    return [c for c, kind in df.dtypes if kind == "string" and c.lower() not in {s.lower() for s in skipped}]


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def placed(words: Column, **more: Callable[[Column], Column]) -> Column:
    """array<struct<more, term, place>> of a field's words and their places, from 0 on, in this order of columns. ``more``: values made of the word."""
    return F.sort_array(F.transform(words, lambda t, i: F.struct(*[make(t).alias(n) for n, make in more.items()], t.alias("term"), i.alias("place"))))


def runs(items: Column, of: str) -> Column:
    """An array of structs cut where the field ``of`` changes."""

    def cut(a: Column) -> Column:
        first = F.transform(a, lambda x, i: F.when((i == 0) | (x[of] != F.get(a, i - 1)[of]), i))
        starts = F.filter(first, lambda i: i.isNotNull())
        return bind(F.concat(starts, F.array(F.size(a))), lambda s: F.transform(F.slice(s, 1, F.size(s) - 1), lambda at, k: F.slice(a, at + 1, F.get(s, k + 1) - at)))

    return bind(items, cut)


def fields_read(df: DataFrame, pk: str, fields: list[str]) -> DataFrame:
    """(pk, field, terms, size): a row for each field."""
    each = F.explode(F.array(*[F.struct(F.lit(f.lower()).alias("field"), terms(F.col(f)).alias("terms")) for f in fields]))
    return df.select(F.col(pk).alias("pk"), each.alias("f")).select("pk", "f.field", "f.terms", F.size("f.terms").cast("bigint").alias("size"))


def by_term(rows: DataFrame, sorted_words: Column, table: str) -> DataFrame:
    """The postings of rows (pk, field, size), from an array<struct<term, place>> in this order."""
    run = rows.select("pk", "field", "size", F.explode(runs(sorted_words, "term")).alias("run"))
    return run.select(F.lit(table).alias("tbl"), "pk", "field", F.get("run", F.lit(0))["term"].alias("term"), F.size("run").cast("bigint").alias("tf"), "size", F.col("run.place").alias("places"))


def postings(df: DataFrame, pk: str, fields: list[str], table: str = "") -> DataFrame:
    """(tbl, pk, field, term, tf, size, places): one row for each term of each field of each row; size is the number of terms of the field, places are where this one stands, from 0 on.

    A row's words are sorted within the row, so nothing is shuffled.
    """
    return by_term(fields_read(df, pk, fields), placed(F.col("terms")), table)


def lengths(df: DataFrame, pk: str, fields: list[str], table: str = "") -> DataFrame:
    """(tbl, pk, field, size): the number of terms of each field that has any."""
    each = F.explode(F.array(*[F.struct(F.lit(f.lower()).alias("field"), F.size(terms(F.col(f))).cast("bigint").alias("size")) for f in fields]))
    return df.select(F.lit(table).alias("tbl"), F.col(pk).alias("pk"), each.alias("f")).select("tbl", "pk", "f.field", "f.size").where("size > 0")


@dataclass(frozen=True)
class Part:
    """A part of a query: words (one, or several of a phrase), the field it is for, whether it must or must not be there."""

    words: tuple[str, ...]
    field: str | None = None
    must: bool = False
    banned: bool = False


def parse(query: str) -> list[Part]:
    """Words, "phrases", field:word, * and ? in words, AND, OR, NOT, + and -. Parts are joined by OR where nothing is said."""
    found, must, banned = [], False, False
    pieces = re.findall(r'[+-]?(?:\w+:)?"[^"]*"|\S+', query)
    for piece in pieces:
        if piece in ("AND", "&&"):
            if found:
                found[-1] = Part(found[-1].words, found[-1].field, not found[-1].banned, found[-1].banned)
            must = True
            continue
        if piece in ("OR", "||"):
            continue
        if piece in ("NOT", "!"):
            banned = True
            continue
        sign, rest = (piece[0], piece[1:]) if piece[0] in "+-" else ("", piece)
        name = re.match(r"(\w+):(?=.)", rest)
        body = rest[name.end() :] if name else rest
        words = tuple(re.findall(r"[\w*?]+", body.lower()))
        if words:
            found.append(Part(words, name.group(1).lower() if name else None, must or sign == "+", banned or sign == "-"))
        must = banned = False
    return found


def pattern(word: str) -> str:
    return "^" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in word) + "$"


def word_fits(term: Column, word: str) -> Column:
    return term.rlike(pattern(word)) if re.search(r"[*?]", word) else term == word


def part_fits(term: Column, part: Part, field: Column | None = None) -> Column:
    """Whether a term has to do with a part: one of its words, in its field."""
    field = F.col("field") if field is None else field
    fits = word_fits(term, part.words[0])
    for w in part.words[1:]:
        fits = fits | word_fits(term, w)
    return fits & (field == part.field) if part.field else fits


def wanted_by(parts: list[Part], term: Column, field: Column | None = None) -> Column:
    return reduce(lambda a, b: a | b, [part_fits(term, p, field) for p in parts], F.lit(False))


def phrase_name(k: int) -> str:
    """Part ``k``, a phrase, among the terms; no term has a number sign."""
    return f"#{k}"


def phrases_of(parts: list[Part]) -> dict[int, Part]:
    return {k: p for k, p in enumerate(parts) if len(p.words) > 1}


def ranked(index: DataFrame, query: str, fields: list[str] | None = None, k1: float = K1, b: float = B, sizes: DataFrame | None = None) -> DataFrame:
    """(pk, score) of the rows that fit: the sum of BM25 over the terms and phrases of the query.

    A row's length and the mean length are those of the searched fields together; ``sizes`` has them as ``lengths`` does,
    so that only the terms asked for are read of the index. A phrase counts where its words stand one after the other in
    one field, as often as they do; its rarity is the sum of its words'. Words of a phrase don't count by themselves.
    """
    parts = parse(query)
    scoped = lambda df: df.where(F.col("field").isin(*[f.lower() for f in fields])) if fields else df
    if not parts:
        return index.sparkSession.createDataFrame([], f"pk {dict(index.dtypes)['pk']}, score double")
    scope = scoped(index)
    each = scoped(sizes) if sizes is not None else scope.groupBy("pk", "field").agg(F.max("size").alias("size"))
    total = each.groupBy("pk").agg(F.sum("size").alias("size"))
    met = scope.where(wanted_by(parts, F.col("term")))
    hits = met.select("pk", "field", "term", "tf")
    for k, p in phrases_of(parts).items():
        hits = hits.unionByName(adjacent(met, p).withColumn("term", F.lit(phrase_name(k))))
    return scored(hits, total, total, parts, k1, b)


def adjacent(met: DataFrame, part: Part) -> DataFrame:
    """(pk, field, tf): how often the words of a phrase stand one after the other, from the places of its words."""
    spots = [F.array_distinct(F.flatten(F.collect_list(F.when(word_fits(F.col("term"), w), F.col("places"))))).alias(f"w{j}") for j, w in enumerate(part.words)]
    rows = met.where(part_fits(F.col("term"), part)).groupBy("pk", "field").agg(*spots)
    follows = lambda at: reduce(lambda a, b: a & b, [F.array_contains(f"w{j}", at + j) for j in range(1, len(part.words))])
    return rows.select("pk", "field", F.size(F.filter("w0", follows)).cast("bigint").alias("tf")).where("tf > 0")


def hit(field: Column, term: Column, tf: Column) -> Column:
    return F.struct(field.alias("field"), term.alias("term"), tf.cast("bigint").alias("tf"))


def phrase_hits(k: int, part: Part) -> Column:
    """Hits of a phrase in the fields of a row, ``told``."""

    def times(t: Column) -> Column:
        stands = lambda w, at: reduce(lambda a, b: a & b, [word_fits(F.coalesce(F.get(t.terms, at + j), F.lit("")), x) for j, x in enumerate(part.words)])
        return F.size(F.filter(t.terms, stands))

    asked = F.filter("told", lambda t: t.field == part.field) if part.field else F.col("told")
    return F.filter(F.transform(asked, lambda t: hit(t.field, F.lit(phrase_name(k)), times(t))), lambda h: h.tf > 0)


def ranked_rows(df: DataFrame, pk: str, fields: list[str], query: str, k1: float = K1, b: float = B) -> DataFrame:
    """The same as ``ranked`` of the rows' postings, without an index: only the words and phrases that the query asks for leave their row."""
    parts = parse(query)
    if not parts:
        return df.sparkSession.createDataFrame([], f"pk {dict(df.dtypes)[pk]}, score double")
    told = F.array(*[F.struct(F.lit(f.lower()).alias("field"), terms(F.col(f)).alias("terms")) for f in fields])
    read = df.select(F.col(pk).alias("pk"), told.alias("told"))
    size = F.aggregate("told", F.lit(0).cast("bigint"), lambda n, t: n + F.size(t.terms))
    asked = F.flatten(F.transform("told", lambda t: F.transform(F.filter(t.terms, lambda w: wanted_by(parts, w, t.field)), lambda w: hit(t.field, w, F.lit(1)))))
    lists = [asked]
    for k, p in phrases_of(parts).items():
        lists.append(phrase_hits(k, p))
    each = read.select("pk", size.alias("size"), F.explode(F.concat(*lists)).alias("a")).select("pk", "size", "a.field", "a.term", "a.tf")
    hits = each.groupBy("pk", "field", "term", "size").agg(F.sum("tf").alias("tf"))
    return scored(hits, hits.select("pk", "size").distinct(), read.select("pk", size.alias("size")).where("size > 0"), parts, k1, b)


def scored(hits: DataFrame, sizes: DataFrame, lengths: DataFrame, parts: list[Part], k1: float, b: float) -> DataFrame:
    """(pk, score) of the hits (pk, field, term, tf; phrases among the terms) that fit the query; ``sizes`` are the lengths of their rows, ``lengths`` those of all."""
    phrases = phrases_of(parts)
    total = lengths.agg(F.count(F.lit(1)).alias("n"), F.avg("size").alias("mean"))  # one row
    there = lambda k, p: F.col("term") == phrase_name(k) if k in phrases else part_fits(F.col("term"), p)
    flags = {f"p{k}": F.max(there(k, p)) for k, p in enumerate(parts)}
    words = {f"w{k}_{j}": F.max(part_fits(F.col("term"), Part((w,), p.field))) for k, p in phrases.items() for j, w in enumerate(p.words)}
    found = hits.groupBy("pk").agg(*[f.alias(n) for n, f in (flags | words).items()])
    keep, optional = F.lit(True), F.lit(False)
    for k, p in enumerate(parts):
        if p.banned:
            keep = keep & ~F.col(f"p{k}")
        elif p.must:
            keep = keep & F.col(f"p{k}")
        else:
            optional = optional | F.col(f"p{k}")
    if not any(p.must for p in parts):
        keep = keep & optional
    rows = found.where(keep).select("pk")
    counting = reduce(lambda a, b: a | b, [there(k, p) for k, p in enumerate(parts) if not p.banned], F.lit(False))
    told = hits.where(counting).groupBy("pk", "term").agg(F.sum("tf").alias("tf"))
    in_rows = told.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    exact = not any(re.search(r"[*?]", w) for p in parts for w in p.words)
    told = told.join(F.broadcast(in_rows) if exact else in_rows, "term")  # without wildcards there are no more terms than words in the query
    joined = told.join(rows, "pk", "left_semi").join(sizes, "pk").crossJoin(F.broadcast(total))
    rare = lambda df: F.ln(1 + (F.col("n") - df + 0.5) / (df + 0.5))
    rarity = rare(F.col("df"))
    if words:
        joined = joined.crossJoin(F.broadcast(found.agg(*[F.count_if(w).alias(f"d{w[1:]}") for w in words])))  # one row
        for k, p in phrases.items():
            rarity = F.when(F.col("term") == phrase_name(k), reduce(lambda a, c: a + c, [rare(F.col(f"d{k}_{j}")) for j in range(len(p.words))])).otherwise(rarity)
    weight = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("size") / F.col("mean")))
    return joined.groupBy("pk").agg(F.sum(rarity * weight).alias("score"))


def highlighted(text: Column, query: str) -> Column:
    """The text with ``<mark>`` around the words of the query."""
    words = [w for p in parse(query) if not p.banned for w in p.words]
    if not words:
        return text
    shapes = "|".join("".join(r"[\p{L}\p{N}]*" if c == "*" else r"[\p{L}\p{N}]" if c == "?" else re.escape(c) for c in w) for w in words)
    return F.regexp_replace(text, rf"(?iu)(?<![\p{{L}}\p{{N}}])({shapes})(?![\p{{L}}\p{{N}}])", "<mark>$1</mark>")


def search(df: DataFrame, pk: str, query: str, fields: list[str] | None = None, kind: Column | None = None, limit: int | None = HITS, index: DataFrame | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """The best ``limit`` rows of ``df`` (all that fit without one), best first, with ``fulltext_score`` and ``highlight``. ``kind`` limits the rows before they are ranked."""
    rows = df.where(kind) if kind is not None else df
    read = fields or searchable(rows)
    hits = ranked(index, query, fields, sizes=sizes) if index is not None else ranked_rows(rows, pk, read, query)
    joined = rows.join(hits, F.col(pk) == F.col("pk")).drop("pk") if pk != "pk" else rows.join(hits, "pk")
    best = joined.withColumnRenamed("score", "fulltext_score").orderBy(F.desc("fulltext_score"), pk)
    best = best if limit is None else best.limit(limit)
    marked = F.filter(F.array(*[highlighted(F.col(f), query) for f in read]), lambda x: F.contains(x, F.lit("<mark>")))
    return best.withColumn("highlight", F.array_join(marked, " … "))


def without(index: DataFrame, keys: DataFrame, table: str = "") -> DataFrame:
    """The postings without those of some rows of a table. ``keys``: pk."""
    gone = keys.select(F.lit(table).alias("tbl"), "pk")
    return index.join(gone, ["tbl", "pk"], "left_anti")


def reindexed(index: DataFrame, rows: DataFrame, pk: str, fields: list[str], table: str = "") -> DataFrame:
    """The postings after rows were added or changed."""
    return without(index, rows.select(F.col(pk).alias("pk")).distinct(), table).unionByName(postings(rows, pk, fields, table))
