"""License scan by ordered signature rules, with DataFrame functions only.

The rules (``license_rules``) are regular expressions over a text's words (lower-cased, one space between). Each has a keyword: a text meets
only rules whose keyword is among its words, and a text without any keyword none. Where rules overlap, one with a higher
priority suppresses those whose span of words it contains, and of equal priority the longer span does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potsherd.llm.common import col, whole_text
from potsherd.llm.license_rules import SIGNATURES

#: Between words, which are digits, small ASCII letters and all characters beyond ASCII.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Base phrases and their labels: all places count, nothing suppresses them.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Words of a segment, and the words before and after it that its rules also see; no rule matches more words than these.
SEGMENT, CONTEXT = 480, 40
MARK = "\u0001"


def rules() -> list[tuple[int, str, str, int, str]]:
    """All rules in order: (rule, label, keyword, priority, pattern); patterns begin and end at words."""
    listed = [(label, keyword, priority, pattern) for label, own in SIGNATURES.items() for priority, keyword, pattern in own]
    return [(k, label, keyword, priority, whole_words(pattern)) for k, (label, keyword, priority, pattern) in enumerate(listed)]


def whole_words(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def words(text: Column) -> Column:
    """The words in one string, with a space before and after each. (Of characters beyond ASCII the Kelvin sign has an ASCII small letter, a k, and the capital I with a dot an i before a combining dot.)"""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), BREAK, " ")), F.lit(" "))


def count_words(spaced: Column) -> Column:
    spaces = F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" "), F.lit("")))
    return F.when(spaced == "  ", 0).otherwise(spaces - 1).cast("long")


def segments(spaced: Column) -> Column:
    """Array of (at, own, text): the words from number ``own`` on are the segment's, its text begins at word ``at``."""
    every = F.split(F.trim(spaced), " ")

    def segment(own: Column) -> Column:
        at = F.greatest(own - CONTEXT, F.lit(0))
        return F.struct(at.alias("at"), own.alias("own"), F.concat(F.lit(" "), F.array_join(F.slice(every, at + 1, own - at + SEGMENT + CONTEXT), " "), F.lit(" ")).alias("text"))

    return F.transform(F.sequence(F.lit(0), F.size(every) - 1, F.lit(SEGMENT)), segment)


def matches(text: Column, pattern: Column) -> Column:
    """Array of (first, last) word numbers of a pattern's matches: a mark before each match shows its first word."""
    marked = F.split(F.trim(F.regexp_replace(text, pattern, F.lit(MARK + "$0"))), " ")
    firsts = F.filter(F.transform(marked, lambda w, k: F.when(F.startswith(w, F.lit(MARK)), k)), lambda k: k.isNotNull())
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.size(F.split(m, " ")))
    return F.zip_with(firsts, sizes, lambda f, n: F.struct(f.alias("first"), (f + n - 1).alias("last")))


def detections(segment: Column, table: Column, keywords: Column) -> Column:
    """Array of (rule, label, priority, first, last) in one segment, word numbers of the whole text."""
    met = F.filter(table, lambda r: F.array_contains(keywords, r.keyword) & F.rlike(segment.text, r.pattern))
    found = F.transform(
        met,
        lambda r: F.transform(
            matches(segment.text, r.pattern),
            lambda m: F.struct(r.rule.alias("rule"), r.label.alias("label"), r.priority.alias("priority"), (m.first + segment.at).alias("first"), (m.last + segment.at).alias("last")),
        ),
    )
    return F.flatten(found)


def suppressed(found: Column) -> Column:
    """What is left of a segment's detections. Each is dropped if a better one's interval contains its own."""

    def better(o: Column, m: Column) -> Column:
        longer = (o.last - o.first > m.last - m.first) | ((o.last - o.first == m.last - m.first) & (o.rule < m.rule))
        return (o.first <= m.first) & (o.last >= m.last) & ((o.priority > m.priority) | ((o.priority == m.priority) & longer))

    return F.filter(found, lambda m: ~F.exists(found, lambda o: better(o, m)))


def table_of(rows: list[tuple[int, str, str, int, str]]) -> Column:
    names = ("rule", "label", "keyword", "priority", "pattern")
    return F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows])


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, base, found (arrays of rule, label, priority, first, last).

    ``found`` holds the rules' detections that no other suppresses, ``base`` all places of the base phrases. A null text
    is empty and has none; ties of priority and span go to the earlier rule. Repeated rows are scanned each, a null
    doc_id stays null, extra columns play no part, no rows give no rows. Nothing is shuffled. Long texts are scanned in
    segments that overlap by more than a rule's reach, so the work grows with their length only.
    """
    listed = rules()
    keywords = sorted({keyword for _, _, keyword, _, _ in listed})
    base = [(k, label, "license", 60, whole_words(phrase)) for k, (phrase, label) in enumerate(BASE)]
    none = F.array().cast("array<struct<rule:int,label:string,priority:int,first:int,last:int>>")
    own = lambda s, found: F.filter(found, lambda m: (m.first >= s.own) & (m.first < s.own + SEGMENT))
    every = lambda one: F.when(F.size("keywords") > 0, F.flatten(F.transform("segments", one))).otherwise(none)

    read = docs.select(col(doc_id).cast("long").alias("doc_id"), words(whole_text(text)).alias("spaced"))
    gate = F.col("spaced").rlike(" (?:" + "|".join(keywords) + ") ")
    gated = read.select("doc_id", "spaced", F.when(gate, F.array_intersect(F.split("spaced", " "), F.array(*map(F.lit, keywords)))).otherwise(F.array().cast("array<string>")).alias("keywords"))
    cut = gated.select("doc_id", count_words(F.col("spaced")).alias("n_words"), "keywords", F.when(F.size("keywords") > 0, segments(F.col("spaced"))).alias("segments"))
    return cut.select(
        "doc_id",
        "n_words",
        every(lambda s: own(s, detections(s, table_of(base), F.col("keywords")))).alias("base"),
        every(lambda s: own(s, suppressed(detections(s, table_of(listed), F.col("keywords"))))).alias("found"),
    )


def summary(scanned: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (the best priority, as a share of 100)."""
    labels = lambda *arrays: F.array_join(F.array_sort(F.array_distinct(F.concat(*[F.transform(a, lambda m: m.label) for a in arrays]))), ",")
    firsts = F.transform("base", lambda m: m.first)
    best = F.array_max(F.transform(F.concat("base", "found"), lambda m: m.priority))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(firsts).cast("long").alias("first_word"),
        F.array_max(firsts).cast("long").alias("last_word"),
        labels("base").alias("base_labels"),
        labels("base", "found").alias("labels"),
        (F.coalesce(best, F.lit(0)) / 100.0).cast("double").alias("score"),
    )
