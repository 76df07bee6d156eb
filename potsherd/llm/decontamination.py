"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Words become template words: numbers, names and units turn into typed placeholders, all others into small letters. Windows
of template words are joined by hash with those of the benchmark. Where windows with placeholders meet, the values in the
slots are compared: a copy has the same ones, a re-parameterised question has others, but one value in the document for
each value of the item. Windows whose slots contradict each other are no evidence. Windows of an item with too few words
that are no placeholders are joined by their real words instead, so only verbatim copies of them are evidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potsherd.llm.common import Scratch, col, fresh, joinable, small, whole_text

#: Words of a window, and how many of them may not be placeholders at least where slots may differ.
WINDOW, LITERALS = 8, 5
#: A document holds an item if its consistent windows cover so great a share of the item's words, or so many words.
SHARE, COVERED = 0.5, 13
ENOUGH = f"share >= {SHARE} OR covered >= {COVERED}"
#: Windows of the benchmark that are broadcast at most; beyond that both sides are shuffled by hash.
BROADCAST_WINDOWS = 2_000_000

#: Units of measure, as they stand after a number.
UNITS = (
    "mm", "cm", "m", "km", "mg", "g", "kg", "ml", "l", "ms", "s", "h", "min", "inch", "inches", "foot", "feet", "mile", "miles", "metre", "metres", "meter", "meters",
    "gram", "grams", "litre", "litres", "liter", "liters", "pound", "pounds", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks",
    "month", "months", "year", "years", "percent", "degree", "degrees", "dollar", "dollars", "euro", "euros", "cent", "cents",
)
#: First characters of numbers, names and units after marking; and of words that begin a sentence, for a while.
NUMBER, NAME, UNIT, BEGIN = "\u0001", "\u0002", "\u0003", "\u0004"
LETTERS = r"\p{L}\p{M}\p{N}_"


def marked(text: Column) -> Column:
    """The text with a mark before each number, name and unit. A name is a capitalised word that begins no sentence or line."""
    begun = F.regexp_replace(F.translate(text, NUMBER + NAME + UNIT + BEGIN, ""), rf"(\A|[.!?\n])([^{LETTERS}]*)(\p{{Lu}})", f"$1$2{BEGIN}$3")
    named = F.regexp_replace(begun, rf"(\A|[^{LETTERS}{BEGIN}])(\p{{Lu}}[\p{{Ll}}\p{{M}}])", f"$1{NAME}$2")
    joined = named
    for _ in range(2):  # 1,234,567.8 is one number; a match can't begin with the end of the last
        joined = F.regexp_replace(joined, r"(\p{N})[.,](\p{N})", "$1_$2")
    counted = F.regexp_replace(joined, rf"(\A|[^{LETTERS}{NAME}{BEGIN}])(\p{{N}})", f"$1{NUMBER}$2")
    measured = F.regexp_replace(counted, rf"({NUMBER}[\p{{N}}_]+)( ?)({'|'.join(UNITS)})([^{LETTERS}]|\z)", f"$1 {UNIT}$3$4")
    return F.when(text.rlike(r"\p{N}"), measured).otherwise(named)


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, rf"[^{LETTERS}{NUMBER}{NAME}{UNIT}]+"), lambda w: w != "")


def template(mark: Column) -> Column:
    """Template words of a marked text: a placeholder is its mark alone."""
    return split_words(F.lower(F.regexp_replace(mark, rf"([{NUMBER}{NAME}{UNIT}])[{LETTERS}]+", "$1")))


def values(mark: Column) -> Column:
    """The words of a marked text as they stand, one for each template word; only their marks are as in the template."""
    return split_words(mark)


def spoken(mark: Column) -> Column:
    """The real words of a marked text in small letters, one for each template word."""
    return split_words(F.lower(F.translate(mark, NUMBER + NAME + UNIT + BEGIN, "")))


def hashed(words: Column, salt: int | None = None) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w) if salt is None else F.xxhash64(w, F.lit(salt)))


def windows(words: Column, size: int) -> Column:
    """Hashes of all windows, in order; empty if there are fewer words."""
    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda k: F.xxhash64(*[F.get(words, k + i) for i in range(size)]))).otherwise(none)


def windowed(rows: DataFrame, keys: list[str], wanted: list[tuple[str, int]]) -> DataFrame:
    """keys, size, at, window: one row for each window of the ``wanted`` sizes over the named columns of hashes, one for each word."""
    if len(wanted) == 1:
        [(name, size)] = wanted
        return rows.select(*keys, F.lit(size).alias("size"), F.posexplode(windows(F.col(name), size)).alias("at", "window"))

    def placed(name: str, size: int) -> Column:
        return F.transform(windows(F.col(name), size), lambda w, at: F.struct(F.lit(size).alias("size"), at.alias("at"), w.alias("window")))

    # one generator for all, so that texts are read once
    return rows.select(*keys, F.explode(F.concat(*[placed(*x) for x in wanted])).alias("w")).select(*keys, "w.size", "w.at", "w.window")


def benchmark_windows(benchmark: DataFrame, text: str, item_id: str, scratch: Scratch) -> tuple[DataFrame, DataFrame, list[tuple[str, int]]]:
    """Items (item_id, n_words, words), their windows (item_id, at, size, window, slots) and the kinds (hashes or plain) and sizes of these; an item shorter than a window is one itself.

    A window with too few literals is one of real words, which has no slots.
    """
    mark = marked(whole_text(text))
    items = scratch.keep(benchmark.select(col(item_id).cast("long").alias("item_id"), template(mark).alias("words"), values(mark).alias("said"), spoken(mark).alias("spoken")).where(F.size("words") > 0).distinct())
    sized = items.withColumn("n_words", F.size("words")).withColumn("size", F.least(F.lit(WINDOW), F.size("words")))
    sizes = [r.size for r in sized.select("size").distinct().collect()]  # at most WINDOW of them
    slots = F.size(F.filter(F.slice("words", F.col("at") + 1, F.col("size")), lambda w: w.isin(NUMBER, NAME, UNIT)))
    enough = F.col("size") - F.col("slots") >= F.least(F.lit(LITERALS), F.col("size"))
    found = None
    for size in sizes:
        own = sized.where(F.col("size") == size).withColumn("hashes", hashed(F.col("words"))).withColumn("plain", hashed(F.col("spoken"), 1))
        for kind, fits in (("hashes", enough), ("plain", ~enough)):
            part = windowed(own, ["item_id", "words"], [(kind, size)]).withColumn("slots", slots).where(fits).drop("words").withColumn("kind", F.lit(kind))
            found = part if found is None else found.unionByName(part)
    if found is None:
        return sized, benchmark.sparkSession.createDataFrame([], "item_id long, size int, at int, window long, slots int"), []
    known = scratch.keep(found.withColumn("slots", F.when(F.col("kind") == "plain", 0).otherwise(F.col("slots"))))
    return sized, known, sorted(tuple(r) for r in known.select("kind", "size").distinct().collect())


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """One row for each document that holds a benchmark item: doc_id, text_key, item_id, covered, item_words, share, verbatim.

    ``covered`` counts the item's words in consistent windows, text_key is the text's 64-bit hash. ``verbatim`` tells
    whether all these words stand in alignments of document and item no slot of which differs, be it in a window that is
    evidence or in one that contradicts another. Texts are read whole, however long, in time that grows with their length.
    Null or empty texts hold nothing and null or empty items are held by nothing. Items of placeholders only, and windows
    with more than WINDOW - LITERALS placeholders, are held where their words stand as they are. Repeated rows count once,
    as do repeated items; several items in a document give several rows, also where they tie, and a null doc_id or item_id
    stays null. Extra columns play no part, whatever their names. Empty tables give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    items, known, wanted = benchmark_windows(benchmark, item_text, item_id, scratch)
    schema = "doc_id long, text_key long, item_id long, covered long, item_words long, share double, verbatim boolean"
    if not wanted:
        return spark.createDataFrame([], schema)
    read = docs.select(col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")).withColumn("text_key", F.xxhash64("text"))
    mark = marked(F.col("text"))
    kinds = {"hashes": hashed(template(mark)), "plain": hashed(spoken(mark), 1)}
    words = read.select("doc_id", "text_key", *[kinds[k].alias(k) for k in sorted({k for k, _ in wanted})])
    seen = windowed(words, ["doc_id", "text_key"], wanted)
    on = (F.col("window") == F.col("item_window")) & (F.col("size") == F.col("item_size"))
    asked = known.select(F.col("size").alias("item_size"), F.col("window").alias("item_window")).distinct()
    asked = F.broadcast(asked) if small(known, BROADCAST_WINDOWS) else asked
    met = scratch.keep(seen.join(asked, on).select("doc_id", "text_key", F.col("at").cast("long").alias("at"), "size", "window").distinct())
    lengths = scratch.keep(items.groupBy(F.col("item_id").alias("own_id")).agg(F.max("n_words").cast("long").alias("item_words")))
    lookup = known.select("item_id", F.col("at").cast("long").alias("item_at"), F.col("size").alias("item_size"), F.col("window").alias("item_window"), "slots")
    likely = possible(met, lookup, lengths, scratch)
    pairs = joinable(likely.select(F.col("doc_id").alias("p_id"), F.col("text_key").alias("p_key"), F.col("item_id").alias("p_item")))
    chosen = met.join(pairs, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("text_key") == F.col("p_key")))
    placed = chosen.join(lookup, on & F.col("item_id").eqNullSafe(F.col("p_item")))
    placed = scratch.keep(placed.select("doc_id", "text_key", "item_id", "at", "item_at", "size", "slots").distinct())

    shift = (F.col("at") - F.col("item_at")).alias("shift")
    plain = placed.where("slots = 0").select("doc_id", "text_key", "item_id", "item_at", "size", shift, F.lit(True).alias("fits"), F.lit(True).alias("same"))
    slotted = placed.where("slots > 0")
    told = plain if slotted.isEmpty() else plain.unionByName(slots_compared(slotted, read, items))
    places = F.sequence(F.col("item_at"), F.col("item_at") + F.col("size") - 1)
    aligned = told.groupBy("doc_id", "text_key", "item_id", "shift").agg(F.min("same").alias("clean"), F.collect_set(F.when(F.col("fits"), places)).alias("places"))
    aligned = aligned.withColumn("places", F.array_sort(F.array_distinct(F.flatten("places"))))
    n_places = lambda which: F.size(F.array_distinct(F.flatten(F.collect_set(which)))).cast("long")
    held = aligned.groupBy("doc_id", "text_key", "item_id").agg(n_places(F.col("places")).alias("covered"), n_places(F.when(F.col("clean"), F.col("places"))).alias("kept"))
    shared = held.join(joinable(lengths), F.col("item_id").eqNullSafe(F.col("own_id"))).withColumn("share", F.col("covered") / F.col("item_words"))
    return shared.where(ENOUGH).select("doc_id", "text_key", "item_id", "covered", "item_words", "share", (F.col("kept") == F.col("covered")).alias("verbatim"))


def possible(met: DataFrame, lookup: DataFrame, lengths: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text_key, item_id): the items that a document would hold if the slots of all its windows fitted.

    Documents that meet the same windows are asked once. So a window that many items share meets these once for each
    different set of windows, and not for each document.
    """
    sets = met.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("size", "window"))).alias("windows"))
    told = F.array_join(F.transform("windows", lambda w: F.concat_ws(":", w["size"], w["window"])), ",")
    sets = scratch.keep(sets.withColumn("own", F.sha2(told, 256)))
    each = sets.groupBy("own").agg(F.first("windows").alias("windows")).select("own", F.explode("windows").alias("w")).select("own", "w.size", "w.window")
    each = each.join(lookup, (F.col("window") == F.col("item_window")) & (F.col("size") == F.col("item_size")))
    places = F.sequence(F.col("item_at"), F.col("item_at") + F.col("size") - 1)
    most = each.groupBy("own", "item_id").agg(F.size(F.array_distinct(F.flatten(F.collect_set(places)))).alias("covered"))
    most = most.join(joinable(lengths), F.col("item_id").eqNullSafe(F.col("own_id"))).withColumn("share", F.col("covered") / F.col("item_words"))
    fits = scratch.keep(most.where(ENOUGH).select(F.col("own").alias("of"), "item_id"))
    return scratch.keep(sets.select("doc_id", "text_key", "own").join(joinable(fits), F.col("own") == F.col("of")).select("doc_id", "text_key", "item_id"))


def slots_compared(slotted: DataFrame, read: DataFrame, items: DataFrame) -> DataFrame:
    """The windows with slots: ``fits`` if they hold one document value for each item value along one alignment of document and item, ``same`` if these are equal."""
    keys = slotted.select(F.col("doc_id").alias("k_id"), F.col("text_key").alias("k_text")).distinct()
    said = read.join(keys, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("text_key") == F.col("k_text")), "left_semi").dropDuplicates(["doc_id", "text_key"])
    said = said.select(F.col("doc_id").alias("k_id"), F.col("text_key").alias("k_text"), values(marked(F.col("text"))).alias("doc_words"))
    asked = items.select(F.col("item_id").alias("k_item"), F.col("said").alias("item_said"))
    same_doc = F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("text_key") == F.col("k_text"))
    both = slotted.join(asked, F.col("item_id").eqNullSafe(F.col("k_item"))).join(said, same_doc)
    cut = lambda words, at: F.slice(words, (F.col(at) + 1).cast("int"), F.col("size"))
    pairs = F.filter(F.arrays_zip(cut("item_said", "item_at").alias("asked"), cut("doc_words", "at").alias("told")), lambda p: F.substr(p.asked, F.lit(1), F.lit(1)).isin(NUMBER, NAME, UNIT))
    named = both.select("doc_id", "text_key", "item_id", "at", "item_at", "size", "slots", (F.col("at") - F.col("item_at")).alias("shift"), pairs.alias("pairs"))
    each = named.select("doc_id", "text_key", "item_id", "shift", F.explode("pairs").alias("p"))
    bound = each.groupBy("doc_id", "text_key", "item_id", "shift", F.col("p.asked").alias("asked")).agg(F.min("p.told").alias("low"), F.max("p.told").alias("high"))
    clash = bound.where(F.col("low") != F.col("high")).groupBy("doc_id", "text_key", "item_id", "shift").agg(F.collect_set("asked").alias("clashes"))
    c = clash.select(*[F.col(n).alias(f"c_{n}") for n in clash.columns])
    on = F.col("doc_id").eqNullSafe(F.col("c_doc_id")) & (F.col("text_key") == F.col("c_text_key")) & F.col("item_id").eqNullSafe(F.col("c_item_id")) & (F.col("shift") == F.col("c_shift"))
    fits = F.col("c_clashes").isNull() | ~F.exists("pairs", lambda p: F.array_contains(F.col("c_clashes"), p.asked))
    same = ~F.exists("pairs", lambda p: p.asked != p.told)
    return named.join(c, on, "left").select("doc_id", "text_key", "item_id", "item_at", "size", "shift", fits.alias("fits"), same.alias("same"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", **more: str) -> DataFrame:
    """The rows of ``docs`` that hold no item, with the columns of ``docs``; repeated rows stay or go together."""
    key, found_id, found_key = fresh(docs, "text_key", "found_id", "found_key")
    scratch = Scratch(docs.sparkSession)
    found = find(docs, benchmark, text, doc_id, **more).select(F.col("doc_id").alias(found_id), F.col("text_key").alias(found_key)).distinct()
    held = joinable(scratch.keep(found))
    named = docs.withColumn(key, F.xxhash64(whole_text(text)))
    return named.join(held, (F.col(key) == F.col(found_key)) & col(doc_id).cast("long").eqNullSafe(F.col(found_id)), "left_anti").select(*[col(c) for c in docs.columns])
