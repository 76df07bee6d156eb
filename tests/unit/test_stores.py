"""Stores that follow changes: buckets, counts, index segments, key registry, published tables."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from potsherd.operators import keys, search, segments
from potsherd.sources import buckets, versions


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# buckets and counts


def plain_apply(table, batch):
    """(key, kind, value, order, gone) rows onto {key: [kind, value, order]}."""
    for k, kind, value, at, gone in sorted(batch, key=lambda r: r[3]):
        if gone:
            table.pop(k, None)
        else:
            old = table.get(k, [None, None, None])
            table[k] = [new if new is not None else was for new, was in zip((kind, value, at), old, strict=True)]


def test_buckets_follow_changes(spark, tmp_path):
    rng, table, root, at = random.Random(3), {}, f"{tmp_path}/t", 0
    for n in range(5):
        batch = []
        for _ in range(30 if n else 60):
            at += 1
            batch.append((rng.choice([None, *range(25)]), rng.choice(["a", "b", None]), rng.choice([1.5, 2.5, None]), at, rng.random() < 0.2))
        df = spark.createDataFrame(batch, "k int, kind string, value double, at long, gone boolean")
        assert buckets.apply(df, root, ["k"], "at", n, "gone", ["kind"], buckets=8)
        assert not buckets.apply(df, root, ["k"], "at", n, "gone", ["kind"])  # a batch that comes again changes nothing
        plain_apply(table, batch)
        assert found(buckets.read(spark, root)) == sorted(((k, *v) for k, v in table.items()), key=str)
        assert found(buckets.counts(spark, root)) == sorted(Counter(v[0] for v in table.values()).items(), key=str)
    assert len(found(buckets.read(spark, root, version=3))) > 0
    buckets.clean(spark, root, keep=1)
    assert found(buckets.read(spark, root)) == sorted(((k, *v) for k, v in table.items()), key=str)


def test_a_small_change_rewrites_few_buckets(spark, tmp_path):
    root = f"{tmp_path}/t"
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit(0).alias("at"))
    buckets.apply(rows, root, ["k"], "at", 0)
    buckets.apply(rows.where("k = 77").withColumn("at", F.lit(1)), root, ["k"], "at", 1)
    assert versions.size(spark, f"{root}/data/1") < versions.size(spark, f"{root}/data/0") / 20
    assert buckets.read(spark, root).count() == 20_000


def test_a_first_batch_keeps_the_last_row_of_a_key(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "c", 3)], "k int, v string, at int")
    buckets.apply(df, f"{tmp_path}/t", ["k"], "at", 0)
    assert found(buckets.read(spark, f"{tmp_path}/t")) == [(1, "a", 2), (2, "c", 3)]
    assert buckets.read(spark, f"{tmp_path}/none") is None and buckets.counts(spark, f"{tmp_path}/t") is None


# published tables


def test_publishing_replaces_all_tables_at_once(spark, tmp_path):
    root = f"{tmp_path}/p"
    versions.publish({"a": spark.range(3), "b": spark.range(4)}, root)
    broken = spark.range(5).select(F.raise_error(F.lit("killed halfway")).cast("long").alias("id"))
    with pytest.raises(Exception, match="killed halfway"):
        versions.publish({"a": spark.range(9), "b": broken}, root)
    assert [versions.published(spark, root, x).count() for x in "ab"] == [3, 4]
    versions.publish({"a": versions.published(spark, root, "a").where("id > 0")}, root)  # reads what it replaces
    assert [versions.published(spark, root, x).count() for x in "ab"] == [2, 4]
    assert versions.published(spark, root, "a", version=0).count() == 3
    with pytest.raises(ValueError):
        versions.published(spark, root, "c")
    with pytest.raises(ValueError):
        versions.commit(spark, root, 0, {})


# key registry


def test_known_keys_keep_their_numbers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keys, "RANGE", 7)
    kind = "soort string, key string, _id string"
    first = [("Put", f"P{k}", f"i{k}") for k in range(30)] + [("Vondst", f"P{k}", f"v{k}") for k in range(5)] + [("Put", None, "x"), ("Put", None, "y"), ("Put", "P3", "again")]
    more = [("Put", f"A{k}", f"a{k}") for k in range(10)] + [(None, "q", "q"), ("Spoor", "S", "s"), ("Put", None, None)]
    numbers = {}
    for run, rows in enumerate([first, more + first[::-1], more[:3]]):
        out = keys.with_registered(spark.createDataFrame(rows, kind), f"{tmp_path}/r", run)
        got = found(out)
        assert got == found(keys.with_registered(spark.createDataFrame(rows, kind), f"{tmp_path}/r", run))  # the run comes again
        assert len(got) == len(rows)
        for soort, key, i, number in got:
            name = (soort, key or i)
            if name[1] is None:
                assert number is None
            else:
                assert numbers.setdefault(name, number) == number
    by_soort = defaultdict(set)
    for (soort, _), number in numbers.items():
        by_soort[soort].add(number)
    assert {s: sorted(n) for s, n in by_soort.items()} == {"Put": list(range(42)), "Vondst": list(range(5)), "Spoor": [0], None: [0]}


# phrases and segments


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def plain_score(rows, phrase, word, k1=1.2, b=0.75):
    """BM25 of a phrase or a word over {pk: text}."""
    docs = {k: words_of(t) for k, t in rows.items() if words_of(t)}
    n, mean = len(docs), sum(map(len, docs.values())) / len(docs)
    rare = lambda df: math.log(1 + (n - df + 0.5) / (df + 0.5))
    out = {}
    for k, d in docs.items():
        together = sum(d[i : i + len(phrase)] == phrase for i in range(len(d)))
        parts = [(together, sum(rare(sum(w in x for x in docs.values())) for w in phrase)), (d.count(word), rare(sum(word in x for x in docs.values())))]
        if any(tf for tf, _ in parts):
            out[k] = sum(r * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(d) / mean)) for tf, r in parts if tf)
    return out


def test_phrases_score_where_they_stand(spark):
    rng = random.Random(1)
    rows = {k: " ".join(rng.choice(["red", "apple", "pear", "plum"]) for _ in range(rng.randint(0, 12))) for k in range(40)} | {100: "apple red pear", 101: "red apple", 102: None}
    df = spark.createDataFrame(list(rows.items()), "k long, text string")
    query, want = '"red apple" pear', plain_score(rows, ["red", "apple"], "pear")
    for out in (search.ranked_rows(df, "k", ["text"], query), search.ranked(search.postings(df, "k", ["text"]), query), search.ranked(search.postings(df, "k", ["text"]), query, sizes=search.lengths(df, "k", ["text"]))):
        got = {r.pk: r.score for r in out.collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    both = lambda q: [sorted(r.pk for r in out.collect()) for out in (search.ranked_rows(df, "k", ["text"], q), search.ranked(search.postings(df, "k", ["text"]), q))]
    for q, fits in (('-"red apple" +pear', lambda d: "pear" in d and "red apple" not in " ".join(d)), ('"r* apple"', lambda d: "red apple" in " ".join(d)), ('text:"red apple" AND plum', lambda d: "red apple" in " ".join(d) and "plum" in d), ('name:"red apple"', lambda d: False)):
        assert both(q) == [[k for k, t in sorted(rows.items()) if fits(words_of(t))]] * 2


def test_segments_equal_a_rebuild(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(segments, "FAN", 3)
    rng, rows, root = random.Random(8), {}, f"{tmp_path}/x"
    for n in range(7):
        batch = {k: None if rng.random() < 0.2 else " ".join(rng.choice(["red", "apple", "pear", "plum", "fig"]) for _ in range(rng.randint(0, 6))) for k in rng.sample(range(30), 8)}
        df = spark.createDataFrame([(k, t, t is None) for k, t in batch.items()], "k long, text string, gone boolean")
        assert segments.apply(df, root, "k", ["text"], n, "t", "gone") and not segments.apply(df, root, "k", ["text"], n, "t", "gone")
        rows = {k: t for k, t in (rows | batch).items() if t is not None}
        if n in (2, 5, 6):
            now = spark.createDataFrame(list(rows.items()), "k long, text string")
            assert found(segments.postings(spark, root)) == found(search.postings(now, "k", ["text"], "t"))
            assert found(segments.lengths(spark, root)) == found(search.lengths(now, "k", ["text"], "t"))
            for query in ('"red apple" pear', "fi* -plum"):
                score = lambda df: [(k, round(s, 9)) for k, s in found(df)]
                assert score(segments.ranked(spark, root, query)) == score(search.ranked_rows(now, "k", ["text"], query))
    levels = [s["level"] for s in versions.content(spark, root)["segments"]]
    assert levels == sorted(levels, reverse=True) and len(levels) <= 4
    segments.clean(spark, root, keep=1)
    assert len(versions.folders(spark, f"{root}/segments")) == len(levels)


def test_words_of_a_row_travel_together(spark, tmp_path, monkeypatch):
    """One shuffle of packed rows, none to make postings; a bucket of many words is dealt to several tasks, whether a batch or a merge writes it."""
    rng = random.Random(3)
    some = ["de", "Pot", "pot", "ÉÉN", "één", "x", "12", "🏺", "漢字", "-", "ij\u0133", *[f"w{k}" for k in range(40)]]
    rows = {k: " ".join(rng.choice(some) for _ in range(rng.randint(0, 15))) for k in range(300)} | {300: None, 301: "", 302: " -- ", 303: "pot " * 500}
    df = spark.createDataFrame(list(rows.items()), "k long, text string")
    assert "Exchange" not in search.postings(df, "k", ["text"])._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(segments, "WORDS", 20)
    monkeypatch.setattr(segments, "FAN", 2)
    want = []
    for k, text in rows.items():
        words = words_of(text)
        want += [("", k, "text", w, words.count(w), len(words), [i for i, x in enumerate(words) if x == w]) for w in set(words)]
    assert sorted(map(tuple, search.postings(df, "k", ["text"]).collect())) == sorted(want)
    for version, batch in enumerate((df, df.where("k % 2 = 0"))):
        segments.apply(batch, f"{tmp_path}/x", "k", ["text"], version)
        assert sorted(map(tuple, segments.postings(spark, f"{tmp_path}/x").collect())) == sorted(want)
        last = versions.content(spark, f"{tmp_path}/x")["segments"][-1]["name"]
        files = [list(b.glob("*.parquet")) for b in (tmp_path / f"x/segments/{last}/postings").glob("bucket=*")]
        assert max(map(len, files)) > 2


def test_a_small_batch_writes_little(spark, tmp_path):
    root = f"{tmp_path}/x"
    rows = spark.range(4000).select("id", F.concat_ws(" ", *[F.sha2((F.col("id") * k).cast("string"), 256) for k in range(5)]).alias("text"))
    segments.apply(rows, root, "id", ["text"], 0)
    segments.apply(rows.where("id < 10"), root, "id", ["text"], 1)
    assert versions.size(spark, f"{root}/segments/1-0") < versions.size(spark, f"{root}/segments/0-0") / 10
    plan = segments.postings(spark, root, "red apple")._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "PushedFilters: [In(term" in plan
