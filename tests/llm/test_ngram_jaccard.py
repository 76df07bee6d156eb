"""The n-gram Jaccard join against brute force, and its edge cases."""

from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import regex

from potsherd.llm import ngram_jaccard
from potsherd.llm.common import table

SCHEMA = "doc_id long, text string"


def grams(text: str | None, n: int = 5) -> frozenset:
    words = regex.findall(r"[\p{L}\p{M}\p{N}_]+", (text or "").lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1)))


def brute_force(rows: list[tuple[int | None, str | None]], similarity: float = 0.8) -> dict:
    """doc_id -> (class_id, links, copies); ids are unique here."""
    sets = {i: grams(t) for i, t in rows}
    by_set = defaultdict(list)
    for i, s in sets.items():
        if s:
            by_set[s].append(i)
    distinct = list(by_set)
    where = defaultdict(set)
    for k, s in enumerate(distinct):
        for g in s:
            where[g].add(k)
    pairs = {p for ks in where.values() for p in combinations(sorted(ks), 2)}
    root = list(range(len(distinct)))

    def find(k: int) -> int:
        while root[k] != k:
            k = root[k]
        return k

    links = [0] * len(distinct)
    for a, b in pairs:
        shared = len(distinct[a] & distinct[b])
        if shared * 9 >= 4 * (len(distinct[a]) + len(distinct[b])) if similarity == 0.8 else shared >= similarity * len(distinct[a] | distinct[b]):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    heads: dict[int, int] = {}
    for k, s in enumerate(distinct):
        heads[find(k)] = min(heads.get(find(k), 10**18), *by_set[s], 10**18)
    out = {i: (i, 0, 1) for i, s in sets.items() if not s}
    for k, s in enumerate(distinct):
        for i in by_set[s]:
            out[i] = (heads[find(k)], links[k], len(by_set[s]))
    return out


def found(df) -> dict:
    return {r.doc_id: (r.class_id, r.links, r.copies) for r in df.collect()}


def prose(rng: random.Random, n: int, words: int = 3000) -> list[str]:
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def near_copies(rng: random.Random, base: list[str], copies: int, edits: int) -> list[str]:
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_driver_table_equals_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(ngram_jaccard.annotate(docs)) == brute_force(rows)


@pytest.mark.parametrize("leaf,depth", [(4096, 4), (8, 3), (4, 0)])
def test_split_and_tiled_buckets_lose_no_link(spark, monkeypatch, leaf, depth):
    """A passage that all texts share, groups of near copies of several sizes, and buckets so small that all are split."""
    rng = random.Random(5)
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 16)
    passage = prose(rng, 60)
    texts = [" ".join(passage + prose(rng, 60)) for _ in range(60)]
    texts += near_copies(rng, prose(rng, 150), 70, 2)
    texts += near_copies(rng, passage + prose(rng, 40), 20, 1)
    for _ in range(20):
        texts += near_copies(rng, prose(rng, rng.randrange(8, 200)), 2, 1)
    texts += texts[:30]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(ngram_jaccard.annotate(docs, leaf=leaf, depth=depth)) == brute_force(rows)


def test_crowded_buckets_and_classes_grow_with_their_rows(spark, monkeypatch):
    """Sets that are all alike meet one of them, and neither each other nor the texts of each other."""
    rng = random.Random(6)
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 50)
    base = prose(rng, 400)
    rows = list(enumerate(near_copies(rng, base, 2000, 1)))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    made = []
    verified = ngram_jaccard.verified
    monkeypatch.setattr(ngram_jaccard, "verified", lambda r, *a: made.append(r.count()) or verified(r, *a))
    got = ngram_jaccard.annotate(docs, leaf=100, depth=1).collect()
    assert {(r.class_id, r.links) for r in got} == {(0, 1999)} and len(got) == 2000
    assert made[0] < 2000


@pytest.mark.parametrize("heads", [1, 3])
def test_sets_around_a_head_lose_no_link(spark, monkeypatch, heads):
    """Chains in which each set is linked with the next ones only, so that linked, nearly linked and far sets stand in one bucket."""
    rng = random.Random(7)
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 8)
    monkeypatch.setattr(ngram_jaccard, "HEADS", heads)
    texts = []
    for _ in range(3):
        words = prose(rng, 120)
        for _ in range(30):
            texts.append(" ".join(words))
            words = words[2:] + prose(rng, 2)
    texts += near_copies(rng, prose(rng, 100), 30, 2)
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert found(ngram_jaccard.annotate(spark.createDataFrame(rows, SCHEMA).repartition(3), leaf=4, depth=1)) == brute_force(rows)


def cloud(rng: random.Random, copies: int, edits: int, words: int = 200) -> list[str]:
    """A text and copies of it with none to ``edits`` words changed, so that many are linked with the first and few with each other."""
    base = prose(rng, words)
    return [t for k in range(copies) for t in near_copies(rng, base, 1, k % (edits + 1))]


def test_forest_compares_only_sets_that_are_not_linked_with_the_most_usual_one(monkeypatch):
    """Sets that differ too much to be linked with anything don't make all the others look for links."""
    rng = random.Random(8)
    texts = cloud(rng, 120, 12) + cloud(rng, 9, 4) + [" ".join(prose(rng, 150)) for _ in range(5)]
    rng.shuffle(texts)
    tokens, bounds = ngram_jaccard.token_sets(texts, 5)
    compared = ngram_jaccard.Compared(tokens, bounds[:-1], 0.8)
    sets = [frozenset(tokens[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    whole = [[9 * len(a & b) >= 4 * (len(a) + len(b)) for b in sets] for a in sets]
    assert [compared.linked(k).tolist() for k in range(len(sets))] == whole
    linked, asked = ngram_jaccard.Compared.linked, []
    monkeypatch.setattr(ngram_jaccard.Compared, "linked", lambda self, k: asked.append(k) or linked(self, k))
    links = compared.forest()
    assert all(whole[a][b] for a, b in links)
    assert len(asked) <= 1 + len(sets) - max(map(sum, whole))

    def classes(pairs) -> list[int]:
        label = list(range(len(sets)))
        for a, b in pairs:
            label = [label[a] if x == label[b] else x for x in label]
        return [label.index(x) for x in label]

    assert classes(links) == classes((a, b) for a in range(len(sets)) for b in range(a) if whole[a][b])


@pytest.mark.parametrize("block", [2048, 24])
def test_near_copies_are_compared_once_not_in_each_bucket(spark, monkeypatch, block):
    """A class's sets meet in some twenty buckets, whose members differ a little; groups that grow too large go by their heads."""
    rng = random.Random(9)
    monkeypatch.setattr(ngram_jaccard, "BLOCK", block)
    texts = cloud(rng, 150, 9) + cloud(rng, 40, 9)
    rows = list(enumerate(texts))
    made = []
    verified = ngram_jaccard.verified
    monkeypatch.setattr(ngram_jaccard, "verified", lambda r, *a: made.append(r.count()) or verified(r, *a))
    assert found(ngram_jaccard.annotate(spark.createDataFrame(rows, SCHEMA).repartition(3))) == brute_force(rows)
    assert made[0] < (3 if block == 2048 else 8) * len(rows)


def test_tiles_bring_each_pair_together(monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 3)
    monkeypatch.setattr(ngram_jaccard, "BLOCK_TOKENS", 40)
    sizes = np.array([5, 5, 90, 1, 1, 1, 1, 1, 20, 30])
    met = {p for part in ngram_jaccard.tiles(sizes) for p in combinations(sorted(part.tolist()), 2)}
    assert met == set(combinations(range(10), 2))


def test_edge_cases(spark):
    long = " ".join(f"word{k}" for k in range(30_000))
    rows = [
        (9, "A b, c"), (4, "a B c!"), (5, "a b"), (None, "a b c"), (6, None), (7, ""), (8, "?!"), (3, "?!"),
        (20, long), (21, long + " more"), (22, long), (22, long), (None, "only here by a null id and so it stays"),
    ]
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, class_id int, node string, text_key int")
    got = sorted(((r.doc_id, r.class_id, r.links, r.copies, r.first) for r in ngram_jaccard.annotate(docs).collect()), key=str)
    assert got == sorted(
        [
            (9, 4, 0, 3, False), (4, 4, 0, 3, True), (5, 5, 0, 1, True), (None, 4, 0, 3, False), (6, 6, 0, 1, True), (7, 7, 0, 1, True), (8, 8, 0, 1, True), (3, 3, 0, 1, True),
            (20, 20, 1, 3, True), (21, 20, 1, 1, False), (22, 20, 1, 3, False), (22, 20, 1, 3, False), (None, None, 0, 1, True),
        ],
        key=str,
    )
    stay = ngram_jaccard.one_of_each(docs)
    assert stay.columns == docs.columns
    assert sorted(str(r.doc_id) for r in stay.collect()) == sorted(["4", "5", "6", "7", "8", "3", "20", "None"])


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")] * 3 + [(2, "a b c d e f")] * 2 + [(3, "!")] * 2, SCHEMA)
    assert sorted(r.doc_id for r in ngram_jaccard.one_of_each(docs).collect()) == [1, 3, 3]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert ngram_jaccard.annotate(docs).count() == 0
    assert ngram_jaccard.one_of_each(docs).count() == 0
