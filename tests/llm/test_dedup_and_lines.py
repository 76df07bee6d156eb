"""Exact dedup, substring dedup and line dedup against plain Python, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from potsherd.llm import exact_dedup, line_dedup, substring_dedup
from potsherd.llm.common import small, table

SCHEMA = "doc_id long, text string"
EDGES = [(5, None), (6, ""), (7, "a  b"), (3, "a\n b"), (3, "a\n b"), (None, "x"), (None, "x"), (9, "x"), (8, "word " * 40_000)]


def edge_docs(spark):
    """Rows with extra columns whose names clash with those of the results."""
    return spark.createDataFrame([(i, t, True, "k", 1, None, "z") for i, t in EDGES], "doc_id long, text string, kept boolean, digest string, removed int, dropped string, TEXT_KEY string")


def normalised(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normalised(t)].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[normalised(t)] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[normalised(t)]), i == keep, hashlib.sha256(normalised(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("counters", [2, 999])
def test_exact_dedup_equals_brute_force(spark, counters):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot  text", "hot\ttext", "warm", f"t{rng.randrange(60)}"])) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert sorted((tuple(r) for r in exact_dedup.annotate(docs, counters=counters).collect()), key=str) == brute_exact(rows)
    left = exact_dedup.drop_duplicates(docs, counters=counters)
    assert sorted(r.doc_id for r in left.collect()) == sorted(r[0] for r in brute_exact(rows) if r[3])


def test_exact_dedup_on_the_driver_table(spark, small_dir):
    docs = table(spark, small_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in exact_dedup.annotate(docs).collect()), key=str) == brute_exact(rows)


def test_exact_dedup_edges(spark):
    docs = edge_docs(spark)
    assert sorted((tuple(r) for r in exact_dedup.annotate(docs).collect()), key=str) == brute_exact(EDGES)
    left = exact_dedup.drop_duplicates(docs)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([5, 3, 9, 8])
    assert exact_dedup.annotate(docs.limit(0)).count() == exact_dedup.drop_duplicates(docs.limit(0)).count() == 0


def test_misra_gries_never_loses_a_heavy_one():
    rng = random.Random(2)
    items = [rng.choice("aaaaabbbc") if rng.random() < 0.5 else str(rng.random()) for _ in range(3000)]
    summary: Counter = Counter()
    for k in range(0, len(items), 50):
        summary.update(items[k : k + 50])
        summary = exact_dedup.misra_gries(summary, 9)
    true = Counter(items)
    assert len(summary) <= 9
    assert all(x in summary for x, n in true.items() if n > len(items) * 2 / 10)
    assert all(summary[x] <= true[x] for x in summary)


def test_broadcasts_are_bounded_in_bytes(spark):
    assert small(spark.range(10))
    assert not small(spark.range(10), limit=9)
    assert not small(spark.createDataFrame([("x" * 100,)], "s string"), size=99)


# substring dedup


def brute_cuts(text: str) -> list[int]:
    """Numbers of the words that end a chunk, by the gear hash character by character and every window in turn."""
    table, h, marks, text = [int(x) for x in substring_dedup.gear()], 0, [], re.sub(r"[ \t\n\v\f\r]+", " ", text)
    for c in "\0" * 16 + text:
        h = ((h << 1) + table[(ord(c) ^ (ord(c) >> 8)) & 255]) & 0xFFFF
        marks.append(h)
    ends = [m.end() for m in re.finditer(r"[^\0 \t\n\v\f\r]+", text)]
    values, w = [marks[16 + e - 1] for e in ends], substring_dedup.WINDOW
    least = [min(values[max(k, 0) : k + w]) for k in range(1 - w, len(values)) if values]
    return [k for k, v in enumerate(values) if v in [least[j + w - 1] for j in range(k - w + 1, k + 1)]]


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_chunks_equal_brute_force():
    rng = random.Random(4)
    texts = [prose(rng, rng.randrange(1, 300)) for _ in range(20)] + ["", "x" * 5000, "é\n ü\t" * 40]
    read = substring_dedup.Texts(texts)
    first, last, digests = read.chunks()
    for k, t in enumerate(texts):
        own = np.arange(read.bounds[k], read.bounds[k + 1])
        assert [t[a:b] for a, b in zip(read.begins[own], read.ends[own], strict=True)] == t.split()
        cuts = brute_cuts(t)
        assert np.flatnonzero(read.cut[own]).tolist() == cuts
        assert not cuts or max(np.diff([-1, *cuts, len(own)])) <= substring_dedup.WINDOW
        wanted = [(a + 1, min(c for c in cuts if c >= a + substring_dedup.LEAST) + 1) for a in cuts if cuts[-1] >= a + substring_dedup.LEAST]
        mine = read.text[first - 1] == k
        assert list(zip((first[mine] - own[0]).tolist(), (last[mine] - own[0]).tolist(), strict=True)) == wanted if len(own) else not mine.any()
    by_words = defaultdict(set)
    for a, b, d in zip(first, last, digests.tolist(), strict=True):
        by_words[tuple(texts[read.text[a]][read.begins[k] : read.ends[k]] for k in range(a, b))].add(d)
    assert all(len(d) == 1 for d in by_words.values()) and len({x for d in by_words.values() for x in d}) == len(by_words)


def test_an_insertion_shifts_no_other_chunk():
    rng = random.Random(8)
    text = prose(rng, 400)
    changed = text[:500] + " nieuw woord " + text[500:]
    digests = lambda t: set(substring_dedup.Texts([t]).chunks()[2].tolist())
    assert len(digests(text) - digests(changed)) <= 8 < 0.2 * len(digests(text))


def brute_substrings(rows, words=substring_dedup.WORDS):
    """doc_id -> the text without all grams that an earlier document has."""
    first = {}
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - words + 1):
            g = tuple(w[k : k + words])
            first[g] = min(i, first.get(g, i))
    out = {}
    for i, t in rows:
        places = [m.span() for m in re.finditer(r"\S+", t)]
        w = t.split()
        gone = {k + x for k in range(len(w) - words + 1) if first[tuple(w[k : k + words])] < i for x in range(words)}
        for k in sorted(gone, reverse=True):
            a, b = places[k]
            t = t[:a] + t[places[k + 1][0] if k + 1 in gone else b :]
        out[i] = t
    return out


def test_substring_dedup_equals_brute_force(spark):
    rng = random.Random(6)
    passages = [prose(rng, 70) for _ in range(4)]
    rows = [(i, " ".join([prose(rng, rng.randrange(5, 60)), rng.choice(passages), prose(rng, 20)]) if i % 3 else prose(rng, 50)) for i in range(60)]
    got = {r.doc_id: r.text for r in substring_dedup.dedup(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert got == brute_substrings(rows)


def test_unspaced_text(spark):
    rng = random.Random(7)
    chinese = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))
    passage = chinese(90)
    rows = [(1, chinese(40) + passage + chinese(30)), (2, chinese(13) + passage + chinese(50)), (3, chinese(200))]
    got = {r.doc_id: r for r in substring_dedup.dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i].removed_chars for i in (1, 2, 3)] == [0, 90, 0] and passage not in got[2].text


def test_whole_passages_go_with_exact_edges(spark):
    rng = random.Random(10)
    passages = [prose(rng, rng.randrange(51, 61)) for _ in range(60)] + [prose(rng, 8 + 2 * substring_dedup.WINDOW + substring_dedup.LEAST) for _ in range(60)]
    around = [[(prose(rng, rng.randrange(1, 60)), prose(rng, rng.randrange(1, 60))) for _ in range(3)] for _ in passages]
    rows = [(3 * k + i, f"{a} {p} {b}") for k, p in enumerate(passages) for i, (a, b) in enumerate(around[k])]
    want = {3 * k + i: f"{a} {p} {b}" if i == 0 else f"{a}  {b}" for k, p in enumerate(passages) for i, (a, b) in enumerate(around[k])}
    random.Random(11).shuffle(rows)
    got = {r.doc_id: r for r in substring_dedup.dedup(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(len(text) - len(got[i].text) == got[i].removed_chars == sum(s.end - s.begin for s in got[i].removed) for i, text in rows)


def test_whole_passages_may_come_from_several_documents(spark):
    rng = random.Random(12)
    p = [prose(rng, 60) for _ in range(3)]
    short = " ".join(p[0].split()[20:50])
    rows = [(1, f"{prose(rng, 9)} {short} {prose(rng, 9)}"), (2, p[0]), (3, "\n".join(["new one", p[0].replace(" ", "\n"), p[1], "last"])), (4, p[1]), (5, p[2]), (5, p[2] + " x")]
    got = {(r.doc_id, len(r.text)): r.text for r in substring_dedup.dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got.values()) == {rows[0][1], p[0].replace(short, ""), f"new one\n\n{p[1]}\nlast", "", p[2], p[2] + " x"}


def test_substring_edges(spark):
    docs = edge_docs(spark)
    out = substring_dedup.dedup(docs)
    assert out.columns == [*[c for c in docs.columns if c != "removed"], "removed", "removed_chars"]
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == sorted((str(i), t) for i, t in EDGES)
    assert substring_dedup.dedup(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(2, prose(random.Random(1), 60)), (1, prose(random.Random(1), 60)), (None, prose(random.Random(1), 60))], SCHEMA)
    assert {r.doc_id: len(r.text) > 0 for r in substring_dedup.dedup(twice).collect()} == {1: True, 2: False, None: False}


# line dedup


def brute_lines(rows, documents):
    """doc index -> kept text, by the same tree."""

    def mask(line):
        plain = re.sub(r"[ \t\n\v\f\r]+", " ", line).strip(" ")
        return re.sub(r"[^ ]*[0-9][^ ]*", "<*>", plain) if re.search("[0-9]", plain) else plain

    masked = [[mask(x) for x in (t or "").split("\n")] for _, t in rows]
    size = lambda m: len(m.split(" ")) if m else 0
    leaf = lambda m: (size(m), tuple(m.split(" ")[: line_dedup.DEPTH])) if size(m) >= line_dedup.GENERAL else None
    docs = Counter(m for ms in masked for m in set(ms) if size(m) >= line_dedup.SHORT)
    drop = {m for m, n in docs.items() if n >= documents}
    leaves = defaultdict(list)
    for m in docs:
        if leaf(m):
            leaves[leaf(m)].append(m)
    todo = list(leaves.values())
    while todo:
        ms = todo.pop()
        total = sum(docs[m] for m in ms)
        if len(ms) < 2 or total < documents:
            continue
        split = {m: m.split(" ") for m in ms}
        votes = [Counter() for _ in split[ms[0]]]
        for m in ms:
            for v, token in zip(votes, split[m], strict=True):
                v[token] += docs[m]
        best = [max((n, token) for token, n in v.items())[1] for v in votes]
        member = [m for m in ms if sum(a == b for a, b in zip(split[m], best, strict=True)) >= line_dedup.ALIKE * len(best)]
        if sum(any(m in set(doc) for m in member) for doc in masked) >= documents:
            drop |= set(member)
        left = [m for m in ms if m not in member]
        if 2 * sum(docs[m] for m in member) >= total:
            todo.append(left)
        else:
            fork = min((len(v), k) for k, v in enumerate(votes) if len(v) > 1)[1]
            apart = defaultdict(list)
            for m in left:
                apart[split[m][fork]].append(m)
            todo += apart.values()
    return ["\n".join(x for x, m in zip((t or "").split("\n"), ms, strict=True) if m not in drop) for (_, t), ms in zip(rows, masked, strict=True)]


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(9)
    vary = lambda: rng.choice(["red", "blue", "green"])
    rows = []
    for i in range(40):
        own = [prose(rng, rng.randrange(1, 12)) for _ in range(3)]
        own += [f"Page {rng.randrange(99)}  of\t{rng.randrange(99)} shown here"] * (i % 2)
        own += [f"please read the {vary()} notice before {vary()} use today"] * (i % 3 == 0)
        own += ["short line", "", "All rights are reserved"]
        rng.shuffle(own)
        rows.append((i, "\n".join(own)))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r.doc_id: r.clean_text for r in line_dedup.annotate(docs).collect()}
    assert [got[i] for i, _ in rows] == brute_lines(rows, line_dedup.DOCUMENTS)
    assert not any("All rights" in t or "shown here" in t for t in got.values())


def test_line_dedup_on_the_driver_table(spark, small_dir):
    docs = table(spark, small_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r.clean_text for r in line_dedup.annotate(docs).collect()}
    assert [got[i] for i, _ in rows] == brute_lines(rows, line_dedup.DOCUMENTS)


def test_all_templates_of_a_leaf_are_found(spark):
    """Seven templates of one length and beginning, each with a variable word, the same number of documents for each."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("klmnop") for _ in range(6))
    shapes = [["same", "three", "words", *[word() for _ in range(6)]] for _ in range(7)]
    rows = []
    for i in range(60):
        own = [" ".join([*s[:5], word(), *s[6:]]) for k, s in enumerate(shapes) if (i + k) % 3]
        own += [f"same three words {prose(rng, 6)}" for _ in range(2)]
        rows.append((i, "\n".join(own)))
    got = {r.doc_id: r for r in line_dedup.annotate(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert [got[i].clean_text for i, _ in rows] == brute_lines(rows, line_dedup.DOCUMENTS)
    assert sum(len(r.dropped) for r in got.values()) == sum((i + k) % 3 > 0 for i in range(60) for k in range(7))


def test_line_edges(spark):
    docs = edge_docs(spark)
    out = line_dedup.annotate(docs)
    assert out.columns == [*[c for c in docs.columns if c != "dropped"], "n_lines", "dropped", "clean_text"]
    assert sorted((str(r.doc_id), r.clean_text) for r in out.collect()) == sorted((str(i), t or "") for i, t in EDGES)
    assert line_dedup.annotate(docs.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "one two three\nfour")] * 12, SCHEMA)
    assert {r.clean_text for r in line_dedup.annotate(same).collect()} == {"four"}


def test_gear_numbers():
    assert len(np.unique(substring_dedup.gear())) > 250
