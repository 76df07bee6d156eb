"""Quality, chat, packing, decontamination, WARC and license operators against plain Python, and their edge cases."""

from __future__ import annotations

import gzip
import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from potsherd.llm import chat, decontamination, license_scan, packing, quality, warc, warc_files
from potsherd.llm import queries as llm_queries
from potsherd.llm.common import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
EDGES = [(5, None), (6, ""), (None, "x y z"), (9, "x y z"), (9, "x y z"), (8, "woord " * 40_000), (4, "\U0001f600 é\u0000\n\ttekst")]


def edge_docs(spark):
    """Rows with extra columns whose names clash with those of the results."""
    return spark.createDataFrame([(i, t, 0.5, 1, "k", 7) for i, t in EDGES], "doc_id long, text string, score double, item_id int, start string, n_words int")


# quality classifier


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    scored = quality.classify(docs, quality.learn(docs, labels)).join(labels, "doc_id").toPandas()
    held = scored[scored.held_out]
    assert set(scored.held_out[[zlib.crc32(str(i).encode()) % 4 == 2 for i in scored.doc_id]]) == {True}
    assert ((scored.score >= 0) & (scored.score <= 1)).all() and (scored.predicted == (scored.score >= 0.7)).all()
    good, bad = held.score[held.quality == 1], held.score[held.quality == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.9
    assert (held.predicted == held.quality).mean() > 0.85


def test_held_out_labels_are_never_learned(spark, small_dir):
    docs, labels = table(spark, small_dir, "documents").select("doc_id", "text"), table(spark, small_dir, "labels")
    changed = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.learn(docs, labels), quality.learn(docs, changed)
    assert np.array_equal(a.labels, b.labels) and np.allclose(a.vectors, b.vectors)
    assert len(quality.learn(docs, labels, sample=10).labels) <= 10


def test_votes_equal_brute_force():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 4, (60, quality.PLACES))
    model = quality.Model.fit(counts[:40], (np.arange(40) % 2).astype(np.int32))
    rows = quality.shares(counts[40:], model.weights) @ model.space
    for row, score in zip(rows, model.score(counts[40:]), strict=True):
        cosines = np.array([row @ v / np.linalg.norm(row) for v in model.vectors])
        near = np.argsort(-cosines)[: quality.NEIGHBOURS]
        votes = np.maximum(cosines[near], 0).astype(float) ** quality.POWER
        assert score == pytest.approx((votes * model.labels[near]).sum() / votes.sum(), abs=1e-5)


def test_quality_edges(spark, small_dir):
    docs = edge_docs(spark)
    model = quality.learn(table(spark, small_dir, "documents"), table(spark, small_dir, "labels"))
    out = quality.classify(docs, model)
    assert out.columns == ["doc_id", "text", "item_id", "start", "n_words", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(EDGES) and all(r.score == 0 for r in got if not r.text)
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.classify(docs.limit(0), model).count() == 0
    none = quality.learn(docs, table(spark, small_dir, "labels").limit(0))
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.0}


# chat formatting

TALKS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", r"### x: \c </turn> \\### y"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "user", "last"),
    (2, 0, "a:b\\###", "text"), (None, 3, None, "n"), (None, None, "assistant", "first"), (3, 1, "assistant", "same"), (3, 1, "assistant", "same"), (4, 0, "assistant", "lang " * 50_000),
    (5, 0, "user", "</turn>\n### assistant: no"), (5, 1, "assistant", "\\"), (5, 2, "assistant", "\\\\###"),
    (6, 0, "### user", "#### x ##### assistant: y </turn> </turn>\n"), (6, 1, "assistant", "### " * 3),
]


def brute_chat(rows):
    by = defaultdict(list)
    for c, k, role, text in rows:
        by[c].append((k is not None, k or 0, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        said = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), sha(said))
    return out


def test_chat_round_trip(spark):
    rows = spark.createDataFrame([(*r, "extra", 1) for r in TALKS], "conv_id long, turn long, role string, text string, formatted string, example int")
    made = chat.examples(rows)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(made).collect()}
    assert got == brute_chat(TALKS)
    examples = made.collect()
    assert sum(r.loss_length > 0 for r in examples) == sum(bool(t) and r == "assistant" for _, _, r, t in TALKS)
    for r in examples:
        assert r.formatted.count("### ") == r.formatted.count(" </turn>\n") == r.n_turns
        if r.conv_id == 1 and r.example == 0:
            assert r.formatted[: r.loss_start] == "### user: hi </turn>\n### assistant: "
    assert chat.digests(chat.examples(rows.limit(0))).count() == 0


def test_chat_query(spark, small_dir):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, small_dir, "conversations").collect()]
    rows += [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in llm_queries.op3_chat_formatting(spark, small_dir).collect()}
    assert got == brute_chat(rows)


# packing


def best_cost(ends, penalties, width):
    """Least cost over all choices of cuts."""
    best = None
    for k in range(len(ends)):
        for chosen in itertools.combinations(range(len(ends) - 1), k):
            cuts = [0, *[ends[c] for c in chosen], ends[-1]]
            if all(b - a <= width for a, b in zip(cuts, cuts[1:], strict=False)):
                cost = sum(width - (b - a) for a, b in zip(cuts, cuts[1:], strict=False)) + sum(penalties[c] for c in chosen) + penalties[-1]
                best = cost if best is None else min(best, cost)
    return best


def test_cuts_cost_least():
    rng = random.Random(3)
    for _ in range(40):
        steps = [rng.randrange(1, 9) for _ in range(10)]
        ends, penalties = np.cumsum(steps), np.array([rng.choice([0, 2, 7]) for _ in steps])
        cuts = packing.choose_cuts(ends, penalties, 12)
        price = dict(zip(ends.tolist(), penalties.tolist(), strict=True))
        cost = sum(12 - (b - a) for a, b in zip([0, *cuts], cuts, strict=False)) + sum(price[c] for c in cuts.tolist())
        assert cost == best_cost(ends.tolist(), penalties.tolist(), 12)


def check_pieces(rows, pieces, width=2048):
    """Each id of each document in exactly one piece, sequences without gaps and not too long."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    wanted = Counter()
    for i, t in rows:
        wanted[(i, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]))] += 1
    docs = defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append(p)
    ids = lambda p: np.frombuffer(p.ids, "<u4").tolist()
    by_doc = defaultdict(list)
    for (i, tokens), n in wanted.items():
        by_doc[i] += [tokens] * n
    for i, own in docs.items():
        assert sum(p.length for p in own) == sum(map(len, by_doc[i]))
        if len(by_doc[i]) == 1:
            own.sort(key=lambda p: p.start)
            assert [p.start for p in own] == [0, *np.cumsum([p.length for p in own])[:-1].tolist()]
            assert tuple(x for p in own for x in ids(p)) == by_doc[i][0]
            assert {p.doc_tokens for p in own} == {len(by_doc[i][0])}
    assert set(docs) == set(by_doc)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()]
        assert sum(n for _, n in own) <= width
    total = sum(p.length for p in pieces)
    padded = sum(0 if n & (n - 1) == 0 else width - n for n in (sum(x for _, x in own) for own in sequences.values()))
    return padded / max(total, 1)


def test_packing(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert check_pieces(rows, packing.pack(docs.repartition(3), TOKENIZER).collect()) < 0.02


def test_packing_edges(spark):
    docs = edge_docs(spark)
    check_pieces(EDGES, packing.pack(docs.repartition(2), TOKENIZER).collect())
    check_pieces(EDGES, packing.pack(docs.coalesce(1), TOKENIZER, width=16).collect(), 16)
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0
    sums = packing.with_checksums(packing.pack(docs.where("doc_id = 6"), TOKENIZER)).first()
    assert sums.ids_crc32 == zlib.crc32((1).to_bytes(4, "little"))


# decontamination


def sentence(rng, n):
    return " ".join("".join(rng.sample("abcdefghijk", 6)) for _ in range(n))


def test_contamination(spark):
    rng = random.Random(12)
    items = [(k, sentence(rng, 30)) for k in range(5)]
    items.append((5, "A train leaves Utrecht at 9 and travels 120 km in 2 hours while another train goes 60 km in 3 hours; which of the trains is faster on the whole way"))
    clean = [(100 + k, sentence(rng, 200)) for k in range(30)]
    planted = [(k, f"{sentence(rng, 40)} {items[k][1]} {sentence(rng, 40)}") for k in range(5)]
    planted.append((5, "Before. A train leaves Leiden at 7 and travels 80 km in 4 hours while another train goes 90 km in 5 hours; which of the trains is faster on the whole way"))
    half = (6, f"{sentence(rng, 30)} {' '.join(items[0][1].split()[:20])} {sentence(rng, 30)}")
    docs = spark.createDataFrame([*clean, *planted, half], "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.covered, r.verbatim) for r in decontamination.find(docs, benchmark).collect()}
    assert set(found) == {*((k, k) for k in range(6)), (6, 0)}
    assert [found[k, k] for k in range(5)] == [(30, True)] * 5 and found[6, 0] == (20, True)
    assert found[5, 5][1] is False
    left = decontamination.drop_contaminated(docs, benchmark)
    assert {r.doc_id for r in left.collect()} == {i for i, _ in clean}


def brute_windows(text):
    """Windows of eight words of a text without capitals and digits."""
    words = re.findall(r"[^\W]+", text.lower())
    return words, {tuple(words[k : k + 8]): k for k in range(len(words) - 7)}


def test_plain_coverage_equals_brute_force(spark):
    rng = random.Random(13)
    items = [(k, sentence(rng, 40)) for k in range(6)]
    docs = [(i, " ".join([sentence(rng, 20), " ".join(items[i % 6][1].split()[a : a + n]), sentence(rng, 20)])) for i, (a, n) in enumerate([(rng.randrange(20), rng.randrange(5, 25)) for _ in range(40)])]
    expected = {}
    for i, t in docs:
        _, have = brute_windows(t)
        for k, q in items:
            words, windows = brute_windows(q)
            covered = {p for w, at in windows.items() if w in have for p in range(at, at + 8)}
            if len(covered) >= 13 or len(covered) >= 0.5 * len(words):
                expected[i, k] = len(covered)
    found = decontamination.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): r.covered for r in found.collect()} == expected


def brute_slots(doc, item):
    """(covered, verbatim) of one item in one document, both of small words and numbers only."""
    doc, item = doc.split(), item.split()
    size = min(8, len(item))
    slot = [w.isdigit() for w in item]
    alike = lambda at, k: item[k] == doc[at] or (slot[k] and doc[at].isdigit())
    by_shift = defaultdict(list)
    for k in range(len(item) - size + 1):
        few = size - sum(slot[k : k + size]) < min(5, size)
        for at in range(len(doc) - size + 1):
            if doc[at : at + size] == item[k : k + size] if few else all(alike(at + i, k + i) for i in range(size)):
                by_shift[at - k].append((k, few))
    covered, kept = set(), set()
    for shift, found in by_shift.items():
        told = defaultdict(set)
        for k, few in found:
            for i in range(k, k + size):
                if slot[i] and not few:
                    told[item[i]].add(doc[i + shift])
        places = set()
        for k, few in found:
            if few or all(len(told[item[i]]) == 1 for i in range(k, k + size) if slot[i]):
                places |= set(range(k, k + size))
        covered |= places
        if all(v == {w} for w, v in told.items()):
            kept |= places
    return len(covered), kept == covered


def test_slots_equal_brute_force(spark):
    """Copies with other numbers, some of which contradict each other, windows that all items share, and slots that stand close together."""
    rng = random.Random(14)
    shared = sentence(rng, 9)
    items = [(k, " ".join([shared, *(str(rng.randrange(10, 15)) if rng.random() < 0.3 else sentence(rng, 1) for _ in range(rng.randrange(3, 30)))])) for k in range(8)]
    items.append((8, "12 and 13 make 25"))
    docs = []
    for i in range(120):
        words = items[i % 9][1].split()
        other = {str(n): str(n + 50) for n in range(10, 15)} if rng.random() < 0.6 else {}
        words = [other.get(w, w) for w in words]
        if rng.random() < 0.5:
            at = rng.randrange(len(words))
            words[at] = "77" if words[at].isdigit() else words[at]
        a = rng.randrange(0, max(1, len(words) // 3))
        docs.append((i, " ".join([sentence(rng, 12), *words[a:], sentence(rng, 12), shared])))
    expected = {}
    for i, t in docs:
        for k, q in items:
            covered, verbatim = brute_slots(t, q)
            if covered >= 13 or covered >= 0.5 * len(q.split()):
                expected[i, k] = (covered, verbatim)
    got = decontamination.find(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): (r.covered, r.verbatim) for r in got.collect()} == expected
    assert {v for _, v in expected.values()} == {True, False}


def test_contradicting_slots_are_not_verbatim_and_long_texts_are_read_whole(spark):
    item = "the first of 12 boats sails with ropes and masts while the last of 12 boats waits in the harbour for better wind to come"
    far = "word " * 150_000
    docs = [(1, item), (2, item.replace("12", "40", 1)), (3, item.replace("12", "40")), (4, far + item + " " + far)]
    named = spark.createDataFrame([(*d, 0, 0, 0, "k", True) for d in docs], "doc_id long, text string, at int, size int, window long, own string, fits boolean")
    found = decontamination.find(named, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r.doc_id: r.verbatim for r in found.collect()} == {1: True, 2: False, 3: False, 4: True}


def test_decontamination_edges(spark):
    docs = edge_docs(spark)
    benchmark = spark.createDataFrame([(1, None, "q"), (None, "x y z", "q"), (3, "", "q"), (4, "12 34 km", "q"), (None, "x y z", "q")], "item_id long, text string, share string")
    found = [(r.doc_id, r.item_id, r.covered) for r in decontamination.find(docs, benchmark).collect()]
    assert sorted(found, key=str) == sorted([(9, None, 3), (None, None, 3)], key=str)
    left = decontamination.drop_contaminated(docs, benchmark)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {5, 6, 8, 4}
    assert decontamination.find(docs, benchmark.limit(0)).count() == 0
    assert decontamination.find(docs.limit(0), benchmark).count() == 0


def test_verbatim_copies_of_items_with_few_literals(spark):
    items = [(1, "Compute 12 plus 30 minus 7"), (2, "12 34 km"), (3, "Alice has 3 apples, Bob 5 pears, Carl 7 plums, Dora 9 figs and Eve 11 nuts"), (4, "What is 6 times 7?"), (5, "Add 3")]
    docs = [(k, f"some words before, then {t} and some more behind") for k, t in items]
    docs += [(11, "Compute 13 plus 31 minus 8"), (12, "12 35 km"), (13, "Anna has 4 apples, Bart 6 pears, Cees 8 plums, Dirk 10 figs and Els 12 nuts"), (14, "What is 8 times 9?"), (15, "Add 4")]
    docs, benchmark = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(k, k) for k, _ in items}
    assert all(r.verbatim and r.covered == r.item_words for r in found)
    assert {r.doc_id for r in decontamination.drop_contaminated(docs, benchmark).collect()} == {11, 12, 13, 14, 15}


# WARC


def test_warc_files_can_be_read_back(spark, tmp_path):
    pages = [(1, "http://a/x y", "<html><title>T &amp; t</title><script>no</script><p>één</p><p>twee <a href='u'>l</a></p></html>"), (2, None, None), (2, None, None), (None, "http://b", "plat &lt;b&gt;")]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, block string")
    records = warc.derivatives(warc.responses(df))
    got = records.collect()
    assert len(got) == 2 * len(pages)
    responses = {r.record_id: r for r in warc.responses(df).collect()}
    for r in got:
        source = responses[r.refers_to]
        assert (r.target_uri, r.date, r.source_payload_digest, r.source_block_digest) == (source.target_uri, source.date, source.payload_digest, source.block_digest)
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
    plain = {r.page_id: r.block for r in got if r.record_type == "conversion"}
    assert plain == {1: "T & t\néén\ntwee l", 2: "", None: "plat <b>"}
    assert "title: T & t\r\noutlinks: 1\r\n" in next(r.block for r in got if r.page_id == 1 and r.record_type == "metadata")
    warc.write(records, f"{tmp_path}/warc")
    data = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "warc").glob("*.gz"))
    found = Counter()
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        n = int(fields["Content-Length"])
        found[fields["WARC-Record-ID"], hashlib.sha256(rest[:n]).hexdigest()] += 1
        assert rest[n : n + 4] == b"\r\n\r\n"
        data = rest[n + 4 :]
    assert found == Counter((r.record_id, r.block_digest[7:]) for r in got)
    assert warc.derivatives(warc.responses(df.limit(0))).count() == 0


def test_hostile_pages_take_no_more_than_their_length(spark):
    parts = ["<!-- ", "<script>", "<a <b ", "<title>", "&#", "</script ", "<p ", "<a href"]
    rows = [(k, "u", x * (1_000_000 // len(x))) for k, x in enumerate(parts)]
    began = time.time()
    got = warc.derivatives(warc.responses(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()
    assert len(got) == 2 * len(rows) and time.time() - began < 120
    assert next(r.block for r in got if r.page_id == 0 and r.record_type == "conversion") == ""


def test_references_and_hidden_parts(spark):
    html = "<title lang='nl'>A&eacute;</title><p>caf&eacute; &#8217;t &#x27;q&#x27; &amp;lt; &unknown; &#0; &#x1F600; a&b; x</p><!-- c --> d <STYLE a='b'>e</style > f <svg/>g</svg> <!-- h <script>var a='<!--';</script> i"
    got = {r.record_type: r.block for r in warc.derivatives(warc.responses(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string"))).collect()}
    assert got["conversion"] == "Aé\ncafé ’t 'q' &lt; &unknown; &#0; 😀 a&b; x\nd f"
    assert "title: Aé\r\n" in got["metadata"]


def test_responses_of_warc_files_keep_their_headers(spark, tmp_path):
    body = "<p>één &amp; twee</p>"
    block = f"HTTP/1.1 404 Not Found\r\nContent-Type: text/html\r\nX-Powered-By: a: b\r\n\r\n{body}"
    record = lambda kind, name, text: f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{name}>\r\nWARC-Target-URI: http://x/{name}\r\nWARC-Date: 2021-02-03T04:05:06Z\r\nContent-Length: {len(text.encode())}\r\n\r\n{text}\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress((record("warcinfo", 1, "software: x") + record("response", 2, block) + record("response", 3, "HTTP/1.1 200 OK\r\n\r\n")).encode()))
    found = warc_files.read_responses(spark, str(tmp_path))
    assert sorted((r.record_id, r.target_uri, r.date, r.payload) for r in found.collect()) == [("<urn:uuid:2>", "http://x/2", "2021-02-03T04:05:06Z", body), ("<urn:uuid:3>", "http://x/3", "2021-02-03T04:05:06Z", "")]
    got = {(r.refers_to, r.record_type): r.block for r in warc.derivatives(found).collect()}
    assert got["<urn:uuid:2>", "conversion"] == "één & twee"
    assert got["<urn:uuid:2>", "metadata"].startswith("http-status: 404 Not Found\r\nhttp-content-type: text/html\r\nhttp-x-powered-by: a: b\r\ntitle: \r\n")


def test_warc_files_are_read_by_bytes(spark, tmp_path):
    def record(kind, name, block, version="1.1", more=b"", length=None):
        return b"WARC/%b\r\nWARC-Type: %b\r\nWARC-Record-ID: <%b>\r\n%bContent-Length: %d\r\n\r\n%b\r\n\r\n" % (version.encode(), kind.encode(), name.encode(), more, len(block) if length is None else length, block)

    latin = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1\r\n\r\n<p>café</p>".encode("latin-1")
    image = b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x89PNG\r\n\x1a\n\x00\xff\r\n\r\n"
    quoting = b"HTTP/1.1 200 OK\r\n\r\n<p>a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc</p>"
    twice = b"WARC-Concurrent-To: <a>\r\nWARC-Concurrent-To: <b>\r\n <c>\r\nWARC-Payload-Digest: sha1:XYZ\r\n"
    plain = [
        record("warcinfo", "info", b"x: y", "1.0"), record("response", "latin", latin, "1.0"), record("response", "image", image), record("response", "quoting", quoting, more=twice),
        record("response", "short", quoting, length=9), record("response", "long", b"ab", length=10), b"stray\n", record("response", "none", b"a").replace(b"Content-Length: 1\r\n", b""), record("response", "last", b"HTTP/1.1 204 No\r\n\r\n"), record("response", "cut", b"abc", length=10**9),
    ]
    want = {"<latin>": "<p>café</p>", "<quoting>": quoting.partition(b"\r\n\r\n")[2].decode(), "<last>": ""}
    (tmp_path / "gz").mkdir()
    (tmp_path / "plain").mkdir()
    (tmp_path / "gz/a.warc.gz").write_bytes(b"".join(map(gzip.compress, plain)))
    (tmp_path / "gz/empty.warc.gz").write_bytes(gzip.compress(b""))
    (tmp_path / "plain/a.warc").write_bytes(b"".join(plain))
    (tmp_path / "plain/b.warc").write_bytes(record("response", "b", b"HTTP/1.0 200 OK\r\n\r\nb"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100)
    try:
        for folder in ("gz", "plain"):
            records = warc_files.read_records(spark, f"{tmp_path}/{folder}").where("path LIKE '%a.warc%'").collect()
            whole = {r.fields.get("warc-record-id", [""])[0]: bytes(r.block) for r in records if r.error is None}
            assert {"<info>": b"x: y", "<latin>": latin, "<image>": image, "<quoting>": quoting, "<last>": b"HTTP/1.1 204 No\r\n\r\n"}.items() <= whole.items()
            bad = [r.fields.get("warc-record-id", [""])[0] for r in records if r.error and r.fields]
            assert {"<short>", "<long>", "<none>", "<cut>"} <= set(bad) and all(r.block is None for r in records if r.error)
            concurrent = next(r for r in records if r.fields and r.fields.get("warc-record-id") == ["<quoting>"])
            assert concurrent.fields["warc-concurrent-to"] == ["<a>", "<b> <c>"] and concurrent.version == "WARC/1.1"
            got = {r.record_id: r for r in warc_files.read_responses(spark, f"{tmp_path}/{folder}").collect()}
            assert {k: got[k].payload for k in want} == want and ("<b>" in got) == (folder == "plain")
            assert got["<quoting>"].payload_digest == "sha1:XYZ" and got["<image>"].payload_digest == "sha256:" + hashlib.sha256(image.partition(b"\r\n\r\n")[2]).hexdigest()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    records = warc.derivatives(warc_files.read_responses(spark, f"{tmp_path}/gz"))
    warc.write(records, f"{tmp_path}/out")
    back = warc_files.read_records(spark, f"{tmp_path}/out").collect()
    assert sorted(bytes(r.block).decode() for r in back) == sorted(r.block for r in records.collect()) and {r.error for r in back} == {None}


# license scan


def brute_base(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = [(k, label) for phrase, label in license_scan.BASE for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    places = [k for k, _ in found]
    return len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


def base_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in df.collect()), key=str)


def test_license_base_equals_brute_force(spark, small_dir):
    docs = table(spark, small_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rng = random.Random(2)
    filler = lambda n: " ".join(rng.choice(["foo", "licence", "MIT", "License", "gpl", "General"]) for _ in range(n))
    rows += [(10_000 + k, f"{filler(rng.randrange(900))} MIT-License, the General\nPublic LICENSE v2 {filler(600)} apache license") for k in range(30)]
    df = license_scan.summary(license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert base_of(df) == sorted(((i, *brute_base(t)) for i, t in rows), key=str)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in df.collect())


def brute_rules(text):
    """All detections that no other suppresses, on the whole text: (label, priority, first, last)."""
    low = re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", (text or "").lower()).strip(" ")
    words, spaced, found = set(low.split(" ")), f" {low} ", []
    for rule, label, keyword, priority, pattern in license_scan.rules():
        if keyword in words:
            for m in re.finditer(pattern, spaced):
                first = spaced[: m.start()].count(" ") - 1
                found.append((first, first + m.group().count(" "), priority, rule, label))

    def better(o, m):
        return o[0] <= m[0] and o[1] >= m[1] and (o[2], o[1] - o[0], -o[3]) > (m[2], m[1] - m[0], -m[3])

    return {(m[4], m[2], m[0], m[1]) for m in found if not any(better(o, m) for o in found)}


def test_rules_suppress_what_they_contain(spark):
    texts = {
        "SPDX-License-Identifier: Apache-2.0": {("apache", 90)},
        "Licensed under the Apache License, Version 2.0": {("apache", 80)},
        "released under the terms of the GNU Lesser General Public License version 2.1": {("lgpl", 80)},
        "no keyword here": set(),
        "All rights reserved. Copyright (c) 2020": {("all-rights-reserved", 50), ("copyright", 40)},
    }
    df = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [{(m.label, m.priority) for m in r.found} for r in df.orderBy("doc_id").collect()] == list(texts.values())


ANY = re.compile(r"\(\?:\[\^ \]\+ \)\{\d+,(\d+)\}")  # some words of any kind


def test_signatures():
    rules = license_scan.rules()
    assert len(rules) > 250 and len({p for *_, p in rules}) == len(rules)
    for _, _, keyword, _, pattern in rules:
        assert re.search(rf"(?<![a-z0-9]){keyword}(?![a-z0-9])", pattern), pattern  # each match holds its keyword
        assert len(ANY.sub(lambda m: "x " * int(m[1]), pattern).split(" ")) <= license_scan.CONTEXT + 2, pattern


def test_scan_equals_brute_force(spark):
    """Every rule's words in a text of its own, shuffled ones around, and texts of several segments."""
    rng = random.Random(21)
    plain = [re.sub(r"\(\?:([^()|]*)[^()]*\)\??", r"\1", ANY.sub("some ", p[9:-6])) for *_, p in license_scan.rules()]
    simple = [re.sub(r"\[(.)[^\]]*\](?:\[0-9\])?|[?()]", r"\1", x).replace("|", " ") for x in plain]
    pool = " ".join(simple).split()
    noise = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    rows = [(k, f"{noise(4)}. {x.capitalize()}, {noise(4)}") for k, x in enumerate(simple)]
    rows += [(1000 + k, "\n".join(f"{noise(rng.randrange(60))}; {rng.choice(simple)}" for _ in range(40))) for k in range(12)]
    got = {r.doc_id: {(m.label, m.priority, m.first, m.last) for m in r.found} for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    wanted = {k: brute_rules(t) for k, t in rows}
    assert got == wanted
    assert len({m[0] for found in wanted.values() for m in found}) > 40


def test_license_edges(spark):
    docs = edge_docs(spark)
    assert base_of(license_scan.summary(license_scan.scan(docs))) == sorted(((i, *brute_base(t)) for i, t in EDGES), key=str)
    assert license_scan.scan(docs.limit(0)).count() == 0


