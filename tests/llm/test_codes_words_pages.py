"""Vector codes, spelling variants and main texts against plain Python, and their edge cases."""

from __future__ import annotations

import hashlib
import html
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from potsherd.llm import main_text, spelling, vector_codes
from potsherd.llm import queries as llm_queries
from potsherd.llm.common import Scratch, table

# vector codes


def plain_lloyd(rows, parts=8, entries=16, rounds=6):
    """(vec_id, label, components) with all distances measured in each round."""
    kept = [(i, label, [math.floor(4096 * x) for x in v]) for i, label, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[2]))
    size = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * size : (p + 1) * size]
    books = [[cut(v, p) for _, _, v in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v, p: min(range(len(books[p])), key=lambda e: (far(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        for p in range(parts):
            met = defaultdict(list)
            for _, _, v in kept:
                met[nearest(v, p)].append(cut(v, p))
            books[p] = [[sum(c) // len(met[e]) for c in zip(*met[e], strict=True)] if e in met else book for e, book in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    out, total = [], Counter()
    for i, label, v in kept:
        code = [nearest(v, p) for p in range(parts)]
        error = sum(far(cut(v, p), books[p][e]) for p, e in enumerate(code))
        total[label] += error
        out.append((i, label, "".join(f"{e:02x}" for e in code), error))
    return sorted(((i, code, error, total[label], digest) for i, label, code, error in out), key=repr)


def coded(df):
    return sorted((tuple(r) for r in vector_codes.compress(df).collect()), key=repr)


def test_vector_codes_on_the_driver_table(spark, small_dir):
    rows = [(r.vec_id, r.label, r.embedding) for r in table(spark, small_dir, "embeddings").collect()]
    got = sorted((tuple(r) for r in llm_queries.op11_vector_codes(spark, small_dir).collect()), key=repr)
    assert got == plain_lloyd(rows)


def test_vector_codes_with_ties_nulls_and_repeated_rows(spark):
    rng = random.Random(5)
    grid = lambda: [rng.choice([-1.0, 0.0, 1.0]) / 4096 * rng.choice([1, 2]) for _ in range(16)]
    rows = [(k // 2 if k < 40 else k, rng.choice([None, 1, 2]), grid()) for k in range(90)]
    rows += [(200 + k, 1, rows[0][2]) for k in range(30)] + [(None, 2, grid()), (None, None, grid())]
    bad = [(-5, 1, None), (-4, 1, [float("nan")] * 16), (-3, None, [float("inf")] + [0.0] * 15), (-2, 1, [None] + [0.0] * 15)]
    df = spark.createDataFrame([(i, v, label, "x", 3) for i, label, v in rows + bad], "vec_id long, embedding array<float>, label int, code string, sums int").repartition(7)
    assert coded(df) == plain_lloyd(rows)


def test_vector_codes_edges(spark):
    kind = "vec_id long, embedding array<double>, label string"
    none = spark.createDataFrame([], kind)
    assert vector_codes.compress(none).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and coded(none) == []
    assert coded(spark.createDataFrame([(1, None, "a")], kind)) == []
    one = coded(spark.createDataFrame([(1, [0.5] * 8, None), (2, [], None)], kind))
    assert [r[:4] for r in one] == [(1, "00" * 8, 0, 0), (2, "01" * 8, 0, 0)]
    odd = coded(spark.createDataFrame([(1, [1.0] * 10, "a"), (2, [1e30] * 10, "a")], kind))  # padded to 16, held within bounds
    assert [r[1] for r in odd] == ["00" * 8, "01" * 5 + "00" * 3] and all(r[2] == 0 for r in odd)


def test_bounds_spare_most_scans(monkeypatch):
    rng = np.random.default_rng(2)
    vecs = rng.integers(-4000, 4000, (3000, 2, 4)) + rng.integers(0, 5, (3000, 1, 1)) * 20_000
    books, scanned = vector_codes.Books(vecs[:16].transpose(1, 0, 2)), []
    plain = vector_codes.squares
    monkeypatch.setattr(vector_codes, "squares", lambda a, b: (scanned.append(len(a)) if b.ndim == 3 and len(b) == 1 else None, plain(a, b))[1])
    known = (None, None, None)
    for _ in range(8):
        known = books.assign(vecs, *known)
        apart = ((vecs[:, :, None] - books.now[None]) ** 2).sum(-1)
        assert (known[0] == apart.argmin(-1)).all()
        own = np.sqrt(np.take_along_axis(apart, known[0][..., None].astype(int), 2)[..., 0])
        np.put_along_axis(apart, known[0][..., None].astype(int), np.iinfo(np.int64).max, 2)
        assert (known[1] >= own).all() and (known[2] <= np.sqrt(apart.min(-1))).all()
        books = vector_codes.Books(books.after(books.sums(vecs, known[0])), books.now)
    assert sum(scanned[:2]) == 6000 and sum(scanned[-2:]) < 3000


def test_integer_roots():
    x = np.array([0, 1, 2, 3, 4, 2**52 + 1, (2**31 - 1) ** 2 - 1, (2**31 - 1) ** 2, 2**62], np.int64)
    assert vector_codes.root_below(x).tolist() == [math.isqrt(int(v)) for v in x]
    assert vector_codes.root_above(x).tolist() == [math.isqrt(int(v) - 1) + 1 if v else 0 for v in x]


# spelling variants


def plain_words(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(docs):
    n = plain_words(docs)
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    form = {}
    for w, met in near.items():
        best = min(met, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


@pytest.mark.parametrize("crowd", [1, 48])
def test_variants_equal_brute_force(spark, crowd):
    rng = random.Random(crowd)
    bases = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 12))) for _ in range(25)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa"]

    def edited(w):
        k, c = rng.randrange(len(w) + 1), rng.choice("abéÿ")
        return rng.choice([w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :]])

    docs = []
    for i in range(60):
        some = [rng.choice(bases) if rng.random() < 0.8 else edited(edited(rng.choice(bases))) for _ in range(30)]
        docs.append((i if i else None, " 1".join(x.upper() if rng.random() < 0.2 and "é" not in x and "ÿ" not in x else x for x in some) + "Ātail"))
    docs += [(9, None), (9, ""), (70, "thousand " * 100 + "thousnd " * 25 + "thousndd thousndd"), (70, "thousand " * 900), (71, "z" * 40_000 + " " + "z" * 40_000), (71, "z" * 40_000 + " " + "z" * 40_001)]
    df = spark.createDataFrame([(t, i, 1, "w") for i, t in docs], "text string, doc_id long, n int, word string")
    got = sorted((tuple(r) for r in spelling.variants(df, crowd=crowd).collect()), key=lambda r: r[0])
    assert got == plain_variants(docs)
    assert any(r[1] for r in got) and any(r[2] not in (r[0], r[1]) for r in got)


def test_each_pair_is_met_once(spark):
    words = sorted({"aaaaaaa"[:k] + c + "aaaaaaa"[k:] for k in range(8) for c in "abc"} | {"aaaaaaa", "aaabaaaa", "aaaabaaa"})
    vocabulary = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    for crowd in (1, 4):
        scratch = Scratch(spark)
        met = [tuple(sorted((r.word, r.near))) for r in spelling.pairs(scratch.keep(vocabulary), scratch, crowd).collect()]
        assert sorted(met) == sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))


def test_no_words(spark):
    df = spark.createDataFrame([(1, "short words"), (2, None)], "doc_id long, text string")
    assert spelling.variants(df).count() == 0 == spelling.variants(df.limit(0)).count()


# main texts

BODY = [f"Paragraph {k} tells of ditches and wells that were dug here, of sherds & bones, and of what was found between them in year {k}." for k in range(5)]
NAV = "<ul>" + "".join(f"<li><a href='/{k}'>Menu item {k}</a></li>" for k in range(8)) + "</ul>"
PAGES = {
    "article": f"<body><header><h1>Site</h1>{NAV}</header><article><header><h1>Title of it</h1></header>{{p}}<footer>Tags</footer></article><aside>Side text about other things</aside><footer>About us</footer>",
    "main": f"<body><nav>{NAV}</nav><main><h1>Title of it</h1>{{p}}<section id=comments><h2>3 Comments</h2><p>{'I have a long remark on this. ' * 30}</p></section></main>",
    "divs": f"<title>Title of it - Site</title><body><div id=top>{NAV}</div><div class=wrap><h1>Title of it</h1><div class='content with-sidebar'>{{p}}</div><div class='sidebar'><p>{'Read on in our letter. ' * 9}</p></div></div><div class='cookie-notice'>We use cookies. {'Agree. ' * 50}</div>",
    "no hints": f"<title>Title of it</title><body><div>{NAV}</div><div><h1>Title of it</h1><div>{{p}}</div><div><a href=a>one other thing</a> <a href=b>two other things</a> <a href=c>three other things</a></div></div><div>All rights</div>",
    "sections": f"<title>Title of it</title><body>{NAV}<div><h1>Title of it</h1><section>{{p1}}</section><section>{{p2}}</section></div><form><p>Write to us <input name=a></p><button>Go</button></form>",
    "form around": f"<title>Title of it</title><body><form id=aspnet>{NAV}<div><h1>Title of it</h1>{{p}}</div></form><p class=ad>Buy this</p>",
    "table": f"<title>Title of it</title><body><table><tr><td>{NAV}<td><h1>Title of it</h1>{{p}}</table>",
    "remarks": f"<body><article><h1>Title of it</h1>{{p}}<div><h3>Reader comments (2)</h3><ul><li>{'Well said. ' * 40}</ul></div><div role=navigation>More</div></article>",
}


@pytest.mark.parametrize("name", PAGES)
def test_articles_of_many_layouts(name):
    marked = [f"<p>{html.escape(x)}" + ("</p>" if k % 2 else "") for k, x in enumerate(BODY)]
    page = PAGES[name].replace("{p1}", "".join(marked[:2])).replace("{p2}", "".join(marked[2:])).replace("{p}", "".join(marked))
    assert main_text.main_text(page).split("\n") == ["Title of it", *BODY]


def test_marks_inside_texts():
    page = """<article><h1>a &lt;b&gt; &amp;amp; &#233;&#x41;&eacute;</h1><!-- <p>no</p> --><p>one<br>two <i>th</i>ree&nbsp;four<p hidden>no<p>five <script>if (a < b) "</p>"</script>six <b>seven<p>eight</b> nine</p></i>ten < 5 <a href='x>y' title="it's">link</a>
    <style>p {}</style><ul><li>x<li>y</ul><div style="display: none">no</div><pre>  k
    l</pre></article>"""
    assert main_text.main_text(page) == "a <b> &amp; éAé\none two three four\nfive six seven\neight nine\nten < 5 link\nx\ny\nk l"


@pytest.mark.parametrize("page", [None, "", " ", "<p", "<!--", "<script>x", "</p>", "<nav>only a menu</nav>", "<title>t</title>", "<div class=ad>buy</div>"])
def test_pages_without_text(page):
    assert main_text.main_text(page) == ""


def test_open_ends_and_plain_texts():
    assert main_text.main_text("just text &amp more") == "just text & more"
    assert main_text.main_text("<p>one<p>two <b") == "one\ntwo"
    assert main_text.main_text('<p title="open>one</p><p>two') == "one\ntwo"


@pytest.mark.parametrize("piece", ["<div>", "<b>", "<p>x", "<a ' ", "<a \">", "<!-", "<li><ul>", "</div>", "<script>", "<table><td>", "&", "<form>", "<i></b>"])
def test_hostile_pages_take_no_more_than_their_length(piece):
    began = time.time()
    main_text.main_text("<article><p>text</p>" + piece * 50_000 + "x</article>")
    assert time.time() - began < 8


def test_main_text_rows(spark, small_dir):
    got = {r.page_id: r for r in llm_queries.op13_main_text(spark, small_dir).collect()}
    pages = table(spark, small_dir, "pages").collect()
    assert len(got) == len(pages)
    for r in pages:
        blocks = [re.sub("<br>|</?b>", " ", x) for x in re.split("</?(?:h1|p)>", re.search("(?s)<article>(.*)</article>", r.html)[1])]
        assert got[r.page_id].text == "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url
    odd = spark.createDataFrame([(None, None, None, 1), (3, "u", "<p>a", 2), (3, "u", "<p>a", 2)], "page_id long, url string, html string, text int")
    out = main_text.extract(odd)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, out.collect()), key=repr) == [(3, "u", "a", 1), (3, "u", "a", 1), (None, None, "", 0)]
    assert main_text.extract(odd.limit(0)).count() == 0
