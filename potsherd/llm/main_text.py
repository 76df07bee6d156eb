"""Main text of web pages by composite text density.

A page becomes a tree of blocks whose leaves are runs of text. Each node has a density, its characters per tag weighed down
by its links; the node whose children's densities add up to most is the article's, grown to the article element around it
or else by those parts beside its path to the body that are no thinner than the thinnest node on that path.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from potsherd.llm.common import col
from potsherd.llm.workers import thrifty

# Elements of HTML by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
UNSEEN = frozenset("svg math canvas object audio video".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a start tag ends, and where the search for it stops.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})} | dict.fromkeys(
    ("thead", "tbody", "tfoot"), ({"thead", "tbody", "tfoot"}, {"table"})
)
#: An end tag or a paragraph's implied end is not looked for beyond these.
SCOPES = frozenset("table td th caption".split())
#: Elements, roles and words of class names and ids that no article's text is in.
ASIDE = frozenset("nav footer aside form button select dialog menu legend datalist search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adbox sponsor sponsored sponsors promo promos promotion outbrain taboola sidebar sidebars widget widgets menu menus nav navbar navigation "
    "breadcrumb breadcrumbs crumbs pager pagination paginator footer masthead topbar toolbar banner cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup "
    "login signin share sharing social related recommended recommendations trending popular skip search searchform copyright disclaimer tagcloud".split()
)
COMMENTS = frozenset("comment comments commentlist commentary disqus reply replies respond responses discussion".split())
#: A class name with one of these first says something about the page, and these make a header the article's own.
ABOUT, OWN = frozenset("has no with without is not js hide show".split()), frozenset("article post entry content story page main".split())

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""")
REMARKS = re.compile(r"\W*\d*\s*(?:reader |readers' )?(?:comments?|responses|replies)\s*(?:\(?\d+\)?)?\W*", re.I)


def unwanted(tag: str, attributes: dict[str, str], within: bool) -> int:
    """2 for what isn't shown, 1 for what belongs to no article, else 0; ``within`` an article, headers are its own."""
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I):
        return 2
    if tag in ASIDE or tag == "header" and not within or attributes.get("role", "").lower() in ROLES or attributes.get("itemprop") == "comment":
        return 1
    if tag in HEADINGS:
        return 0
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = re.findall("[a-z]+", re.sub("([a-z])([A-Z])", r"\1 \2", name).lower())
        if not words or words[0] in ABOUT:
            continue
        if not COMMENTS.isdisjoint(words):
            return 1
        if tag not in ("article", "main", "body") and (not WORDS.isdisjoint(words) or "header" in words and not within and OWN.isdisjoint(words)):
            return 1
    return 0


class Page:
    """Blocks of a page in the order of its source: parents, tags and counts by number, and the runs of text."""

    def __init__(self, source: str):
        self.source, self.title = source, ""
        self.parent, self.tag, self.landmark = [-1], ["body"], [""]
        self.leaves: list[tuple[int, str, int, int, int]] = []  # node, text, its characters in links, its tags, links among them
        self.all_chars = self.all_links = 0
        self.stack: list[tuple[str, int, int, bool]] = [("body", 0, 0, False)]  # tag, node, what is unwanted there, in an article
        self.run: list[str] = []
        self.linked: list[str] = []
        self.tags = self.links = 0
        self.anchors = 0
        self.opened: Counter[str] = Counter()
        self.wrapper_seen = False
        self.read()

    def read(self) -> None:
        source, at, last, pattern = self.source, 0, self.source.rfind(">"), TAG
        while True:
            begin = source.find("<", at)
            if begin < 0 or begin > last:
                # without a later '>' only an open tag or comment is left, which is no text
                self.text(source[at:] if begin < 0 or not re.match("[a-zA-Z!?/]", source[begin + 1 : begin + 2]) else source[at:begin])
                break
            after = source[begin + 1 : begin + 2]
            if after.isalpha() and after.isascii() or after == "/" and source[begin + 2 : begin + 3].isalpha():
                self.text(source[at:begin])
                found = pattern.match(source, begin)
                if not found:
                    pattern = PLAIN_TAG  # a quote is left open: from here on a tag ends at the first '>'
                    found = pattern.match(source, begin)
                if not found:
                    break
                at = found.end()
                tag = found[2].lower()
                if found[1]:
                    self.close(tag)
                else:
                    self.open(tag, found[3])
                    if tag in RAW:
                        stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
                        if tag == "title" and not self.title:
                            self.title = " ".join(html.unescape(source[at : stop.start() if stop else len(source)]).split())
                        self.pop()
                        if not stop:
                            break
                        end = source.find(">", stop.end())
                        if end < 0:
                            break
                        at = end + 1
            elif after in ("!", "?", "/"):
                self.text(source[at:begin])
                comment = source.startswith("<!--", begin)
                end = source.find("-->", begin + 4) if comment else source.find(">", begin)
                if end < 0:
                    break
                at = end + (3 if comment else 1)
            else:
                self.text(source[at : begin + 1])
                at = begin + 1
        self.flush()

    def text(self, piece: str) -> None:
        state = self.stack[-1][2]
        if not piece or state == 2:
            return
        piece = html.unescape(piece) if "&" in piece else piece
        if state:
            n = len(" ".join(piece.split()))
            self.all_chars += n
            self.all_links += n if self.anchors else 0
        else:
            self.run.append(piece)
            if self.anchors:
                self.linked.append(piece)

    def flush(self) -> None:
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                linked = min(len(text), len(" ".join("".join(self.linked).split())))
                self.all_chars += len(text)
                self.all_links += linked
                self.leaves.append((self.here(), text, linked, self.tags, self.links))
            self.run, self.linked = [], []
        self.tags = self.links = 0

    def here(self) -> int:
        return self.stack[-1][1]

    def pop(self) -> None:
        tag = self.stack.pop()[0]
        self.opened[tag] -= 1
        self.anchors -= tag == "a"

    def end(self, tags: set[str] | frozenset[str], stops: set[str] | frozenset[str]) -> bool:
        """Close the innermost element of these tags, and all within it, unless one of the stops is met first."""
        opened = self.opened
        if not any(opened[x] for x in tags):
            return False
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[k][0]
            if tag in tags:
                self.flush()
                while len(self.stack) > k:
                    self.pop()
                return True
            if tag in stops:
                return False
        return False

    def open(self, tag: str, rest: str) -> None:
        if tag in ("html", "head", "body"):
            return
        block = tag in BLOCKS
        if block:
            self.flush()
            if tag in ENDS:
                self.end(*ENDS[tag])
            elif tag in HEADINGS:
                self.end(HEADINGS, BLOCKS - HEADINGS)
            if tag not in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend", "summary"):
                self.end({"p"}, SCOPES)
        if tag == "br":
            self.run.append(" ")
        if tag in VOID:
            if self.stack[-1][2] == 0 and not block:
                self.tags += 1
            return
        _, node, state, within = self.stack[-1]
        attributes, landmark = {}, ""
        if state:  # what is left out is left out with all that it holds
            own = 2 if tag in RAW or tag in UNSEEN else 0
        else:
            if "=" in rest or "hidden" in rest:
                for name, value in ATTRIBUTE.findall(rest):
                    attributes.setdefault(name.lower(), html.unescape(value.strip("\"'")))
            landmark = "article" if tag == "article" or attributes.get("itemprop") == "articleBody" else "main" if tag == "main" or attributes.get("role") == "main" else ""
            own = 2 if tag in RAW or tag in UNSEEN else unwanted(tag, attributes, within) if attributes else int(tag in ASIDE or tag == "header" and not within)
        if tag == "form" and own == 1 and node == 0 and not self.wrapper_seen:
            self.wrapper_seen = True
            own = 0 if self.wraps() else 1
        state = max(state, own)
        if tag == "a":
            self.anchors += 1
        if state == 0:
            if block:
                self.parent.append(node)
                self.tag.append(tag)
                self.landmark.append(landmark)
                node = len(self.tag) - 1
            else:
                self.tags += 1
                self.links += tag == "a"
        self.stack.append((tag, node, state, within or bool(landmark)))
        self.opened[tag] += 1

    def wraps(self) -> bool:
        """Whether the page's first form is one around the whole page, as some servers write it."""
        begin = re.search(r"<form\b", self.source, re.I).start()
        return bool(re.search(r"<(?:article|main|h1)\b", self.source[begin : self.source.lower().find("</form", begin)], re.I))

    def close(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end(HEADINGS if tag in HEADINGS else {tag}, SCOPES - {tag} if tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html") else frozenset() if tag == "table" else {"table"})
            return
        # markup within lines: that element alone ends, blocks inside it go on
        for k in range(len(self.stack) - 1, 0, -1) if self.opened[tag] else ():
            if self.stack[k][0] == tag:
                self.anchors -= tag == "a"
                self.opened[tag] -= 1
                del self.stack[k]
                return

    def menus(self) -> list[bool]:
        """Which nodes are, or are in, lists of three links or more with hardly a word besides."""
        n = len(self.tag)
        chars, linked, links = [0] * n, [0] * n, [0] * n
        for node, text, lc, _, lt in self.leaves:
            chars[node] += len(text)
            linked[node] += lc
            links[node] += lt
        for k in range(n - 1, 0, -1):
            for counts in (chars, linked, links):
                counts[self.parent[k]] += counts[k]
        found = [False] * n
        for k in range(1, n):
            found[k] = found[self.parent[k]] or self.tag[k] in ("ul", "ol", "dl", "div", "table", "section") and links[k] >= 3 and 5 * linked[k] >= 4 * chars[k]
        return found

    def main_text(self) -> str:
        n, menus = len(self.tag), self.menus()
        chars, linked, tags, links, depth_sum, last = [0] * n, [0] * n, [0] * n, [0] * n, [0.0] * n, list(range(n))
        page_share = self.all_links / max(1, self.all_chars)

        def density(c: int, lc: int, t: int, lt: int) -> float:
            """Characters per tag times the logarithm of unlinked shares, to a base that grows with the links (the published form, its logarithms at least those of e)."""
            if not c:
                return 0.0
            base = c / max(1, c - lc) * lc + page_share * c + math.e
            return c / max(1, t) * math.log1p(c / max(1, lc) * max(1, t) / max(1, lt)) / max(1.0, math.log(base))

        for node, text, lc, t, lt in self.leaves:
            if menus[node]:
                continue
            chars[node] += len(text)
            linked[node] += lc
            tags[node] += t
            links[node] += lt
            depth_sum[node] += density(len(text), lc, t, lt)
        dense = [0.0] * n
        for k in range(n - 1, -1, -1):  # children come after their parents
            dense[k] = density(chars[k], linked[k], tags[k], links[k])
            if (up := self.parent[k]) >= 0:
                chars[up] += chars[k]
                linked[up] += linked[k]
                tags[up] += tags[k] + (not menus[k])
                links[up] += links[k]
                depth_sum[up] += dense[k]
                last[up] = max(last[up], last[k])
        if not chars[0]:
            return ""
        best = 0
        for k in range(1, n):
            if depth_sum[k] > depth_sum[best] or depth_sum[k] == depth_sum[best] and k <= last[best]:
                best = k
        path = [best]
        while path[-1]:
            path.append(self.parent[path[-1]])
        marked = [k for kind in ("article", "main") for k in reversed(path) if self.landmark[k] == kind]
        threshold = min(dense[k] for k in path)
        kept, on_path = {marked[0] if marked else best}, set(path)
        loose = set()
        if not marked:
            first: dict[int, str] = {}
            for node, text, *_ in self.leaves:
                first.setdefault(node, text)
            for k in range(1, n):
                if k not in on_path and self.parent[k] in on_path and self.parent[k] != best and chars[k]:
                    titled = self.tag[k] in HEADINGS and len(head := first.get(k, "").casefold()) > 2 and (head in self.title.casefold() or self.title and self.title.casefold() in head)
                    if titled or dense[k] >= threshold and 2 * linked[k] < chars[k]:
                        kept.add(k)
            loose = {k for k in path if k != best}
        heads = {}
        for node, text, *_ in self.leaves:
            for up in (node, self.parent[node]):
                if up >= 0 and up not in heads and node <= last[up]:
                    heads[up] = (self.tag[node], text)
        inside = [False] * n
        for k in range(n):
            up = self.parent[k]
            inside[k] = k in kept or up >= 0 and inside[up]
            if inside[k] and k not in kept:
                remarks = self.tag[k] in ("section", "div", "ol", "ul") and heads.get(k, ("", ""))[0] in HEADINGS and REMARKS.fullmatch(heads[k][1])
                inside[k] = not (menus[k] or remarks)
        return "\n".join(text for node, text, lc, t, lt in self.leaves if inside[node] or node in loose and not menus[node] and density(len(text), lc, t, lt) >= threshold and 2 * lc < len(text))


def main_text(source: str | None) -> str:
    """The main text of one page, empty if it has none."""
    return Page(source).main_text() if source else ""


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            piece = batch.slice(k, 256)
            texts = [main_text(x) for x in piece.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of each page: its article's blocks in order, one on a line.

    Left out are elements, roles and class names of menus, headers, footers, sidebars, notices, adverts, forms and comments
    (the sets above), what isn't shown, lists of links, and what lies beside the subtree of the greatest density sum unless
    an article or main element holds both or its density reaches the least one on the path to the body. Broken markup is
    read as browsers do: a paragraph ends at the next block, an end tag without its start is nothing, comments and scripts
    left open last to the page's end, a line break within a block is white space. Equal sums: the inner node, else the
    first. Null and empty pages, and those without an article, have an empty text; ids and addresses may be null; repeated
    rows give repeated results, extra columns play no part, no pages give no rows. Pages are read whole, in time that grows
    with their length and the depth of open elements. Nothing is shuffled, a page lies in one row.
    """
    rows = pages.select(col(page_id).alias("page_id"), col(url).cast("string").alias("url"), F.coalesce(col(html).cast("string"), F.lit("")).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(thrifty(_texts), f"page_id {kind}, url string, text string, n_chars long")
