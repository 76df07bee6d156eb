"""WARC derivative builder: response records become linked metadata and plain-text conversion records.

Every derivative refers to its response by WARC-Refers-To and repeats the response's target URI, date and digests, so it
can be checked against its source. Identifiers are derived from the source, so building again gives the same records.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potsherd.llm.common import col, whole_text

VERSION, BREAK = "WARC/1.1", "\r\n"
#: Time of capture where the source has none.
DATE = "2024-01-01T00:00:00Z"

#: Elements whose whole content is no text, and elements that end a line.
HIDDEN = ("script", "style", "template", "noscript", "svg")
BLOCKS = (
    "address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "head", "header", "hr", "html", "li", "main", "nav", "ol", "option", "p", "pre", "section", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
)
#: Named character references that are resolved, besides those of accented letters.
NAMED = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&", "nbsp": " ", "copy": "©", "reg": "®", "trade": "™", "middot": "·", "bull": "•", "hellip": "…", "mdash": "—", "ndash": "–",
    "laquo": "«", "raquo": "»", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "euro": "€", "pound": "£", "yen": "¥", "cent": "¢", "sect": "§", "para": "¶", "deg": "°", "plusmn": "±",
    "times": "×", "divide": "÷", "frac12": "½", "frac14": "¼", "szlig": "ß", "aelig": "æ", "AElig": "Æ", "oslash": "ø", "Oslash": "Ø", "iexcl": "¡", "iquest": "¿",
}
#: The letters that each accent's references are made of, and the accent as a combining mark.
ACCENTS = {"acute": ("aeiouyAEIOUY", "\u0301"), "grave": ("aeiouAEIOU", "\u0300"), "circ": ("aeiouAEIOU", "\u0302"), "uml": ("aeiouyAEIOU", "\u0308"), "tilde": ("anoANO", "\u0303"), "cedil": ("cC", "\u0327"), "ring": ("aA", "\u030A")}
ENTITIES = NAMED | {letter + name: unicodedata.normalize("NFC", letter + mark) for name, (letters, mark) in ACCENTS.items() for letter in letters}

#: A reference after its ampersand: decimal, hexadecimal or by name.
REFERENCE = r"^(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,7});"
TAG = r"<[/!?a-zA-Z][^<>]*>"
LINED = rf"(?i)</?(?:{'|'.join(BLOCKS)})(\s[^<>]*)?/?>"


def resolve(text: Column) -> Column:
    """The text with its character references resolved, each once; unknown ones stay as they are."""
    table = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def character(name: Column) -> Column:
        number = F.when(F.substring(name, 2, 1).isin("x", "X"), F.conv(F.substring(name, 3, 8), 16, 10)).otherwise(F.substring(name, 2, 8)).cast("int")
        real = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number <= 0x10FFFF))
        coded = F.when(real, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
        return F.when(F.startswith(name, F.lit("#")), F.when(number == 160, " ").otherwise(coded)).otherwise(F.try_element_at(table, name))

    def part(piece: Column, k: Column) -> Column:
        name = F.substring_index(piece, ";", 1)
        found = F.when((k > 0) & piece.rlike(REFERENCE), character(name))
        return F.when(k == 0, piece).when(found.isNull(), F.concat(F.lit("&"), piece)).otherwise(F.concat(found, F.substr(piece, F.length(name) + 2)))

    return F.array_join(F.transform(F.split(text, "&", -1), part), "")


def squeeze(text: Column) -> Column:
    """No spaces at the ends of lines, one between words, no empty lines."""
    lines = F.regexp_replace(F.regexp_replace(text, r"[ \t\r\f\x0B]+", " "), r" ?\n[ \n]*", "\n")
    return F.regexp_replace(lines, r"\A[ \n]+|[ \n]+\z", "")


#: What is hidden: comments and some elements, to their ends or, left open, to the page's end; no part is tried twice.
SKIPPED = rf"(?is)<(?:!--(?:[^-]++|-(?!->))*+(?:-->)?|({'|'.join(HIDDEN)})[\s/>](?:[^<]++|<(?!/\1\s*+>))*+(?:</\1\s*+>)?|/(?:{'|'.join(HIDDEN)})\s*+>)"


def plain_text(html: Column) -> Column:
    """The text that a reader sees, one line for each block."""
    shown = F.regexp_replace(html, SKIPPED, " ")
    lined = F.regexp_replace(F.replace(shown, F.lit("\n"), F.lit(" ")), LINED, "\n")
    return squeeze(resolve(F.regexp_replace(lined, TAG, "")))


def title(html: Column) -> Column:
    """The content of the first title element; what is left open is none."""
    upto = F.split(html, r"(?i)</title\s*>", 2)
    inside = F.get(F.split(F.get(upto, 0), r"(?i)<title", 2), 1)
    content = F.when(F.contains(inside, F.lit(">")), F.substr(inside, F.instr(inside, ">") + 1))
    return squeeze(resolve(F.regexp_replace(F.replace(F.when(F.size(upto) > 1, F.coalesce(content, F.lit(""))).otherwise(""), F.lit("\n"), F.lit(" ")), TAG, "")))


def responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = DATE) -> DataFrame:
    """Pages as response records: page_id, record_id, target_uri, date, payload, block, payload_digest, block_digest.

    The block is an HTTP response with its header; the payload is the page.
    """
    body = whole_text(html)
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "), F.octet_length(body).cast("string"), F.lit(BREAK * 2))
    read = pages.select(
        col(page_id).cast("long").alias("page_id"),
        whole_text(url).alias("target_uri"),
        F.lit(date).alias("date"),
        body.alias("payload"),
        F.concat(head, body).alias("block"),
    )
    name = F.concat_ws(" ", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), "target_uri", "date", "payload_digest")
    return digested(read).select("page_id", record_id(name).alias("record_id"), "target_uri", "date", "payload", "block", "payload_digest", "block_digest")


def digested(read: DataFrame) -> DataFrame:
    digest = lambda c: F.concat(F.lit("sha256:"), F.sha2(c, 256))
    return read.withColumn("payload_digest", digest("payload")).withColumn("block_digest", digest("block"))


def record_id(name: Column) -> Column:
    """``<urn:uuid:...>`` from the digest of a name."""
    h = F.sha2(name, 256)
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-"), part(13, 4), F.lit("-"), part(17, 4), F.lit("-"), part(21, 12), F.lit(">"))


def headers(block: Column) -> Column:
    """The header of an HTTP response as an array of lines: ``http-status`` and one of each field, named in small letters with ``http-`` before."""
    lines = F.split(F.substring_index(block, BREAK * 2, 1), r"\r\n", -1)
    field = lambda x: F.concat(F.lit("http-"), F.lower(F.trim(F.substring_index(x, ":", 1))), F.lit(": "), F.trim(F.substr(x, F.instr(x, ":") + 1)))
    status = F.transform(F.filter(lines, lambda x: F.startswith(x, F.lit("HTTP/"))), lambda x: F.concat(F.lit("http-status: "), F.substr(x, F.instr(x, " ") + 1)))
    return F.concat(status, F.transform(F.filter(lines, lambda x: ~F.startswith(x, F.lit("HTTP/")) & F.contains(x, F.lit(":"))), field))


def derivatives(found: DataFrame) -> DataFrame:
    """Two records per response: page_id, record_type, record_id, refers_to, target_uri, date, content_type, block, block_digest, source_payload_digest, source_block_digest.

    ``found`` are responses as ``responses`` or ``warc_files.read_responses`` give them. The metadata record holds the source's fields,
    those of its HTTP header among them, as ``application/warc-fields``; the conversion record is the plain text. What is
    hidden (comments, scripts and the like) and left open is hidden to the page's end; a tag ends before the next one.
    Null pages are empty: their conversion has an empty block. A null id stays null, repeated pages give repeated
    records with equal identifiers, extra columns play no part, and no pages give no records. Pages are read whole, in
    time that grows with their length only. Nothing is shuffled.
    """
    links = F.regexp_count("payload", F.lit(r"(?i)<a\s[^<>]*href="))
    text = found.withColumn("plain", plain_text(F.col("payload")))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit(BREAK))
    fields = F.concat(
        F.array_join(F.transform(headers(F.col("block")), lambda x: F.concat(x, F.lit(BREAK))), ""),
        line("title", title(F.col("payload"))),
        line("outlinks", links.cast("string")),
        line("html-octets", F.octet_length("payload").cast("string")),
        line("text-octets", F.octet_length("plain").cast("string")),
        line("text-digest", F.concat(F.lit("sha256:"), F.sha2("plain", 256))),
    )
    both = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("plain").alias("block")),
    )
    each = text.select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", F.col("payload_digest").alias("source_payload_digest"), F.col("block_digest").alias("source_block_digest"), F.inline(both))
    return each.select(
        "page_id",
        "record_type",
        record_id(F.concat_ws(" ", "record_type", "refers_to")).alias("record_id"),
        "refers_to",
        "target_uri",
        "date",
        "content_type",
        "block",
        F.concat(F.lit("sha256:"), F.sha2("block", 256)).alias("block_digest"),
        "source_payload_digest",
        "source_block_digest",
    )


def serialised(records: DataFrame) -> DataFrame:
    """Each record as it stands in a file, without the two line breaks that end it: column ``value``. A header whose value is null is left out."""
    line = lambda key, value: F.coalesce(F.concat(F.lit(f"{key}: "), value, F.lit(BREAK)), F.lit(""))
    head = F.concat(
        F.lit(VERSION + BREAK),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Refers-To", F.col("refers_to")),
        line("WARC-Target-URI", F.regexp_replace("target_uri", r"[\x00-\x20]", "%20")),
        line("WARC-Date", F.col("date")),
        line("WARC-Block-Digest", F.col("block_digest")),
        line("WARC-Source-Payload-Digest", F.col("source_payload_digest")),
        line("WARC-Source-Block-Digest", F.col("source_block_digest")),
        line("Content-Type", F.col("content_type")),
        line("Content-Length", F.octet_length("block").cast("string")),
    )
    return records.select(F.concat(head, F.lit(BREAK), F.col("block")).alias("value"))


def write(records: DataFrame, path: str) -> None:
    """WARC files in a folder, one for each partition; a file that a lost executor left behind is not committed."""
    serialised(records).write.option("lineSep", BREAK * 2).option("compression", "gzip").text(path)
