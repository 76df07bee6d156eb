"""Reading WARC files by bytes: records end where their Content-Length says, whatever their blocks hold.

A file is read from its begin to its end, line by line, as a stream: of a compressed file nothing else is possible, and of
a plain one no range could tell a record's begin from a page that quotes one. Many files are many tasks.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from potsherd.llm.workers import thrifty

VERSION = re.compile(rb"WARC/\d+\.\d+\s*\Z")
#: Bytes of rows that are handed on together.
TOGETHER = 8_000_000
RECORD = "path string, version string, fields map<string,array<string>>, block binary, error string"


class Records:
    """Splits the lines of one file into records; ``done`` collects (version, fields, block, error)."""

    def __init__(self) -> None:
        self.done: list[tuple[str | None, list[tuple[str, list[str]]] | None, bytes | None, str | None]] = []
        self.state, self.head, self.held, self.have, self.need = "seek", [], [], 0, 0
        self.version, self.fields, self.stray = "", [], 0

    def line(self, line: bytes) -> None:
        """One line without its line feed."""
        waiting = [line]
        while waiting:
            one = waiting.pop()
            if self.state == "seek":
                self.seek(one)
            elif self.state == "head":
                self.header(one)
            else:
                self.held.append(one)
                self.have += len(one) + 1
                if self.have >= self.need + 2:
                    waiting += self.end()[::-1]

    def seek(self, line: bytes) -> None:
        if VERSION.match(line):
            self.told_stray()
            self.state, self.version, self.head = "head", line.strip().decode("latin-1"), []
        elif line.strip(b"\r"):
            self.stray += len(line) + 1

    def told_stray(self) -> None:
        if self.stray:
            self.done.append((None, None, None, f"{self.stray} bytes belong to no record"))
            self.stray = 0

    def header(self, line: bytes) -> None:
        line = line.removesuffix(b"\r")
        if line:
            if line[:1] in b" \t" and self.head:
                self.head[-1] += b" " + line.strip()
            else:
                self.head.append(line)
            return
        named: dict[str, list[str]] = {}
        for x in self.head:
            name, colon, value = x.partition(b":")
            if colon:
                named.setdefault(name.strip().decode("utf-8", "replace").lower(), []).append(value.strip().decode("utf-8", "replace"))
        self.fields = list(named.items())
        length = named.get("content-length", [""])[0]
        if not re.fullmatch(r"\d{1,18}", length):
            self.done.append((self.version, self.fields, None, "no Content-Length"))
            self.state = "seek"
            return
        self.state, self.need, self.held, self.have = "block", int(length), [], 0

    def end(self, last: bool = False) -> list[bytes]:
        """The block is whole, or the file is over; returns lines that are to be read again."""
        data = b"\n".join(self.held) + (b"" if last else b"\n")
        lines, self.held, self.state = self.held, [], "seek"
        block, rest = data[: self.need], data[self.need :]
        if len(block) == self.need and not rest.strip(b"\r\n"):
            self.done.append((self.version, self.fields, block, None))
            return []
        self.done.append((self.version, self.fields, None, "the block hasn't its Content-Length"))
        return lines  # a record that begins in what was taken for the block

    def close(self) -> None:
        for _ in range(1_000_000):  # each turn has a record less to look through
            if self.state != "block":
                break
            for line in self.end(last=True):
                self.line(line)
        if self.state == "head":
            self.done.append((self.version, None, None, "the header has no end"))
        self.told_stray()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path, reader, weight = None, Records(), 0

    def told() -> pa.RecordBatch:
        version, fields, block, error = zip(*reader.done, strict=True)
        reader.done = []
        kinds = (pa.string(), pa.map_(pa.string(), pa.list_(pa.string())), pa.binary(), pa.string())
        arrays = [pa.array([path] * len(version), pa.string()), *[pa.array(x, kind) for x, kind in zip((version, fields, block, error), kinds, strict=True)]]
        return pa.RecordBatch.from_arrays(arrays, names=["path", "version", "fields", "block", "error"])

    for batch in batches:
        for name, line in zip(batch.column("path").to_pylist(), batch.column("line").to_pylist(), strict=True):
            if name != path:
                reader.close()
                if reader.done:
                    yield told()
                path, reader, weight = name, Records(), 0
            before = len(reader.done)
            reader.line(line)
            if len(reader.done) > before:
                weight += sum(len(x[2] or b"") for x in reader.done[before:])
                if weight > TOGETHER or len(reader.done) > 4096:
                    yield told()
                    weight = 0
    reader.close()
    if reader.done:
        yield told()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """path, version, fields, block, error: the records of WARC files of any version, compressed or not.

    ``fields`` has a list of values for each name (in small letters), in order, as a header may stand more than once; a
    header that goes on in the next line is one. ``block`` are bytes, images and texts in any encoding alike. A record that
    has no Content-Length, or whose block doesn't end where it says, has an ``error`` and a null block, and the next
    record is looked for from there on, so a bad record costs itself only; bytes between records are told as such. Empty
    files have no records. A block must fit into memory.
    """
    read = spark.read.option("lineSep", "\n").text(path)
    rows = read.select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("line"), F.col("_metadata.file_block_start").alias("start"))
    if all(f.endswith(".gz") for f in read.inputFiles()):
        return rows.select("path", "line").mapInArrow(thrifty(_records), RECORD)  # these aren't cut into ranges
    # ranges of plain files come together again, each file in one task and in order
    placed = rows.withColumn("at", F.monotonically_increasing_id()).repartition("path").sortWithinPartitions("path", "start", "at")
    return placed.select("path", "line").mapInArrow(thrifty(_records), RECORD)


def charset(head: str, body: bytes) -> str:
    """The encoding that an HTTP header or the page itself names, UTF-8 otherwise."""
    found = re.search(r"(?im)^content-type:.*charset=[\"']?([\w.:-]+)", head) or re.search(r"(?i)<meta[^>]{0,200}charset=[\"']?([\w.:-]+)", body[:2048].decode("latin-1"))
    try:
        return codecs.lookup(found[1]).name if found else "utf-8"
    except LookupError:
        return "utf-8"


def _first(fields: list[tuple[str, list[str]]], name: str) -> str | None:
    return next((values[0] for key, values in fields if key == name), None)


def _responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "record_id", "target_uri", "date", "payload", "block", "payload_digest", "block_digest"]
    for batch in batches:
        for row in range(batch.num_rows):
            fields, block = batch.column("fields")[row].as_py(), batch.column("block")[row].as_py()
            head, _, body = block.partition(b"\r\n\r\n")
            top = head.decode("latin-1")
            kind = charset(top, body)
            text = body.decode(kind, "replace")
            digests = [_first(fields, f"warc-{x}-digest") or "sha256:" + hashlib.sha256(y).hexdigest() for x, y in (("payload", body), ("block", block))]
            values = [None, _first(fields, "warc-record-id"), _first(fields, "warc-target-uri") or "", _first(fields, "warc-date"), text, f"{top}\r\n\r\n{text}", *digests]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if n == "page_id" else pa.string()) for n, v in zip(names, values, strict=True)], names=names)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """The response records of WARC files, as ``warc.responses`` gives them (page_id is null): with their own identifiers, dates, HTTP headers and digests.

    Payloads become text by the encoding that they name, UTF-8 otherwise; what doesn't fit it becomes U+FFFD. Digests are
    those that the record states, or else SHA-256 of its bytes. Records with an error are left out (see ``read_records``).
    """
    kept = read_records(spark, path).where(F.col("error").isNull() & (F.get(F.try_element_at("fields", F.lit("warc-type")), F.lit(0)) == "response")).select("fields", "block")
    kinds = "page_id long, record_id string, target_uri string, date string, payload string, block string, payload_digest string, block_digest string"
    return kept.mapInArrow(thrifty(_responses), kinds)
