"""Packing of documents into fixed windows by order-preserving dynamic programming.

Each input partition is one stream of tokens in its own order; nothing is shuffled. Cuts are chosen among document and
sentence ends so that padding plus the penalties of cut documents is least. With ``g(i) = f(i) + S(i)`` the cost of
ending a window at candidate j is ``width - S(j) + penalty(j) + min g(i)`` over the candidates within one width before j:
a sliding minimum, kept in a monotone queue. The stream is solved in blocks; the last windows of a block are left open
and solved again with what follows, so memory stays bounded whatever the partition holds.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from potsherd.llm import tokens
from potsherd.llm.common import col, whole_text
from potsherd.llm.workers import hold, thrifty

WIDTH = 2048
#: Id after each document.
END_ID = 1
#: Padding tokens that a cut at a sentence's end, or at any other token, is held to be worth.
SENTENCE, ANYWHERE = 4, 24
#: A sentence of more tokens than the first may also be cut within, after each so many tokens as the second.
LONG_SENTENCE, STEP = 64, 32
#: Windows solved together, and the last ones that are solved again with the next block.
BLOCK, OPEN = 256, 8
#: Characters tokenised at once.
CHARS = 400_000

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def choose_cuts(ends: np.ndarray, penalties: np.ndarray, width: int) -> np.ndarray:
    """Window ends among ``ends`` (increasing, at most ``width`` apart, from 0) that reach the last one at least cost."""
    places, weights = [0, *ends.tolist()], [0, *penalties.tolist()]
    best, back = [0.0] * len(places), [0] * len(places)
    queue: deque[int] = deque([0])
    g = [0.0] * len(places)
    for j in range(1, len(places)):
        here = places[j]
        low = here - width
        while places[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        back[j] = i
        best[j] = cost = width - here + g[i] + weights[j]
        g[j] = value = cost + here
        while queue and g[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(places) - 1
    while j:
        cuts.append(places[j])
        j = back[j]
    return np.array(cuts[::-1], np.int64)


def candidates(total: int, documents: np.ndarray, sentences: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end and their penalties; long sentences also offer places within."""
    ends = np.union1d(documents, sentences)
    ends = ends[(ends > 0) & (ends <= total)]
    if not len(ends) or ends[-1] != total:
        ends = np.append(ends, total)
    gaps = np.diff(ends, prepend=0)
    far = np.flatnonzero(gaps > min(LONG_SENTENCE, width))
    if len(far):
        step = min(STEP, width)
        inside = (gaps[far] - 1) // step
        more = np.repeat(ends[far] - gaps[far], inside) + step * (np.arange(inside.sum()) - np.repeat(np.cumsum(inside) - inside, inside) + 1)
        ends = np.union1d(ends, more)
    penalties = np.full(len(ends), ANYWHERE)
    penalties[np.isin(ends, sentences)] = SENTENCE
    penalties[np.isin(ends, documents)] = 0
    return ends, penalties


def split_tail(length: int, width: int) -> list[int]:
    """Lengths of the windows that end the stream: one padded to ``width``, or powers of two, which need no padding."""
    powers = [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]
    return powers if (len(powers) - 1) * ANYWHERE < width - length else [length]


class Packer:
    """The open part of one stream: ids, its documents and sentence ends, counted from the first open id."""

    def __init__(self, width: int, end_id: int, first_sequence: int):
        self.width, self.end_id, self.sequence = width, end_id, first_sequence
        self.ids = np.empty(0, np.uint32)
        self.sentences = np.empty(0, np.int64)
        self.starts = np.empty(0, np.int64)  # of documents; the first may have begun before the open part
        self.sizes = np.empty(0, np.int64)
        self.doc_ids: list[int | None] = []
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray, list]] = []
        self.length = 0

    def add(self, doc_ids: list, texts: list[str], path: str) -> None:
        flat, sizes, sentences = tokens.encode(texts, path)
        whole = np.cumsum(sizes)
        ids = np.insert(flat, whole, self.end_id)
        sentences = sentences + np.searchsorted(whole, sentences, "left")
        self.waiting.append((ids, sizes + 1, sentences, doc_ids))
        self.length += len(ids)

    def _gather(self) -> None:
        at, ids, sentences, sizes = len(self.ids), [self.ids], [self.sentences], [self.sizes]
        starts = [self.starts]
        for more, size, ends, doc_ids in self.waiting:
            ids.append(more)
            sentences.append(ends + at)
            starts.append(at + np.cumsum(size) - size)
            sizes.append(size)
            self.doc_ids += doc_ids
            at += len(more)
        self.ids, self.sentences, self.sizes, self.starts = map(np.concatenate, (ids, sentences, sizes, starts))
        self.waiting = []

    def solve(self, last: bool) -> pa.RecordBatch | None:
        self._gather()
        if not len(self.ids):
            return None
        ends, penalties = candidates(len(self.ids), self.starts + self.sizes, self.sentences, self.width)
        cuts = choose_cuts(ends, penalties, self.width)
        if last:
            before = int(cuts[-2]) if len(cuts) > 1 else 0
            cuts = np.append(cuts[:-1], before + np.cumsum(split_tail(int(cuts[-1]) - before, self.width)))
        else:
            cuts = cuts[:-OPEN]
        return self._emit(cuts) if len(cuts) else None

    def _emit(self, cuts: np.ndarray) -> pa.RecordBatch:
        done = int(cuts[-1])
        begins = np.union1d(np.r_[0, cuts[:-1]], self.starts[(self.starts > 0) & (self.starts < done)])
        lengths = np.diff(begins, append=done)
        doc = np.searchsorted(self.starts, begins, "right") - 1
        window = np.searchsorted(cuts, begins, "right")
        opened = np.r_[0, cuts[:-1]][window]
        offsets = np.append(begins, done) * 4
        out = pa.RecordBatch.from_arrays(
            [
                pa.array(self.doc_ids, pa.int64()).take(pa.array(doc)),
                pa.array(begins - self.starts[doc]),
                pa.array(lengths),
                pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(self.ids[:done].astype("<u4").tobytes())]),
                pa.array(self.sizes[doc]),
                pa.array(self.sequence + window),
                pa.array(begins - opened),
            ],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )
        self.sequence += len(cuts)
        open_from = int(np.searchsorted(self.starts + self.sizes, done, "right"))
        self.starts, self.sizes, self.doc_ids = self.starts[open_from:] - done, self.sizes[open_from:], self.doc_ids[open_from:]
        self.ids, self.sentences = self.ids[done:], self.sentences[self.sentences > done] - done
        self.length = len(self.ids)
        return out


def pack(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file that every executor has. Each document is its ids and ``end_id``; a
    null or empty text is ``end_id`` alone. Each id lies in exactly one piece, the pieces of a sequence fill it from 0
    without gaps, and documents keep the order of their partition. A null doc_id stays null, repeated rows are packed
    as often as they occur, extra columns play no part, and no rows give no pieces. Only the last windows of a
    partition are filled at will: they are padded, or cut into powers of two if that costs less.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold(tokens.pieces.cache_clear)
        packer = Packer(width, end_id, (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            chars = np.cumsum(np.diff(np.frombuffer(texts.cast(pa.large_binary()).buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]))
            cut = [0, *(np.searchsorted(chars, np.arange(CHARS, int(chars[-1]) if len(chars) else 0, CHARS), "left") + 1).tolist(), len(texts)]
            for a, b in zip(cut, cut[1:], strict=False):
                if b > a:
                    packer.add(keys.slice(a, b - a).to_pylist(), texts.slice(a, b - a).to_pylist(), tokenizer)
                    if packer.length >= BLOCK * width and (out := packer.solve(False)) is not None:
                        yield out
        if (out := packer.solve(True)) is not None:
            yield out

    return docs.select(col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")).mapInArrow(thrifty(run, keeps=True), SCHEMA)


def with_checksums(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
