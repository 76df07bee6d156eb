"""Token ids of texts by a public word-BPE tokenizer, with a table of known pieces for each Python worker.

The tokenizer drops white space and never merges across it, so a text's ids are those of its pieces between spaces, one
after the other. Pieces are found and hashed by numpy and looked up together; only unknown ones reach the tokenizer.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np

from potsherd.llm import chars

#: Pieces, and words within them, that a worker remembers at most; beyond that it starts anew.
PIECES, WORDS = 500_000, 100_000
#: Pieces of these letters only and of common marks are taken apart here, by the tokenizer's own pattern; all others go through it whole.
PLAIN = re.compile(r"[!-;=-~À-ÖØ-öø-įĲ-ſ]*")
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-įĲ-ſ]+|[0-9]|[^a-zß-öø-įĲ-ſ0-9]+")
#: Last characters of a sentence.
STOPS = ".!?。"


def byte_letters() -> dict[int, str]:
    """The tokenizer's letter for each byte: printable ones stand for themselves, the rest follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Pieces:
    """Known pieces by hash, in a table with open addressing; the ids of all lie in one array."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.words: dict[str, list[int]] = {}
        self.room = 1 << (4 * PIECES).bit_length() - 1
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(self.room, np.uint64)
        self.values = np.zeros(self.room, np.int32)
        self.flat = np.empty(1 << 16, np.uint32)
        self.used = self.n = 0
        self.starts, self.sizes = np.empty(PIECES, np.int32), np.empty(PIECES, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each piece, -1 if unknown."""
        mask = np.uint64(self.room - 1)
        slots = hashes & mask
        out = np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        while len(left):
            there = self.keys[slots[left]]
            hit = there == hashes[left]
            out[left[hit]] = self.values[slots[left[hit]]]
            left = left[~hit & (there != 0)]
            slots[left] = (slots[left] + np.uint64(1)) & mask
        return out

    def insert(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        mask = np.uint64(self.room - 1)
        slots = hashes & mask
        left = np.arange(len(hashes))
        while len(left):
            at = slots[left]
            free = self.keys[at] == 0
            self.keys[at[free]] = hashes[left[free]]
            own = self.keys[at] == hashes[left]
            self.values[at[own]] = numbers[left[own]]
            left = left[~own]
            slots[left] = (slots[left] + np.uint64(1)) & mask

    def ids(self, piece: str) -> list[int]:
        lower = piece.lower()
        if (got := self.words.get(lower)) is not None:
            return got
        if piece[-1] in ",." and piece[-2:-1].isalpha() and (got := self.words.get(lower[:-1])) is not None:
            return got + self.spell(piece[-1])
        if not PLAIN.fullmatch(piece):
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        return [i for part in PARTS.findall(lower) for i in self.spell(part)]

    def spell(self, part: str) -> list[int]:
        got = self.words.get(part)
        if got is None:
            spelled = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            got = self.words[part] = [t.id for t in self.model.tokenize(spelled)]
        return got

    def learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        if self.n + len(pieces) > len(self.starts):
            grown = np.empty((2, 2 * (self.n + len(pieces))), np.int32)
            grown[0, : self.n], grown[1, : self.n] = self.starts[: self.n], self.sizes[: self.n]
            self.starts, self.sizes = grown
        if len(self.words) > WORDS:
            self.words.clear()
        found = [self.ids(p) for p in pieces]
        flat = np.array([i for f in found for i in f], np.uint32)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(len(self.flat), np.uint32)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.starts[self.n : self.n + len(found)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[self.n : self.n + len(found)] = sizes
        self.insert(hashes, np.arange(self.n, self.n + len(found)))
        self.used, self.n = self.used + len(flat), self.n + len(found)


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts in a row, the number of ids of each text, and the places in the ids that end a sentence."""
    known = pieces(path)
    joined = "\n".join(texts) + "\n"
    codes = chars.code_points(joined)
    begins, ends = chars.runs((codes != 32) & ((codes < 9) | (codes > 13)))
    hashes = chars.span_hashes(codes, begins, ends)
    hashes[hashes == 0] = 1
    if known.n > PIECES or known.n + len(hashes) > known.room // 2:
        known.forget()
        while len(hashes) > known.room // 4:  # one very long text
            known.room *= 2
            known.forget()
    at = known.find(hashes)
    lost = np.flatnonzero(at < 0)
    if len(lost):
        new, first = np.unique(hashes[lost], return_index=True)
        where = lost[first]
        known.learn(new, [joined[a:b] for a, b in zip(begins[where].tolist(), ends[where].tolist(), strict=True)])
        at[lost] = known.find(hashes[lost])
    sizes = known.sizes[at].astype(np.int64)
    over = np.cumsum(sizes)
    flat = known.flat[np.repeat(known.starts[at] - (over - sizes), sizes) + np.arange(int(over[-1]) if len(over) else 0)]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    closed = np.searchsorted(begins, np.cumsum(lengths + 1) - 1)
    upto = np.r_[0, over][closed]
    stop = np.isin(codes[ends - 1], list(map(ord, STOPS))) | (codes[ends] == 10)
    return flat, np.diff(upto, prepend=0), over[stop]
