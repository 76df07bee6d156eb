"""Texts as arrays of code points, so that a batch's words are found and hashed by a few numpy passes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

#: Multipliers of the polynomial hash modulo 2**64 and of its mixing steps.
BASE, SPREAD, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD
#: Characters that are handled together.
CHARS = 400_000

_powers = np.ones((2, 1), np.uint64)


def powers(n: int) -> np.ndarray:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    global _powers
    if _powers.shape[1] < n:
        steps = np.empty((2, max(n, 2 * CHARS)), np.uint64)
        steps[:, 0], steps[0, 1:], steps[1, 1:] = 1, BASE, pow(BASE, -1, 1 << 64)
        _powers = np.cumprod(steps, axis=1, dtype=np.uint64)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits (a bijection of 64-bit numbers)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(MIX)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(SPREAD)
    return h ^ (h >> np.uint64(32))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def span_hashes(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans; equal spans have equal hashes wherever they stand."""
    forward, backward = powers(len(codes) + 1)[:, : len(codes) + 1]
    values = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(SPREAD)
    values ^= values >> np.uint64(32)
    values *= forward[:-1]
    sums = np.empty(len(codes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values, out=sums[1:])
    return mix((sums[ends] - sums[begins]) * backward[begins])


@cache
def word_table() -> np.ndarray:
    """For each code point below 2**17 whether it belongs to a word: letters, marks, digits and the underscore."""
    import regex

    table = np.zeros(1 << 17, bool)
    for m in regex.finditer(r"[\p{L}\p{M}\p{N}_]+", "".join(map(chr, [*range(0xD800), *[0x20] * 0x800, *range(0xE000, 1 << 17)]))):
        table[m.start() : m.end()] = True
    return table


def is_word(codes: np.ndarray) -> np.ndarray:
    return word_table()[np.minimum(codes, (1 << 17) - 1)]


def batches(sizes: np.ndarray, most: int = CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about ``most`` characters each; a longer text is a range of its own."""
    if not len(sizes):
        return
    block = (np.cumsum(sizes) - sizes) // most
    edges = np.flatnonzero(np.diff(block, prepend=-1))
    yield from zip(edges.tolist(), [*edges[1:].tolist(), len(sizes)], strict=True)


class Words:
    """The words of a list of texts, lower-cased: ``hashes`` in order and ``bounds``, so that text k has the words from bounds[k] to bounds[k+1]."""

    def __init__(self, texts: list[str]):
        lowered = [t.lower() for t in texts]
        self.sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
        self.codes = code_points("\n".join(lowered) + "\n")
        self.begins, self.ends = runs(is_word(self.codes))
        starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.bounds = np.append(np.searchsorted(self.begins, starts), len(self.begins))
        self.starts = starts
        self.hashes = span_hashes(self.codes, self.begins, self.ends)

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each n consecutive words within a text and the text of each; a text of fewer words has one of them all."""
        counts = np.diff(self.bounds)
        forward = powers(n)[0]
        h, total = self.hashes, len(self.hashes)
        rolled = np.zeros(max(total - n + 1, 0), np.uint64)
        for k in range(n):
            rolled += h[k : k + len(rolled)] * forward[k]
        text = np.repeat(np.arange(len(counts)), counts)
        at = np.flatnonzero(text[: len(rolled)] == text[n - 1 : n - 1 + len(rolled)])
        out, owner = mix(rolled[at]), text[at]
        few = np.flatnonzero((counts > 0) & (counts < n))
        if len(few):
            part = np.array([(h[self.bounds[k] : self.bounds[k + 1]] * forward[: counts[k]]).sum(dtype=np.uint64) for k in few], np.uint64)
            out, owner = np.r_[out, mix(part + np.uint64(1))], np.r_[owner, few]
            order = np.argsort(owner, kind="stable")
            out, owner = out[order], owner[order]
        return out, owner
