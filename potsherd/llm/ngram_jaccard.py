"""Similarity join of word n-gram sets by chosen paths.

Each run samples about BRANCH tokens that two similar sets can be expected to share, by one hash for all sets, and puts a
set into the bucket of each token it samples. Buckets with too many sets are split again on freshly sampled tokens. In what
is still large after DEPTH splits all sets are compared with a central one: those linked with it need no further links among
themselves, and what is further from it than two links can reach meets none of these. What then is left is dealt into
tiles, so that each pair of its blocks meets. Small buckets are compared by brute force: first by sketches, which give
groups, then by the sets themselves. Near copies meet in many buckets, so groups with the same central set are put together
and compared once, as large buckets are if they become too large. Runs repeat until the target recall.

Sets that are equal are one node. A bucket gives a spanning forest of its links and never all pairs, connected
components of these are the classes, and links are counted within the classes, on the sets' differences from one set of
their class. Sets within half a link's distance of that one are linked with each other and need only be counted; the
others are compared tile by tile.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potsherd.llm import chars
from potsherd.llm.common import Scratch, col, fresh, joinable, whole_text
from potsherd.llm.workers import thrifty

#: Words of an n-gram, and the similarity of a link.
NGRAM, SIMILARITY = 5, 0.8
#: Tokens that two linked sets are expected to share among those sampled in a run, at least; and the share of links to be found.
BRANCH, RECALL = 2.0, 0.99999
#: A bucket of more sets is split again, so often at most; and sets of a block of the tiles.
LEAF, DEPTH, BLOCK = 4096, 4, 2048
#: Sets that all others of a crowded bucket are compared with, one after the other, before the rest is dealt into tiles.
HEADS = 3
#: Tokens of a block at most, unless one set has more.
BLOCK_TOKENS = 1_000_000
#: Bits of a sketch, and standard deviations below the expected agreement at which a pair is still compared.
BITS, SLACK = 128, 5.5
SEED = 0xC0FFEE
#: Bytes of text that are handled together.
PIECE = 500_000

TABLE = "doc_id long, text_key long, node binary, size int, s0 long, s1 long, paths array<long>"


def multipliers(n: int, seed: int) -> np.ndarray:
    """Odd 64-bit numbers by a rule; each makes another hash of the (well mixed) tokens."""
    return chars.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(chars.BASE) + np.uint64(seed)) | np.uint64(1)


def runs_for(recall: float, branch: float, depth: int = DEPTH) -> int:
    """Runs after which two linked sets have met with the wanted probability.

    A run misses them with exp(-branch) where their buckets stay whole. Each split samples anew and may lose them again, so
    the chance is that of a branching process to die out within ``depth`` further levels.
    """
    miss = 0.0
    for _ in range(depth + 1):
        miss = math.exp(-branch * (1 - miss))
    return max(1, math.ceil(math.log1p(-recall) / math.log(miss)))


def token_sets(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of each text as sorted hashes without repeats, one after the other, and the bounds of each text."""
    hashes, owner = chars.Words(texts).shingles(n)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def rate(sizes: np.ndarray, branch: float, similarity: float) -> np.ndarray:
    """The largest hash that a set of each size samples."""
    return (np.minimum(branch / (similarity * np.maximum(sizes, 1)), 1) * float(2**64 - 2**12)).astype(np.uint64)


def segment_min(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.minimum.reduceat(values, starts) if len(starts) else values[:0]


def sketches(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """BITS one-bit min-hashes of each set (none of them empty), as two columns of 64-bit numbers."""
    out = np.zeros((2, len(starts)), np.uint64)
    for k, m in enumerate(multipliers(BITS, SEED)):
        bit = (segment_min(tokens * m, starts) >> np.uint64(11)) & np.uint64(1)
        out[k // 64] |= bit << np.uint64(k % 64)
    return out


def least_agreement(similarity: float) -> int:
    p = (1 + similarity) / 2
    return math.floor(BITS * p - SLACK * math.sqrt(BITS * p * (1 - p)))


def described(docs: DataFrame, n: int, similarity: float, branch: float, runs: int) -> DataFrame:
    """TABLE for each row of (doc_id, text_key, text): its node, size, sketch and the buckets that it samples."""
    seeds = multipliers(runs, SEED + 1)

    def describe(texts: list[str]) -> list[pa.Array]:
        tokens, bounds = token_sets(texts, n)
        sizes = np.diff(bounds)
        full = np.flatnonzero(sizes)
        starts = bounds[:-1][full]
        keys = np.zeros((len(texts), 2), np.uint64)
        sketch = np.zeros((2, len(texts)), np.uint64)
        if len(full):
            keys[full, 0] = np.add.reduceat(chars.mix(tokens), starts)
            keys[full, 1] = np.add.reduceat(chars.mix(tokens ^ np.uint64(chars.MIX)), starts)
            sketch[:, full] = sketches(tokens, starts)
        keys[:, 1] += sizes.astype(np.uint64) * np.uint64(chars.BASE)
        limit = np.repeat(rate(sizes, branch, similarity), sizes)
        owner = np.repeat(np.arange(len(texts)), sizes)
        chosen = [np.flatnonzero(tokens * s <= limit) for s in seeds]
        paths = np.concatenate([chars.mix(tokens[c] ^ s) for c, s in zip(chosen, seeds, strict=True)])
        of = np.concatenate([owner[c] for c in chosen])
        order = np.argsort(of, kind="stable")
        offsets = np.searchsorted(of[order], np.arange(len(texts) + 1)).astype(np.int32)
        raw = np.ascontiguousarray(keys).tobytes()
        return [
            pa.array([raw[16 * k : 16 * k + 16] for k in range(len(texts))], pa.binary()),
            pa.array(sizes.astype(np.int32)),
            pa.array(sketch[0].view(np.int64)),
            pa.array(sketch[1].view(np.int64)),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(paths[order].view(np.int64))),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), *describe(part.column("text").to_pylist())],
                    ["doc_id", "text_key", "node", "size", "s0", "s1", "paths"],
                )

    return docs.select("doc_id", "text_key", "text").mapInArrow(thrifty(run), TABLE)


def pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Ranges of a batch's rows with about PIECE bytes of text each."""
    yield from chars.batches(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64), PIECE)


def grouped(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups and the groups' bounds, from batches that are sorted by ``name`` (a long)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(name).to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))
        if held and held[-1].column(name)[-1].as_py() != keys[0]:
            yield bounded(held, name)
            held = []
        if last:
            yield bounded([*held, batch.slice(0, last)], name)
            held = []
        held.append(batch.slice(last))
    if held:
        yield bounded(held, name)


def bounded(held: list[pa.RecordBatch], name: str) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(held).combine_chunks()
    keys = table.column(name).to_numpy()
    return table, np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])


def sorted_by(df: DataFrame, name: str) -> DataFrame:
    return df.repartition(name).sortWithinPartitions(name)


def blocks(sizes: np.ndarray) -> np.ndarray:
    """A block number for each set, in order: at most BLOCK sets and about BLOCK_TOKENS tokens in each."""
    before = np.cumsum(sizes) - sizes
    return np.maximum(before // BLOCK_TOKENS, 0) + np.arange(len(sizes)) // BLOCK


def sketch_groups(s0: np.ndarray, s1: np.ndarray, sizes: np.ndarray, similarity: float) -> np.ndarray:
    """A group number for each set of a bucket: connected by sketches that agree enough and sizes that allow a link; -1 if alone."""
    agree, n = least_agreement(similarity), len(sizes)
    out = np.full(n, -1)
    left = np.arange(n)  # not reached yet
    groups = 0
    for root in range(n):
        if out[root] >= 0:
            continue
        todo, found = [root], False
        out[root] = groups
        left = left[left != root]
        while todo and len(left):
            k = todo.pop()
            apart = np.bitwise_count(s0[left] ^ s0[k]).astype(np.int64) + np.bitwise_count(s1[left] ^ s1[k])
            small, large = np.minimum(sizes[left], sizes[k]), np.maximum(sizes[left], sizes[k])
            near = (BITS - apart >= agree) & (small >= similarity * large - 1e-9)
            if near.any():
                found = True
                met = left[near]
                out[met] = groups
                todo += met.tolist()
                left = left[~near]
        if found:
            groups += 1
        else:
            out[root] = -1
    return out


def central(s0: np.ndarray, s1: np.ndarray, marks: np.ndarray) -> np.uint64:
    """The mark of the set whose sketch is nearest to what most of a group's sketches say; of several, the smallest."""
    bits = np.unpackbits(np.stack([s0, s1], axis=1).view(np.uint8), axis=1)
    agree = (bits == (2 * bits.sum(axis=0, dtype=np.int64) > len(bits))).sum(axis=1)
    return marks[agree == agree.max()].min()


def plausible(rows: DataFrame, similarity: float, merged: bool = True) -> DataFrame:
    """(meet, node, times): the sets of small buckets that may have a link there, in the groups that are compared exactly.

    A group's number is that of its central set, so that near copies, which meet in many buckets, are compared once;
    ``times`` tells in how many buckets. Unless ``merged``, it is a hash of its members, and no group outgrows two blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in grouped(batches, "path"):
            sizes = table.column("size").to_numpy()
            s0, s1 = (table.column(c).to_numpy().view(np.uint64) for c in ("s0", "s1"))
            nodes = table.column("node").combine_chunks()
            marks = chars.mix(np.frombuffer(nodes.cast(pa.binary(16)).buffers()[1], np.uint64)[::2])
            meet: list[np.ndarray] = []
            at: list[np.ndarray] = []
            many = np.flatnonzero(np.diff(bounds) > 1)
            for a, b in zip(bounds[many].tolist(), bounds[many + 1].tolist(), strict=True):
                groups = sketch_groups(s0[a:b], s1[a:b], sizes[a:b], similarity)
                for g in range(groups.max() + 1):
                    own = np.flatnonzero(groups == g) + a
                    if merged:
                        meet.append(np.full(len(own), central(s0[own], s1[own], marks[own]).view(np.int64)))
                        at.append(own)
                        continue
                    for part in tiles(sizes[own]):
                        number = chars.mix(marks[own[part]].sum(keepdims=True, dtype=np.uint64) + np.uint64(len(part)))
                        meet.append(np.repeat(number.view(np.int64), len(part)))
                        at.append(own[part])
            if at:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(meet)), nodes.take(pa.array(np.concatenate(at)))], ["meet", "node"])

    return sorted_by(rows, "path").mapInArrow(thrifty(run), "meet long, node binary").groupBy("meet", "node").agg(F.count(F.lit(1)).alias("times"))


def tiles(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Members of parts of a group such that any two of the group meet in one of them, each part of bounded weight."""
    block = blocks(sizes)
    ids, first = np.unique(block, return_index=True)
    edges = [*first.tolist(), len(sizes)]
    spans = [np.arange(a, b) for a, b in zip(edges, edges[1:], strict=False)]
    if len(spans) == 1:
        yield spans[0]
    for i in range(len(spans)):
        for j in range(i + 1, len(spans)):
            yield np.r_[spans[i], spans[j]]


class Compared:
    """Sets side by side, for exact comparisons of one with many.

    With ``base`` and ``lost``, the sets are differences from one of ``base`` tokens, of which each lacks ``lost``.

    Each is held by how it differs from what more than half of them list. Near copies differ in few tokens, and only
    those that several sets have in their differences are looked up, in lists of the sets that have them.
    """

    def __init__(self, tokens: np.ndarray, starts: np.ndarray, similarity: float, base: np.ndarray | None = None, lost: np.ndarray | None = None):
        n, listed = len(starts), np.diff(np.append(starts, len(tokens)))
        self.n, self.sizes = n, listed if base is None else base + listed - 2 * lost.astype(np.int64)
        vocabulary, codes, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(n), listed)
        common = 2 * counts > n
        usual = common[codes]
        lacking = np.ones((n, int(common.sum())), bool)
        lacking[owner[usual], (np.cumsum(common) - 1)[codes[usual]]] = False
        sets, places = np.nonzero(lacking)
        owner, codes = np.append(owner[~usual], sets), np.append(codes[~usual], np.flatnonzero(common)[places])
        self.apart = np.bincount(owner, minlength=n)
        several = np.where(common, n - counts, counts)[codes] > 1
        owner, codes = owner[several], codes[several]
        order = np.argsort(codes, kind="stable")
        self.having = owner[order]
        self.edges = np.searchsorted(codes[order], np.arange(len(vocabulary) + 1))
        order = np.argsort(owner, kind="stable")
        self.codes = codes[order]
        self.bounds = np.searchsorted(owner[order], np.arange(n + 1))
        f = Fraction(similarity).limit_denominator(10_000)
        self.upper, self.lower = f.numerator + f.denominator, f.numerator

    def linked(self, k: int) -> np.ndarray:
        """Whether each set is linked with set k (which itself counts as linked)."""
        own = self.codes[self.bounds[k] : self.bounds[k + 1]]
        first, many = self.edges[own], self.edges[own + 1] - self.edges[own]
        ends = np.cumsum(many)
        places = np.repeat(first - (ends - many), many) + np.arange(int(ends[-1]) if len(ends) else 0)
        both = self.sizes + self.sizes[k]
        apart = self.apart + self.apart[k] - 2 * np.bincount(self.having[places], minlength=self.n)
        out = (both - apart) * self.upper >= 2 * self.lower * both
        out[k] = True
        return out

    def forest(self) -> list[tuple[int, int]]:
        """Links that connect what is connected.

        Sets that are linked with the most usual one are connected by it, so only the others look for their links.
        """
        root = int(np.argmin(self.apart))
        near = self.linked(root)
        label = np.where(near, root, np.arange(self.n))
        out = [(root, m) for m in np.flatnonzero(near).tolist() if m != root]
        for k in np.flatnonzero(~near).tolist():
            met = np.flatnonzero(self.linked(k))
            met = met[label[met] != label[k]]
            if len(met):
                labels, first = np.unique(label[met], return_index=True)
                out += [(k, m) for m in met[first].tolist()]
                label[np.isin(label, labels)] = label[k]
        return out


def lists_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    lists = table.column("tokens").combine_chunks()
    return lists.flatten().to_numpy().view(np.uint64), lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()


def sets_of(texts: pa.ChunkedArray | pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``token_sets`` of any number of texts (not none), some at a time."""
    sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
    parts = [token_sets(texts.slice(a, b - a).to_pylist(), n) for a, b in chars.batches(sizes, PIECE)]
    return np.concatenate([t for t, _ in parts]), np.append(0, np.cumsum(np.concatenate([np.diff(b) for _, b in parts])))


def verified(rows: DataFrame, n: int, similarity: float) -> DataFrame:
    """(a, b): links between nodes that connect what is connected within each group of (meet, node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in grouped(batches, "meet"):
            texts = table.column("text")
            weights = np.add.reduceat(pc.binary_length(texts).to_numpy().astype(np.int64), bounds[:-1])
            found: list[tuple[int, int]] = []
            for i, j in chars.batches(weights, PIECE):
                base = int(bounds[i])
                tokens, offsets = sets_of(texts.slice(base, int(bounds[j]) - base), n)
                for a, b in zip((bounds[i:j] - base).tolist(), (bounds[i + 1 : j + 1] - base).tolist(), strict=True):
                    if b - a > 1:
                        own = tokens[offsets[a] : offsets[b]]
                        found += [(base + a + x, base + a + y) for x, y in Compared(own, offsets[a:b] - offsets[a], similarity).forest()]
            if found:
                nodes, ends = table.column("node").combine_chunks(), np.array(found)
                yield pa.RecordBatch.from_arrays([nodes.take(pa.array(ends[:, 0])), nodes.take(pa.array(ends[:, 1]))], ["a", "b"])

    return sorted_by(rows, "meet").mapInArrow(thrifty(run), "a binary, b binary")


def with_texts(docs: DataFrame, reps: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, text) of some nodes, each with the text that stands for it.

    Sets travel as texts, which compress to about half of their tokens, and are taken from them where they are compared.
    """
    picks = scratch.keep(reps.join(joinable(nodes), "node", "left_semi").select("node", F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key")))
    same = docs.doc_id.eqNullSafe(picks.own_id) & (docs.text_key == picks.own_key)
    out = scratch.keep(docs.join(joinable(picks), same).select("node", "text"))
    # rows that repeat both id and text give their node more than once
    return out if out.count() == picks.count() else scratch.keep(out.dropDuplicates(["node"]))


def split_again(large: DataFrame, texts: DataFrame, n: int, branch: float, similarity: float) -> DataFrame:
    """(path, node, size, s0, s1) of the buckets below the large ones: each set samples tokens by a hash of its bucket's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch):
                part = batch.slice(a, b - a)
                sets, offsets = token_sets(part.column("text").to_pylist(), n)
                limit = rate(np.diff(offsets), branch, similarity)
                paths: list[np.ndarray] = []
                owner: list[np.ndarray] = []
                for k, above in enumerate(part.column("paths").to_pylist()):
                    own = sets[offsets[k] : offsets[k + 1]]
                    for path in np.array(above, np.int64).view(np.uint64):
                        hashes = chars.mix(own ^ path)
                        paths.append(chars.mix(hashes[hashes <= limit[k]] ^ (path * np.uint64(chars.BASE))))
                        owner.append(np.full(len(paths[-1]), k))
                if paths:
                    take = pa.array(np.concatenate(owner))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(paths).view(np.int64)), *[part.column(c).take(take) for c in ("node", "size", "s0", "s1")]],
                        ["path", "node", "size", "s0", "s1"],
                    )

    by_node = large.groupBy("node").agg(F.collect_set("path").alias("paths"), F.first("size").alias("size"), F.first("s0").alias("s0"), F.first("s1").alias("s1"))
    return by_node.join(texts, "node").mapInArrow(thrifty(run), "path long, node binary, size int, s0 long, s1 long")


def tiled(large: DataFrame, counts: DataFrame) -> DataFrame:
    """Buckets that were split often enough, as tiles: each two of a bucket's blocks meet in one."""
    many = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = large.join(joinable(counts.select(F.col("path").alias("p"), "n")), F.col("path") == F.col("p")).withColumn("many", many)
    own = dealt.withColumn("block", F.pmod(F.xxhash64("node", "path"), F.col("many")).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("many") - 1)))
    return other.select(F.xxhash64("path", F.least("block", "other"), F.greatest("block", "other")).alias("path"), "node", "size", "s0", "s1")


def within(reach: int, similarity: float) -> Column:
    """Whether a set, given by its differences from another, is at most ``reach`` halves of a link's distance from it.

    One less the Jaccard similarity is a distance, so sets within one half of the same set are linked, and those of more
    than four are linked with no set within two. All in whole numbers.
    """
    f = Fraction(similarity).limit_denominator(10_000)
    apart = F.size("tokens").cast("long")
    return 2 * f.denominator * apart <= reach * (f.denominator - f.numerator) * (F.col("base") + apart - F.col("lost"))


def by_heads(large: DataFrame, texts: DataFrame, n: int, similarity: float, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Each crowded bucket against its head: links with that, buckets of linked and nearly linked sets, and the sets that aren't linked.

    The head is the node of most ``times``. Sets that differ from it in little stand in most of the buckets that it is in,
    so buckets of near copies share their head, and what is linked meets what is nearly linked once for each head.
    """
    firsts = scratch.keep(large.groupBy(F.col("path").alias("p")).agg(F.max(F.struct("times", "node"))["node"].alias("root")))
    own = scratch.keep(large.join(joinable(firsts), F.col("path") == F.col("p")).drop("p"))
    pairs = own.select("root", "node").distinct()
    wholes = scratch.keep(texts.join(joinable(firsts.select("root").distinct()), F.col("node") == F.col("root"), "left_semi").select(F.col("node").alias("head"), F.col("text").alias("whole")))
    apart = differences(pairs, texts, n, joinable(wholes)).select(F.col("root").alias("r"), F.col("node").alias("k"), within(2, similarity).alias("linked"), within(4, similarity).alias("near"))
    told = scratch.keep(own.join(apart, (F.col("root") == F.col("r")) & (F.col("node") == F.col("k"))).drop("r", "k"))
    links = told.where("linked AND node != root").select(F.col("root").alias("a"), F.col("node").alias("b")).distinct()

    blocks = lambda which: F.ceil(F.count(F.when(which, 1)) / BLOCK).cast("int")
    ring = F.col("near") & ~F.col("linked")
    close = scratch.keep(told.where("near").select("root", "node", "size", "s0", "s1", "near", "linked").distinct())
    counts = scratch.keep(close.groupBy(F.col("root").alias("p")).agg(blocks(F.col("linked")).alias("inner"), blocks(ring).alias("outer")).where("outer > 0"))
    both = close.join(joinable(counts), F.col("root") == F.col("p"))
    mine, theirs = F.when(F.col("linked"), F.col("inner")).otherwise(F.col("outer")), F.when(F.col("linked"), F.col("outer")).otherwise(F.col("inner"))
    dealt = both.withColumn("block", F.pmod(F.xxhash64("node", "root"), mine).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), theirs - 1)))
    low, high = F.when(F.col("linked"), F.col("block")).otherwise(F.col("other")), F.when(F.col("linked"), F.col("other")).otherwise(F.col("block"))
    between = dealt.select(F.xxhash64("root", low, high).alias("path"), "node", "size", "s0", "s1")
    return links, between, told.where("NOT linked").select("path", "node", "size", "s0", "s1", "times")


def crowded(large: DataFrame, texts: DataFrame, n: int, similarity: float, leaf: int, scratch: Scratch, merged: bool) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """Of (path, node, size, s0, s1, times), what is crowded and can't be split: lists of (meet, node, times) of what heads leave small, of tiles, and the links (a, b) that were found on the way."""
    small, dealt, links = [], [], None
    for _ in range(HEADS):
        more, between, rest = by_heads(large, texts, n, similarity, scratch)
        more, rest = scratch.keep(more), scratch.keep(rest)
        links = more if links is None else links.unionByName(more)
        dealt.append(scratch.keep(plausible(between, similarity, merged=False)))
        counts = scratch.keep(rest.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > leaf))
        hot = joinable(counts.select(F.col("path").alias("p")))
        is_hot = F.col("path") == F.col("p")
        small.append(scratch.keep(plausible(rest.join(hot, is_hot, "left_anti"), similarity, merged)))
        large = scratch.keep(rest.join(hot, is_hot, "left_semi"))
        if counts.isEmpty():
            return small, dealt, links
    dealt.append(scratch.keep(plausible(tiled(large, counts), similarity, merged=False)))
    return small, dealt, links


def candidates(docs: DataFrame, reps: DataFrame, n: int, similarity: float, branch: float, leaf: int, depth: int, scratch: Scratch) -> tuple[DataFrame, list[DataFrame], DataFrame | None]:
    """(meet, node, times) of all small buckets, those of split ones included; lists of tiles of crowded ones, and the links (a, b) that these gave already."""
    rows = reps.where("size > 0").select(F.explode("paths").alias("path"), "node", "size", "s0", "s1")
    texts, found, dealt, links = None, [], [], None
    for level in range(depth + 1):
        counts = scratch.keep(rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > leaf))
        if counts.isEmpty():
            found.append(scratch.keep(plausible(rows, similarity)))
            break
        hot = joinable(counts.select(F.col("path").alias("p")))
        is_hot = F.col("path") == F.col("p")
        found.append(scratch.keep(plausible(rows.join(hot, is_hot, "left_anti"), similarity)))
        large = scratch.keep(rows.join(hot, is_hot, "left_semi"))
        if texts is None:  # the sets of deeper buckets are among these
            texts = with_texts(docs, reps, large.select("node").distinct(), scratch)
        if level == depth:
            times = large.groupBy(F.col("node").alias("k")).agg(F.count(F.lit(1)).alias("times"))
            small, dealt, links = crowded(scratch.keep(large.join(times, F.col("node") == F.col("k")).drop("k")), texts, n, similarity, leaf, scratch, merged=True)
            found += small
            break
        rows = scratch.keep(split_again(large, texts, n, branch, similarity))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out if len(found) == 1 else scratch.keep(out.groupBy("meet", "node").agg(F.sum("times").alias("times"))), dealt, links


def without_large(meets: DataFrame, reps: DataFrame, texts: DataFrame, n: int, similarity: float, leaf: int, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """(meet, node) of (meet, node, times), groups of more than two blocks as crowded buckets, and the links (a, b) that these gave."""
    weights = meets.join(reps.select("node", "size"), "node").groupBy(F.col("meet").alias("m")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("weight"))
    many = scratch.keep(weights.where((F.col("n") > 2 * BLOCK) | (F.col("weight") > 2 * BLOCK_TOKENS)).select("m"))
    if many.isEmpty():
        return meets.select("meet", "node"), None
    lookup, same = joinable(many), F.col("meet") == F.col("m")
    rows = meets.join(lookup, same, "left_semi").join(reps.select("node", "size", "s0", "s1"), "node")
    small, dealt, links = crowded(scratch.keep(rows.withColumnRenamed("meet", "path")), texts, n, similarity, leaf, scratch, merged=False)
    out = meets.join(lookup, same, "left_anti").select("meet", "node")
    for more in [*small, *dealt]:
        out = out.unionByName(more.select("meet", "node"))
    return out, links


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of all nodes with links, the root being the smallest of its component.

    Alternates large-star and small-star steps, which need about log(n) rounds; each round is written.
    """
    pairs = scratch.keep(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(low, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.keep(large)
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(lower.withColumnRenamed("u", "w"), F.col("u") == F.col("w")).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = scratch.keep(moved.unionByName(lower.select("u", F.col("m").alias("v"))).distinct())
        after = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(large, pairs)
        pairs = new
        if after == before:
            break
        before = after
    return scratch.keep(pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())


def differences(classes: DataFrame, texts: DataFrame, n: int, heads: DataFrame | None = None) -> DataFrame:
    """(root, node, base, lost, tokens): how each set differs from its class's root, a set of ``base`` tokens, of which it lacks ``lost``.

    Near copies differ in few tokens, so these lists are short whatever the texts' length. Two sets share ``base`` less
    what either lacks, and what both lists of differences hold. ``heads`` are the roots' texts (head, whole), if known.
    """
    if heads is None:
        heads = classes.where("node = root").select(F.col("node").alias("head")).join(texts.withColumnRenamed("text", "whole"), F.col("head") == F.col("node")).select("head", "whole")
    both = classes.join(texts, "node").join(heads, F.col("root") == F.col("head")).select("root", "node", "text", "whole")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch):
                part = batch.slice(a, b - a)
                own, ends = token_sets(part.column("text").to_pylist(), n)
                roots = part.column("root").dictionary_encode()
                at = roots.indices.to_numpy()
                wholes, edges = sets_of(part.column("whole").take(pa.array(np.unique(at, return_index=True)[1])), n)
                left = [np.setxor1d(own[ends[k] : ends[k + 1]], wholes[edges[r] : edges[r + 1]], assume_unique=True) for k, r in enumerate(at.tolist())]
                base, sizes, apart = np.diff(edges)[at], np.diff(ends), np.fromiter(map(len, left), np.int64, len(left))
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(apart)).astype(np.int32)), pa.array(np.concatenate(left).view(np.int64)))
                lost = (base - sizes + apart) // 2
                yield pa.RecordBatch.from_arrays([part.column("root"), part.column("node"), pa.array(base.astype(np.int32)), pa.array(lost.astype(np.int32)), lists], ["root", "node", "base", "lost", "tokens"])

    return both.mapInArrow(thrifty(run), "root binary, node binary, base int, lost int, tokens array<long>")


def count_links(classes: DataFrame, texts: DataFrame, n: int, similarity: float, scratch: Scratch) -> DataFrame:
    """(node, links): the linked nodes of each node, counted within its class.

    Nodes so close to the root that any two of them are linked (a class's core) are counted and not compared with each
    other. Others meet each other and the core in tiles of their differences.
    """
    apart = scratch.keep(differences(classes, texts, n).withColumn("core", within(1, similarity)))
    blocks = lambda which: F.ceil(F.greatest(F.count(F.when(which, 1)) / BLOCK, F.coalesce(F.sum(F.when(which, F.size("tokens"))), F.lit(0)) / BLOCK_TOKENS)).cast("int")
    core = F.col("core")
    sizes = apart.groupBy(F.col("root").alias("r")).agg(F.count(F.when(core, 1)).alias("n_core"), blocks(core).alias("inner"), blocks(~core).alias("outer"))
    dealt = apart.join(joinable(scratch.keep(sizes)), F.col("root") == F.col("r"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.when(core, F.col("inner")).otherwise(F.col("outer"))).cast("int"))
    kept = ["node", "base", "lost", "tokens"]
    upto = lambda many: F.explode(F.when(F.col(many) > 0, F.sequence(F.lit(0), F.col(many) - 1)))

    outside = dealt.where(~core)
    each = outside.withColumn("other", upto("outer"))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    side = F.when(low == high, 2).otherwise((F.col("block") == high).cast("int")).alias("side")
    rows = each.select(F.xxhash64("root", low, high).alias("meet"), side, *kept)
    inner = dealt.where(core).withColumn("other", upto("outer")).select(F.xxhash64("root", F.lit("core"), "block", "other").alias("meet"), F.lit(0).alias("side"), *kept)
    outer = outside.withColumn("other", upto("inner")).select(F.xxhash64("root", F.lit("core"), "other", "block").alias("meet"), F.lit(1).alias("side"), *kept)
    rows = rows.unionByName(inner).unionByName(outer)
    certain = dealt.where(core).select("node", (F.col("n_core") - 1).alias("links"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in grouped(batches, "meet"):
            tokens, offsets = lists_of(table)
            sides, base, lost = (table.column(c).to_numpy() for c in ("side", "base", "lost"))
            counts = np.zeros(table.num_rows, np.int64)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                compared = Compared(tokens[offsets[a] : offsets[b]], offsets[a:b] - offsets[a], similarity, base[a:b], lost[a:b])
                inside, low = sides[a] == 2, sides[a:b] == 0
                few = low if 2 * low.sum() <= b - a else ~low
                for k in range(b - a) if inside else np.flatnonzero(few).tolist():
                    linked = compared.linked(k)
                    if inside:
                        counts[a + k] = linked.sum() - 1
                    else:
                        linked &= ~few
                        counts[a + k] = linked.sum()
                        counts[a:b] += linked
            yield pa.RecordBatch.from_arrays([table.column("node").combine_chunks(), pa.array(counts)], ["node", "links"])

    compared = sorted_by(rows, "meet").mapInArrow(thrifty(run), "node binary, links long")
    return compared.unionByName(certain).groupBy("node").agg(F.sum("links").alias("links"))


def keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")).withColumn("text_key", F.xxhash64("text"))


def connected(docs: DataFrame, n: int, similarity: float, recall: float, branch: float, leaf: int, depth: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Of (doc_id, text_key, text): its rows' nodes, the nodes, (node, text) of those that were compared, and (node, root) of those with links."""
    told = scratch.keep(described(docs, n, similarity, branch, runs_for(recall, branch, depth)))
    smallest = F.min(ordered()).alias("best")
    same = [F.first(c).alias(c) for c in ("size", "s0", "s1", "paths")]  # equal for all rows of a node
    reps = told.where("size > 0").groupBy("node").agg(smallest, F.count(F.lit(1)).alias("copies"), *same)
    reps = scratch.keep(reps.select("node", "best.doc_id", "best.text_key", "copies", "size", "s0", "s1", "paths"))

    meets, dealt, known = candidates(docs, reps, n, similarity, branch, leaf, depth, scratch)
    known = [] if known is None else [known]
    nodes = meets.select("node")
    for more in [*(d.select("node") for d in dealt), *(k.select(F.explode(F.array("a", "b")).alias("node")) for k in known)]:
        nodes = nodes.unionByName(more)
    texts = with_texts(docs, reps, scratch.keep(nodes.distinct()), scratch)
    meets, more = without_large(meets, reps, texts, n, similarity, leaf, scratch)
    known += [] if more is None else [more]
    for more in dealt:
        meets = meets.unionByName(more.select("meet", "node"))
    links = scratch.keep(verified(meets.distinct().join(texts, "node"), n, similarity))
    for more in known:
        links = links.unionByName(more)
    return told, reps, texts, components(links, scratch)


def ordered() -> Column:
    """What the smallest row of a class is found by: a null doc_id is the largest."""
    return F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("text_key"))


def heads(reps: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, head, copies) of all nodes that several rows or nodes share a class with, ``head`` being the class's smallest row."""
    roots = scratch.keep(classes.join(reps.select("node", "doc_id", "text_key", "copies"), "node"))
    least = roots.groupBy(F.col("root").alias("r")).agg(F.min(ordered()).alias("head"))
    linked = roots.join(least, F.col("root") == F.col("r")).select("node", "head", "copies")
    copied = reps.where("copies > 1").join(joinable(classes.select("node")), "node", "left_anti").select("node", ordered().alias("head"), "copies")
    return linked.unionByName(copied)


def annotate(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    n: int = NGRAM,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    branch: float = BRANCH,
    leaf: int = LEAF,
    depth: int = DEPTH,
    scratch: Scratch | None = None,
    counted: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key (the text's 64-bit hash), class_id, links, copies, first.

    ``class_id`` is the smallest doc_id of the rows that are connected by links or by equal sets of n-grams, ``copies``
    the rows with the same set (this one included), ``links`` the different sets with a Jaccard similarity of at least
    ``similarity`` (null unless ``counted``), and ``first`` marks the row (or the repeated rows) that stands for its class.
    Words are runs of letters, marks, digits and underscores in small letters; a text of fewer than n words has one n-gram
    of them all. Texts are read whole, however long. Texts without words, null and empty ones among them, are in no class
    but their own. A null doc_id loses to any other, a class of null ids has class_id null; repeated rows are copies; extra
    columns play no part; no rows give none.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    told, reps, texts, classes = connected(keyed(docs, text, doc_id), n, similarity, recall, branch, leaf, depth, scratch)
    known = scratch.keep(heads(reps, classes, scratch).withColumnRenamed("node", "known"))
    marked = told.select("doc_id", "text_key", "node", "size").join(joinable(known), (F.col("node") == F.col("known")) & (F.col("size") > 0), "left")
    if counted:
        links = scratch.keep(count_links(classes, texts, n, similarity, scratch)).select(F.col("node").alias("of"), "links")
        marked = marked.join(joinable(links), F.col("known") == F.col("of"), "left")
    alone = F.col("known").isNull()
    return marked.select(
        "doc_id",
        "text_key",
        F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce("links", F.lit(0).cast("long")).alias("links") if counted else F.lit(None).cast("long").alias("links"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("copies"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_key") == F.col("head.text_key")))).alias("first"),
    )


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how: float) -> DataFrame:
    """The rows of ``docs`` that stand for their class, with the columns of ``docs``; one row of each class stays.

    Null, empty and repeated values count as in ``annotate``; rows without words that repeat both id and text all stay.
    """
    scratch = Scratch(docs.sparkSession)
    key, lost_id, lost_key = fresh(docs, "text_key", "lost_id", "lost_key")
    marked = scratch.keep(annotate(docs, text, doc_id, scratch=scratch, counted=False, **how))
    lost = scratch.keep(marked.where("NOT first").select(F.col("doc_id").alias(lost_id), F.col("text_key").alias(lost_key)).distinct())
    again = scratch.keep(marked.where("first AND copies > 1").groupBy(F.col("doc_id").alias(lost_id), F.col("text_key").alias(lost_key)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    named = docs.withColumn(key, F.xxhash64(whole_text(text)))

    def same(df: DataFrame) -> Column:
        return (named[key] == df[lost_key]) & col(doc_id).cast("long").eqNullSafe(df[lost_id])

    stay = named.join(joinable(lost), same(lost), "left_anti")
    if not again.isEmpty():
        lookup = joinable(again)
        repeated = stay.join(lookup, same(again), "left_semi")
        stay = stay.join(lookup, same(again), "left_anti").unionByName(repeated.dropDuplicates([doc_id, key]))
    return stay.select(*[col(c) for c in docs.columns])
