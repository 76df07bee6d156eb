"""Vector code compression: each part of a vector becomes the index of its nearest codebook entry, learnt by Hamerly's Lloyd rounds.

Rows keep, from round to round, one upper bound of the distance to their own entry and one lower bound of that to the
second nearest, per part, as integers rounded away from each other. Entries move by known distances, so bounds are
loosened by these; only a part whose bounds don't differ strictly is measured against all entries again. So ties always
reach the full comparison, which gives them to the lower index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potsherd.llm.common import Scratch, col, joinable
from potsherd.llm.workers import thrifty

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096

STATE = "vec_id {id}, label {label}, vec array<int>, code binary, upper array<int>, lower array<int>, sums array<bigint>"


def whole(embedding: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    x = col(embedding)
    return x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))


def integers(embedding: str, width: Column | int) -> Column:
    """Components as integers, floor(SCALE * x), padded with zeros to ``width``; held within bounds in which no sum of squares leaves 63 bits."""
    bound = float(int(2**30 / max(1, width) ** 0.5))
    whole_number = lambda v: F.greatest(F.least(F.floor(v.cast("double") * SCALE).cast("double"), F.lit(bound)), F.lit(-bound)).cast("int")
    return F.concat(F.transform(col(embedding), whole_number), F.array_repeat(F.lit(0), F.lit(width) - F.size(col(embedding))))


def root_below(x: np.ndarray) -> np.ndarray:
    """The integer square root."""
    r = np.floor(np.sqrt(x.astype(np.float64))).astype(np.int64)
    r -= r * r > x
    return r + ((r + 1) * (r + 1) <= x)


def root_above(x: np.ndarray) -> np.ndarray:
    r = root_below(x)
    return r + (r * r < x)


def squares(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows to entries that stand beside them."""
    apart = rows - entries
    return np.einsum("...k,...k->...", apart, apart)


class Books:
    """The codebooks of a round (part, entry, component), how far entries came since the round before, and half their distances to each other."""

    def __init__(self, now: np.ndarray, before: np.ndarray | None = None):
        self.now = now
        self.moved = None if before is None else root_above(squares(now, before))
        between = squares(now[:, :, None], now[:, None])
        between[:, np.arange(now.shape[1]), np.arange(now.shape[1])] = np.iinfo(np.int64).max
        self.gap = root_below(np.minimum(between.min(axis=2), 2**62))

    def assign(self, vecs: np.ndarray, code: np.ndarray | None, upper: np.ndarray | None, lower: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes and bounds of rows (row, part, component) from those of the round before, or from none."""
        n, parts, _ = vecs.shape
        if code is None:
            code, upper, lower = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.int64), np.full((n, parts), -1, np.int64)
        for p in range(parts):
            entries, own = self.now[p], code[:, p]
            scan = np.arange(n)
            if self.moved is not None:
                moved = self.moved[p]
                first = int(moved.argmax())
                second = int(np.delete(moved, first).max(initial=0))
                upper[:, p] += moved[own]
                lower[:, p] -= np.where(own == first, second, moved[first])
                open_ = lambda at: ~((upper[at, p] < lower[at, p]) | (2 * upper[at, p] < self.gap[p][own[at]]))  # noqa: B023, E731
                scan = scan[open_(scan)]
                upper[scan, p] = root_above(squares(vecs[scan, p], entries[own[scan]]))
                scan = scan[open_(scan)]
            if len(scan):
                apart = squares(vecs[scan, p][:, None], entries[None])
                best = apart.argmin(axis=1)  # the first of equals
                code[scan, p] = best
                upper[scan, p] = root_above(apart[np.arange(len(scan)), best])
                apart[np.arange(len(scan)), best] = np.iinfo(np.int64).max
                lower[scan, p] = root_below(np.minimum(apart.min(axis=1), 2**62))
        return code, np.minimum(upper, 2**31 - 1), np.clip(lower, -1, 2**31 - 1)

    def errors(self, vecs: np.ndarray, code: np.ndarray) -> np.ndarray:
        return sum(squares(vecs[:, p], self.now[p][code[:, p]]) for p in range(vecs.shape[1]))

    def sums(self, vecs: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Number of parts of each entry and their sums: (part, entry, 1 + components)."""
        out = np.zeros((*self.now.shape[:2], self.now.shape[2] + 1), np.int64)
        for p in range(len(self.now)):
            np.add.at(out[p, :, 0], code[:, p], 1)
            np.add.at(out[p, :, 1:], code[:, p], vecs[:, p])
        return out

    def after(self, sums: np.ndarray) -> np.ndarray:
        """The entries as floors of their parts' means; unused ones as they are."""
        count = sums[:, :, :1]
        return np.where(count > 0, sums[:, :, 1:] // np.maximum(count, 1), self.now)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.now.ravel().tolist())).encode()).hexdigest()


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    flat = values.reshape(len(values), -1)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]), pa.array(flat.ravel(), kind))


def _read(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)


def _known(batch: pa.RecordBatch, books: Books) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None, np.ndarray | None]:
    parts, _, size = books.now.shape
    vecs = _read(batch, "vec", parts * size).astype(np.int64).reshape(batch.num_rows, parts, size)
    if books.moved is None:
        return vecs, None, None, None
    code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts).copy()
    return vecs, code, _read(batch, "upper", parts).astype(np.int64), _read(batch, "lower", parts).astype(np.int64)


#: Rows that are compared with all entries at once.
BLOCK = 4096


def rounds_of(books: Books) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with new codes and bounds, and at the end of each task one row more with the sums of its parts by entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, schema = None, None
        for whole_batch in batches:
            for k in range(0, whole_batch.num_rows, BLOCK):
                batch = whole_batch.slice(k, BLOCK)
                vecs, *known = _known(batch, books)
                code, upper, lower = books.assign(vecs, *known)
                total = books.sums(vecs, code) + (0 if total is None else total)
                out = {
                    "vec_id": batch.column("vec_id"),
                    "label": batch.column("label"),
                    "vec": batch.column("vec").cast(pa.list_(pa.int32())),
                    "code": pa.array([x.tobytes() for x in code], pa.binary()),
                    "upper": _lists(upper, pa.int32()),
                    "lower": _lists(lower, pa.int32()),
                    "sums": pa.nulls(len(code), pa.list_(pa.int64())),
                }
                done = pa.RecordBatch.from_pydict(out)
                schema = done.schema
                yield done
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, f.type) if f.name != "sums" else pa.array([total.ravel().tolist()], f.type) for f in schema], schema=schema)

    return thrifty(run)


def codes_of(books: Books) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Final codes as hexadecimal digits, and errors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for k in range(0, whole_batch.num_rows, BLOCK):
                batch = whole_batch.slice(k, BLOCK)
                vecs, *known = _known(batch, books)
                code, _, _ = books.assign(vecs, *known)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([x.tobytes().hex() for x in code]), pa.array(books.errors(vecs, code), pa.int64())], names=["vec_id", "label", "code", "error"])

    return thrifty(run)


def compress(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of each vector that is there and finite in all components.

    Components become floor(4096 * x). Codebooks begin with the parts of the vectors of the smallest ids (null ids last;
    of equal ids the smaller vector first), as many as there are up to ``entries``. Each round assigns all parts and sets
    each entry to the floor of its parts' mean; equal distances go to the lower index, so equal entries leave the later
    ones unused and unchanged. Null vectors and those with null, NaN or infinite components are dropped. All vectors are
    padded with zeros to the longest one's length, or the next that ``parts`` divides; an empty one is all zeros. Integers
    beyond 2^30 over the root of that length are held at it, so that sums of squares stay whole. Repeated rows count and
    come out as often as they are there, extra columns play no part, null labels are one label, no vectors give no rows.

    A round reads and writes each row once and shuffles only sums, of a size that depends on the codebooks; the driver
    holds codebooks and sums of one round. Rounds are written to the shared folder, the one before goes.
    """
    scratch = Scratch(df.sparkSession)
    kept = df.where(whole(embedding)).select(col(vec_id).alias("vec_id"), col(label).alias("label"), col(embedding).alias("embedding"))
    kinds = {name: kept.schema[name].dataType.simpleString() for name in ("vec_id", "label")}
    longest = kept.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return kept.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256")).limit(0)
    width = max(1, -(-longest // parts)) * parts
    rows = kept.select("vec_id", "label", integers("embedding", width).alias("vec"))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()
    books = Books(np.array([r.vec for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2))
    state = rows
    for _ in range(rounds):
        read = state if state is rows else state.where("sums IS NULL")
        done = scratch.keep(read.mapInArrow(rounds_of(books), STATE.format(id=kinds["vec_id"], label=kinds["label"])))
        if state is not rows:
            scratch.drop(state)
        total = np.zeros(books.now.shape[0] * books.now.shape[1] * (books.now.shape[2] + 1), np.int64)
        for r in done.where("sums IS NOT NULL").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("total")).collect():
            total[r.pos] = r.total
        books = Books(books.after(total.reshape(*books.now.shape[:2], -1)), books.now)
        state = done
    read = state if state is rows else state.where("sums IS NULL")
    coded = scratch.keep(read.mapInArrow(codes_of(books), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"))
    scratch.drop(state)
    by_label = scratch.keep(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")))
    met = coded.join(joinable(by_label), F.col("label").eqNullSafe(F.col("_label")))
    return met.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
