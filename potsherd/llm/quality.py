"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

Terms are the shapes of words (runs of small letters, capitals, digits and marks), pairs of shapes, the words themselves and
immediate repetitions, hashed into a fixed number of places. A singular value decomposition of the weighted terms of a
bounded, balanced sample of labelled documents gives the latent space. The sample's vectors are broadcast, and every
document votes by its exact cosines with all of them, computed block by block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from potsherd.llm import chars
from potsherd.llm.common import col, whole_text
from potsherd.llm.workers import give_back, thrifty

#: Labelled documents that are learned from at most, half of them of each label; what is broadcast is bounded by it.
SAMPLE = 4096
#: Places for shapes, for pairs of shapes and for words; and dimensions of the latent space.
SHAPES, PAIRS, WORDS, LATENT = 384, 384, 256, 64
#: Neighbours that vote, and the power of the cosine that weighs a vote (a power of two); cosines nearer than the third number are ties.
NEIGHBOURS, POWER, TIE = 31, 8, 1e-6
#: Characters that a text counts for beyond its own when texts are handled together, as each takes a row of cosines.
ROW = 1000
#: Scores from here on are predicted to be good.
GOOD = 0.7
#: Rows with this remainder of crc32(doc_id as text) by FOLDS are never learned from.
FOLDS, HELD_OUT = 4, 2

PLACES = SHAPES + PAIRS + WORDS + 1


def classes() -> np.ndarray:
    """A class for each code point below 2**16: 0 blank, 1 small letter or other letter, 2 capital, 3 digit, else itself."""
    out = np.arange(1 << 16, dtype=np.uint32) + 16
    for c in range(1 << 16):
        s = chr(c)
        if s.isspace():
            out[c] = 0
        elif s.isalpha():
            out[c] = 2 if s.isupper() else 1
        elif s.isdigit():
            out[c] = 3
    return out


_classes: list[np.ndarray] = []


def terms(texts: list[str]) -> np.ndarray:
    """Term counts of each text: one row of PLACES for each."""
    if not _classes:
        _classes.append(classes())
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + 1) - sizes - 1
    codes = chars.code_points("\n".join(texts) + "\n")
    kinds = _classes[0][np.minimum(codes, (1 << 16) - 1)]
    begins, ends = chars.runs(kinds != 0)
    text = np.searchsorted(starts, begins, "right") - 1
    words = chars.span_hashes(codes, begins, ends)
    turns = np.flatnonzero(np.diff(kinds, prepend=np.uint32(0)) != 0)
    shapes = chars.span_hashes(kinds[turns], np.searchsorted(turns, begins), np.searchsorted(turns, ends))
    next_to = text[1:] == text[:-1]
    pairs = chars.mix(shapes[:-1] + shapes[1:] * np.uint64(chars.BASE))[next_to]
    again = text[1:][next_to & (words[1:] == words[:-1])]
    place = lambda h, n, at: (h % np.uint64(n)).astype(np.int64) + at
    cells = np.concatenate(
        [
            text * PLACES + place(shapes, SHAPES, 0),
            text[1:][next_to] * PLACES + place(pairs, PAIRS, SHAPES),
            text * PLACES + place(words, WORDS, SHAPES + PAIRS),
            again * PLACES + PLACES - 1,
        ]
    )
    return np.bincount(cells, minlength=len(texts) * PLACES).reshape(len(texts), PLACES)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    """Weights of the places, the latent space, and the sample's vectors in it with their labels (0 or 1)."""

    weights: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @staticmethod
    def fit(counts: np.ndarray, labels: np.ndarray) -> Model:
        weights = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1
        rows = shares(counts, weights)
        _, vectors = np.linalg.eigh(rows.T @ rows)
        space = np.ascontiguousarray(vectors[:, ::-1][:, :LATENT], np.float32)
        return Model(weights, space, unit(rows @ space).astype(np.float32), labels.astype(np.float32))

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the nearest neighbours; 0 where nothing is alike, as for empty texts. All that tie with the last neighbour vote, too."""
        cosines = unit(shares(counts, self.weights) @ self.space).astype(np.float32) @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        least = np.partition(cosines, -k, axis=1)[:, -k, None]
        votes = np.where(cosines >= least - TIE, np.maximum(cosines, 0), 0)
        for _ in range(POWER.bit_length() - 1):
            votes *= votes
        total = votes.sum(axis=1, dtype=np.float64)
        return np.clip(np.divide(votes @ self.labels, total, out=np.zeros(len(total)), where=total > 0), 0, 1)


def shares(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Square roots of the terms' shares, weighted, as unit vectors."""
    total = np.maximum(counts[:, : SHAPES].sum(axis=1, keepdims=True), 1)
    return unit(np.sqrt(counts / total) * weights).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model of at most ``sample`` labelled documents, taken by a hash of the id, that aren't held out.

    Null labels and ids and labels without a document are passed over. A document with two labels counts with both, and of
    several texts of one id the one with the smallest term counts is learned from.
    """
    known = labels.select(col(doc_id).cast("long").alias("id"), col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)").where(~held_out(F.col("id"))).distinct()
    halves = [known.where(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(sample // 2) for v in (0, 1)]
    chosen = F.broadcast(halves[0].unionByName(halves[1]))  # at most `sample` rows
    read = docs.select(col(doc_id).cast("long").alias("id"), whole_text(text).alias("text")).join(chosen, "id").select("id", "label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, found in counted(batch.column("text")):
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * PLACES), pa.array(found.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), batch.column("label").slice(a, b - a), lists], ["id", "label", "counts"])

    rows = read.mapInArrow(thrifty(count), "id long, label int, counts array<long>").groupBy("id", "label").agg(F.min("counts").alias("counts")).orderBy("id", "label").toArrow()
    if not rows.num_rows:
        return Model(np.ones(PLACES), np.zeros((PLACES, LATENT), np.float32), np.zeros((1, LATENT), np.float32), np.zeros(1, np.float32))
    counts = rows.column("counts").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, PLACES)
    return Model.fit(counts, rows.column("label").to_numpy())


def counted(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """Ranges of texts and the term counts of each."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + ROW
    for a, b in chars.batches(sizes):
        yield a, b, terms(texts.slice(a, b - a).to_pylist())


def scorer(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """The score of a text column, by a broadcast model."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = [shared.value.score(found) for _, _, found in counted(texts)]
        give_back()
        return pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())

    return score


def classify(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with three more columns: held_out, score (0 to 1), predicted (0 or 1).

    A column of ``docs`` with such a name is left out of the result. The score depends on the whole text alone, however
    long; a null or empty text scores 0, and neighbours that tie for the last place all vote. A null id isn't held out, repeated rows score alike, and no rows give no rows.
    """
    names = [c for c in docs.columns if c.lower() not in ("held_out", "score", "predicted")]
    scored = docs.select(*[col(c) for c in names], held_out(col(doc_id)).alias("held_out"), scorer(docs.sparkSession, model)(whole_text(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted to be good, with the columns of ``docs``."""
    return docs.where(scorer(docs.sparkSession, model)(whole_text(text)) >= GOOD)
