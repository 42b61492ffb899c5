"""Quality scores by a vote of the nearest labelled documents in a latent-semantic space.

A document is a vector of hashed term counts: shapes (runs of three character classes), words, and
repetitions (a word that follows itself, a line seen before). TF-IDF weights and a truncated SVD,
both fitted on a bounded sample of labelled documents, map it to a short vector. The sample's
vectors are broadcast; every document gets its exact cosine with all of them, block by block, and
its nearest neighbours vote, weighted by the fourth power of their similarity, so that near ones
outvote many that are merely of the same kind. A document of the sample is one of its own voters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrow_text as at

#: Bounds of what is fitted and broadcast: documents voted with, and numbers in a vector.
N_LABELLED = 3000
N_DIMENSIONS = 64
N_NEIGHBOURS = 25
THRESHOLD = 0.7

N_CLASSES = 16
N_SHAPES = N_CLASSES**3
N_WORDS = 2048
N_REPEATS = 16
N_TERMS = N_SHAPES + N_WORDS + N_REPEATS

#: Of a chunk. A row takes 8 * N_TERMS bytes as counts, about 50 KB, and as much again on the way to a score.
CHUNK_BYTES, CHUNK_ROWS = 1 << 18, 128


def _classes() -> np.ndarray:
    table = np.full(256, 15, np.uint16)
    groups = [
        b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r",
        b".", b",;:", b"!", b"?", b"#*$%&@", b"|", b"<>{}[]()", b"\"'`", b"-_=+/\\~^", bytes(range(128, 256)),
    ]
    for k, group in enumerate(groups):
        table[[*group]] = k
    return table


_CLASS = _classes()


def term_counts(texts: pa.Array) -> np.ndarray:
    """Rows of N_TERMS counts for a chunk of texts."""
    n = len(texts)
    data, offsets = at.flat(texts)
    codes = _CLASS[data]
    rows = at.row_of(offsets)
    whole = rows[2:] == rows[:-2]
    shape = (codes[:-2] * N_CLASSES + codes[1:-1]) * N_CLASSES + codes[2:]
    cells = [rows[2:][whole] * N_TERMS + shape[whole]]
    w = at.words(data, offsets)
    of = w.texts()
    cells.append(of * N_TERMS + N_SHAPES + (w.hashes % np.uint64(N_WORDS)).astype(np.int64))
    same = (w.hashes[1:] == w.hashes[:-1]) & (of[1:] == of[:-1])
    twice = same[1:] & same[:-1]
    # repetitions are spread over several terms by their share of the words, so that the share counts
    for k, hits in enumerate((of[1:][same], of[2:][twice])):
        share = np.bincount(hits, minlength=n) / np.maximum(np.diff(w.bounds), 1)
        for step, least in enumerate((0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8)):
            cells.append(np.flatnonzero(share > least) * N_TERMS + N_SHAPES + N_WORDS + 8 * k + step)
    return np.bincount(np.concatenate(cells), minlength=n * N_TERMS).reshape(n, N_TERMS)


@dataclass
class Model:
    weights: np.ndarray  # inverse document frequency of each term
    axes: np.ndarray  # N_TERMS x N_DIMENSIONS
    voters: np.ndarray  # labelled documents x N_DIMENSIONS, of length 1
    labels: np.ndarray
    neighbours: int

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_weighted(counts, self.weights) @ self.axes)

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """The weighted share of label 1 among the nearest voters; ties for the last place all vote."""
        if not len(self.labels):
            return np.full(len(vectors), 0.5)
        cosine = vectors @ self.voters.T
        k = min(self.neighbours, len(self.labels))
        last = np.partition(cosine, len(self.labels) - k, axis=1)[:, -k][:, None]
        weight = np.where(cosine >= last - 1e-6, np.clip(cosine, 1e-3, None) ** 4, 0)
        return np.round((weight @ self.labels) / weight.sum(1), 6)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    x = counts.astype(np.float32)
    np.log1p(x, out=x)
    x *= weights
    for part in (slice(0, N_SHAPES), slice(N_SHAPES, N_SHAPES + N_WORDS), slice(N_SHAPES + N_WORDS, None)):
        x[:, part] = _unit(x[:, part])
    return x


def _svd_axes(x: np.ndarray, k: int) -> np.ndarray:
    """Right singular vectors by subspace iteration from a fixed start."""
    k = min(k, *x.shape)
    q = np.random.default_rng(0).standard_normal((x.shape[1], k + 8)).astype(np.float32)
    for _ in range(6):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, turn = np.linalg.svd(x @ q, full_matrices=False)
    return np.ascontiguousarray((q @ turn.T)[:, :k])


def _sparse_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in at.chunks(batches, limit=CHUNK_BYTES, rows=CHUNK_ROWS):
        counts = term_counts(batch.column("text"))
        terms = [np.flatnonzero(row) for row in counts]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("label"),
                pa.array([t.astype(np.uint16).tobytes() for t in terms], pa.binary()),
                pa.array([c[t].astype(np.uint32).tobytes() for c, t in zip(counts, terms, strict=True)], pa.binary()),
            ],
            ["label", "terms", "counts"],
        )


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in at.chunks(batches, limit=CHUNK_BYTES, rows=CHUNK_ROWS):
        result = model.scores(model.vectors(term_counts(batch.column("text"))))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(result, pa.float64())], [*batch.schema.names, "score"])


def fit(
    documents: DataFrame,
    labels: DataFrame,
    n_labelled: int = N_LABELLED,
    dimensions: int = N_DIMENSIONS,
    neighbours: int = N_NEIGHBOURS,
) -> Model:
    """Fits on ``documents`` (doc_id, text) that have a label in ``labels`` (doc_id, label).

    Labels are from 0 to 1; null ones are left out, and repeated ones of a doc_id are averaged.
    ``n_labelled`` bounds the sample: the labelled ids first in the order of a hash. Their list is
    broadcast, terms are counted in tasks, and the driver gets a sparse row of at most N_TERMS
    terms for each.
    """
    chosen = (
        labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.avg("label").cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(n_labelled)
    )
    sample = (
        documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .orderBy(F.xxhash64("doc_id"), F.xxhash64("text"))
        .limit(n_labelled)
        .select("label", "text")
    )
    rows = sample.mapInArrow(_sparse_counts, "label double, terms binary, counts binary").collect()
    counts = np.zeros((len(rows), N_TERMS), np.float32)
    for k, row in enumerate(rows):
        counts[k, np.frombuffer(row.terms, np.uint16)] = np.frombuffer(row.counts, np.uint32)
    found = (counts > 0).sum(0)
    weights = np.where(found > 0, np.log((1 + len(rows)) / (1 + found)) + 0.01, 0).astype(np.float32)
    x = _weighted(counts, weights)
    axes = _svd_axes(x, dimensions) if len(rows) else np.zeros((N_TERMS, 1), np.float32)
    return Model(weights, axes, _unit(x @ axes), np.array([r.label for r in rows], np.float32), neighbours)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of ``documents`` plus ``score``, a double from 0 to 1.

    A null text counts as empty. An empty text is equally far from all voters, so its score is
    their share of label 1 (0.5 without voters). Repeated rows get equal scores; a column named
    ``score`` is replaced. The model is broadcast: N_TERMS x N_DIMENSIONS + n_labelled x
    N_DIMENSIONS numbers at most, whatever the input.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    documents = documents.drop("score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scored(batches, shared.value)

    return documents.mapInArrow(run, at.schema_with(documents, "score double"))
