"""Quality by nearest-neighbour voting over latent-semantic vectors.

Terms of a text are its byte trigrams (lower-cased only in a second, shape-free
set) and pairs of word shapes, hashed into ``TERMS`` columns; a shape tells
capitals, symbols, length class and whether the word repeats the one before.
Weights are ``log(1 + tf) * idf`` with document frequencies counted over all
documents in one pass (one vector per task, summed on Spark), rows are scaled to
length one and projected on the leading right singular vectors of the labelled
sample (randomised SVD in numpy on the driver).

The labelled vectors (``MAX_TRAIN`` x ``RANK`` floats, at most 2 MB, a documented
bound) and the projection are broadcast. Every document's vector is multiplied
with all of them in blocks, exactly, its ``K`` most similar ones vote with
their similarity as weight. Memory per task is one block of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import LOWER, PLAIN_WORD, U, mix, slices, word_bounds, word_hashes
from shelfsense.llm.labelled import held_out, training_ids, training_rows

#: Columns of trigrams and of shape pairs.
TRIGRAMS, SHAPES = 2048, 512
TERMS = TRIGRAMS + SHAPES
RANK, K, BLOCK = 64, 25, 512
#: Labelled rows that vote.
MAX_TRAIN = 4096
#: Bytes and rows of text counted at once (a row takes 10 kB of counts).
SLICE, SLICE_ROWS = 1 << 20, 512
#: Similarities are compared in steps of this, so equal vectors tie wherever they stand in a product.
STEP = np.float32(2.0 ** -20)

# Character classes of the shapes.
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x61:0x7B] = 1
_CLASS[0x80:] = 1
_CLASS[0x41:0x5B] = 2
_CLASS[0x30:0x3A] = 4
for _c in b"#*$%&|<>!=~^@+_\\/{}[]":
    _CLASS[_c] = 8


def term_counts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Dense (rows, TERMS) term counts of a slice of texts."""
    n = len(off) - 1
    out = np.zeros(n * TERMS, np.float32)
    row_at = np.repeat(np.arange(n), np.diff(off))
    if len(buf) >= 3:
        b = buf.astype(np.uint32)
        tri = b[:-2] | b[1:-1] << 8 | b[2:] << 16
        ok = row_at[:-2] == row_at[2:]
        h = (tri * np.uint32(0x9E3779B1)) >> np.uint32(21)
        out += np.bincount(row_at[:-2][ok] * TERMS + h[ok], minlength=n * TERMS).astype(np.float32)
    s, e, first = word_bounds(buf, off, PLAIN_WORD)
    if len(s):
        wrow = row_at[s]
        cls = _CLASS[buf]
        some = np.bitwise_or.reduceat(cls, s).astype(np.int64)
        # reduceat runs to the next word's start; blanks have class 0.
        size = np.minimum((e - s).astype(np.int64), 31) // 4
        hashes = word_hashes(buf, s, e, LOWER)
        same = np.zeros(len(s), np.int64)
        same[1:] = (hashes[1:] == hashes[:-1]) & (wrow[1:] == wrow[:-1])
        shape = some | same << 4 | size << 5
        prev = np.r_[255, shape[:-1]]
        prev[np.r_[True, wrow[1:] != wrow[:-1]]] = 255
        pair = (mix((prev.astype(U) << U(16)) | shape.astype(U)) % U(SHAPES)).astype(np.int64)
        out += np.bincount(wrow * TERMS + TRIGRAMS + pair, minlength=n * TERMS).astype(np.float32)
    return out.reshape(n, TERMS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Length-one rows of log(1 + tf) * idf, trigrams and shapes with equal say."""
    x = np.log1p(counts) * idf
    for lo, hi in ((0, TRIGRAMS), (TRIGRAMS, TERMS)):
        part = x[:, lo:hi]
        norm = np.sqrt((part ** 2).sum(1, keepdims=True))
        np.divide(part, norm, out=part, where=norm > 0)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x ** 2).sum(1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents and, per term, of those that have it; over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TERMS + 1, np.int64)
        for b in batches:
            for _, _, buf, off in text_slices(b.column(0)):
                total[:TERMS] += (term_counts(buf, off) > 0).sum(0)
                total[TERMS] += len(off) - 1
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["term", "n"])

    rows = (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "term int, n bigint")
            .groupBy("term").agg(F.sum("n").alias("n")).collect())
    df = np.zeros(TERMS + 1, np.int64)
    for r in rows:
        df[r.term] = r.n
    return int(df[TERMS]), df[:TERMS]


def right_vectors(x: np.ndarray, rank: int, seed: int = 11) -> np.ndarray:
    """Leading right singular vectors (randomised, three power iterations)."""
    rng = np.random.default_rng(seed)
    k = min(rank + 16, *x.shape)
    q = np.linalg.qr(x @ rng.normal(size=(x.shape[1], k)).astype(np.float32))[0]
    for _ in range(3):
        q = np.linalg.qr(x @ (x.T @ q))[0]
    return np.linalg.svd(q.T @ x, full_matrices=False)[2][:rank].T.astype(np.float32)


def text_slices(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of bounded bytes and rows."""
    for lo, hi, buf, off in slices(col, SLICE):
        for a in range(0, hi - lo, SLICE_ROWS):
            own = off[a:min(a + SLICE_ROWS, hi - lo) + 1]
            yield lo + a, lo + a + len(own) - 1, buf[own[0]:own[-1]], own - own[0]


def vote(vectors: np.ndarray, known: np.ndarray, y: np.ndarray, prior: float) -> np.ndarray:
    """Similarity-weighted share of label 1 among the K nearest; ties at the K-th go to earlier rows."""
    k = min(K, len(y))
    out = np.full(len(vectors), prior)
    for lo in range(0, len(vectors), BLOCK):
        sim = vectors[lo:lo + BLOCK] @ known.T
        place = np.rint(sim / STEP).astype(np.int32)
        kth = -np.partition(-place, k - 1, axis=1)[:, k - 1:k]
        near, tied = place > kth, place == kth
        near |= tied & (np.cumsum(tied, axis=1) <= k - near.sum(1, keepdims=True))
        w = np.where(near, np.square(np.square(np.clip(sim, 0, None))), 0)
        total = w.sum(1)
        out[lo:lo + BLOCK] = np.where(total > 1e-12, (w @ y) / np.maximum(total, 1e-12), prior)
    return np.clip(out, 0.0, 1.0)


def quality_scores(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """Score every whole text: ``doc_id, held_out, score, predicted``, one row per row of ``docs``.

    Null and empty texts have no term and get the labelled rows' mean label, as
    does every row where no labelled row exists (then 0.5). Repeated rows score
    alike. Columns other than ``doc_id`` and ``text`` are not read.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n_docs, df = document_frequencies(d)
    idf = (np.log((1 + n_docs) / (1 + df)) + 0.1).astype(np.float32)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, off in text_slices(b.column(1)):
                x = weighted(term_counts(buf, off), idf).astype(np.float16)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo),
                                                  pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "y", "x"])

    ids = training_ids(labels, "quality", max_train)
    got = (training_rows(d, ids).mapInArrow(counts, "doc_id bigint, y int, x binary")
           .orderBy("doc_id", "x").limit(max_train).toPandas())
    if not len(got):
        scored = d.select("doc_id", F.lit(0.5).alias("score"))
    else:
        x = np.stack([np.frombuffer(r, np.float16) for r in got["x"]]).astype(np.float32)
        y = got["y"].to_numpy().astype(np.float32)
        basis = right_vectors(x, RANK)
        shared = spark.sparkContext.broadcast((idf, basis, unit(x @ basis), y, float(y.mean())))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            idf, basis, known, y, prior = shared.value
            for b in batches:
                for lo, hi, buf, off in text_slices(b.column(1)):
                    v = unit(weighted(term_counts(buf, off), idf) @ basis)
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(vote(v, known, y, prior))],
                                                     ["doc_id", "score"])

        scored = d.mapInArrow(score, "doc_id bigint, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
