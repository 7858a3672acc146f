"""Exact candidate search for repeated spans: windows grouped by their minimizer.

A window is ``length`` consecutive units (words or bytes) of one document. Its
minimizer is the smallest hash of the ``anchor`` consecutive units inside it;
equal windows have equal minimizers, so no repeat is lost by looking only at
windows whose minimizer occurs again. Neighbouring windows mostly have it at one
place: such a run is a *context* - ``n`` windows starting at ``start``, together
``n + length - 1`` units, less than twice the window - and is one row, not ``n``.
Two contexts with equal minimizer and equal digest of their units hold the same
windows; a text that repeats itself has contexts with equal minimizers too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import (BASE_D, BASE_W, BYTES_A, BYTES_B, PLAIN_WORD, U, discard, materialise, prefix_hash,
                                   returning, signed, slices, sliding_min, span_hash, window_hashes, word_bounds, word_hashes)

CONTEXTS = "key bigint, fp bigint, dig bigint, start int, n int"


def minimizers(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the smallest of every w consecutive hashes, the leftmost of equal ones.

    Hashes are compared by their upper 32 bits, below them stands the position;
    equal windows pick the same place whatever slice they are in.
    """
    if len(h) < w:
        return np.zeros(0, np.int64)
    bits = U(32)
    packed = (h >> bits << bits) | np.arange(len(h), dtype=U)
    return (sliding_min(packed, w) & ((U(1) << bits) - U(1))).astype(np.int64)


def runs(at: np.ndarray, row: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, number) of maximal runs of windows of one row with their minimizer at one place.

    ``at`` has the place for each window start, ``row`` the row of each unit.
    """
    n = len(at)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = row[:n] == row[length - 1:length - 1 + n]
    cut = np.ones(n, bool)
    cut[1:] = (at[1:] != at[:-1]) | (row[1:n] != row[:n - 1]) | (inside[1:] != inside[:-1])
    start = np.flatnonzero(cut)
    size = np.diff(np.append(start, n))
    ok = inside[start]
    return start[ok], size[ok]


class Units:
    """The units of a slice of texts: two independent hashes, the row of each and each row's first."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, words: bool):
        self.buf, self.off = buf, off
        n = len(off) - 1
        if words:
            self.s, self.e, self.first = word_bounds(buf, off, PLAIN_WORD)
            self.a = word_hashes(buf, self.s, self.e)
            self.b = word_hashes(buf, self.s, self.e, second=True)
        else:
            self.first = off
            self.a, self.b = BYTES_A[buf], BYTES_B[buf]
        self.row = np.repeat(np.arange(n), np.diff(self.first))
        self._sums: np.ndarray | None = None

    def digests(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the units of each span, independent of the minimizers."""
        if self._sums is None:
            self._sums = prefix_hash(self.b, BASE_D)
        return span_hash(self._sums, start, end, BASE_D)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of every window start (over row borders too)."""
        at = np.arange(max(0, len(self.a) - length + 1))
        return window_hashes(self.a, length, BASE_W), self.digests(at, at + length)


def context_rows(docs: DataFrame, length: int, anchor: int, words: bool) -> DataFrame:
    """``CONTEXTS`` of a ``(key, text)`` table, computed in one pass without a shuffle."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, buf, off in slices(b.column(1)):
                u = Units(buf, off, words)
                hashes = window_hashes(u.a, anchor)
                at = minimizers(hashes, length - anchor + 1)
                start, n = runs(at, u.row, length)
                if not len(start):
                    continue
                row = u.row[start]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[lo:hi][row]), pa.array(signed(hashes[at[start]])),
                     pa.array(signed(u.digests(start, start + n + length - 1))),
                     pa.array((start - u.first[row]).astype(np.int32)), pa.array(n.astype(np.int32))],
                    ["key", "fp", "dig", "start", "n"])

    return docs.select("key", "text").mapInArrow(returning(cut), CONTEXTS)


def repeated_contexts(docs: DataFrame, length: int, anchor: int, words: bool) -> DataFrame:
    """The contexts whose minimizer occurs more than once, written.

    Minimizers are counted first (partial counts before the shuffle) and the
    repeated ones written, so the join's sides are plain and a hot one's rows
    can be split over tasks.
    """
    rows = context_rows(docs, length, anchor, words)
    again = materialise(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("fp"), "minimizers")
    out = materialise(context_rows(docs, length, anchor, words).join(again, "fp", "left_semi"), "contexts")
    discard(again)
    return out


def merge_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges as maximal disjoint ones (touching ranges join)."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    s, e = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > e[:-1]
    at = np.flatnonzero(new)
    return s[at], e[np.append(at[1:], len(s)) - 1]
