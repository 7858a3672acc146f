"""Shared helpers of the text operators: table access, row keys, byte-level words, shared files."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.session import scratch_path

U = np.uint64
#: Bytes of text handled at once inside a task (a longer document is one slice).
SLICE_BYTES = 1 << 20


# ------------------------------------------------------------------ tables
def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs nothing that was already written,
    and a table used several times is computed once. ``discard`` deletes it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    release(spark)
    out = spark.read.schema(schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote and nothing reads any more."""
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs (it does so when the driver's garbage is collected)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def keyed(docs: DataFrame, carry: bool = False) -> DataFrame:
    """``(key, doc_id, text)`` with a unique non-null ``key`` in document order.

    Where ids are unique and present, the id is the key and nothing is moved.
    Otherwise (null or repeated ids) rows are put in order of (id, text), nulls
    first, written once and numbered; equal rows are separate documents next
    to each other. With ``carry`` the struct ``row`` has all other columns of ``docs``.
    """
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")] if carry else []
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *row)
    odd = (d.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
           .filter((F.col("n") > 1) | F.col("doc_id").isNull()))
    if odd.isEmpty():
        return d.select(F.col("doc_id").alias("key"), *d.columns)
    n = max(1, int(d.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["doc_id", F.sha2(F.coalesce("text", F.lit("")), 256)]
    ranged = d.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("key", F.monotonically_increasing_id())
    return materialise(ranged.select("key", *d.columns), "keyed")


def with_text(rows: DataFrame, docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The rows carried by ``keyed``, as in ``docs``; with another text (and its length in ``n_chars``) if one is given."""
    out = rows.select("row", (F.col("text") if text is None else text).alias("new"))
    return out.select(*[F.col("new").alias(c) if c == "text"
                        else F.char_length("new").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" and text is not None
                        else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


# ------------------------------------------------------------------ shared files
def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder's URI and the path in it."""
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[5:])
    return pafs.LocalFileSystem(), uri


def make_folder(uri: str) -> None:
    fs, path = filesystem(uri)
    fs.create_dir(path, recursive=True)


def attempt_name(stem: str, ext: str) -> str:
    """A file name no other attempt of the same task can use."""
    return f"{stem}-{uuid.uuid4().hex[:12]}{ext}"


# ------------------------------------------------------------------ byte-level words
def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, 256, dtype=np.uint64) * U(2) + U(1)


#: Byte values of the two independent word hashes.
BYTES_A, BYTES_B = _table(0x5EED_A), _table(0x5EED_B)
#: Odd bases of the polynomial hashes (fixed values).
BASE_A, BASE_B, BASE_W, BASE_D = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: Words of everything but ASCII white space.
PLAIN_WORD = ~SPACE
#: Words of lower-case letters, digits and all non-ASCII bytes (after lower-casing A-Z).
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x41:0x5B] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
SAME = np.arange(256, dtype=np.uint8)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^n and base^-0..base^-n modulo 2^64."""
    got = _powers.get(base)
    if got is None or len(got[0]) <= n:
        m = max(n + 1, 1 << 16)
        up, down = np.full(m, base, U), np.full(m, pow(base, -1, 1 << 64), U)
        up[0] = down[0] = 1
        got = (np.cumprod(up, dtype=U), np.cumprod(down, dtype=U))
        if m <= SLICE_BYTES * 2:
            _powers[base] = got
    return got


#: What operators remember in a worker process between tasks, and the operator that ran last.
_remembered: list[dict] = [_powers]
_current = ""


def remember(cache: dict) -> dict:
    """Register a worker's cache: it is emptied when another kind of operator takes the worker over."""
    _remembered.append(cache)
    return cache


def enter(kind: str) -> None:
    """A task of this kind of operator begins; caches of other kinds are dropped."""
    global _current
    if kind != _current:
        for cache in _remembered:
            cache.clear()
        _current = kind
        give_back()


def give_back() -> None:
    """Return this process's free memory to the system: Arrow's pool, and glibc's heap where there is one."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def returning(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, after which the worker keeps no free memory.

    An executor's workers wait for further tasks, of other operators too; what they hold meanwhile is missing there.
    """

    @functools.wraps(run)
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(31))
    x = x * U(0x9E3779B97F4A7C15)
    x ^= x >> U(29)
    x = x * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(32))


def prefix_hash(values: np.ndarray, base: int) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` turns two of them into a span's hash."""
    up, _ = powers(base, len(values))
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * up[:len(values)], dtype=U, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    _, down = powers(base, len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def slices(col: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into row ranges of about ``max_bytes``.

    Yields (first row, end row, bytes, offsets of the rows and the end); null is empty.
    """
    enter("bytes")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), len(col))
        yield lo, hi, buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def text_slices(col: pa.Array, rows: int, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``rows`` texts and ``max_bytes``; a longer text is a range of its own."""
    size = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(col):
        hi = int(np.searchsorted(size, (size[lo - 1] if lo else 0) + max_bytes, "right"))
        hi = min(max(hi, lo + 1), lo + rows, len(col))
        yield lo, hi
        lo = hi


def word_bounds(buf: np.ndarray, off: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word and, per row, the index of its first word (with the total last)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    w = word[buf]
    first, last = w.copy(), w.copy()
    first[1:] &= ~w[:-1]
    last[:-1] &= ~w[1:]
    inner = off[(off > 0) & (off < len(buf))]
    first[inner] = w[inner]
    last[inner - 1] = w[inner - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, e, np.searchsorted(s, off)


def word_hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray, fold: np.ndarray = SAME,
                second: bool = False) -> np.ndarray:
    """64-bit hash of every word (an independent one with ``second``)."""
    values, base = (BYTES_B, BASE_B) if second else (BYTES_A, BASE_A)
    return span_hash(prefix_hash(values[fold][buf], base), s, e, base)


def window_hashes(h: np.ndarray, k: int, base: int = BASE_W) -> np.ndarray:
    """Hash of every k consecutive values (over row borders too; callers mask these)."""
    if len(h) < k:
        return np.zeros(0, U)
    at = np.arange(len(h) - k + 1)
    return span_hash(prefix_hash(h, base), at, at + k, base)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    if len(x) < w:
        return np.zeros(0, x.dtype)
    m, y = 1, x
    while m * 2 <= w:
        y = np.minimum(y[:-m], y[m:])
        m *= 2
    return y if m == w else np.minimum(y[:len(y) - (w - m)], y[w - m:])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == U else x.astype(np.int64)
