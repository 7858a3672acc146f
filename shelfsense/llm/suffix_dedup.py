"""Byte-level dedup of repeated 200-byte strings by merged Burrows-Wheeler indexes.

1. Runs of windows that share a minimizer are contexts (see ``spans``); only
   those whose minimizer occurs again can hold a repeat. Equal contexts are
   counted (partial counts before the shuffle): all windows of a context that
   occurs twice are repeated, wherever it lies.
2. Where different contexts share a minimizer, one copy of each is sent to the
   partition of its minimizer, a few MB each. A task indexes its contexts in
   shards (``bwt.Shard``) and merges the shards' transforms by interleave
   refinement; the windows of repeated intervals come back as ranges.
3. A minimizer with more than ``HOT`` different contexts would be a partition of
   its own. Its contexts are cut again by a second, independent minimizer of
   their windows - equal windows stay together - and counted again; what still
   exceeds ``HOT`` is counted window by window. Every group is so resolved
   exactly, and none grows with the data.
4. The ranges are collected per document (bounded by its length) and cut out in
   one pass over the texts.

Windows are judged on the input: all copies of a repeated string go, the first too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.bwt import DEPTH, Shard, repeated
from shelfsense.llm.common import (BASE_W, U, discard, enter, keyed, materialise, mix, returning, signed, slices,
                                   window_hashes, with_text)
from shelfsense.llm.spans import Units, merge_spans, minimizers, repeated_contexts, runs

#: Bytes of a minimizer and of the second one; contexts of one minimizer that a task takes together.
ANCHOR, SECOND, HOT = 32, 16, 4096
#: Bytes of contexts per partition and contexts per shard.
PARTITION_BYTES, SHARD_ROWS = 2 << 20, 2048
PIECES = "fp bigint, dig bigint, key bigint, start int, n int, second boolean, body binary"


def _pieces(length: int, second: int):
    """The bytes of listed contexts; those of hot minimizers cut by their second minimizer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, buf, off in slices(b.column(1)):
                lists = b.column(2).slice(lo, hi - lo)
                row = np.repeat(np.arange(hi - lo), np.diff(lists.offsets.to_numpy()))
                flat = lists.flatten()
                fp = flat.field(0).to_numpy().view(np.int64)
                start = flat.field(1).to_numpy().astype(np.int64) + off[row]
                n = flat.field(2).to_numpy().astype(np.int64)
                hot = flat.field(3).to_numpy(zero_copy_only=False).astype(bool)
                if hot.any():
                    u = Units(buf, off, False)
                    hashes = window_hashes(u.b, second, BASE_W)
                    at = minimizers(hashes, length - second + 1)
                    cut_at, cut_n = runs(at, u.row, length)
                    parts = [[fp[~hot], start[~hot], n[~hot], row[~hot], np.zeros((~hot).sum(), bool)]]
                    for f, s, m, r in zip(fp[hot], start[hot], n[hot], row[hot]):
                        i = np.arange(np.searchsorted(cut_at, s, "right") - 1, np.searchsorted(cut_at, s + m))
                        a = np.maximum(cut_at[i], s)
                        z = np.minimum(cut_at[i] + cut_n[i], s + m)
                        own = signed(mix(hashes[at[a]] ^ mix(np.full(1, f, np.int64).view(U))))
                        parts.append([own, a, z - a, np.full(len(a), r), np.ones(len(a), bool)])
                    fp, start, n, row, hot = (np.concatenate(x) for x in zip(*parts))
                    dig = signed(u.digests(start, start + n + length - 1))
                else:
                    dig = np.zeros(len(fp), np.int64)
                raw = buf.tobytes()
                body = [raw[a:a + m + length - 1] for a, m in zip(start.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp), pa.array(dig), pa.array(keys[lo:hi][row]), pa.array((start - off[row]).astype(np.int32)),
                     pa.array(n.astype(np.int32)), pa.array(hot), pa.array(body, pa.binary())],
                    ["fp", "dig", "key", "start", "n", "second", "body"])

    return run


def _ranges(key, start, n, flags: np.ndarray, off: np.ndarray) -> pa.RecordBatch | None:
    """Ranges of flagged positions of strings: (key, first window, windows)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    a, z = edge[::2], edge[1::2]
    if not len(a):
        return None
    # Windows never reach a string's end, so no range crosses into the next string.
    i = np.searchsorted(off, a, "right") - 1
    return pa.RecordBatch.from_arrays([pa.array(key[i]), pa.array((start[i] + a - off[i]).astype(np.int32)),
                                       pa.array((z - a).astype(np.int32))], ["key", "start", "n"])


def _merge_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index the partition's contexts in shards, merge, give back the repeated windows."""
    shards, places = [], []
    for b in batches:
        for lo in range(0, b.num_rows, SHARD_ROWS):
            part = b.slice(lo, SHARD_ROWS)
            for _, _, data, off in slices(part.column(3), 1 << 62):
                shards.append(Shard(data, off))
                places.append((*(part.column(i).to_numpy(zero_copy_only=False) for i in range(3)), off))
    if shards:
        for flags, (key, start, n, off) in zip(repeated(shards), places):
            out = _ranges(key, start, n, flags, off)
            if out is not None:
                yield out


def _windows(length: int):
    """Every window of the pieces by itself: two hashes and its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, off in slices(b.column(2)):
                u = Units(buf, off, False)
                n = np.diff(off) - length + 1
                at = np.repeat(off[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                ka, kb = u.windows(length)
                row = u.row[at]
                start = b.column(1).to_numpy(zero_copy_only=False)[lo:hi]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(ka[at])), pa.array(signed(kb[at])),
                     pa.array(b.column(0).to_numpy(zero_copy_only=False)[lo:hi][row]),
                     pa.array((start[row] + at - off[row]).astype(np.int32))], ["ka", "kb", "key", "start"])

    return run


def repeated_windows(docs: DataFrame, hot: int = HOT, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(key, start, n) of a keyed table, written: n windows from byte ``start`` occur elsewhere too."""
    spark, length = docs.sparkSession, DEPTH
    cand = repeated_contexts(docs, length, ANCHOR, words=False)
    ctx = materialise(cand.groupBy("fp", "dig", "n").agg(F.min(F.struct("key", "start")).alias("first"),
                                                         F.count(F.lit(1)).alias("c")), "distinct")
    whole = materialise(cand.join(ctx.filter("c > 1").select("fp", "dig", "n"), ["fp", "dig", "n"], "left_semi")
                        .select("key", "start", "n"), "whole")
    discard(cand)
    several = ctx.groupBy("fp").agg(F.count(F.lit(1)).alias("different")).filter("different > 1")
    lists = (ctx.join(several, "fp")
             .select(F.col("first.key").alias("key"), F.struct("fp", F.col("first.start").alias("start"), "n",
                                                               (F.col("different") > hot).alias("hot")).alias("x"))
             .groupBy("key").agg(F.collect_list("x").alias("xs")))  # as many as the document has contexts
    pieces = materialise(docs.select("key", "text").join(lists, "key").mapInArrow(returning(_pieces(length, SECOND)), PIECES), "pieces")
    # Second cut: equal pieces are counted again; one of each goes on.
    cut = pieces.filter("second")
    kinds = materialise(cut.groupBy("fp", "dig", "n").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("key", "start")).alias("first")),
                        "second")
    again = cut.join(kinds.filter("c > 1").select("fp", "dig", "n"), ["fp", "dig", "n"], "left_semi").select("key", "start", "n")
    groups = kinds.groupBy("fp").agg(F.count(F.lit(1)).alias("different")).filter("different > 1")
    firsts = kinds.join(groups, "fp").select("fp", "dig", "n", F.col("first.key").alias("key"),
                                             F.col("first.start").alias("start"), "different")
    second = cut.join(firsts, ["fp", "dig", "n", "key", "start"])
    single = second.filter(F.col("different") > hot).select("key", "start", "body").mapInArrow(
        returning(_windows(length)), "ka bigint, kb bigint, key bigint, start int")
    twice = single.groupBy("ka", "kb").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("ka", "kb")
    single = single.join(twice, ["ka", "kb"], "left_semi").select("key", "start", F.lit(1).alias("n"))
    merged = pieces.filter("NOT second").select("fp", "key", "start", "n", "body").unionAll(
        second.filter(F.col("different") <= hot).select("fp", "key", "start", "n", "body"))
    size = pieces.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = max(1, -(-size // partition_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    intervals = (merged.repartition(parts, "fp").select("key", "start", "n", "body")
                 .mapInArrow(returning(_merge_partition), "key bigint, start int, n int"))
    out = materialise(whole.unionAll(again).unionAll(single).unionAll(intervals), "spans")
    discard(ctx, whole, pieces, kinds)
    return out


def _finish(length: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for lo, hi, buf, off in slices(b.column(2)):
                raw = buf.tobytes()
                for i in range(hi - lo):
                    own = b.column(3)[lo + i]
                    base, end = int(off[i]), int(off[i + 1])
                    if own.is_valid and len(own):
                        p = own.values
                        a = p.field(0).to_numpy().astype(np.int64)
                        a, z = merge_spans(a, a + p.field(1).to_numpy() + length - 1)
                    else:
                        a = z = np.zeros(0, np.int64)
                    edges = [0, *(x for s in zip(a.tolist(), z.tolist()) for x in s), end - base]
                    kept = b"".join(raw[base + x:base + y] for x, y in zip(edges[::2], edges[1::2]))
                    rows.append({"key": b.column(0)[lo + i].as_py(), "doc_id": b.column(1)[lo + i].as_py(),
                                 "n_bytes": end - base, "n_removed": int((z - a).sum()), "n_spans": len(a),
                                 "kept_sha256": hashlib.sha256(kept).hexdigest(),
                                 "kept": kept.decode("utf-8", "ignore") if keep_text else None})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _DONE)

    return run


_DONE = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                   ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])
DONE = "key bigint, doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"


def suffix_dedup(docs: DataFrame, keep_text: bool = False, **options: int) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``).

    Texts are UTF-8 bytes, null is empty; matches never cross rows. Rows with
    equal or null ids are separate documents, so equal rows of 200 bytes or
    more lose all of these. ``kept`` is the remaining text, without the rest of a
    character that was cut inside. An empty table gives an empty result.
    Columns other than ``doc_id`` and ``text`` are not read.
    """
    d = keyed(docs)
    spans = repeated_windows(d, **options)
    per_doc = spans.groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("own"))
    done = d.join(per_doc, "key", "left").select("key", "doc_id", "text", "own").mapInArrow(
        returning(_finish(DEPTH, keep_text)), DONE)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + (["key", "kept"] if keep_text else [])
    return done.select(*columns)


def cut_repeats(docs: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs``, all columns, without repeated strings in ``text``; ``n_chars`` follows it."""
    d = keyed(docs, carry=True)
    spans = repeated_windows(d.select("key", "doc_id", "text"), **options)
    per_doc = spans.groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("own"))

    @F.arrow_udf("string")
    def cut(text: pa.Array, own: pa.Array) -> pa.Array:
        enter("bytes")
        out = []
        for t, o in zip(text, own):
            if not o.is_valid or not t.is_valid:
                out.append(t.as_py())
                continue
            raw, p = t.as_buffer().to_pybytes(), o.values
            a = p.field(0).to_numpy().astype(np.int64)
            a, z = merge_spans(a, a + p.field(1).to_numpy() + DEPTH - 1)
            edges = [0, *(x for s in zip(a.tolist(), z.tolist()) for x in s), len(raw)]
            out.append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])).decode("utf-8", "ignore"))
        return pa.array(out, pa.string())

    return with_text(d.join(per_doc, "key", "left"), docs, cut("text", "own"))
