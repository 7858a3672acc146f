"""Substring dedup by De Bruijn compaction over word windows.

Every window of ``length`` words is an edge between the nodes of its first and
last ``length - 1`` words. The graph is never built whole:

1. Runs of windows with one minimizer (see ``spans``) are paths already; only
   runs whose minimizer occurs again can hold a repeated edge.
2. Equal runs collapse to one path with its first place (partial minima before
   the shuffle, so a passage in a third of all documents is one row per task).
   Later places of a path repeat it wholly.
3. Where different paths share a minimizer, their first places become single
   edges, keyed by two independent 64-bit hashes. One exchange groups them and
   joins each edge to its first place and to the number of ways into and out
   of it. Per document, consecutive repeated edges without a branch between
   them, whose first places are consecutive too, compact to one path.
4. Paths that continue each other in the document and in the source are glued
   to long spans: (document, start) repeats (source, start). Source coordinates
   verify them: both texts are read, and the digests of the words must agree;
   a span that fails (a hash collision) is dropped and its document done again.

A word is removed if it lies in a window that starts earlier elsewhere; the
first place of every window stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import PLAIN_WORD, U, discard, keyed, materialise, signed, slices, word_bounds
from shelfsense.llm.spans import Units, merge_spans, repeated_contexts

#: Words of a window and of a minimizer.
WINDOW, ANCHOR = 20, 8
SPANS = "key bigint, start int, n int, src_key bigint, src_start int"
EDGES = "ka bigint, kb bigint, key bigint, pos int, ways bigint"
DONE = ("kind int, key bigint, doc_id bigint, start int, n int, src_key bigint, src_start int, digest binary, "
        "n_words bigint, n_removed bigint, kept_sha256 string, kept string")


def _edges(length: int):
    """Edges of the listed runs: two hashes, place, 32 bits each of the words before and after."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, buf, off in slices(b.column(1)):
                u = Units(buf, off, True)
                lists = b.column(2).slice(lo, hi - lo)
                sizes = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten()
                base = u.first[np.repeat(np.arange(hi - lo), sizes)]
                start = flat.field(0).to_numpy() + base
                n = flat.field(1).to_numpy().astype(np.int64)
                if not len(start):
                    continue
                at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
                ka, kb = u.windows(length)
                row = u.row[at]
                before = np.where(at > u.first[row], u.a[np.maximum(at - 1, 0)], U(0)) >> U(32)
                end = at + length
                inside = end < u.first[row + 1]
                after = np.where(inside, u.a[np.minimum(end, len(u.a) - 1)], U(0)) >> U(32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(ka[at])), pa.array(signed(kb[at])), pa.array(keys[lo:hi][row]),
                     pa.array((at - u.first[row]).astype(np.int32)), pa.array(signed((before << U(32)) | after))],
                    ["ka", "kb", "key", "pos", "ways"])

    return cut


def glue(start, n, src_key, src_start, joined) -> tuple[np.ndarray, ...]:
    """Glue pieces of one document that continue each other in it and in their source.

    ``joined`` is false where a piece must not be glued to the one before (a
    branch); such pieces are glued only when they are paths in their own right.
    """
    order = np.lexsort((src_start, src_key, start))
    start, n, src_key, src_start, joined = (x[order] for x in (start, n, src_key, src_start, joined))
    order = np.lexsort((start, start - src_start, src_key))
    start, n, src_key, src_start, joined = (x[order] for x in (start, n, src_key, src_start, joined))
    new = np.ones(len(start), bool)
    new[1:] = ((src_key[1:] != src_key[:-1]) | (start[1:] - src_start[1:] != start[:-1] - src_start[:-1])
               | (start[1:] != start[:-1] + n[:-1]) | ~joined[1:])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(start)) - 1
    return start[at], start[last] + n[last] - start[at], src_key[at], src_start[at]


def _compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: pieces to paths (no branch inside), paths to long spans."""
    for b in batches:
        keys = b.column(0).to_numpy(zero_copy_only=False)
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        for i in range(b.num_rows):
            p = b.column(1)[i].values
            start, n, src_key, src_start = (p.field(j).to_numpy().astype(np.int64) for j in range(4))
            paths = glue(start, n, src_key, src_start, p.field(4).to_numpy(zero_copy_only=False))
            spans = glue(*paths, np.ones(len(paths[0]), bool))
            for x, y in zip(out, (np.full(len(spans[0]), keys[i]), *spans)):
                x.append(y)
        if out[0]:
            c = [np.concatenate(x) for x in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[0]), pa.array(c[1].astype(np.int32)), pa.array(c[2].astype(np.int32)), pa.array(c[3]),
                 pa.array(c[4].astype(np.int32))], ["key", "start", "n", "src_key", "src_start"])


def repeated_spans(docs: DataFrame, length: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``SPANS`` of a keyed table, written: n windows from ``start`` repeat those of an earlier place."""
    cand = repeated_contexts(docs, length, anchor, words=True)
    place = F.struct("key", "start")
    paths = materialise(cand.groupBy("fp", "dig", "n").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c")),
                        "paths")
    later = (cand.join(paths.filter("c > 1"), ["fp", "dig", "n"]).filter(place != F.col("first"))
             .select("key", "start", "n", F.col("first.key").alias("src_key"), F.col("first.start").alias("src_start"),
                     F.lit(True).alias("joined")))
    several = paths.groupBy("fp").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("fp")
    # A document's runs are as many as its words at most.
    lists = (paths.join(several, "fp", "left_semi")
             .select(F.col("first.key").alias("key"), F.struct(F.col("first.start").alias("start"), "n").alias("run"))
             .groupBy("key").agg(F.collect_list("run").alias("runs")))
    edges = docs.select("key", "text").join(lists.hint("merge"), "key").mapInArrow(_edges(length), EDGES)
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    edges = edges.repartition(n, "ka", "kb")  # one exchange serves the counts and the join
    nodes = (edges.groupBy("ka", "kb").agg(
        F.min(F.struct("key", "pos")).alias("first"), F.count(F.lit(1)).alias("c"),
        F.min(F.shiftrightunsigned("ways", 32)).alias("in_lo"), F.max(F.shiftrightunsigned("ways", 32)).alias("in_hi"))
        .filter("c > 1"))
    single = (edges.join(nodes, ["ka", "kb"]).filter(F.struct("key", "pos") != F.col("first"))
              .select("key", F.col("pos").alias("start"), F.lit(1).alias("n"), F.col("first.key").alias("src_key"),
                      F.col("first.pos").alias("src_start"), (F.col("in_lo") == F.col("in_hi")).alias("joined")))
    single = materialise(single, "edges")
    pieces = later.unionAll(single).groupBy("key").agg(
        F.collect_list(F.struct("start", "n", "src_key", "src_start", "joined")).alias("p"))
    out = materialise(pieces.mapInArrow(_compact, SPANS), "spans")
    discard(cand, paths, single)
    return out


def _finish(length: int, keep_text: bool):
    """Digests of the listed spans and the document without its repeated words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for lo, hi, buf, off in slices(b.column(2)):
                s, e, first = word_bounds(buf, off, PLAIN_WORD)
                raw = buf.tobytes()
                for i in range(hi - lo):
                    key, doc_id = b.column(0)[lo + i].as_py(), b.column(1)[lo + i].as_py()
                    ws, we = s[first[i]:first[i + 1]], e[first[i]:first[i + 1]]

                    def words(a: int, z: int) -> bytes:
                        return b" ".join(raw[ws[a]:we[z - 1]].split())

                    def digest(a: int, n: int) -> bytes:
                        return hashlib.blake2b(words(a, a + n + length - 1), digest_size=16).digest()

                    own, wanted = b.column(3)[lo + i].as_py() or [], b.column(4)[lo + i].as_py() or []
                    for x in own:
                        rows.append({"kind": 1, "key": key, **x, "digest": digest(x["start"], x["n"])})
                    for x in wanted:
                        rows.append({"kind": 2, "src_key": key, **x, "digest": digest(x["src_start"], x["n"])})
                    from_, to = merge_spans(np.array([x["start"] for x in own], np.int64),
                                            np.array([x["start"] + x["n"] + length - 1 for x in own], np.int64))
                    kept, at = [], 0
                    for a, z in zip(from_.tolist(), to.tolist()):
                        if a > at:
                            kept.append(words(at, a))
                        at = z
                    if at < len(ws):
                        kept.append(words(at, len(ws)))
                    text = b" ".join(kept)
                    rows.append({"kind": 0, "key": key, "doc_id": doc_id, "n_words": len(ws),
                                 "n_removed": int((to - from_).sum()), "kept_sha256": hashlib.sha256(text).hexdigest(),
                                 "kept": text.decode() if keep_text else None})
                    if len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, _DONE)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _DONE)

    return run


_DONE = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int32()),
                   ("n", pa.int32()), ("src_key", pa.int64()), ("src_start", pa.int32()), ("digest", pa.binary()),
                   ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                   ("kept", pa.string())])


def substring_dedup(docs: DataFrame, length: int = WINDOW, anchor: int = ANCHOR, keep_text: bool = False) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256`` (and ``kept``, the words that stay).

    Null and empty texts have no words (the digest of nothing). Documents come
    in order of doc_id, nulls first; rows with equal ids are separate documents
    in order of their text, so of two equal rows one is kept. An empty table
    gives an empty result. Columns other than ``doc_id`` and ``text`` are not read.
    """
    d = keyed(docs)
    spans = repeated_spans(d, length, anchor)
    while True:
        own = spans.groupBy("key").agg(F.collect_list(F.struct("start", "n", "src_key", "src_start")).alias("own"))
        wanted = (spans.select(F.col("src_key").alias("key"), "src_start", "n").distinct()
                  .groupBy("key").agg(F.collect_list(F.struct("src_start", "n")).alias("wanted")))
        asked = own.join(wanted, "key", "full")
        done = materialise(d.join(asked.hint("merge"), "key", "left").select("key", "doc_id", "text", "own", "wanted")
                           .mapInArrow(_finish(length, keep_text), DONE), "deduplicated")
        mine = done.filter("kind = 1").select("key", "start", "n", "src_key", "src_start", "digest")
        source = done.filter("kind = 2").select("src_key", "src_start", "n", F.col("digest").alias("source"))
        failed = mine.join(source, ["src_key", "src_start", "n"]).filter("digest <> source").select("key", "start", "n", "src_key")
        if failed.isEmpty():
            break
        spans = materialise(spans.join(failed, ["key", "start", "n", "src_key"], "left_anti"), "spans")
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"] + (["key", "kept"] if keep_text else [])
    return done.filter("kind = 0").select(*columns)
