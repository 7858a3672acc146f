"""Near-duplicate documents: fast similarity sketching, banding, exact verification.

Sketch of a set of shingles with t coordinates (bins): in round i < t every
shingle is thrown into one bin by a hash of (i, shingle) and the bin keeps the
smallest (i, value); the rounds end as soon as no bin is empty. Rounds t to
2t - 1 throw every shingle into bin i - t, so each coordinate is filled after 2t
rounds at the latest, however small the set. Two sets agree in a coordinate
with the probability of their similarity, with Chernoff-type concentration as
for independent hashes, at about n + t log t throws instead of n * t.

Work on Spark:

1. Documents with equal sets are one class (count and 128-bit digest of the
   set, partial minima before the shuffle); its smallest key represents it.
2. Representatives meet in buckets of ``BANDS`` bands of ``ROWS`` coordinates. At
   similarity 0.75 a pair misses all buckets with probability
   (1 - 0.75^5)^40 = 2e-5.
3. Buckets are worked off in rounds with pivots, not by all pairs: first the
   most central member (the one that meets most documents in all its buckets,
   so the least edited of a group of copies) is compared with all others, then those of ranks 2 to 15,
   16 to 127 and so on with those after them that aren't in the same component yet. A bucket is done when every pair was
   compared or is in one component. So a bucket of mutual copies costs one
   comparison per member; only pairs that could still change a component, and
   whose finer sketches (1024 coordinates, for members of shared buckets) agree as
   they must (see ``alike``; a pair at similarity 0.75 fails with probability 1e-6),
   are ever emitted.
4. Pairs of fitting sizes are confirmed on the full sets with
   ``100 * intersection >= 75 * union``, and components formed by Spark joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.llm.common import (BASE_D, LOWER, PLAIN_WORD, U, discard, keyed, materialise, mix, prefix_hash, returning,
                                   signed, slices, span_hash, window_hashes, with_text, word_bounds, word_hashes)
from shelfsense.llm.components import components

#: Words of a shingle; similarity in per cent; bands and coordinates per band.
SHINGLE, PERCENT, BANDS, ROWS = 5, 75, 40, 5
#: Growth of the ranks worked off in a round.
GROWTH = 8
#: Coordinates of the finer sketch by which pairs are sorted out before the exact check.
FINE = 1024
SKETCHES = "key bigint, doc_id bigint, n bigint, d1 bigint, d2 bigint, bands array<bigint>"


def shingle_sets(buf: np.ndarray, off: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows one after the other, and where each row's begin (and the end)."""
    s, e, first = word_bounds(buf, off, PLAIN_WORD)
    h = word_hashes(buf, s, e, LOWER)
    windows = window_hashes(h, k)
    sums = prefix_hash(h, BASE_D)
    sets, sizes = [], np.zeros(len(off) - 1, np.int64)
    for i, (a, z) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if z == a:
            continue
        if z - a < k:
            own = span_hash(sums, np.array([a]), np.array([z]), BASE_D)
        else:
            own = np.sort(windows[a:z - k + 1])
            own = own[np.r_[True, own[1:] != own[:-1]]]
        sets.append(own)
        sizes[i] = len(own)
    return (np.concatenate(sets) if sets else np.zeros(0, U)), np.concatenate([[0], np.cumsum(sizes)])


def sketch(sets: np.ndarray, begin: np.ndarray, t: int) -> np.ndarray:
    """(rows, t) coordinates; rows without shingles have none that mean anything."""
    n = len(begin) - 1
    out = np.zeros((n, t), U)
    # (row, bin) and a 40-bit value share one sort key.
    step = max(1, (1 << 24) // t - 1)
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        h = sets[begin[lo]:begin[hi]]
        size = np.diff(begin[lo:hi + 1])
        row = np.repeat(np.arange(hi - lo), size)
        flat = np.zeros((hi - lo) * t, U)
        full = np.zeros((hi - lo) * t, bool)
        for i in range(2 * t):
            if not len(h):
                break
            g = mix(h ^ mix(np.full(1, i + 1, U) * U(0xA24BAED4963EE407)))
            value = g >> U(24)
            place = (g & U(0xFFFFFF)) * U(t) >> U(24) if i < t else np.full(len(g), i - t, U)
            key = np.sort(((row.astype(U) * U(t) + place) << U(40)) | value)
            at = (key >> U(40)).astype(np.int64)
            keep = np.ones(len(at), bool)
            keep[1:] = at[1:] != at[:-1]
            at, value = at[keep], key[keep] & U((1 << 40) - 1)
            new = ~full[at]
            flat[at[new]] = (U(i + 1) << U(40)) | value[new]
            full[at[new]] = True
            missing = (~full.reshape(hi - lo, t)).any(1)
            if not missing[row].all():
                stay = missing[row]
                h, row = h[stay], row[stay]
        out[lo:hi] = flat.reshape(hi - lo, t)
    return out


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One bucket key per row and band."""
    odd = mix(np.arange(1, rows + 1, dtype=U)) | U(1)
    h = (mix(coordinates).reshape(len(coordinates), bands, rows) * odd).sum(2, dtype=U)
    return mix(h ^ mix(np.arange(1, bands + 1, dtype=U) * U(0x8CB92BA72F3D8DD7)))


def marks_of(coordinates: np.ndarray) -> np.ndarray:
    """Four bits of every coordinate, sixteen coordinates in a number."""
    n, t = coordinates.shape
    bits = np.zeros((n, -(-t // 16) * 16), U)
    bits[:, :t] = mix(coordinates ^ U(0x1B873593CC9E2D51)) & U(15)
    return (bits.reshape(n, -1, 16) << (np.arange(16, dtype=U) * U(4))).sum(2, dtype=U)


def alike(t: int, percent: int, a: str, b: str) -> Column:
    """Sketches agree often enough for the similarity: within five standard deviations of what it makes expected.

    Coordinates of a pair at similarity s agree in four bits with probability s + (1 - s) / 16.
    """
    equal = percent / 100 + (1 - percent / 100) / 16
    least = t * equal - 5 * (t * equal * (1 - equal)) ** 0.5
    any_bit = "(u ^ v) | shiftrightunsigned(u ^ v, 1) | shiftrightunsigned(u ^ v, 2) | shiftrightunsigned(u ^ v, 3)"
    return F.expr(f"aggregate(zip_with({a}, {b}, (u, v) -> bit_count(({any_bit}) & {0x1111111111111111}L)), 0, "
                  f"(s, x) -> s + x) <= {int(t - least)}")


def _sketches(bands: int, rows: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, off in slices(b.column(2)):
                sets, begin = shingle_sets(buf, off, shingle)
                size = np.diff(begin)
                total = np.zeros((2, len(sets) + 1), U)
                np.cumsum(mix(sets), dtype=U, out=total[0, 1:])
                np.cumsum(mix(sets * U(BASE_D) ^ U(0x27D4EB2F165667C5)), dtype=U, out=total[1, 1:])
                digest = total[:, begin[1:]] - total[:, begin[:-1]]
                keys = band_keys(sketch(sets, begin, bands * rows), bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * bands),
                                                 pa.array(signed(keys.reshape(-1))))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(size),
                     pa.array(signed(digest[0])), pa.array(signed(digest[1])), lists],
                    ["key", "doc_id", "n", "d1", "d2", "bands"])

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, off in slices(b.column(1)):
                sets, begin = shingle_sets(buf, off, shingle)
                marks = marks_of(sketch(sets, begin, FINE))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo),
                     pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(signed(sets))),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(marks) + 1, dtype=np.int32) * marks.shape[1]),
                                              pa.array(signed(marks.reshape(-1))))], ["key", "s", "marks"])

    return run


def sizes_fit(a: Column, b: Column, percent: int) -> Column:
    """Sets of these sizes can reach the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def confirm(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full shingle sets reach the similarity, written."""
    x, y = sets.select(F.col("key").alias("a"), F.col("s").alias("sa")), sets.select(F.col("key").alias("b"), F.col("s").alias("sb"))
    both = pairs.join(x, "a").join(y, "b")
    both = both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"),
                       F.size(F.array_intersect("sa", "sb")).alias("common"))
    return materialise(both.filter(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common")))
                       .select("a", "b"), "confirmed")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept`` (and the internal ``key``).

    Words are runs of anything but ASCII white space, A-Z lower-cased. Null,
    empty and blank texts have no shingles and are linked with nothing. Rows
    with equal or null ids are separate documents (in order of id, nulls first,
    then text): of equal rows one is kept; the component of a null id's row
    is named by the first non-null id it links to, else null. An empty table gives
    an empty result. Columns other than ``doc_id`` and ``text`` are not read.
    """
    return _components(keyed(docs), percent, shingle, bands, rows)


def keep_first(docs: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs``, all columns, that ``near_duplicates`` keeps: the first of every component."""
    d = keyed(docs, carry=True)
    settings = {"percent": PERCENT, "shingle": SHINGLE, "bands": BANDS, "rows": ROWS} | options
    kept = _components(d.select("key", "doc_id", "text"), **settings).filter("kept").select("key")
    return with_text(d.join(materialise(kept, "kept").hint("merge"), "key", "left_semi"), docs)


def _components(d: DataFrame, percent: int, shingle: int, bands: int, rows: int) -> DataFrame:
    base = materialise(d.mapInArrow(returning(_sketches(bands, rows, shingle)), SKETCHES), "sketches")
    classes = materialise(base.filter("n > 0").groupBy("n", "d1", "d2").agg(F.min("key").alias("rep")), "classes")
    reps = base.join(classes.select(F.col("rep").alias("key")), "key", "left_semi")
    bucket = Window.partitionBy("bucket")
    shared = (reps.select("key", "n", F.explode("bands").alias("bucket"))
              .withColumn("m", F.count(F.lit(1)).over(bucket)).filter("m > 1"))
    # A document's centrality: how many it meets in all its buckets.
    central = shared.groupBy("key").agg(F.first("n").alias("n"), F.sum("m").alias("c"),
                                        F.collect_list(F.struct("bucket", "m")).alias("own"))
    order = F.struct((-F.col("c")).alias("c"), "key", "n")
    placed = (central.select("key", "n", "c", F.explode("own").alias("x")).select("key", "n", "c", "x.*")
              .withColumns({"rank": F.row_number().over(bucket.orderBy(F.desc("c"), "key")), "pivot": F.min(order).over(bucket)}))
    # One row per document again (at most BANDS entries), so that labels are joined to documents, not to entries.
    members = materialise(placed.groupBy("key").agg(F.first("n").alias("n"), F.collect_list(
        F.struct("bucket", "rank", "m", F.col("pivot.key").alias("pivot"), F.col("pivot.n").alias("pivot_n"))).alias("own")),
        "members")
    pairs = (members.select("key", "n", F.explode("own").alias("x"))
             .filter((F.col("x.rank") > 1) & sizes_fit(F.col("n"), F.col("x.pivot_n"), percent))
             .select(F.col("x.pivot").alias("a"), F.col("key").alias("b")).distinct())
    sets = materialise(d.select("key", "text").join(members.select("key").hint("merge"), "key", "left_semi")
                       .mapInArrow(returning(_sets(shingle)), "key bigint, s array<bigint>, marks array<bigint>"), "sets")
    links = confirm(sets, pairs, percent)
    labels = components(links)
    lo = 2
    while True:
        # Entries not worked off; only buckets with more than one component among them go on.
        m = (members.join(sets.select("key", "marks"), "key").alias("m")
             .join(labels.alias("l"), F.col("m.key") == F.col("l.key"), "left")
             .select("m.key", "m.n", "m.marks", F.col("m.own.bucket").alias("buckets"),
                     F.coalesce("l.label", "m.key").alias("label"),
                     F.explode(F.filter("m.own", lambda x: x["rank"] >= lo)).alias("x")))
        open_ = materialise(
            m.select("key", "n", "marks", "buckets", "label", "x.bucket", "x.rank")
            .withColumns({"first": F.min("label").over(bucket), "last": F.max("label").over(bucket)})
            .filter(F.col("first") != F.col("last")).drop("first", "last"), "open")
        if open_.isEmpty():
            break
        hi = GROWTH * lo
        p, o = open_.filter(F.col("rank") < hi).alias("p"), open_.alias("o")
        pairs = (o.join(p, (F.col("o.bucket") == F.col("p.bucket")) & (F.col("o.rank") > F.col("p.rank"))
                        & (F.col("o.label") != F.col("p.label")) & sizes_fit(F.col("o.n"), F.col("p.n"), percent)
                        & alike(FINE, percent, "o.marks", "p.marks")
                        # of the buckets that a pair shares, only the first emits it
                        & (F.array_min(F.array_intersect("o.buckets", "p.buckets")) == F.col("o.bucket")))
                 .select(F.least("p.key", "o.key").alias("a"), F.greatest("p.key", "o.key").alias("b")).distinct())
        found = confirm(sets, pairs, percent)
        discard(open_)
        if not found.isEmpty():
            links = links.unionAll(found)
            labels = components(links)
        lo = hi
    discard(members, sets)
    # Every document: its class, the class's component, the component's first document.
    c = base.alias("b").join(classes.alias("c"), F.expr("b.n = c.n AND b.d1 = c.d1 AND b.d2 = c.d2"), "left").select(
        "b.key", "b.doc_id", "b.n", F.coalesce("c.rep", "b.key").alias("rep"))
    g = c.alias("c").join(labels.alias("l"), F.col("c.rep") == F.col("l.key"), "left").select(
        "c.key", "c.doc_id", "c.n", F.coalesce("l.label", "c.rep").alias("first"))
    named = (g.groupBy("first").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("size"))
             .filter("size > 1").select("first", "component_id"))
    out = g.alias("g").join(named.alias("n"), F.col("g.first") == F.col("n.first"), "left")
    return out.select("g.doc_id", F.col("g.n").alias("n_shingles"),
                      F.coalesce("n.component_id", "g.doc_id").alias("component_id"),
                      (F.col("g.key") == F.col("g.first")).alias("kept"), "g.key")
