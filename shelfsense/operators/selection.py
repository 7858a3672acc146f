"""Exact values of given ranks by repeated value-range counts.

Without groups, a pass runs over Arrow batches (``_counted``): the order-preserving bits of a value minus those of
its bracket's lower end, cut to ``RANGES * 16`` equal ranges, so heavy tails cost no further passes; the first bracket is a
column's smallest and largest value. With groups the same is done by grouped counts in SQL:

A rank's value is found without sorting, without windows and without shuffling
the values. One grouped aggregate gives count and a bounded sketch per group,
whose neighbouring grid points bracket every rank. A pass then cuts each
bracket into ``RANGES`` equal value ranges and counts rows per range (with the smallest and
largest value of each), all ranks of all groups in one grouped count: what is shuffled are
at most ``RANGES + 2`` rows per rank and task, however many rows there are and however
often a value occurs. The range that holds the rank is the next bracket, until it holds
a single value. The smallest and the largest value of a bracket always fall into different
ranges, so every pass makes progress; two or three passes are the rule.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.functions.columns import nan_to_null
from shelfsense.session import scratch_path

#: Value ranges of a pass; grid points of the sketch and its accuracy.
RANGES, GRID, ACCURACY = 4096, 256, 10_000
#: Rank tables up to this size are broadcast, larger ones joined by shuffle.
BROADCAST_RANKS = 50_000


#: With this setting on, the end of a statement removes the shuffle files it made.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writes, _lock = {"now": 0, "before": None}, threading.Lock()


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """What is executed meanwhile leaves no shuffle files; writes of several threads may overlap."""
    with _lock:
        if not _writes["now"]:
            _writes["before"] = spark.conf.get(REMOVE_SHUFFLES, None)
            spark.conf.set(REMOVE_SHUFFLES, "true")
        _writes["now"] += 1
    try:
        yield
    finally:
        with _lock:
            _writes["now"] -= 1
            if not _writes["now"]:
                spark.conf.unset(REMOVE_SHUFFLES) if _writes["before"] is None else spark.conf.set(REMOVE_SHUFFLES, _writes["before"])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; the shuffle files of the write are not kept."""
    path = scratch_path(df.sparkSession, name)
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Deletes a table of ``written`` that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def held(df: DataFrame):
    """``df`` kept in memory and on disk for several passes."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def to_long(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = (),
            name: str = "column", value: str = "v") -> DataFrame:
    """Unpivot numeric ``cols`` into (group..., column, v) with NaN as null."""
    pairs = F.array(*[F.struct(F.lit(c).alias("k"), nan_to_null(F.col(c).cast("double")).alias("x")) for c in cols])
    return (df.select(*group_cols, F.explode(pairs).alias("__kv"))
              .select(*group_cols, F.col("__kv.k").alias(name), F.col("__kv.x").alias(value)))


def _ranks(long: DataFrame, key: list[str], probs: Sequence[float],
           rank_of: Callable[[Column, Column], Column] | None) -> DataFrame:
    """One row per (key, prob): position, its rank below, and the bracket ``a..b`` of that rank."""
    grid = [i / GRID for i in range(GRID + 1)]
    stat = long.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"),
                                  F.percentile_approx("v", grid, ACCURACY).alias("grid"))
    asked = F.array(*[F.struct(F.lit(i).alias("q_index"), F.lit(float(p)).alias("prob")) for i, p in enumerate(probs)])
    t = stat.select("*", F.explode(asked).alias("p")).select(*key, "n", "least", "most", "grid", "p.*")
    pos = (F.col("n") - 1).cast("double") * F.col("prob") if rank_of is None else rank_of(F.col("n"), F.col("prob")).cast("double")
    t = t.withColumn("pos", pos).filter("pos >= 0 AND pos <= n - 1").withColumn("rank", F.floor("pos").cast("bigint"))
    # One grid step to either side covers the sketch's error (a 1 / ACCURACY share of the rows).
    step = F.floor(F.col("rank") / F.col("n") * GRID).cast("int")
    edge = lambda i: F.element_at("grid", F.greatest(F.least(i, F.lit(GRID)), F.lit(0)) + 1)
    a = F.when(step <= 1, F.col("least")).otherwise(edge(step - 1))
    b = F.when(step >= GRID - 2, F.col("most")).otherwise(edge(step + 2))
    return t.select(*key, "q_index", "prob", "pos", "rank", "least", "most", a.alias("a"), b.alias("b"))


def _one_pass(long: DataFrame, ranks: DataFrame, key: list[str], few: bool, ranges: int) -> DataFrame:
    """For every rank the value range that holds it: rows before it, its rows, least and largest value, the next value."""
    v, a, b = F.col("v"), F.col("a"), F.col("b")
    # Halves, so that the width of a bracket can't overflow; its two ends are apart in any case.
    inner = F.floor((v / 2 - a / 2) / (b / 2 - a / 2) * ranges)
    at = (F.when(v < a, F.lit(-1)).when(v > b, F.lit(ranges)).when(v == a, F.lit(0)).when(v == b, F.lit(ranges - 1))
          .otherwise(F.greatest(F.least(F.coalesce(F.nanvl(inner.cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(ranges - 1.0)),
                                F.lit(0.0)))).cast("int")
    asked = ranks.select(*key, "q_index", "a", "b")
    counts = (long.join(F.broadcast(asked) if few else asked, key)
              .groupBy(*key, "q_index", at.alias("at"))
              .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    return _located(ranks, counts, [*key, "q_index"])


def _located(ranks: DataFrame, counts: DataFrame, key: list[str]) -> DataFrame:
    """For every rank what ``counts`` (at, c, lo, hi) say about the value range that holds it."""
    lists = counts.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("at", "c", "lo", "hi"))).alias("ranges"))
    found = F.expr("""aggregate(ranges, named_struct('seen', 0L, 'before', -1L, 'c', 0L, 'lo', 0D, 'hi', 0D, 'next', cast(null AS double)),
        (s, r) -> if(s.before < 0,
            if(s.seen + r.c > rank,
               named_struct('seen', s.seen + r.c, 'before', s.seen, 'c', r.c, 'lo', r.lo, 'hi', r.hi, 'next', cast(null AS double)),
               named_struct('seen', s.seen + r.c, 'before', -1L, 'c', 0L, 'lo', 0D, 'hi', 0D, 'next', cast(null AS double))),
            named_struct('seen', s.seen, 'before', s.before, 'c', s.c, 'lo', s.lo, 'hi', s.hi, 'next', coalesce(s.next, r.lo))))""")
    return ranks.join(lists, key).withColumn("f", found).select(*ranks.columns, "f.*")


_SIGN = np.uint64(1 << 63)


def _bits(x: np.ndarray) -> np.ndarray:
    """Doubles as unsigned integers in the same order (-0.0 as 0.0)."""
    u = (np.asarray(x, float) + 0.0).view(np.uint64)
    return np.where(u & _SIGN, ~u, u | _SIGN)


def _double(u: np.ndarray) -> np.ndarray:
    return np.where(u & _SIGN, u ^ _SIGN, ~u).view(np.float64)


def _merged(parts: list[tuple]) -> tuple:
    """(at, c, lo, hi) arrays of several batches added up."""
    at, c, lo, hi = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return (at[first], np.add.reduceat(c[order], first), np.minimum.reduceat(lo[order], first),
            np.maximum.reduceat(hi[order], first))


def _counted(wide: DataFrame, slots: list[tuple[int, float, float]], ranges: int) -> DataFrame:
    """(slot, at, c, lo, hi): rows of a slot's column per value range of its bracket, below it (-1) and above it (``ranges``).

    ``slots`` are (column number, lower end, upper end). A task hands on one row per range it saw.
    """
    asked: dict[int, list[tuple]] = {}
    for s, (column, a, b) in enumerate(slots):
        ka, kb = (int(k) for k in _bits(np.array([a, b])))
        asked.setdefault(column, []).append((s, ka, kb, max(0, (kb - ka).bit_length() - (ranges - 1).bit_length())))

    def count(batches):
        found: dict[int, list[tuple]] = {}
        for b in batches:
            for column, own in asked.items():
                x = b.column(column).to_numpy(zero_copy_only=False)
                k = np.sort(_bits(x[~np.isnan(x)]))
                for s, ka, kb, shift in own if len(k) else ():
                    i, j = np.searchsorted(k, np.array([ka], np.uint64), "left")[0], np.searchsorted(k, np.array([kb], np.uint64), "right")[0]
                    at = ((k[i:j] - np.uint64(ka)) >> np.uint64(shift)).astype(np.int64)
                    at = np.concatenate([np.full(i, -1), at, np.full(len(k) - j, ranges)])
                    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                    last = np.append(first[1:], len(at)) - 1
                    parts = found.setdefault(s, [])
                    parts.append((at[first], last - first + 1, k[first], k[last]))
                    if len(parts) == 64:
                        found[s] = [_merged(parts)]
        for s, parts in found.items():
            at, c, lo, hi = _merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), s, np.int32)), pa.array(at.astype(np.int32)), pa.array(c),
                                              pa.array(_double(lo)), pa.array(_double(hi))], ["slot", "at", "c", "lo", "hi"])

    return wide.mapInArrow(count, "slot int, at int, c bigint, lo double, hi double").groupBy("slot", "at").agg(
        F.sum("c").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _whole_ranks(wide: DataFrame, cols: list[str], probs: Sequence[float], rank_of: Callable[[Column, Column], Column] | None,
                 ranges: int) -> DataFrame:
    """``select_ranks`` without groups; the driver sees one row per column and probability of every pass."""
    spark, ranges = wide.sparkSession, 1 << (16 * max(2, ranges) - 1).bit_length()
    x = [nan_to_null(F.col(f"`{c}`")) for c in wide.columns]
    row = wide.agg(*[f(c) for c in x for f in (F.count, F.min, F.max)]).first()   # one row
    ends = {i: row[3 * i:3 * i + 3] for i in range(len(cols)) if row[3 * i]}
    asked = [(i, int(n), q, float(p)) for i, (n, _, _) in ends.items() for q, p in enumerate(probs)]
    if rank_of is None:
        asked = [(*r, (r[1] - 1) * r[3]) for r in asked]
    elif asked:
        t = spark.createDataFrame(asked, "i int, n bigint, q_index int, prob double")
        asked = [tuple(r) for r in t.withColumn("pos", rank_of(F.col("n"), F.col("prob")).cast("double")).collect()]
    # (column number, q_index, prob, pos, rank, lower end, upper end)
    open_, done = [(i, q, p, pos, int(pos), *ends[i][1:]) for i, n, q, p, pos in asked if pos is not None and 0 <= pos <= n - 1], []
    while open_:
        slots = list(dict.fromkeys((r[0], r[5], r[6]) for r in open_))
        ranks = spark.createDataFrame([(n, slots.index((r[0], r[5], r[6])), r[4]) for n, r in enumerate(open_)],
                                      "no int, slot int, rank bigint")
        left = []
        for f in _located(F.broadcast(ranks), _counted(wide, slots, ranges), ["slot"]).collect():
            i, q, p, pos, rank = open_[f["no"]][:5]
            if f["lo"] < f["hi"]:
                left.append((i, q, p, pos, rank, f["lo"], f["hi"]))
                continue
            above, between = f["lo"] if rank + 1 < f["before"] + f["c"] else f["next"], pos - rank
            done.append((cols[i], q, p, f["lo"] if between == 0 else f["lo"] + (above - f["lo"]) * between))
        open_ = left
    return spark.createDataFrame(done, "column string, q_index int, prob double, value double")


def select_ranks(df: DataFrame, cols: Sequence[str], probs: Sequence[float], group_cols: Sequence[str] = (),
                 rank_of: Callable[[Column, Column], Column] | None = None, ranges: int = RANGES) -> DataFrame:
    """``(group..., column, q_index, prob, value)``: exact values at positions, linear between two ranks.

    The position of ``prob`` among ``n`` values is ``prob * (n - 1)``, or what ``rank_of(n, prob)`` says
    (it may use the group columns); positions outside 0..n-1 have no row. Null and
    NaN values don't count. ``df`` is read once and kept for the passes; the result is a small table (with groups a written one) of one row
    per group, column and probability.
    """
    g = list(group_cols)
    if not g and len(cols) * len(probs) <= BROADCAST_RANKS:
        with held(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])) as wide:
            return _whole_ranks(wide, list(cols), probs, rank_of, ranges)
    key = [*g, "column"]
    safe = {c: f"__g{i}" for i, c in enumerate(g)}   # groups are matched by a text that also stands for null
    with held(df.select(*g, *[F.col(c).cast("double").alias(c) for c in cols])) as wide:
        long = to_long(wide, cols, g).where(F.col("v").isNotNull())
        for c, s in safe.items():
            long = long.withColumn(s, F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")))
        inner = [*safe.values(), "column"]
        ranks = written(_ranks(long, [*safe.values(), "column", *g], probs, rank_of), "ranks")
        names = ranks.select(*inner, *g).distinct() if g else None
        ranks = ranks.drop(*g)
        few = ranks.count() <= BROADCAST_RANKS
        done = None
        while True:
            step = written(_one_pass(long.select(*inner, "v"), ranks, inner, few, max(2, ranges)), "rank-pass")
            ready = step.filter("before >= 0 AND lo = hi")
            done = ready if done is None else done.unionAll(ready)
            # A rank outside its bracket (the sketch was off) starts again from the side it is on.
            left = step.filter("before < 0 OR lo < hi").select(
                *inner, "q_index", "prob", "pos", "rank", "least", "most", F.col("lo").alias("a"), F.col("hi").alias("b"))
            if left.isEmpty():
                break
            ranks = left
        above = F.when(F.col("rank") + 1 < F.col("before") + F.col("c"), F.col("lo")).otherwise(F.col("next"))
        between = F.col("pos") - F.col("rank")
        value = F.when(between == 0, F.col("lo")).otherwise(F.col("lo") + (above - F.col("lo")) * between)
        out = done.select(*inner, "q_index", "prob", value.alias("value"))
        if g:
            out = out.join(F.broadcast(names) if few else names, inner)
        return written(out.select(*key, "q_index", "prob", "value"), "rank-values")
