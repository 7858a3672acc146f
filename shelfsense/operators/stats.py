"""Distributed statistics: exact quantiles, summaries, correlation, VIF,
histograms and box-plot numbers.

Exact quantiles avoid Spark's ``percentile`` aggregate on purpose: it keeps
every distinct value of a group in one in-memory map on one task. They are
selected by counting values per range (``selection``). The interpolation is the usual linear one:
pos = p * (n - 1); v = v[floor] + (v[ceil] - v[floor]) * (pos - floor).
"""

from __future__ import annotations

import os
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.functions.columns import nan_to_null
from shelfsense.operators.selection import RANGES, held, select_ranks, to_long, written

# Value-range buckets per (group, column) for ranks and running sums: each
# window task holds about 1 / DEFAULT_BUCKETS of a column's distinct values.
DEFAULT_BUCKETS = int(os.environ.get("SHELFSENSE_QUANTILE_BUCKETS", "64"))


def bucket_of(edges: str, v, n_edges: int):
    """Number of sorted ``edges`` that are <= v, as a static binary-search
    expression tree (log2 comparisons per row, codegen-friendly)."""
    v = F.col(v) if isinstance(v, str) else v

    def count(lo: int, hi: int):
        if lo >= hi:
            return F.lit(0)
        mid = (lo + hi) // 2
        e = F.element_at(F.col(edges), mid + 1)
        return F.when(e <= v, F.lit(mid - lo + 1) + count(mid + 1, hi)).otherwise(count(lo, mid))

    return count(0, n_edges)


def quantiles_long(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   group_cols: Sequence[str] = (), rank_of=None, buckets: int = RANGES) -> DataFrame:
    """Exact linear-interpolated quantiles; one row per (group..., column, q_index, prob).

    ``rank_of(n, prob)`` may replace the position rule: it maps the column
    count ``n`` and ``prob`` to a (0-based, possibly fractional) rank. ``buckets``
    is the number of value ranges a pass counts.
    """
    return select_ranks(df, cols, probs, group_cols, rank_of, buckets)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    group_cols: Sequence[str] = (), **kw) -> DataFrame:
    """Wide form: one row per group with ``{col}_q{i}`` columns."""
    long = quantiles_long(df, cols, probs, group_cols, **kw)
    names = [f"{c}_q{i}" for c in cols for i in range(len(probs))]
    wide = (long.withColumn("name", F.concat(F.col("column"), F.lit("_q"), F.col("q_index")))
                .groupBy(*group_cols).pivot("name", names).agg(F.first("value")))
    return wide


def describe(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (exact, linear), max per column."""
    g = list(group_cols)
    with held(df.select(*g, *cols)) as kept:
        v = {c: nan_to_null(F.col(c).cast("double")) for c in cols}
        one = [F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                        F.min(x).alias("min"), F.max(x).alias("max")) for c, x in v.items()]
        # All columns of a row in one go: no row is taken apart for them. An empty table has no moments.
        moments = written(kept.groupBy(*g).agg(F.array(*one).alias("m"), F.count(F.lit(1)).alias("n")).filter("n > 0")
                          .select(*g, F.explode("m").alias("m")).select(*g, "m.*"), "moments")
        q = quantiles_long(kept, cols, [0.25, 0.5, 0.75], g)
    q = q.groupBy(*g, "column").agg(*[F.max(F.when(F.col("q_index") == i, F.col("value"))).alias(f"p{p}")
                                      for i, p in enumerate((25, 50, 75))])
    return moments.join(q, g + ["column"], "left").select(
        *g, "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def pair_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, j, n, mi, mj, cii, cjj, cij) of every pair of columns, i <= j, over the rows that have both (NaN is a gap).

    One pass: a task adds up its batches' centred sums of all pairs as matrices and hands on
    one row per pair; the tasks' rows are merged pairwise, as exact as one running sum.
    """
    k = len(cols)

    def sums(batches):
        state = None
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
            m = (~np.isnan(x)).astype(float)
            x = np.where(m > 0, x, 0.0)
            shift = x.sum(0) / np.maximum(m.sum(0), 1.0)     # near the means, so that little is lost
            x = np.where(m > 0, x - shift, 0.0)
            n = m.T @ m
            some = np.maximum(n, 1.0)
            d = x.T @ m / some                               # [i, j]: mean of i over the rows that have j, too
            new = (n, shift[:, None] * (n > 0) + d, (x * x).T @ m - n * d * d, x.T @ x - n * d * d.T)
            state = new if state is None else _merged(state, new)
        if state is not None:
            i, j = np.triu_indices(k)
            n, mean, sq, both = state
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (
                i.astype(np.int32), j.astype(np.int32), n[i, j].astype(np.int64), mean[i, j], mean[j, i], sq[i, j], sq[j, i],
                both[i, j])], ["i", "j", "n", "mi", "mj", "cii", "cjj", "cij"])

    parts = df.select(*[nan_to_null(F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(
        sums, "i int, j int, n bigint, mi double, mj double, cii double, cjj double, cij double")
    one = F.struct("n", "mi", "mj", "cii", "cjj", "cij")
    merge = """aggregate(slice(parts, 2, size(parts)), parts[0], (s, p) -> if(p.n = 0, s, if(s.n = 0, p, named_struct('n', s.n + p.n,
        'mi', s.mi + (p.mi - s.mi) * p.n / (s.n + p.n), 'mj', s.mj + (p.mj - s.mj) * p.n / (s.n + p.n),
        'cii', s.cii + p.cii + (p.mi - s.mi) * (p.mi - s.mi) * s.n * (p.n / (s.n + p.n)),
        'cjj', s.cjj + p.cjj + (p.mj - s.mj) * (p.mj - s.mj) * s.n * (p.n / (s.n + p.n)),
        'cij', s.cij + p.cij + (p.mi - s.mi) * (p.mj - s.mj) * s.n * (p.n / (s.n + p.n))))))"""
    return (parts.groupBy("i", "j").agg(F.sort_array(F.collect_list(one)).alias("parts"))   # a row per task
            .select("i", "j", F.expr(merge).alias("m")).select("i", "j", "m.*"))


def _merged(a: tuple, b: tuple) -> tuple:
    """Counts, means, squares and products of two sets of rows (matrices by pair)."""
    n = a[0] + b[0]
    share, gap = b[0] / np.maximum(n, 1.0), b[1] - a[1]
    mean = np.where(a[0] == 0, b[1], np.where(b[0] == 0, a[1], a[1] + gap * share))
    gap = np.where((a[0] == 0) | (b[0] == 0), 0.0, gap)
    return n, mean, a[2] + b[2] + gap * gap * a[0] * share, a[3] + b[3] + gap * gap.T * a[0] * share


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair (pairwise complete), long form (a, b, corr); null where a column doesn't vary.

    From ``pair_moments``: one pass over the rows for all pairs.
    """
    cols = list(cols)
    spread = F.sqrt(F.col("cii") * F.col("cjj"))
    m = pair_moments(df, cols).select("i", "j", F.when((F.col("n") > 1) & (spread != 0), F.col("cij") / spread).alias("corr"))
    names = F.array(*[F.lit(c) for c in cols])
    sides = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    return m.select(F.explode(sides).alias("p"), "corr").select(
        F.element_at(names, F.col("p.i") + 1).alias("a"), F.element_at(names, F.col("p.j") + 1).alias("b"), "corr")


def covariance_moments(df: DataFrame, cols: Sequence[str]):
    """n, means and the population covariance matrix from one aggregate."""
    cs = [F.col(c).cast("double") for c in cols]
    clean = df.na.drop(subset=list(cols))
    exprs = [F.count(F.lit(1)).alias("n")] + [F.avg(c).alias(f"m{i}") for i, c in enumerate(cs)]
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            exprs.append(F.covar_pop(cs[i], cs[j]).alias(f"c{i}_{j}"))
    row = clean.agg(*exprs).collect()[0]   # one row of k*(k+1)/2 numbers
    k = len(cols)
    cov = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            cov[i, j] = cov[j, i] = row[f"c{i}_{j}"]
    means = np.array([row[f"m{i}"] for i in range(k)])
    return row["n"], means, cov


def vif(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Variance inflation factor of every column, plus the constant term.

    VIF_j = 1 / (1 - R_j^2), R_j^2 from the other columns' correlations; for the
    intercept VIF = 1 + m' S^-1 m (S population covariance, m means). A column
    that the others determine has an infinite factor, and so has a constant
    column (the intercept determines it) unless it is zero, whose factor is
    undefined (null). Only the k x k moment matrix reaches the driver.
    """
    n, m, cov = covariance_moments(df, cols)
    var = np.diag(cov)
    varies = np.array([v > 1e-12 * max(1.0, mean * mean) for v, mean in zip(var, m)], bool)
    sd = np.sqrt(np.where(varies, var, 1.0))
    corr = cov / np.outer(sd, sd)
    live = np.flatnonzero(varies)

    def factor(j: int) -> float:
        rest = [i for i in live if i != j]
        if not rest:
            return 1.0
        c = corr[rest, j]
        free = 1.0 - float(c @ np.linalg.pinv(corr[np.ix_(rest, rest)], rcond=1e-10, hermitian=True) @ c)
        return float("inf") if free < 1e-9 else 1.0 / free

    if (~varies & (m != 0)).any():
        const = float("inf")
    else:
        z = m[live] / sd[live]
        back = np.linalg.pinv(corr[np.ix_(live, live)], rcond=1e-10, hermitian=True) if len(live) else np.zeros((0, 0))
        lost = z - corr[np.ix_(live, live)] @ back @ z     # part of the means outside the columns' span
        const = float("inf") if np.abs(lost).max(initial=0.0) > 1e-6 * max(1.0, np.abs(z).max(initial=0.0)) \
            else float(1.0 + z @ back @ z)
    rows = [("const", const)]
    rows += [(c, factor(i) if varies[i] else (float("inf") if m[i] else None)) for i, c in enumerate(cols)]
    out = df.sparkSession.createDataFrame(rows, "feature string, vif double")
    return out.orderBy(F.desc("vif"))


def histogram(df: DataFrame, col: str, bins: int, lower=None, upper=None) -> DataFrame:
    """Equal-width histogram over [min, max] (or given bounds), last bin closed.

    One aggregate for the bounds, one grouped count, and a full bin grid so
    empty bins show 0.
    """
    x = nan_to_null(F.col(col).cast("double"))
    if lower is not None:
        x = F.when(x < lower, F.lit(float(lower))).otherwise(x)
    if upper is not None:
        x = F.when(x > upper, F.lit(float(upper))).otherwise(x)
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    bounds = vals.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / width).cast("int"), F.lit(bins - 1)))
    counts = (vals.crossJoin(F.broadcast(bounds)).select(b.alias("bin"))
                  .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    grid = (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
            .crossJoin(F.broadcast(bounds)))
    return (grid.join(counts, "bin", "left")
                .select("bin",
                        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                        F.coalesce(F.col("n"), F.lit(0)).alias("n")))


def boxplot_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (furthest points inside the fences) and
    outlier counts per column."""
    long = to_long(df, cols).where(F.col("v").isNotNull())
    q = (quantiles_long(df, cols, [0.25, 0.5, 0.75])
         .groupBy("column").pivot("q_index", [0, 1, 2]).agg(F.first("value"))
         .withColumnRenamed("0", "q1").withColumnRenamed("1", "median").withColumnRenamed("2", "q3")
         .withColumn("iqr", F.col("q3") - F.col("q1"))
         .withColumn("lo_fence", F.col("q1") - 1.5 * F.col("iqr"))
         .withColumn("hi_fence", F.col("q3") + 1.5 * F.col("iqr")))
    inside = (F.col("v") >= F.col("lo_fence")) & (F.col("v") <= F.col("hi_fence"))
    agg = (long.join(F.broadcast(q), "column")
               .groupBy("column", "q1", "median", "q3", "iqr", "lo_fence", "hi_fence")
               .agg(F.min(F.when(inside, F.col("v"))).alias("whisker_lo"),
                    F.max(F.when(inside, F.col("v"))).alias("whisker_hi"),
                    F.sum(F.when(~inside, 1).otherwise(0)).alias("n_outliers")))
    return agg


def running_totals(vc: DataFrame, key: Sequence[str], value: str, sums: Sequence[str],
                   buckets: int = DEFAULT_BUCKETS, accuracy: int = 10000) -> DataFrame:
    """Inclusive running sums of ``sums`` over ``value`` within ``key``, and
    the next distinct value (``next_v``), for a table with one row per
    (key, value).

    Same bucketing as the quantiles: value-range buckets from a bounded
    sketch, bucket offsets from a small per-bucket table, then a window per
    (key, bucket), so no task holds a whole key.
    """
    key = list(key)
    edges_p = [i / buckets for i in range(1, buckets)]
    edges = vc.groupBy(*key).agg(F.percentile_approx(value, edges_p, accuracy).alias("__edges"))
    vb = (vc.join(edges, key)
            .withColumn("__b", bucket_of("__edges", value, len(edges_p)))
            .drop("__edges"))
    per_b = vb.groupBy(*key, "__b").agg(*[F.sum(s).alias(f"__bs_{s}") for s in sums],
                                          F.min(value).alias("__bmin"))
    wk = Window.partitionBy(*key).orderBy("__b")
    prev = wk.rowsBetween(Window.unboundedPreceding, -1)
    per_b = per_b.select(*key, "__b",
                         *[F.coalesce(F.sum(f"__bs_{s}").over(prev), F.lit(0)).alias(f"__off_{s}") for s in sums],
                         F.lead("__bmin").over(wk).alias("__next_bmin"))
    wb = Window.partitionBy(*key, "__b").orderBy(value)
    upto = wb.rowsBetween(Window.unboundedPreceding, 0)
    out = vb.join(per_b, key + ["__b"])
    for s in sums:
        out = out.withColumn(f"cum_{s}", F.col(f"__off_{s}") + F.sum(s).over(upto))
    out = out.withColumn("next_v", F.coalesce(F.lead(value).over(wb), F.col("__next_bmin")))
    return out.drop("__b", "__next_bmin", *[f"__off_{s}" for s in sums])


def kth_smallest(df: DataFrame, col: str, k_of, group_cols: Sequence[str] = ()) -> DataFrame:
    """The value of rank ``k_of(n) - 1`` (``k_of`` maps the group count to k)
    per group, exact and distributed: (group..., kth). A group with k = 0 has
    no row."""
    out = quantiles_long(df, [col], [0.0], group_cols, rank_of=lambda n, p: k_of(n) - 1)
    return out.select(*group_cols, F.col("value").alias("kth"))
