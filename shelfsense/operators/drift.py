"""Data drift between a reference half and a current half of a table.

The halves follow a total row order (W7): the first floor(n/2) rows are the
reference. The cut is found without a global sort: rows per day, then row
numbers only inside the one day that straddles the middle, by range
partitions and the counts before them.

The test of a column is a parameter, not a matter of its size: ``ks`` (two-sample
Kolmogorov-Smirnov D) and ``wasserstein`` (distance divided by the reference std) for numbers,
``jensenshannon`` (distance), ``chisquare`` and ``z`` (difference of the shares of a two-valued
column) for any. Distances drift from 0.1 on, the others where p < 0.05. The table drifts when
at least half of the columns do. ``all_statistics`` gives every statistic that a column has.

All statistics come from per-(column, value) counts of the two halves (one
grouped aggregate) and bucketed running sums; only per-column numbers reach
the driver for the p-values.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsense.functions.columns import nan_to_null
from shelfsense.operators.selection import held, written
from shelfsense.operators.stats import running_totals

KS_ALPHA = 0.05
DIST_THRESHOLD = 0.1
ZERO_FILL = 0.0001
#: Tests of a column without one of its own, by kind.
DEFAULT_TESTS = {"num": "wasserstein", "cat": "jensenshannon"}
#: Result column of every test.
STATISTIC = {"ks": "ks_d", "wasserstein": "wasserstein_norm", "jensenshannon": "js_distance", "chisquare": "chi2", "z": "z"}
NUMERIC_ONLY = ("ks", "wasserstein")


def half_split(df: DataFrame, day_col: str = "dt", tie_cols: Sequence[str] = ()) -> DataFrame:
    """Adds ``half`` = 'reference' for the first floor(n/2) rows in
    (day, *tie_cols) order, null days first, else 'current'. A timestamp is
    cut to its day, which bounds the broadcast day table."""
    if isinstance(df.schema[day_col].dataType, (T.TimestampType, T.TimestampNTZType)):
        return half_split(df.withColumn("__cut", F.to_date(day_col)), "__cut",
                          [day_col, *tie_cols]).drop("__cut")
    # One entry per day: the list is bounded by the calendar, not by the data volume. Null days come first.
    days = (df.groupBy(F.col(day_col).alias("day")).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.sort_array(F.collect_list(F.struct("day", "n"))).alias("days")).first()["days"])
    mid, before, cut = sum(d["n"] for d in days) // 2, 0, None
    for d in days:
        if before + d["n"] > mid:
            cut = d
            break
        before += d["n"]
    if cut is None:   # no rows
        return df.withColumn("half", F.lit(None).cast("string"))
    day, here = F.col(day_col), F.lit(cut["day"]).cast(df.schema[day_col].dataType)
    earlier = F.lit(False) if cut["day"] is None else F.coalesce(day < here, F.lit(True))
    name = lambda first: F.when(first, "reference").otherwise("current")
    if before == mid:   # the cut is between two days
        return df.withColumn("half", name(earlier))
    whole = df.where(~day.eqNullSafe(here)).withColumn("half", name(earlier))
    order = list(tie_cols) or [day_col]
    numbered = row_numbers(df.where(day.eqNullSafe(here)), order, "__rn")
    return whole.unionByName(numbered.withColumn("half", name(F.col("__rn") <= mid - before)).drop("__rn"))


def row_numbers(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Numbers from 1 in ``order``: rows are dealt to sorted ranges, and a range starts after the rows of those before it.

    No task holds more than its range; only the ranges' counts are added up (one number per range). The
    ranges are written once, so the numbers are the same whenever they are read.
    """
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    place = F.monotonically_increasing_id()   # range number and place inside it
    ranged = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__place", place), "ranges")
    part, at = F.shiftright("__place", 33), F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted((r["p"], r["n"]) for r in ranged.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for p, c in counts:
        starts += [F.lit(p), F.lit(total)]
        total += c
    start = F.create_map(*starts)[part] if starts else F.lit(0)
    return ranged.withColumn(name, (start + at + 1).cast("bigint")).drop("__place")


def value_counts_by_half(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str]) -> DataFrame:
    """(column, kind, v_num, v_cat, n_ref, n_cur) with one grouped aggregate."""
    items = ([F.struct(F.lit(c).alias("column"), F.lit("num").alias("kind"),
                       nan_to_null(F.col(c).cast("double")).alias("v_num"),
                       F.lit(None).cast("string").alias("v_cat")) for c in num_cols]
             + [F.struct(F.lit(c).alias("column"), F.lit("cat").alias("kind"),
                         F.lit(None).cast("double").alias("v_num"),
                         F.col(c).cast("string").alias("v_cat")) for c in cat_cols])
    long = df.select("half", F.explode(F.array(*items)).alias("p")).select("half", "p.*")
    long = long.where(F.col("v_num").isNotNull() | F.col("v_cat").isNotNull())
    return long.groupBy("column", "kind", "v_num", "v_cat").agg(
        F.sum((F.col("half") == "reference").cast("long")).alias("n_ref"),
        F.sum((F.col("half") == "current").cast("long")).alias("n_cur"))


def column_totals(vc: DataFrame) -> DataFrame:
    return vc.groupBy("column", "kind").agg(
        F.sum("n_ref").alias("total_ref"), F.sum("n_cur").alias("total_cur"),
        F.count(F.lit(1)).alias("n_unique"))


def distance_statistics(vc: DataFrame, totals: DataFrame) -> DataFrame:
    """KS D and Wasserstein / reference std for numeric columns, from
    bucketed running sums of the two halves' counts over the sorted values."""
    num = vc.where(F.col("kind") == "num").select("column", "v_num", "n_ref", "n_cur")
    run = running_totals(num, ["column"], "v_num", ["n_ref", "n_cur"]).join(
        F.broadcast(totals.select("column", "total_ref", "total_cur")), "column")   # one row per column
    fdiff = F.abs(F.col("cum_n_ref") / F.col("total_ref") - F.col("cum_n_cur") / F.col("total_cur"))
    stats = run.groupBy("column").agg(
        F.max(fdiff).alias("ks_d"),
        F.sum(F.when(F.col("next_v").isNotNull(), fdiff * (F.col("next_v") - F.col("v_num"))).otherwise(0.0))
         .alias("wasserstein"))
    mean_ref = num.groupBy("column").agg((F.sum(F.col("n_ref") * F.col("v_num")) / F.sum("n_ref")).alias("__mean"))
    std_ref = (num.join(F.broadcast(mean_ref), "column")
               .groupBy("column").agg(F.sqrt(F.sum(F.col("n_ref") * F.pow(F.col("v_num") - F.col("__mean"), 2))
                                             / F.sum("n_ref")).alias("std_ref")))
    return (stats.join(std_ref, "column", "left")
                 .withColumn("wasserstein_norm", F.col("wasserstein")
                             / F.when(F.col("std_ref") > 0, F.col("std_ref")).otherwise(F.lit(1.0))))


def share_statistics(vc: DataFrame, totals: DataFrame) -> DataFrame:
    """Jensen-Shannon distance (zero shares filled, renormalised) and the
    chi-square statistic against reference shares scaled to the current size."""
    t = F.broadcast(totals.select("column", "total_ref", "total_cur"))   # one row per column
    sh = vc.join(t, "column")
    p = F.col("n_ref") / F.col("total_ref")
    q = F.col("n_cur") / F.col("total_cur")
    sh = (sh.withColumn("p", F.when(p == 0, ZERO_FILL).otherwise(p))
            .withColumn("q", F.when(q == 0, ZERO_FILL).otherwise(q)))
    whole = sh.groupBy("column").agg(F.sum("p").alias("__p"), F.sum("q").alias("__q"))   # one row per column
    sh = sh.join(F.broadcast(whole), "column").withColumns({"p": F.col("p") / F.col("__p"), "q": F.col("q") / F.col("__q")})
    m = (F.col("p") + F.col("q")) / 2
    expected = F.col("n_ref") * (F.col("total_cur") / F.col("total_ref"))
    return sh.groupBy("column").agg(
        F.sqrt(F.greatest(F.lit(0.0), 0.5 * F.sum(F.col("p") * F.log(F.col("p") / m))
                          + 0.5 * F.sum(F.col("q") * F.log(F.col("q") / m)))).alias("js_distance"),
        F.sum(F.when(expected > 0, F.pow(F.col("n_cur") - expected, 2) / expected)
               .when(F.col("n_cur") > 0, F.lit(float("inf"))).otherwise(0.0)).alias("chi2"))


def z_statistics(vc: DataFrame, totals: DataFrame) -> DataFrame:
    """z of the difference of shares (current less reference) of the larger value of two-valued columns."""
    value = F.coalesce(F.col("v_cat"), F.col("v_num").cast("string"))
    two = F.broadcast(totals.filter("n_unique = 2").select("column", "total_ref", "total_cur"))
    top = (vc.join(two, "column").groupBy("column", "total_ref", "total_cur")
           .agg(F.max_by(F.struct("n_ref", "n_cur"), F.struct("v_num", value)).alias("top")))
    ref, cur = F.col("top.n_ref") / F.col("total_ref"), F.col("top.n_cur") / F.col("total_cur")
    pooled = (F.col("top.n_ref") + F.col("top.n_cur")) / (F.col("total_ref") + F.col("total_cur"))
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("total_ref") + 1 / F.col("total_cur")))
    return top.select("column", F.when(spread > 0, (cur - ref) / spread).alias("z"))


def ks_pvalue(d: float, n: int, m: int) -> float:
    """Asymptotic two-sample KS p-value (Kolmogorov distribution)."""
    if d is None or n == 0 or m == 0:
        return float("nan")
    en = math.sqrt(n * m / (n + m))
    lam = (en + 0.12 + 0.11 / en) * d
    if lam < 1e-3:
        return 1.0
    s = sum(2 * (-1) ** (j - 1) * math.exp(-2 * j * j * lam * lam) for j in range(1, 101))
    return min(1.0, max(0.0, s))


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution (regularised gamma Q)."""
    if x is None or dof <= 0:
        return float("nan")
    if math.isinf(x):
        return 0.0
    if x <= 0:
        return 1.0
    a, z = dof / 2.0, x / 2.0
    if z < a + 1:   # series for P, then Q = 1 - P
        term = total = 1.0 / a
        k = a
        for _ in range(1000):
            k += 1
            term *= z / k
            total += term
            if abs(term) < abs(total) * 1e-15:
                break
        return max(0.0, 1.0 - total * math.exp(-z + a * math.log(z) - math.lgamma(a)))
    b, c, d = z + 1 - a, 1e300, 1.0 / (z + 1 - a)   # continued fraction for Q
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return min(1.0, h * math.exp(-z + a * math.log(z) - math.lgamma(a)))


def normal_two_sided(z: float) -> float:
    """Probability of a standard normal at least as far from 0 as ``z``."""
    return float("nan") if z is None else math.erfc(abs(z) / math.sqrt(2))


def _gather(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], day_col: str, tie_cols: Sequence[str],
            wanted) -> tuple[dict, dict]:
    """Totals per column, and its statistics by test; ``wanted`` maps totals to the tests of every column."""
    # Written once: the days' counts, the halves and the numbering of the middle day all read these rows.
    needed = dict.fromkeys([*num_cols, *cat_cols, day_col, *tie_cols])
    halves = half_split(written(df.select(*needed), "drift-rows"), day_col, tie_cols)
    with held(value_counts_by_half(halves, num_cols, cat_cols)) as vc:
        tot_df = column_totals(vc)
        tot = {r["column"]: r for r in tot_df.collect()}        # one row per column
        tests = wanted(tot)
        got: dict[str, dict] = {c: {} for c in tot}
        for names, compute in ((NUMERIC_ONLY, distance_statistics), (("jensenshannon", "chisquare"), share_statistics),
                               (("z",), z_statistics)):
            cols = [c for c, own in tests.items() if set(own) & set(names)]
            if not cols:
                continue
            these = F.col("column").isin(cols)
            for r in compute(vc.where(these), tot_df.where(these)).collect():
                got[r["column"]].update({t: r[STATISTIC[t]] for t in names if t in tests[r["column"]]})
    return tot, got


def _check(tests: dict[str, str], kinds: dict[str, str]) -> None:
    for c, t in tests.items():
        if t not in STATISTIC:
            raise ValueError(f"unknown test {t!r} of column {c!r}")
        if t in NUMERIC_ONLY and kinds.get(c) == "cat":
            raise ValueError(f"test {t!r} needs numbers, column {c!r} has text")


def statistics_table(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str],
                     day_col: str = "dt", tie_cols: Sequence[str] = (), tests: dict[str, str] | None = None) -> DataFrame:
    """Per-column test and statistic, computed eagerly; one row per column.

    ``tests`` names the test of a column; the others have that of their kind (``DEFAULT_TESTS``).
    The per-(column, value) counts of the two halves are the only input of every statistic, so they are
    kept for the few passes over them; only the statistics asked for are computed.
    """
    tests = dict(tests or {})
    _check(tests, {**dict.fromkeys(num_cols, "num"), **dict.fromkeys(cat_cols, "cat")})
    chosen = lambda tot: {c: [tests.get(c, DEFAULT_TESTS[r["kind"]])] for c, r in tot.items()}
    tot, got = _gather(df, num_cols, cat_cols, day_col, tie_cols, chosen)
    rows = [(c, r["kind"], int(r["total_ref"]), int(r["total_cur"]), int(r["n_unique"]), t, got[c].get(t))
            for c, r in tot.items() for t in chosen(tot)[c]]
    schema = ("column string, kind string, total_ref bigint, total_cur bigint, n_unique bigint, "
              "stat_test string, statistic double")
    return df.sparkSession.createDataFrame(rows, schema)


def all_statistics(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str],
                   day_col: str = "dt", tie_cols: Sequence[str] = ()) -> DataFrame:
    """Every test a column can have, with statistic, p-value (tests with one), threshold and flag.

    Numbers have ``ks`` and ``wasserstein``, all columns ``jensenshannon`` and ``chisquare``, two-valued ones ``z``.
    """
    def every(tot):
        return {c: [t for t in STATISTIC if (r["kind"] == "num" or t not in NUMERIC_ONLY) and (t != "z" or r["n_unique"] == 2)]
                for c, r in tot.items()}

    tot, got = _gather(df, num_cols, cat_cols, day_col, tie_cols, every)
    rows = [(c, r["kind"], int(r["total_ref"]), int(r["total_cur"]), int(r["n_unique"]), t, got[c].get(t))
            for c, r in tot.items() for t in every(tot)[c]]
    return _judged(df, rows)


def p_value(test: str, statistic: float | None, n_ref: int, n_cur: int, n_unique: int) -> float | None:
    if test == "ks":
        return ks_pvalue(statistic, n_ref, n_cur)
    if test == "chisquare":
        return chi2_sf(statistic, n_unique - 1)
    return normal_two_sided(statistic) if test == "z" else None


def _judged(df: DataFrame, rows: list[tuple]) -> DataFrame:
    out = []
    for column, kind, n_ref, n_cur, n_unique, test, value in rows:
        p = p_value(test, value, n_ref, n_cur, n_unique)
        drift = (p < KS_ALPHA) if p is not None else (value is not None and value >= DIST_THRESHOLD)
        out.append((column, kind, n_ref, n_cur, test, float(value) if value is not None else None, p,
                    KS_ALPHA if p is not None else DIST_THRESHOLD, bool(drift)))
    schema = ("column string, kind string, n_reference bigint, n_current bigint, stat_test string, "
              "statistic double, p_value double, threshold double, drift_detected boolean")
    return df.sparkSession.createDataFrame(out, schema)


def drift_report(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str],
                 day_col: str = "dt", tie_cols: Sequence[str] = (), tests: dict[str, str] | None = None) -> DataFrame:
    """Per-column test, statistic, p-value (tests with one), threshold and
    drift flag; plus ``dataset_drift`` on every row."""
    rows = [tuple(r) for r in statistics_table(df, num_cols, cat_cols, day_col, tie_cols, tests).collect()]
    out = _judged(df, rows)
    flags = [r["drift_detected"] for r in out.collect()]   # one row per column
    return out.withColumn("dataset_drift", F.lit(bool(flags) and 2 * sum(flags) >= len(flags)))
