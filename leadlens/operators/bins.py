"""Histograms, box-plot statistics and 2-D bins: the tables behind the charts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import approx_quantiles, quantiles_from_ranked, ranked_value_counts


def _null_safe_join(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    r = right.select(*[F.col(c).alias(f"_k_{c}") for c in by], *[c for c in right.columns if c not in by])
    cond = None
    for c in by:
        e = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond).drop(*[f"_k_{c}" for c in by])


def bin_index(x, edges: Sequence[float]):
    """0-based bin of ``x`` for ascending edges (last bin closed, outside -> NULL).
    Equal integer steps use arithmetic; other edges a CASE ladder (exact at edges)."""
    edges = [float(e) for e in edges]
    nb = len(edges) - 1
    step = edges[1] - edges[0]
    regular = all(e == int(e) for e in edges) and all(edges[i + 1] - edges[i] == step for i in range(nb))
    if regular:
        inside = (x >= edges[0]) & (x <= edges[-1])
        return F.when(inside, F.least(F.floor((x - F.lit(edges[0])) / F.lit(step)), F.lit(nb - 1)))
    b = None
    for i in range(nb):
        cond = (x >= edges[i]) & ((x < edges[i + 1]) if i < nb - 1 else (x <= edges[i + 1]))
        b = F.when(cond, F.lit(i).cast("bigint")) if b is None else b.when(cond, F.lit(i).cast("bigint"))
    return b


def hist(df: DataFrame, col: str, edges: Sequence[float]) -> DataFrame:
    """Counts per bin for ascending ``edges``: bins [e_i, e_{i+1}), the last one closed;
    values outside [e_0, e_last] are not counted. Output: bin (0-based), lo, hi, count;
    empty bins appear with count 0."""
    edges = [float(e) for e in edges]
    nb = len(edges) - 1
    x = F.col(col).cast("double")
    b = bin_index(x, edges)
    counts = df.select(b.alias("bin")).where(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.count(F.lit(1)).alias("count")
    )
    spark = df.sparkSession
    frame = spark.createDataFrame([(i, edges[i], edges[i + 1]) for i in range(nb)], "bin bigint, lo double, hi double")
    # The bin frame has one row per edge pair (a fixed, caller-given size).
    return (
        F.broadcast(frame)
        .join(counts, "bin", "left")
        .select("bin", "lo", "hi", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))
    )


def equal_width_hist(df: DataFrame, col: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """``bins`` equal-width bins over [min, max] of ``col`` (per ``by`` group), last bin
    closed. One pass for min/max, one for counts; ``width_bucket`` is folded so max lands
    in the last bin."""
    by = list(by)
    x = F.col(col).cast("double")
    rng = df.where(x.isNotNull()).groupBy(*by).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    base = df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull())
    if by:
        j = _null_safe_join(base, rng, by)
    else:  # one range row: literals, not a join
        r = rng.first()
        j = base.withColumns({"_lo": F.lit(r["_lo"]), "_hi": F.lit(r["_hi"])})
    w = F.width_bucket(F.col("_x"), F.col("_lo"), F.col("_hi"), F.lit(bins))
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(F.least(w, F.lit(bins))) - 1
    out = j.groupBy(*by, b.alias("bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("count"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return out.select(
        *by,
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("lo"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("hi"),
        F.col("count").cast("bigint").alias("count"),
    )


def box_stats(df: DataFrame, col: str, by: Sequence[str] = (), approx_accuracy: int | None = None, weight: str | None = None) -> DataFrame:
    """Box-plot statistics of ``col`` per ``by`` group: n, mean, min, q1, median, q3, max,
    iqr, whiskers (the most extreme data points within 1.5 IQR of the quartiles) and the
    number of outliers beyond them. Quartiles are exact (linear interpolation).

    The data is scanned once, into (group, value, count); quartiles, whiskers, outlier
    counts and the mean are all computed from that distinct-value table. ``weight``: a column
    of how often each row counts."""
    by = list(by)
    if approx_accuracy:
        # Sketch quartiles (one pass); whiskers and outliers from a second pass over rows.
        q = approx_quantiles(df, col, [0.25, 0.5, 0.75], by, ["q1", "median", "q3"], approx_accuracy)
        cum = df.select(*by, F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull()).withColumn("_c", F.lit(1))
    else:
        cum = ranked_value_counts(df, col, by, weight)
        q = quantiles_from_ranked(cum, [0.25, 0.5, 0.75], by, names=["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    q = q.withColumn("_lf", F.col("q1") - 1.5 * F.col("iqr")).withColumn("_hf", F.col("q3") + 1.5 * F.col("iqr"))
    base = cum.select(*by, "_x", "_c")
    if by:
        j = _null_safe_join(base, q, by)
    else:
        # One statistics row: pass it as literals rather than joining.
        r = q.first().asDict()
        if not r["n"]:
            return q.drop("_lf", "_hf").withColumns(
                {k: F.lit(None).cast("double") for k in ["mean", "min", "max", "lower_whisker", "upper_whisker"]}
            ).withColumn("n_outliers", F.lit(0).cast("bigint"))
        j = base.withColumns({k: F.lit(v) for k, v in r.items()})
    x, c = F.col("_x"), F.col("_c")
    agg = j.groupBy(*by, "n", "q1", "median", "q3", "iqr").agg(
        (F.sum(x * c) / F.sum(c)).alias("mean"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.min(F.when(x >= F.col("_lf"), x)).alias("lower_whisker"),
        F.max(F.when(x <= F.col("_hf"), x)).alias("upper_whisker"),
        F.sum(F.when((x < F.col("_lf")) | (x > F.col("_hf")), c).otherwise(0)).alias("n_outliers"),
    )
    return agg.select(
        *by, F.col("n").cast("bigint").alias("n"), "mean", "min", "q1", "median", "q3", "max", "iqr",
        "lower_whisker", "upper_whisker", F.col("n_outliers").cast("bigint").alias("n_outliers"),
    )


def box_outliers(df: DataFrame, col: str, by: Sequence[str] = (), keep: Sequence[str] = ("key",)) -> DataFrame:
    """The rows beyond the whiskers (the points drawn individually on a box plot)."""
    by = list(by)
    st = box_stats(df, col, by).select(*by, "q1", "q3", "iqr")
    base = df.select(*by, *[k for k in keep if k not in by], col)
    j = _null_safe_join(base, st, by) if by else base.withColumns({k: F.lit(v) for k, v in st.first().asDict().items()})
    x = F.col(col)
    return j.where((x < F.col("q1") - 1.5 * F.col("iqr")) | (x > F.col("q3") + 1.5 * F.col("iqr"))).drop(
        "q1", "q3", "iqr"
    )


def hist2d(df: DataFrame, x: str, y: str, x_edges: Sequence[float] | None = None,
           y_edges: Sequence[float] | None = None, nx: int = 20, ny: int = 20,
           ranges: tuple | None = None) -> DataFrame:
    """Counts on a 2-D grid (the table behind a scatter plot): equal-width bins over each
    column's range unless edges are given. Only non-empty cells are returned. ``ranges``
    (x min, x max, y min, y max over complete pairs) skips the range pass when known."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    base = df.select(xs.alias("_x"), ys.alias("_y")).where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    r = ranges if ranges is not None else base.agg(F.min("_x"), F.max("_x"), F.min("_y"), F.max("_y")).first()
    if r[0] is None:
        return df.sparkSession.createDataFrame([], "bx int, by int, count bigint")

    def binexpr(c, lo, hi, n, edges):
        if edges is not None:
            e = [float(v) for v in edges]
            expr = None
            for i in range(len(e) - 1):
                cond = (c >= e[i]) & ((c < e[i + 1]) if i < len(e) - 2 else (c <= e[i + 1]))
                expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
            return expr
        if hi == lo:
            return F.lit(0)
        return F.least(F.width_bucket(c, F.lit(lo), F.lit(hi), F.lit(n)), F.lit(n)) - 1

    bx = binexpr(F.col("_x"), r[0], r[1], nx, x_edges)
    by_ = binexpr(F.col("_y"), r[2], r[3], ny, y_edges)
    return (
        base.select(bx.alias("bx"), by_.alias("by"))
        .where(F.col("bx").isNotNull() & F.col("by").isNotNull())
        .groupBy("bx", "by")
        .agg(F.count(F.lit(1)).alias("count"))
    )


# Axial-coordinate factors of a pointy-top hexagonal grid: sqrt(3)/3 and 2/3.
HEX_Q = math.sqrt(3.0) / 3.0
HEX_R = 2.0 / 3.0


def hexagon(x, y, size: float):
    """Axial (q, r) of the pointy-top hexagon of circumradius ``size`` around a point, by cube
    rounding of its fractional coordinates."""
    qf = (F.lit(HEX_Q) * x - y / F.lit(3.0)) / F.lit(float(size))
    rf = (F.lit(HEX_R) * y) / F.lit(float(size))
    sf = -qf - rf
    q, r, s = F.round(qf), F.round(rf), F.round(sf)
    dq, dr, ds = F.abs(q - qf), F.abs(r - rf), F.abs(s - sf)
    q2 = F.when((dq > dr) & (dq > ds), -r - s).otherwise(q)
    r2 = F.when((dq > dr) & (dq > ds), r).when(dr > ds, -q - s).otherwise(r)
    return q2.cast("bigint"), r2.cast("bigint")


def hexbin(df: DataFrame, x: str, y: str, size: float) -> DataFrame:
    """Counts per pointy-top hexagon of circumradius ``size`` (axial q, r)."""
    X, Y = F.col(x).cast("double"), F.col(y).cast("double")
    hq, hr = hexagon(X, Y, size)
    return df.where(X.isNotNull() & Y.isNotNull()).groupBy(hq.alias("hq"), hr.alias("hr")).agg(F.count(F.lit(1)).alias("count"))


def pair_bins(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Pair-plot table: for every ordered pair (x != y) the 2-D equal-width bin counts,
    and for x == y the 1-D histogram, in one long result
    (x_col, y_col, bx, by, count). One unpivot, one aggregate per shape."""
    cols = list(cols)
    rng = df.agg(*[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in cols],
                 *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in cols]).first()

    def b(c):
        lo, hi = rng[f"lo_{c}"], rng[f"hi_{c}"]
        if lo is None:
            return F.lit(None).cast("int")
        x = F.col(c).cast("double")  # least() passes over nulls
        return F.when(x.isNotNull(), F.lit(0) if lo == hi else F.least(F.width_bucket(x, F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins)) - 1)

    binned = df.select(*[b(c).alias(c) for c in cols])
    pairs = [(a, c) for a in cols for c in cols]
    stacked = binned.select(
        F.explode(
            F.array(*[F.struct(F.lit(a).alias("x_col"), F.lit(c).alias("y_col"), F.col(a).alias("bx"),
                               (F.col(c) if a != c else F.lit(0)).alias("by")) for a, c in pairs])
        ).alias("p")
    ).select("p.*")
    return (
        stacked.where(F.col("bx").isNotNull() & F.col("by").isNotNull())
        .groupBy("x_col", "y_col", "bx", "by")
        .agg(F.count(F.lit(1)).alias("count"))
    )
