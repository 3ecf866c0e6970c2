"""Distribution tests: Jarque-Bera, D'Agostino-Pearson omnibus, Shapiro-Wilk (Royston
1995), Lilliefors, Q-Q points, Durbin-Watson and the condition number.

Each test is one or two aggregates over the data; only the final handful of numbers is
turned into a p-value. Order statistics come from the range-partitioned ranking.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dist import norm_cdf_col, norm_ppf_col, norm_sf
from .ordering import rank_rows, ranked_value_counts, with_previous


def central_moments(df: DataFrame, col: str) -> DataFrame:
    """n, mean, population skewness S and (non-excess) kurtosis K of ``col``. Spark's
    ``skewness``/``kurtosis`` are the population forms (kurtosis excess)."""
    x = F.col(col).cast("double")
    return df.agg(
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        F.skewness(x).alias("skew"),
        (F.kurtosis(x) + F.lit(3.0)).alias("kurtosis"),
    )


def normality(df: DataFrame, col: str) -> DataFrame:
    """One row: n, skew, kurtosis, Jarque-Bera and its p-value, omnibus K^2 and its
    p-value (both chi-square with 2 df, so p = exp(-stat/2)). One aggregate over the
    data; the two statistics are closed forms of its three numbers. The omnibus needs
    n >= 8 (D'Agostino's skewness transform)."""
    m = central_moments(df, col).first()
    n, sk, ku = m["n"], m["skew"], m["kurtosis"]
    jb = jbp = k2 = k2p = None
    if n and sk is not None and ku is not None and not (math.isnan(sk) or math.isnan(ku)):
        jb, jbp = jarque_bera_from(n, sk, ku)
        if n >= 8:
            try:
                k2, k2p = omnibus_from(n, sk, ku)
            except (ValueError, ZeroDivisionError):
                k2 = k2p = None
    return df.sparkSession.createDataFrame(
        [(int(n or 0), sk, ku, jb, jbp, k2, k2p)],
        "n bigint, skew double, kurtosis double, jarque_bera double, jb_p_value double, omnibus double, "
        "omnibus_p_value double",
    )


def jarque_bera_from(n: float, skew: float, kurt: float) -> tuple[float, float]:
    jb = n / 6.0 * (skew * skew + (kurt - 3.0) ** 2 / 4.0)
    return jb, math.exp(-jb / 2.0)


def omnibus_from(n: float, skew: float, kurt: float) -> tuple[float, float]:
    """Driver-side K^2 and p for published (n, S, K) triples."""
    k2 = _omnibus_py(n, skew, kurt)
    return k2, math.exp(-k2 / 2.0)


def _omnibus_py(n, s, k):
    y = s * math.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + math.sqrt(2 * (beta2 - 1))
    delta = 1 / math.sqrt(0.5 * math.log(w2))
    alpha = math.sqrt(2 / (w2 - 1))
    y = 1.0 if y == 0 else y
    zs = delta * math.log(y / alpha + math.sqrt((y / alpha) ** 2 + 1))
    e = 3.0 * (n - 1) / (n + 1)
    varb2 = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    x = (k - e) / math.sqrt(varb2)
    sb1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / sb1 * (2.0 / sb1 + math.sqrt(1 + 4.0 / sb1 ** 2))
    t1 = 1 - 2 / (9.0 * a)
    den = 1 + x * math.sqrt(2 / (a - 4.0))
    t2 = math.copysign(1.0, den) * ((1 - 2.0 / a) / abs(den)) ** (1 / 3.0)
    zk = (t1 - t2) / math.sqrt(2 / (9.0 * a))
    return zs * zs + zk * zk


# Royston (1995) polynomial coefficients.
_AN = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
_AN1 = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
_MU_BIG = [-1.5861, -0.31082, -0.083751, 0.0038915]
_SIG_BIG = [-0.4803, -0.082676, 0.0030302]
_MU_SMALL = [0.5440, -0.39978, 0.025054, -0.0006714]
_SIG_SMALL = [1.3822, -0.77857, 0.062767, -0.0020322]
_GAMMA_SMALL = [-2.273, 0.459]


def _pv(coef, x):
    return sum(c * x ** i for i, c in enumerate(coef))


def shapiro(df: DataFrame, col: str, alpha: float = 0.05) -> DataFrame:
    """Shapiro-Wilk W with Royston's (1995) weights and p-value, for n >= 6.

    Pass 1 ranks the values (range partitions) and, in one aggregate, collects n, the
    sum of squares, sum(m_i^2), sum(m_i x_(i)) and the two extreme order statistics at
    each end; the weights of the two outermost pairs are then corrected as Royston
    prescribes. Pass 2 takes the Lilliefors statistic from the same ranks. Returns one row: n, w,
    p_value, lilliefors, lilliefors_p_value, gaussian. The verdict is p > alpha, p being Royston's up
    to n = 5000, to where that is calibrated, and Lilliefors' above."""
    x = df.select(F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    ranked = rank_rows(x, ["_x"], rank_col="_r", size_col="_n")
    i = F.col("_r") + 1
    n = F.col("_n")
    m = norm_ppf_col((i - F.lit(0.375)) / (n + F.lit(0.25)))
    agg = ranked.agg(
        F.max("_n").alias("n"),
        F.sum(m * m).alias("mm"),
        F.sum(m * F.col("_x")).alias("mx"),
        F.avg("_x").alias("mean"),
        F.max(F.when(i == n, F.col("_x"))).alias("x_n"),
        F.max(F.when(i == n - 1, F.col("_x"))).alias("x_n1"),
        F.max(F.when(i == 1, F.col("_x"))).alias("x_1"),
        F.max(F.when(i == 2, F.col("_x"))).alias("x_2"),
        F.max(F.when(i == n, m)).alias("m_n"),
        F.max(F.when(i == n - 1, m)).alias("m_n1"),
    ).first()
    ss = x.agg(F.sum((F.col("_x") - F.lit(agg["mean"] or 0.0)) ** 2)).first()[0] if agg["n"] else None
    w, p = shapiro_from_stats(agg["n"] or 0, agg["mm"], agg["mx"], ss, agg["x_1"], agg["x_2"], agg["x_n1"],
                              agg["x_n"], agg["m_n"], agg["m_n1"])
    spark = df.sparkSession
    sd = math.sqrt(ss / (agg["n"] - 1)) if ss and agg["n"] > 1 else 0.0
    d = None
    if sd > 0:
        cdf = norm_cdf_col((F.col("_x") - F.lit(agg["mean"])) / F.lit(sd))
        d = ranked.agg(F.max(F.greatest(i / n - cdf, cdf - (i - 1) / n))).first()[0]
    lp = lilliefors_p(d, agg["n"]) if d is not None else None
    verdict = p if (agg["n"] or 0) <= 5000 else lp
    return spark.createDataFrame(
        [(int(agg["n"] or 0), w, p, d, lp, None if verdict is None else bool(verdict > alpha))],
        "n bigint, w double, p_value double, lilliefors double, lilliefors_p_value double, gaussian boolean",
    )


# P of the modified statistic (Stephens 1974) in pieces, by its upper end.
LILLIEFORS_PIECES = [(0.302, [1.0]), (0.5, [2.76773, -19.828315, 80.709644, -138.55152, 81.218052]),
               (0.9, [-4.901232, 40.662806, -97.490286, 94.029866, -32.355711]),
               (1.31, [6.198765, -19.558097, 23.186922, -12.234627, 2.423045]), (math.inf, [0.0])]


def lilliefors_p(d: float, n: float) -> float:
    """p of the largest distance ``d`` between the distributions of ``n`` values and of the normal
    with their mean and standard deviation. Stephens' modification makes the statistic's law the
    same at every n, so this holds for large tables; a plain Kolmogorov-Smirnov p would not, as the
    parameters are fitted."""
    k = d * (math.sqrt(n) - 0.01 + 0.85 / math.sqrt(n))
    return min(1.0, max(0.0, next(_pv(c, k) for end, c in LILLIEFORS_PIECES if k <= end)))


def lilliefors(df: DataFrame, col: str, alpha: float = 0.05) -> DataFrame:
    """Lilliefors' test for a normal distribution of unknown mean and deviation, from the distinct
    values and their running counts: one row n, lilliefors, lilliefors_p_value, gaussian (p > alpha).
    Fewer than 5 values or a constant column give nulls."""
    ranked = ranked_value_counts(df, col)
    x, c = F.col("_x"), F.col("_c")
    st = ranked.agg(F.sum("_c").alias("n"), (F.sum(x * c) / F.sum("_c")).alias("mean")).first()
    n, mean = st["n"] or 0, st["mean"]
    ss = ranked.agg(F.sum((x - F.lit(mean)) ** 2 * c)).first()[0] if n >= 5 else None
    d = p = None
    if ss:
        cdf = norm_cdf_col((x - F.lit(mean)) / F.lit(math.sqrt(ss / (n - 1))))
        d = ranked.agg(F.max(F.greatest((F.col("_cb") + c) / F.lit(n) - cdf, cdf - F.col("_cb") / F.lit(n)))).first()[0]
        p = lilliefors_p(d, n)
    return df.sparkSession.createDataFrame([(int(n), d, p, None if p is None else p > alpha)],
                                           "n bigint, lilliefors double, lilliefors_p_value double, gaussian boolean")


def shapiro_from_stats(n, mm, mx, ss, x1, x2, xn1, xn, mn, mn1):
    """W and p from the aggregated pieces (see :func:`shapiro`)."""
    if n is None or n < 6 or not ss:
        return None, None
    u = 1.0 / math.sqrt(n)
    rsm = math.sqrt(mm)
    an = mn / rsm + _pv(_AN, u)
    an1 = mn1 / rsm + _pv(_AN1, u)
    phi = (mm - 2 * mn * mn - 2 * mn1 * mn1) / (1 - 2 * an * an - 2 * an1 * an1)
    # middle weights m_i / sqrt(phi); m is antisymmetric, so the outer terms drop out of mx
    inner = mx - mn * xn + mn * x1 - mn1 * xn1 + mn1 * x2
    num = inner / math.sqrt(phi) + an * (xn - x1) + an1 * (xn1 - x2)
    w = min(num * num / ss, 1.0)
    if n >= 12:
        ln_n = math.log(n)
        y = math.log(1 - w)
        mu = _pv(_MU_BIG, ln_n)
        sig = math.exp(_pv(_SIG_BIG, ln_n))
    else:
        gamma = _pv(_GAMMA_SMALL, n)
        y = -math.log(gamma - math.log(1 - w))
        mu = _pv(_MU_SMALL, n)
        sig = math.exp(_pv(_SIG_SMALL, n))
    return w, norm_sf((y - mu) / sig)


def qq_points(df: DataFrame, col: str, line: str = "s") -> DataFrame:
    """Normal Q-Q table: rank i, sample value x_(i), theoretical quantile at the plotting
    position i/(n+1), and the reference line at that quantile: ``"s"`` = mean + sd*z
    (population sd); ``"45"`` standardises the sample by its fitted mean and sd and uses
    y = z; ``"r"`` none."""
    x = df.select(F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    st = x.agg(F.avg("_x").alias("mu"), F.stddev_pop("_x").alias("sd")).first()
    ranked = rank_rows(x, ["_x"], rank_col="_r", size_col="_n")
    i = F.col("_r") + 1
    z = norm_ppf_col(i / (F.col("_n") + 1))
    sample = F.col("_x")
    if line == "45" and not st["sd"]:
        sample, ref = F.lit(None).cast("double"), z  # constant sample: no standardised values
    elif line == "45":
        sample = (sample - F.lit(st["mu"])) / F.lit(st["sd"])
        ref = z
    elif line == "s":
        ref = F.lit(st["mu"]) + F.lit(st["sd"]) * z
    else:
        ref = F.lit(None).cast("double")
    return ranked.select(i.cast("bigint").alias("rank"), sample.alias("sample"), z.alias("theoretical"), ref.alias("line"))


def durbin_watson(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """sum (e_t - e_{t-1})^2 / sum e_t^2 in ``order`` (unique): ``lag`` inside ranges and one
    boundary row per range, so no self-join and no one-task window."""
    e = with_previous(df.select(*order, F.col(col).cast("double").alias("_e")), order, "_e", "_ep")
    return e.agg(F.try_divide(F.sum((F.col("_e") - F.col("_ep")) ** 2), F.sum(F.col("_e") ** 2)).alias("durbin_watson"))


def condition_number(xtx: np.ndarray) -> float:
    """sqrt(lambda_max / lambda_min) of X'X (= condition number of the design X)."""
    ev = np.linalg.eigvalsh(xtx)
    return float(math.sqrt(ev.max() / ev.min())) if ev.min() > 0 else math.inf
