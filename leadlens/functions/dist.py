"""Distribution functions.

Driver-side scalars (applied to a handful of aggregated numbers) and one Column
expression, the normal quantile, used per row for Q-Q positions and Shapiro-Wilk
weights. Sources: Wichura (1988) AS 241 for the normal quantile; Lentz's continued
fraction for the regularised incomplete beta (Numerical Recipes, 3rd ed., 6.4).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# AS 241 (PPND16) coefficients.
_A = [3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
      4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3]
_B = [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
      2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3]
_C = [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
      1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4]
_D = [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
      1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9]
_E = [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
      2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7]
_F = [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
      7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15]


def _poly(coef, x):
    acc = coef[-1]
    for c in reversed(coef[:-1]):
        acc = acc * x + c
    return acc


def norm_ppf(p: float) -> float:
    """Standard normal quantile (AS 241, ~1e-16 relative accuracy)."""
    if p <= 0.0:
        return -math.inf
    if p >= 1.0:
        return math.inf
    q = p - 0.5
    if abs(q) <= 0.425:
        r = 0.180625 - q * q
        return q * _poly(_A, r) / _poly(_B, r)
    r = p if q < 0 else 1.0 - p
    r = math.sqrt(-math.log(r))
    if r <= 5.0:
        v = _poly(_C, r - 1.6) / _poly(_D, r - 1.6)
    else:
        v = _poly(_E, r - 5.0) / _poly(_F, r - 5.0)
    return -v if q < 0 else v


def norm_ppf_col(p: Column) -> Column:
    """The same quantile as a JVM-side Column expression (no Python per row)."""

    def poly(coef, x):
        acc = F.lit(coef[-1])
        for c in reversed(coef[:-1]):
            acc = acc * x + F.lit(c)
        return acc

    q = p - F.lit(0.5)
    r_c = F.lit(0.180625) - q * q
    central = q * poly(_A, r_c) / poly(_B, r_c)
    r = F.sqrt(-F.ln(F.when(q < 0, p).otherwise(F.lit(1.0) - p)))
    mid = poly(_C, r - F.lit(1.6)) / poly(_D, r - F.lit(1.6))
    far = poly(_E, r - F.lit(5.0)) / poly(_F, r - F.lit(5.0))
    tail = F.when(r <= 5.0, mid).otherwise(far)
    return F.when(F.abs(q) <= 0.425, central).otherwise(F.when(q < 0, -tail).otherwise(tail))


def norm_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


# Hart's (1968) rational approximation of the normal distribution (double precision).
_HART_P = [220.206867912376, 221.213596169931, 112.079291497871, 33.912866078383, 6.37396220353165, 0.700383064443688, 3.52624965998911e-2]
_HART_Q = [440.413735824752, 793.826512519948, 637.333633378831, 296.564248779674, 86.7807322029461, 16.064177579207, 1.75566716318264,
           8.83883476483184e-2]


def norm_cdf_col(x: Column) -> Column:
    """The normal distribution function as a Column (about 1e-15 within 7 deviations of the mean;
    0 or 1 beyond, where it is off by 1e-12 at most)."""

    def poly(coef, v):
        acc = F.lit(coef[-1])
        for c in reversed(coef[:-1]):
            acc = acc * v + F.lit(c)
        return acc

    a = F.abs(x)
    below = F.when(a < 7.0, F.exp(-a * a / 2) * poly(_HART_P, a) / poly(_HART_Q, a)).otherwise(F.lit(0.0))
    return F.when(x > 0, F.lit(1.0) - below).otherwise(below)


def norm_cdf_sql(x: str) -> str:
    """:func:`norm_cdf_col` as SQL text, for engines without an error function."""

    def poly(coef, v):
        acc = repr(coef[-1])
        for c in reversed(coef[:-1]):
            acc = f"(({acc}) * {v} + {c!r})"
        return acc

    a = f"abs({x})"
    below = f"(CASE WHEN {a} < 7.0 THEN exp(-{a} * {a} / 2) * {poly(_HART_P, a)} / {poly(_HART_Q, a)} ELSE 0.0 END)"
    return f"(CASE WHEN {x} > 0 THEN 1.0 - {below} ELSE {below} END)"


def norm_sf(x: float) -> float:
    return 0.5 * math.erfc(x / math.sqrt(2.0))


def _betacf(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < 1e-15:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


_LARGE = 1e7


def t_sf2(t: float, df: float) -> float:
    """Two-sided p-value of a t statistic. Beyond _LARGE degrees of freedom, where the logs of
    gamma would cancel, it is the normal one (the error is of order 1 / df)."""
    if math.isnan(t):
        return math.nan
    if df > _LARGE:
        return 2.0 * norm_sf(abs(t))
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def t_ppf(p: float, df: float) -> float:
    """Quantile of Student's t by bisection on the two-sided tail (monotone, robust)."""
    if p == 0.5:
        return 0.0
    upper = p > 0.5
    tail = 2.0 * (1.0 - p if upper else p)  # two-sided tail mass
    lo, hi = 0.0, 1.0
    while t_sf2(hi, df) > tail:
        hi *= 2.0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if t_sf2(mid, df) > tail:
            lo = mid
        else:
            hi = mid
    v = 0.5 * (lo + hi)
    return v if upper else -v


def f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail probability of the F distribution."""
    if math.isnan(f):
        return math.nan
    if f <= 0:
        return 1.0
    d2 = min(d2, _LARGE)  # the chi-square limit, to a relative 1 / _LARGE
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_sf_2df(x: float) -> float:
    """Upper tail of chi-square with 2 degrees of freedom (exp(-x/2))."""
    return math.exp(-x / 2.0)


def norm_ppf_sql(p: str) -> str:
    """The AS 241 normal quantile as SQL text (same Horner order as :func:`norm_ppf_col`),
    for engines without a built-in probit."""

    def poly(coef, x):
        acc = repr(coef[-1])
        for c in reversed(coef[:-1]):
            acc = f"(({acc}) * ({x}) + {c!r})"
        return acc

    q = f"(({p}) - 0.5)"
    rc = f"(0.180625 - {q} * {q})"
    central = f"({q} * {poly(_A, rc)} / {poly(_B, rc)})"
    r = f"sqrt(-ln(CASE WHEN {q} < 0 THEN ({p}) ELSE 1.0 - ({p}) END))"
    mid = f"({poly(_C, f'{r} - 1.6')} / {poly(_D, f'{r} - 1.6')})"
    far = f"({poly(_E, f'{r} - 5.0')} / {poly(_F, f'{r} - 5.0')})"
    tail = f"(CASE WHEN {r} <= 5.0 THEN {mid} ELSE {far} END)"
    return f"(CASE WHEN abs({q}) <= 0.425 THEN {central} ELSE (CASE WHEN {q} < 0 THEN -{tail} ELSE {tail} END) END)"
