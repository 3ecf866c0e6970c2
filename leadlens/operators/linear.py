"""Linear models on the moment table: OLS with its inference table and fit statistics,
ridge (fit, alpha sweep, coefficient path), lasso (coordinate descent on the Gram matrix,
alpha sweep, exact LARS path), plus the Spark ML estimators for fitting and serving.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dist import f_sf, t_ppf, t_sf2
from ..functions.scalar import named
from .moments import Moments, moments
from .stattests import condition_number, durbin_watson, normality


@dataclass
class OLSFit:
    names: list[str]
    coef: np.ndarray  # intercept first, raw (unshifted) scale
    cov: np.ndarray
    n: float
    rss: float
    tss: float
    cond: float

    @property
    def k(self) -> int:
        return len(self.coef)

    def prediction(self) -> Column:
        e = F.lit(float(self.coef[0]))
        for b, c in zip(self.coef[1:], self.names):
            e = e + F.lit(float(b)) * named(c).cast("double")
        return e


class OLSModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted linear model as a Spark ML Model: prediction = intercept + sum(b_i x_i)
    as one Column expression over named feature columns (no vector needed)."""

    featureCols = Param(Params._dummy(), "featureCols", "feature columns", TypeConverters.toListString)
    coefficients = Param(Params._dummy(), "coefficients", "slopes", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)
    predictionCol = Param(Params._dummy(), "predictionCol", "output column", TypeConverters.toString)

    @keyword_only
    def __init__(self, featureCols=None, coefficients=None, intercept=0.0, predictionCol="prediction"):
        super().__init__()
        self._setDefault(predictionCol="prediction", intercept=0.0)
        self._set(**self._input_kwargs)

    @classmethod
    def from_fit(cls, fit: "OLSFit", predictionCol: str = "prediction") -> "OLSModel":
        return cls(featureCols=list(fit.names), coefficients=[float(v) for v in fit.coef[1:]],
                   intercept=float(fit.coef[0]), predictionCol=predictionCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        e = F.lit(self.getOrDefault("intercept"))
        for b, c in zip(self.getOrDefault("coefficients"), self.getOrDefault("featureCols")):
            e = e + F.lit(b) * named(c).cast("double")
        return df.withColumn(self.getOrDefault("predictionCol"), e)


def aliased(mom: Moments, g: int = 0, tol: float = 1e-10) -> list[int]:
    """Positions of features that are (numerically) constant or linear combinations of
    earlier features: a Gram-Schmidt sweep over the centred X'X, dropping a column whose
    residual sum of squares is below ``tol`` times its own."""
    xx, _, _, _, _, _ = mom.centered(g)
    kept: list[int] = []
    drop: list[int] = []
    for j in range(len(xx)):
        own = xx[j, j]
        if kept:
            a = xx[np.ix_(kept, kept)]
            b = xx[kept, j]
            resid = own - b @ np.linalg.solve(a, b)
        else:
            resid = own
        if own <= 0 or resid <= tol * max(own, 1e-300):
            drop.append(j)
        else:
            kept.append(j)
    return drop


def ols(mom: Moments, g: int = 0) -> OLSFit:
    """Least squares with intercept from slot ``g`` of the moments (solved in the shifted
    coordinates, mapped back to raw coefficients and covariance). Aliased features (see
    :func:`aliased`) are removed first; ``OLSFit.names`` lists the features kept."""
    drop = aliased(mom, g)
    if drop:
        mom = mom.subset([i for i in range(mom.p) if i not in drop])
    zz, zy, yy, n = mom.zz[g], mom.zy[g], mom.yy[g], mom.n[g]
    beta = np.linalg.solve(zz, zy)
    rss = float(yy - beta @ zy)
    k = len(beta)
    sigma2 = rss / (n - k) if n > k else math.nan
    cov_s = sigma2 * np.linalg.inv(zz)
    a_inv = np.linalg.inv(mom._a())
    coef = a_inv @ beta
    coef[0] += mom.mu_y
    cov = a_inv @ cov_s @ a_inv.T
    tss = float(yy - zy[0] ** 2 / n)
    return OLSFit(list(mom.names), coef, cov, float(n), rss, tss, condition_number(mom.raw(g)[0]))


def ols_tables(fit: OLSFit, spark: SparkSession, alpha: float = 0.05):
    """(coefficients, statistics) DataFrames: coef, std err, t, two-sided p, CI and a
    Yes/No significance flag per term; R^2, adjusted R^2, F and P(F), log-likelihood,
    AIC, BIC, degrees of freedom and condition number."""
    n, k = fit.n, fit.k
    df_resid, df_model = n - k, k - 1
    se = np.sqrt(np.diag(fit.cov))
    tq = t_ppf(1 - alpha / 2, df_resid)
    rows = []
    for name, b, s in zip(["Intercept", *fit.names], fit.coef, se):
        t = b / s if s > 0 else math.nan
        p = t_sf2(t, df_resid)
        rows.append((name, float(b), float(s), float(t), float(p), float(b - tq * s), float(b + tq * s),
                     "Yes" if p < alpha else "No"))
    coefs = spark.createDataFrame(
        rows, "feature string, coef double, std_err double, t double, p_value double, ci_low double, ci_high double, significant string"
    )
    r2 = 1 - fit.rss / fit.tss if fit.tss > 0 else math.nan
    adj = 1 - (1 - r2) * (n - 1) / df_resid if df_resid > 0 else math.nan
    fstat = (r2 / df_model) / ((1 - r2) / df_resid) if df_model > 0 and df_resid > 0 and r2 < 1 else math.nan
    ll = -n / 2 * (math.log(2 * math.pi) + math.log(fit.rss / n) + 1) if fit.rss > 0 else math.inf
    stats = spark.createDataFrame(
        [(int(n), int(df_model), int(df_resid), r2, adj, fstat, f_sf(fstat, df_model, df_resid), ll,
          -2 * ll + 2 * k, -2 * ll + k * math.log(n), fit.cond)],
        "n bigint, df_model bigint, df_resid bigint, r2 double, adj_r2 double, f_stat double, f_p_value double, "
        "log_likelihood double, aic double, bic double, cond_no double",
    )
    return coefs, stats


def ols_summary(df: DataFrame, features: Sequence[str], label: str, order: Sequence[str] | None = None,
                alpha: float = 0.05):
    """The regression printout as tables: (fit, coefficients, statistics). Statistics
    add residual skew, kurtosis, Jarque-Bera, omnibus and (with ``order``) Durbin-Watson,
    from one more pass over the residuals."""
    fit = ols(moments(df, features, label))
    coefs, stats = ols_tables(fit, df.sparkSession, alpha)
    dropped = [f for f in features if f not in fit.names]
    if dropped:  # aliased terms are listed with no estimate
        coefs = coefs.unionByName(df.sparkSession.createDataFrame(
            [(f, None, None, None, None, None, None, "aliased") for f in dropped], coefs.schema))
    res = df.select(*(order or []), (F.col(label).cast("double") - fit.prediction()).alias("resid"))
    norm = normality(res, "resid").select(
        F.col("skew").alias("resid_skew"), F.col("kurtosis").alias("resid_kurtosis"),
        "jarque_bera", "jb_p_value", "omnibus", "omnibus_p_value",
    ).first().asDict()
    dw = durbin_watson(res, "resid", order).first()[0] if order else None
    stats = stats.withColumns({k: F.lit(v).cast("double") for k, v in norm.items()}).withColumn(
        "durbin_watson", F.lit(dw).cast("double")
    )
    return fit, coefs, stats


def r2_from(mom: Moments, coef_shifted: np.ndarray, g: int = 0) -> float:
    """R^2 of a coefficient vector (shifted coordinates, intercept first) on slot ``g``."""
    zz, zy, yy, n = mom.zz[g], mom.zy[g], mom.yy[g], mom.n[g]
    rss = yy - 2 * coef_shifted @ zy + coef_shifted @ zz @ coef_shifted
    tss = yy - zy[0] ** 2 / n
    return float(1 - rss / tss)


def _ridge_solve(xx: np.ndarray, xy: np.ndarray, alpha: float) -> np.ndarray:
    if alpha > 0:
        return np.linalg.solve(xx + alpha * np.eye(len(xy)), xy)
    # columns scaled to unit length, so that the rank does not depend on their units
    scale = np.sqrt(np.diag(xx))
    scale[scale <= 0] = 1.0
    return np.linalg.lstsq(xx / np.outer(scale, scale), xy / scale, rcond=1e-12)[0] / scale


def ridge(mom: Moments, alpha: float, g: int = 0) -> np.ndarray:
    """Ridge with an unpenalised intercept (X and y centred):
    beta = (Xc'Xc + alpha I)^-1 Xc'yc. Returns [intercept, beta] in raw units. At alpha 0
    constant or duplicate columns leave the least-norm solution."""
    xx, xy, _, mx, my, _ = mom.centered(g)
    beta = _ridge_solve(xx, xy, alpha)
    return np.concatenate([[my - mx @ beta], beta])


def to_shifted(mom: Moments, coef_raw: np.ndarray) -> np.ndarray:
    """Raw [intercept, beta] -> the same model in the shifted coordinates of ``mom``."""
    c = coef_raw.copy()
    c[0] = coef_raw[0] + mom.mu_x @ coef_raw[1:] - mom.mu_y
    return c


def ridge_sweep(train: Moments, test: Moments, alphas: Sequence[float]) -> list[tuple]:
    """(alpha, train R^2, test R^2, non-zero coefs, |coef| > 1 count) per alpha."""
    out = []
    for a in sorted(alphas):
        c = ridge(train, a)
        out.append((float(a), r2_from(train, to_shifted(train, c)), r2_from(test, to_shifted(test, c)),
                    int(np.sum(c[1:] != 0)), int(np.sum(np.abs(c[1:]) > 1.0))))
    return out


def ridge_path(mom: Moments, alphas: Sequence[float], g: int = 0) -> list[tuple]:
    """Ridge without intercept on raw X: (alpha, feature, coef) rows."""
    zz, zy, _, _ = mom.raw(g)
    xx, xy = zz[1:, 1:], zy[1:]
    rows = []
    for a in alphas:
        b = _ridge_solve(xx, xy, a)
        rows.extend((float(a), f, float(v)) for f, v in zip(mom.names, b))
    return rows


def _settle(xx: np.ndarray, xy: np.ndarray, thr: float, beta: np.ndarray) -> np.ndarray:
    """The lasso's minimum with the signs of ``beta``, from ``beta`` on: where the way to it leads a
    coefficient through 0, that one stays there and the others go on."""
    def cost(v: np.ndarray) -> float:
        return float(v @ xx @ v / 2 - xy @ v + thr * np.abs(v).sum())

    out = beta.copy()
    for _ in range(len(beta)):
        on = np.flatnonzero(out)
        if not len(on):
            break
        to = _ridge_solve(xx[np.ix_(on, on)], xy[on] - thr * np.sign(out[on]), 0)
        crossing = to * out[on] <= 0 if thr > 0 else np.zeros(len(on), bool)
        share = np.min(out[on][crossing] / (out[on] - to)[crossing], initial=1.0)
        stops = on[crossing][out[on][crossing] / (out[on] - to)[crossing] <= share]
        out[on] += share * (to - out[on])
        out[stops] = 0.0
        if not len(stops):
            break
    return out if cost(out) <= cost(beta) else beta


def lasso(mom: Moments, alpha: float, g: int = 0, tol: float = 1e-9, max_iter: int = 100000, settle: int = 1000) -> np.ndarray:
    """Lasso with intercept, objective 1/(2n)||y - b - X beta||^2 + alpha ||beta||_1,
    by cyclic coordinate descent on the centred Gram matrix (no data pass per alpha). Nearly
    collinear columns let it creep: every ``settle`` rounds the coefficients at hand are solved for
    (:func:`_settle`), and the rounds go on from there until none moves by ``tol``."""
    xx, xy, _, mx, my, n = mom.centered(g)
    p = len(xy)
    beta = np.zeros(p)
    thr = alpha * n
    diag = np.diag(xx)
    for turn in range(1, max_iter + 1):
        delta = 0.0
        for j in range(p):
            if diag[j] <= 0:
                continue
            rho = xy[j] - xx[j] @ beta + diag[j] * beta[j]
            new = np.sign(rho) * max(abs(rho) - thr, 0.0) / diag[j]
            delta = max(delta, abs(new - beta[j]))
            beta[j] = new
        if delta < tol:
            return np.concatenate([[my - mx @ beta], beta])
        if turn % settle == 0:
            beta = _settle(xx, xy, thr, beta)
    raise RuntimeError(f"lasso: no convergence to {tol} in {max_iter} rounds (alpha {alpha})")


def lasso_sweep(train: Moments, test: Moments, alphas: Sequence[float]) -> list[tuple]:
    out = []
    for a in sorted(alphas):
        c = lasso(train, a)
        out.append((float(a), r2_from(train, to_shifted(train, c)), r2_from(test, to_shifted(test, c)),
                    int(np.sum(c[1:] != 0)), int(np.sum(np.abs(c[1:]) > 1.0))))
    return out


def lars_lasso_path(gram: np.ndarray, xty: np.ndarray, n: float, eps: float = 1e-12):
    """Exact lasso path by LARS with the lasso modification (Efron et al. 2004), from
    X'X and X'y only (no centring, no intercept). Returns (alphas, coefs[knots, p]) with
    alpha = max |correlation| / n at each knot."""
    p = len(xty)
    beta = np.zeros(p)
    active: list[int] = []
    c = xty.copy()
    alphas = [float(np.max(np.abs(c)) / n)]
    coefs = [beta.copy()]
    if alphas[0] <= eps:
        return np.array(alphas), np.array(coefs)
    active.append(int(np.argmax(np.abs(c))))
    while True:
        c = xty - gram @ beta
        C = float(np.max(np.abs(c[active])))
        s = np.sign(c[active])
        ga = gram[np.ix_(active, active)]
        w = np.linalg.solve(ga, s)
        aa = 1.0 / math.sqrt(float(s @ w))
        d = aa * w
        a = gram[:, active] @ d
        gamma = C / aa  # step to the least-squares fit of the active set
        enter = None
        for j in range(p):
            if j in active:
                continue
            for cand in ((C - c[j]) / (aa - a[j]) if aa != a[j] else math.inf,
                         (C + c[j]) / (aa + a[j]) if aa != -a[j] else math.inf):
                if eps < cand < gamma:
                    gamma, enter = cand, j
        drop = None
        ba = beta[active]
        for i, j in enumerate(active):
            if d[i] != 0:
                g = -ba[i] / d[i]
                if eps < g < gamma:
                    gamma, drop, enter = g, j, None
        for i, j in enumerate(active):
            beta[j] += gamma * d[i]
        alpha = max((C - gamma * aa) / n, 0.0)
        if drop is not None:
            beta[drop] = 0.0
            active.remove(drop)
        alphas.append(float(alpha))
        coefs.append(beta.copy())
        if enter is not None:
            active.append(enter)
        elif drop is None:
            break  # reached the least-squares solution of the full active set
        if alpha <= eps or not active:
            break
    return np.array(alphas), np.array(coefs)


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def spark_ols(df: DataFrame, features: Sequence[str], label: str):
    """Spark ML least squares (normal equations; X'X aggregated by a tree reduce)."""
    lr = LinearRegression(featuresCol="features", labelCol=label, solver="normal", regParam=0.0)
    return lr.fit(assemble(df, features))


def spark_ridge(df: DataFrame, features: Sequence[str], label: str, alpha: float, fit_intercept: bool = True):
    """Spark ML ridge equal to the closed form above: regParam = alpha * sd_pop(y) / n,
    no feature standardisation, normal-equation solver."""
    st = df.agg(F.stddev_pop(F.col(label).cast("double")), F.count(F.lit(1))).first()
    reg = alpha * float(st[0]) / float(st[1])
    lr = LinearRegression(featuresCol="features", labelCol=label, solver="normal", elasticNetParam=0.0,
                          regParam=reg, standardization=False, fitIntercept=fit_intercept)
    return lr.fit(assemble(df, features))


def spark_lasso(df: DataFrame, features: Sequence[str], label: str, alpha: float):
    """Spark ML lasso with the same objective (regParam = alpha, no standardisation)."""
    lr = LinearRegression(featuresCol="features", labelCol=label, elasticNetParam=1.0, regParam=alpha,
                          standardization=False, maxIter=1000, tol=1e-12)
    return lr.fit(assemble(df, features))
