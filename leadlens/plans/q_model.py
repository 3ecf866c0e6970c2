"""Distribution tests, linear models, feature selection, trees, scoring and JSON/CSV
source queries."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import RFormula
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import clean, cube, encode, evaluate, leaps, linear, modeling_data, profile, score, select, split, stattests, trees
from ..operators import moments as M
from ..operators.ordering import row_numbers
from ..session import cleanup_at_exit, scratch_path, write_and_read
from ..sources import files, jsonops
from ..sources.issues import issues
from ..sources.tables import table
from .q_prep import _TR, LAB_CTE
from .registry import register, rounded, with_issues
from .shared import SHORT_TYPES, design, memo, train_test  # noqa: F401

SPLIT_SQL = "('0x' || substr(md5(CAST(key AS VARCHAR)), 1, 8))::BIGINT % 100"
TR_SPLIT = LAB_CTE + ",\n" + _TR + f",\ntrs AS (SELECT *, {SPLIT_SQL} < 80 AS is_train FROM tr)"


# ---------------------------------------------------------------- distribution tests
def _normality_sql(expr: str, src: str, where: str = "TRUE") -> str:
    return f"""SELECT CAST(n AS BIGINT) AS n, round(s, 6) AS skew, round(k, 6) AS kurtosis,
       round(n / 6.0 * (s * s + (k - 3) * (k - 3) / 4.0), 6) AS jarque_bera,
       round(exp(-(n / 6.0 * (s * s + (k - 3) * (k - 3) / 4.0)) / 2), 6) AS jb_p_value,
       round(zs * zs + zk * zk, 6) AS omnibus, round(exp(-(zs * zs + zk * zk) / 2), 6) AS omnibus_p_value
FROM (SELECT *, delta * ln(yy / alpha + sqrt((yy / alpha) * (yy / alpha) + 1)) AS zs,
             ((1 - 2 / (9 * a)) - sign(den) * cbrt((1 - 2 / a) / abs(den))) / sqrt(2 / (9 * a)) AS zk
  FROM (SELECT *, CASE WHEN y0 = 0 THEN 1 ELSE y0 END AS yy, 1 / sqrt(0.5 * ln(w2)) AS delta, sqrt(2 / (w2 - 1)) AS alpha,
               1 + xk * sqrt(2 / (a - 4)) AS den
    FROM (SELECT *, -1 + sqrt(2 * (beta2 - 1)) AS w2,
                 6 + 8 / sb1 * (2 / sb1 + sqrt(1 + 4 / (sb1 * sb1))) AS a
      FROM (SELECT n, s, k, s * sqrt((n + 1) * (n + 3) / (6.0 * (n - 2))) AS y0,
                   3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS beta2,
                   (k - 3.0 * (n - 1) / (n + 1)) / sqrt(24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS xk,
                   6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb1
        FROM (SELECT CAST(count(*) AS DOUBLE) AS n, avg(power(x - m, 3)) / power(avg(power(x - m, 2)), 1.5) AS s,
                     avg(power(x - m, 4)) / power(avg(power(x - m, 2)), 2) AS k
              FROM (SELECT x, avg(x) OVER () AS m FROM (SELECT CAST({expr} AS DOUBLE) AS x FROM {src} WHERE {where}) WHERE x IS NOT NULL))))))"""


@register("normality_log_duration", with_issues(_normality_sql("ln(duration_min)", "lab", "duration_min > 0"), LAB_CTE))
def normality_log_duration(spark, data_dir):
    """Jarque-Bera and omnibus tests of ln(resolution minutes)."""
    df = modeling_data.labelled_with_target(issues(spark, data_dir))
    return rounded(stattests.normality(df, "log_duration"))


@register("normality_duration", with_issues(_normality_sql("duration_min", "lab"), LAB_CTE))
def normality_duration(spark, data_dir):
    """The same tests on raw minutes (before the log transform)."""
    df = clean.add_duration(clean.split_labelled(issues(spark, data_dir))[0])
    return rounded(stattests.normality(df, "duration_min"))


def _shapiro_w_sql() -> str:
    from ..functions.dist import norm_ppf_sql
    from ..operators.stattests import _AN, _AN1

    def pv(coef, x):
        return " + ".join(f"{c!r} * power({x}, {i})" for i, c in enumerate(coef))

    mi = norm_ppf_sql("(CAST(i AS DOUBLE) - 0.375) / (n + 0.25)")
    return with_issues(
        f"""SELECT CAST(n AS BIGINT) AS n,
       round(least(power(inner_ / sqrt(phi) + an * (x_n - x_1) + an1 * (x_n1 - x_2), 2) / ss, 1.0), 6) AS w
FROM (SELECT *, (mm - 2 * m_n * m_n - 2 * m_n1 * m_n1) / (1 - 2 * an * an - 2 * an1 * an1) AS phi,
             mx - m_n * x_n + m_n * x_1 - m_n1 * x_n1 + m_n1 * x_2 AS inner_
      FROM (SELECT *, m_n / sqrt(mm) + ({pv(_AN, 'u')}) AS an, m_n1 / sqrt(mm) + ({pv(_AN1, 'u')}) AS an1
            FROM (SELECT *, 1 / sqrt(n) AS u FROM agg, ss_)))""",
        f"""d AS (SELECT CAST(summary_length AS DOUBLE) AS x FROM issues WHERE summary_length IS NOT NULL),
r AS (SELECT x, row_number() OVER (ORDER BY x) AS i, count(*) OVER () AS n FROM d),
m AS (SELECT x, i, n, {mi} AS mi FROM r),
agg AS (SELECT max(n) AS n, sum(mi * mi) AS mm, sum(mi * x) AS mx,
               max(CASE WHEN i = n THEN x END) AS x_n, max(CASE WHEN i = n - 1 THEN x END) AS x_n1,
               max(CASE WHEN i = 1 THEN x END) AS x_1, max(CASE WHEN i = 2 THEN x END) AS x_2,
               max(CASE WHEN i = n THEN mi END) AS m_n, max(CASE WHEN i = n - 1 THEN mi END) AS m_n1 FROM m),
ss_ AS (SELECT sum((x - (SELECT avg(x) FROM d)) * (x - (SELECT avg(x) FROM d))) AS ss FROM d)""",
    )


@register("shapiro_w_summary_length", _shapiro_w_sql())
def shapiro_w_summary_length(spark, data_dir):
    """The Shapiro-Wilk W statistic of summary_length (Royston's weights)."""
    return rounded(stattests.shapiro(issues(spark, data_dir), "summary_length").select("n", "w"))


@register("shapiro_summary_length")
def shapiro_summary_length(spark, data_dir):
    """Shapiro-Wilk test of summary_length (Royston weights and p-value)."""
    return rounded(stattests.shapiro(issues(spark, data_dir), "summary_length"))


def _lilliefors_sql(expr: str, src: str, ctes: str = "") -> str:
    from ..functions.dist import norm_cdf_sql

    cases = " ".join(f"WHEN k <= {end!r} THEN {' + '.join(f'{c!r} * power(k, {i})' for i, c in enumerate(coef))}"
                     for end, coef in stattests.LILLIEFORS_PIECES[:-1])
    return with_issues(
        f"""SELECT n, round(d, 6) AS lilliefors, round(p, 6) AS lilliefors_p_value, p > 0.05 AS gaussian
FROM (SELECT n, d, least(1.0, greatest(0.0, CASE {cases} ELSE 0.0 END)) AS p
      FROM (SELECT n, d, d * (sqrt(n) - 0.01 + 0.85 / sqrt(n)) AS k
            FROM (SELECT CAST(max(n) AS BIGINT) AS n, max(greatest(i / n - f, f - (i - 1) / n)) AS d
                  FROM (SELECT i, n, {norm_cdf_sql('((x - mu) / sd)')} AS f FROM r))))""",
        (ctes + ",\n" if ctes else "") + f"""d AS (SELECT CAST({expr} AS DOUBLE) AS x FROM {src} WHERE {expr} IS NOT NULL),
r AS (SELECT x, CAST(row_number() OVER (ORDER BY x) AS DOUBLE) AS i, CAST(count(*) OVER () AS DOUBLE) AS n, avg(x) OVER () AS mu,
             stddev_samp(x) OVER () AS sd FROM d)""")


@register("lilliefors_summary_length", _lilliefors_sql("summary_length", "issues"))
def lilliefors_summary_length(spark, data_dir):
    """Lilliefors' test of summary_length: a normal with fitted mean and deviation, valid at any n."""
    return rounded(stattests.lilliefors(issues(spark, data_dir), "summary_length"))


@register("lilliefors_log_duration", _lilliefors_sql("ln(duration_min)", "(SELECT * FROM lab WHERE duration_min > 0)", LAB_CTE))
def lilliefors_log_duration(spark, data_dir):
    """Lilliefors' test of ln(resolution minutes)."""
    return rounded(stattests.lilliefors(modeling_data.labelled_with_target(issues(spark, data_dir)), "log_duration"))


def _qq_sql() -> str:
    from ..functions.dist import norm_ppf_sql

    z = norm_ppf_sql("CAST(i AS DOUBLE) / (n + 1)")
    return with_issues(
        f"""SELECT CAST(i AS BIGINT) AS rank, round(x, 6) AS sample, round({z}, 6) AS theoretical,
       round(mu + sd * {z}, 6) AS line
FROM (SELECT x, row_number() OVER (ORDER BY x) AS i, count(*) OVER () AS n, avg(x) OVER () AS mu,
             stddev_pop(x) OVER () AS sd
      FROM (SELECT CAST(summary_length AS DOUBLE) AS x FROM issues WHERE summary_length IS NOT NULL))"""
    )


@register("qq_summary_length", _qq_sql())
def qq_summary_length(spark, data_dir):
    """Normal Q-Q points of summary_length with the standardised line."""
    return rounded(stattests.qq_points(issues(spark, data_dir), "summary_length", line="s"))


_CORR_COLS = ["vote_count", "comment_count", "description_length", "summary_length", "watch_count"]


@register(
    "correlation_matrix",
    with_issues(
        "\nUNION ALL\n".join(
            f"SELECT '{a}' AS x, '{b}' AS y, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM lab"
            for a in _CORR_COLS for b in _CORR_COLS
        ),
        LAB_CTE,
    ),
)
def correlation_matrix(spark, data_dir):
    lab = clean.split_labelled(issues(spark, data_dir))[0]
    return rounded(M.correlation_matrix(lab, _CORR_COLS))


_M0_FEATS = ["comment_count", "watch_count", "vote_count"]


def _m0_sql() -> str:
    terms = [("1", "1")] + [("1", a) for a in _M0_FEATS] + [("1", "y")]
    vals = _M0_FEATS + ["y"]
    for i, a in enumerate(vals):
        for b in vals[i:]:
            terms.append((a, b))
    expr = {"1": "1.0", "y": "log_duration", **{c: c for c in _M0_FEATS}}
    parts = [
        f"SELECT CAST(fold AS INTEGER) AS fold, '{a}' AS a, '{b}' AS b, round(sum({expr[a]} * {expr[b]}), 4) AS value FROM f GROUP BY fold"
        for a, b in terms
    ]
    return with_issues("\nUNION ALL\n".join(parts),
                       LAB_CTE + ",\n" + _TR + f",\nf AS (SELECT *, ('0x' || substr(md5(CAST(key AS VARCHAR)), 1, 8))::BIGINT % 5 + 1 AS fold FROM tr)")


@register("moments_by_fold", _m0_sql())
def moments_by_fold(spark, data_dir):
    """The moment table M0 (n, sums, X'X, X'y, y'y) per hash fold, long form."""
    _, enc, _ = design(spark, data_dir)
    mom = M.moments(split.hash_folds(enc, "key", 5), _M0_FEATS, "log_duration", group="fold", shift=False)
    names = ["1", *_M0_FEATS, "y"]
    rows = []
    for g, fold in enumerate(mom.groups):
        full = np.zeros((len(names), len(names)))
        full[:-1, :-1] = mom.zz[g]
        full[:-1, -1] = full[-1, :-1] = mom.zy[g]
        full[-1, -1] = mom.yy[g]
        for i in range(len(names)):
            for j in range(i, len(names)):
                rows.append((int(fold), names[i], names[j], round(float(full[i, j]), 4)))
    return spark.createDataFrame(rows, "fold int, a string, b string, value double")


# ---------------------------------------------------------------- one-predictor least squares (SQL-checkable)
_SIMPLE = TR_SPLIT + """,
co AS (SELECT regr_intercept(log_duration, comment_count) AS b0, regr_slope(log_duration, comment_count) AS b1,
              regr_r2(log_duration, comment_count) AS r2, count(*) AS n FROM trs WHERE is_train),
pr AS (SELECT key, log_duration AS y, b0 + b1 * comment_count AS p FROM trs, co WHERE NOT is_train),
fit AS (SELECT key, log_duration - (b0 + b1 * comment_count) AS e FROM trs, co WHERE is_train)"""


def _simple(spark, data_dir):
    def build():
        train, test = train_test(spark, data_dir)
        return linear.ols(M.moments(train, ["comment_count"], "log_duration")), train, test

    return memo(spark, data_dir, "simple", build)


@register(
    "simple_ols_fit",
    with_issues("SELECT CAST(n AS BIGINT) AS n, round(b0, 6) AS intercept, round(b1, 6) AS slope, round(r2, 6) AS r2 FROM co", _SIMPLE),
)
def simple_ols_fit(spark, data_dir):
    """ln(minutes) on ln(comments+1), least squares on the 80 % hash split."""
    fit, _, _ = _simple(spark, data_dir)
    return rounded(spark.createDataFrame([(int(fit.n), float(fit.coef[0]), float(fit.coef[1]), 1 - fit.rss / fit.tss)],
                                         "n bigint, intercept double, slope double, r2 double"))


@register(
    "simple_ols_test_metrics",
    with_issues(
        """SELECT CAST(count(*) AS BIGINT) AS n, round(avg(abs(y - p)), 6) AS mae, round(avg((y - p) * (y - p)), 6) AS mse,
       round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2 FROM pr""",
        _SIMPLE,
    ),
)
def simple_ols_test_metrics(spark, data_dir):
    fit, _, test = _simple(spark, data_dir)
    return rounded(evaluate.regression_metrics(test.withColumn("prediction", fit.prediction()), "log_duration"))


@register(
    "simple_ols_accuracy",
    with_issues(
        """SELECT round(avg(abs(p - y)), 6) AS avg_error, round(100 * avg(abs(p - y) / y), 6) AS mape,
       round(100 - 100 * avg(abs(p - y) / y), 6) AS accuracy FROM pr""",
        _SIMPLE,
    ),
)
def simple_ols_accuracy(spark, data_dir):
    """Average error, MAPE and accuracy = 100 - MAPE on the test split (log scale)."""
    fit, _, test = _simple(spark, data_dir)
    return rounded(evaluate.accuracy(test.withColumn("prediction", fit.prediction()), "log_duration"))


@register(
    "simple_ols_actual_predicted",
    with_issues(
        "SELECT key, round(y, 6) AS actual, round(p, 6) AS predicted, round(exp(y), 4) AS actual_exp, "
        "round(exp(p), 4) AS predicted_exp FROM pr",
        _SIMPLE,
    ),
)
def simple_ols_actual_predicted(spark, data_dir):
    fit, _, test = _simple(spark, data_dir)
    ap = evaluate.actual_predicted(test.withColumn("prediction", fit.prediction()), "log_duration")
    return ap.select("key", F.round("actual", 6).alias("actual"), F.round("predicted", 6).alias("predicted"),
                     F.round("actual_exp", 4).alias("actual_exp"), F.round("predicted_exp", 4).alias("predicted_exp"))


@register(
    "simple_ols_durbin_watson",
    with_issues(
        "SELECT round(sum((e - ep) * (e - ep)) / sum(e * e), 6) AS durbin_watson "
        "FROM (SELECT e, lag(e) OVER (ORDER BY key) AS ep FROM fit)",
        _SIMPLE,
    ),
)
def simple_ols_durbin_watson(spark, data_dir):
    """Durbin-Watson of training residuals in key order."""
    fit, train, _ = _simple(spark, data_dir)
    res = train.select("key", (F.col("log_duration") - fit.prediction()).alias("resid"))
    return rounded(stattests.durbin_watson(res, "resid", ["key"]))


@register(
    "simple_ols_scaled_residual_hist",
    with_issues(
        """SELECT bin, round(lo_ + bin * (hi_ - lo_) / 20, 6) AS lo, round(lo_ + (bin + 1) * (hi_ - lo_) / 20, 6) AS hi,
       CAST(count(*) AS BIGINT) AS count
FROM (SELECT least(CAST(floor(20 * (x - lo_) / (hi_ - lo_)) AS BIGINT), 19) AS bin, lo_, hi_
      FROM (SELECT x, min(x) OVER () AS lo_, max(x) OVER () AS hi_
            FROM (SELECT e / sqrt(sum(e * e) OVER () / (count(*) OVER () - 2)) AS x FROM fit)))
GROUP BY bin, lo_, hi_""",
        _SIMPLE,
    ),
)
def simple_ols_scaled_residual_hist(spark, data_dir):
    """20-bin histogram of Pearson residuals e / sqrt(RSS / (n - k))."""
    fit, train, _ = _simple(spark, data_dir)
    r = evaluate.residual_frame(train.withColumn("prediction", fit.prediction()), "log_duration", n_params=2)
    return rounded(evaluate.bins.equal_width_hist(r, "resid_pearson", 20))


# ---------------------------------------------------------------- full least squares and regularised fits
def _ols_full(spark, data_dir):
    def build():
        train, _ = train_test(spark, data_dir)
        _, _, feats = design(spark, data_dir)
        return linear.ols_summary(train, feats, "log_duration", order=["key"])

    return memo(spark, data_dir, "ols_full", build)


@register("ols_coefficients")
def ols_coefficients(spark, data_dir):
    """Coefficient table of the full model: coef, se, t, p, 95 % CI, significance."""
    return rounded(_ols_full(spark, data_dir)[1], significant=["p_value"])


@register("ols_statistics")
def ols_statistics(spark, data_dir):
    """Fit statistics: R^2, adj. R^2, F, P(F), log-likelihood, AIC, BIC, residual skew,
    kurtosis, Jarque-Bera, omnibus, Durbin-Watson, condition number."""
    st = _ols_full(spark, data_dir)[2]
    line = F.concat_ws(", ",
                       F.concat(F.lit("R-squared: "), S.fmt("r2", 3)),
                       F.concat(F.lit("Adj. R-squared: "), S.fmt("adj_r2", 3)),
                       F.concat(F.lit("F-statistic: "), S.fmt("f_stat", 2)),
                       F.concat(F.lit("No. Observations: "), F.col("n").cast("string")))
    return rounded(st.withColumn("summary", line), significant=[c for c in st.columns if c.endswith("p_value")])


@register("ols_formula_fit")
def ols_formula_fit(spark, data_dir):
    """The model given as a formula string (RFormula) fitted by Spark ML; returns the
    formula and its training R^2 (equal to the moment-table fit)."""
    train, _ = train_test(spark, data_dir)
    _, _, feats = design(spark, data_dir)
    safe = {f: f"f{i}" for i, f in enumerate(feats)}
    renamed = train.select(*[F.col(f"`{f}`").alias(safe[f]) for f in feats], "log_duration")
    formula = "log_duration ~ " + " + ".join(safe[f] for f in feats)
    prepared = RFormula(formula=formula).fit(renamed).transform(renamed)
    from pyspark.ml.regression import LinearRegression

    m = LinearRegression(solver="normal").fit(prepared)
    return rounded(spark.createDataFrame([(formula, float(m.summary.r2))], "formula string, r2 double"))


def _scaled_split(spark, data_dir):
    """75/25 split with min-max scaling fitted on the training part (as the ridge/lasso
    study does), as moments of each part."""

    def build():
        _, enc, feats = design(spark, data_dir)
        tr, te = split.train_test(enc, "key", 75)
        sc = encode.MinMaxScaling(inputCols=feats).fit(tr)
        flagged = split.hash_split(sc.transform(enc), "key", 75)
        mom = M.moments(flagged, feats, "log_duration", group="is_train")
        return mom.group(True), mom.group(False), feats

    return memo(spark, data_dir, "scaled", build)


@register("ridge_fit")
def ridge_fit(spark, data_dir):
    """Ridge (alpha = 20) on scaled features: coefficients with train/test R^2."""
    tr, te, feats = _scaled_split(spark, data_dir)
    c = linear.ridge(tr, 20.0)
    r_tr, r_te = linear.r2_from(tr, linear.to_shifted(tr, c)), linear.r2_from(te, linear.to_shifted(te, c))
    rows = [(n, float(v), r_tr, r_te) for n, v in zip(["Intercept", *feats], c)]
    return rounded(spark.createDataFrame(rows, "feature string, coef double, r2_train double, r2_test double"))


# The alpha grids of the regularisation study.
RIDGE_ALPHAS = [0.001, 0.01, 0.1, 0, 1, 10, 20, 50, 100, 1000]
LASSO_ALPHAS = [0.01, 0.07, 0.05, 0.1, 1, 2, 3, 5, 10, 100, 1000, 10000]


def _sweep_frame(spark, rows, coefs, feats):
    """R^2 rows joined with coefficient counts computed in Spark (count_if over the
    long coefficient table)."""
    r2 = spark.createDataFrame(rows, "alpha double, r2_train double, r2_test double")
    long = spark.createDataFrame([(a, f, float(v)) for a, c in coefs for f, v in zip(feats, c[1:])],
                                 "alpha double, feature string, coef double")
    counts = long.groupBy("alpha").agg(F.count_if(F.col("coef") != 0).alias("n_nonzero"),
                                       F.count_if(F.abs("coef") > 1.0).alias("n_abs_gt_1"))
    return rounded(r2.join(counts, "alpha"))


@register("ridge_sweep")
def ridge_sweep(spark, data_dir):
    """Train/test R^2 and coefficient counts (non-zero, |coef| > 1) per ridge alpha."""
    tr, te, feats = _scaled_split(spark, data_dir)
    rows, coefs = [], []
    for a in sorted(RIDGE_ALPHAS):
        c = linear.ridge(tr, a)
        rows.append((float(a), linear.r2_from(tr, linear.to_shifted(tr, c)), linear.r2_from(te, linear.to_shifted(te, c))))
        coefs.append((float(a), c))
    return _sweep_frame(spark, rows, coefs, feats)


@register("ridge_path")
def ridge_path(spark, data_dir):
    """Ridge coefficients without intercept for 200 alphas, log-spaced 1e0..1e8."""
    tr, _, _ = _scaled_split(spark, data_dir)
    alphas = list(np.logspace(0, 8, 200))
    return rounded(spark.createDataFrame(linear.ridge_path(tr, alphas), "alpha double, feature string, coef double"))


@register("lasso_fit")
def lasso_fit(spark, data_dir):
    """Lasso (alpha = 1000 as in the study, and 0.01): non-zero coefficients ranked by
    absolute size, with train/test R^2."""
    tr, te, feats = _scaled_split(spark, data_dir)
    rows = []
    for a in (0.01, 1000.0):
        c = linear.lasso(tr, a)
        r_tr, r_te = linear.r2_from(tr, linear.to_shifted(tr, c)), linear.r2_from(te, linear.to_shifted(te, c))
        rows.extend((a, f, float(v), r_tr, r_te) for f, v in zip(feats, c[1:]))
    coefs = spark.createDataFrame(rows, "alpha double, feature string, coef double, r2_train double, r2_test double")
    w = Window.partitionBy("alpha").orderBy(F.desc(F.abs("coef")), "feature")  # one row per feature per alpha
    nz = coefs.where(F.col("coef") != 0).withColumn("rank", F.row_number().over(w))
    return rounded(nz.select("alpha", "feature", "coef", "rank", "r2_train", "r2_test"))


@register("lasso_sweep")
def lasso_sweep(spark, data_dir):
    """Train/test R^2 and coefficient counts per lasso alpha."""
    tr, te, feats = _scaled_split(spark, data_dir)
    rows, coefs = [], []
    for a in sorted(LASSO_ALPHAS):
        c = linear.lasso(tr, a)
        rows.append((float(a), linear.r2_from(tr, linear.to_shifted(tr, c)), linear.r2_from(te, linear.to_shifted(te, c))))
        coefs.append((float(a), c))
    return _sweep_frame(spark, rows, coefs, feats)


@register("lars_lasso_path")
def lars_lasso_path(spark, data_dir):
    """Exact lasso path knots (LARS, uncentred): knot, alpha, feature, coef and the
    x-axis sum|coef| / max sum|coef|."""
    tr, _, feats = _scaled_split(spark, data_dir)
    zz, zy, _, n = tr.raw()
    alphas, coefs = linear.lars_lasso_path(zz[1:, 1:], zy[1:], n)
    l1 = np.abs(coefs).sum(1)
    xx = l1 / l1[-1] if l1[-1] > 0 else l1
    rows = [(k, float(alphas[k]), f, float(coefs[k, j]), float(xx[k])) for k in range(len(alphas)) for j, f in enumerate(feats)]
    return rounded(spark.createDataFrame(rows, "knot int, alpha double, feature string, coef double, l1_ratio double"))


def _train_residuals(spark, data_dir):
    fit = _ols_full(spark, data_dir)[0]
    train, _ = train_test(spark, data_dir)
    r = evaluate.residual_frame(train.withColumn("prediction", fit.prediction()), "log_duration", n_params=fit.k)
    return r


@register("qq_ols_residuals")
def qq_ols_residuals(spark, data_dir):
    """Q-Q table of the full model's Pearson residuals, standardised, 45-degree line."""
    return rounded(stattests.qq_points(_train_residuals(spark, data_dir), "resid_pearson", line="45"))


@register("shapiro_ols_residuals")
def shapiro_ols_residuals(spark, data_dir):
    """Shapiro-Wilk test of the full model's residuals (reject normality when p < 0.05)."""
    return rounded(stattests.shapiro(_train_residuals(spark, data_dir), "resid"))


@register("ols_residual_tables")
def ols_residual_tables(spark, data_dir):
    """Predictor-vs-residual and fitted-vs-residual 2-D bins and the scaled-residual
    histogram of the full model on the training split."""
    fit = _ols_full(spark, data_dir)[0]
    train, _ = train_test(spark, data_dir)
    df = train.withColumn("prediction", fit.prediction())
    return evaluate.residual_tables(df, ["comment_count", "watch_count", "vote_count"], "log_duration", n_params=fit.k)


# ---------------------------------------------------------------- feature selection
def _fold_mom(spark, data_dir):
    def build():
        _, enc, feats = design(spark, data_dir)
        lab = issues(spark, data_dir).select("key", "created")
        folded = split.contiguous_folds(enc.join(lab, "key"), ["created", "key"], 5)
        return select.fold_moments(folded, feats, "log_duration")

    return memo(spark, data_dir, "foldmom", build)


def _search(spark, data_dir):
    return memo(spark, data_dir, "search", lambda: select.search_table(spark, _fold_mom(spark, data_dir)))


@register("feature_selection_table")
def feature_selection_table(spark, data_dir):
    """Forward, backward, floating forward and floating backward searches: per size the
    feature set, 5-fold CV MSE per fold, mean, sd, se and 90 % bound; best size flagged."""
    return rounded(_search(spark, data_dir))


@register("feature_selection_consensus")
def feature_selection_consensus(spark, data_dir):
    """Which features each method's best subset keeps (1/0), over their union."""
    return select.consensus(_search(spark, data_dir))


@register("best_subset_size")
def best_subset_size(spark, data_dir):
    """Arg-min of mean CV MSE over sizes 1..p per method."""
    t = _search(spark, data_dir)
    return rounded(t.groupBy("method").agg(F.min_by("k", "avg_mse").alias("best_k"), F.min("avg_mse").alias("best_mse")))


@register("exhaustive_selection")
def exhaustive_selection(spark, data_dir):
    """Best subset of each size over all columns of the design by residual sum of squares, exact by
    leaps and bounds, with its 5-fold CV MSE; the best size by that is flagged."""
    return rounded(leaps.best_subsets(spark, _fold_mom(spark, data_dir)))


# ---------------------------------------------------------------- trees and scoring
MODELS = ("linear", "tree", "forest")


def _models(spark, data_dir, names=MODELS):
    """The fitted models of ``names``, each fitted once."""
    from concurrent.futures import ThreadPoolExecutor

    train, _ = train_test(spark, data_dir)
    _, _, feats = design(spark, data_dir)
    fits = {
        "linear": lambda: linear.OLSModel.from_fit(linear.ols(M.moments(train, feats, "log_duration"))),
        "tree": lambda: trees.fit_tree(train, feats, "log_duration", max_depth=5, seed=0),
        # depth 6: MLlib has no cap on leaves; this holds 64 of them at most
        "forest": lambda: trees.fit_forest(train, feats, "log_duration", num_trees=100, max_depth=6, seed=0),
    }
    # Independent fits run as concurrent Spark jobs (as CrossValidator(parallelism) does).
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        futures = {m: pool.submit(memo, spark, data_dir, f"model_{m}", fits[m]) for m in names}
        return {m: fut.result() for m, fut in futures.items()}


# The registered search: draws of the full grid, with few trees and folds as a correctness run allows.
SEARCH_DRAWS, SEARCH_TREES, SEARCH_FOLDS = 2, 10, 2


def _search_forest(spark, data_dir):
    def build():
        train, _ = train_test(spark, data_dir)
        _, _, feats = design(spark, data_dir)
        return trees.random_search(train, feats, "log_duration", n_iter=SEARCH_DRAWS, folds=SEARCH_FOLDS, max_trees=SEARCH_TREES)

    return memo(spark, data_dir, "search_forest", build)


@register("random_search_draws")
def random_search_draws(spark, data_dir):
    """Every draw of the randomised forest search with its parameters as drawn and as MLlib can
    use them, its cross-validated R^2, and whether it is the best."""
    return rounded(trees.search_table(spark, *_search_forest(spark, data_dir)))


@register("tuned_forest_improvement")
def tuned_forest_improvement(spark, data_dir):
    """Test accuracy of the base forest and of the best draw's, and the improvement in per cent."""
    _, test = train_test(spark, data_dir)
    _, _, feats = design(spark, data_dir)
    models = {"forest": _models(spark, data_dir, ["forest"])["forest"], "tuned": _search_forest(spark, data_dir)[0].bestModel}
    pr = score.score_side_by_side(test, feats, models, keep=["log_duration"])
    rows = evaluate.accuracy_by_model(pr, {(m, "log"): (F.col("log_duration"), F.col(f"pred_{m}")) for m in models})
    base = F.max(F.when(F.col("model") == "forest", F.col("accuracy"))).over(Window.partitionBy("scale"))
    return rounded(rows.withColumn("improvement_vs_base", evaluate.improvement(F.col("accuracy"), base)))


@register("model_train_metrics")
def model_train_metrics(spark, data_dir):
    """MAE, MSE, RMSE and R^2 of the three models on the training split."""
    train, _ = train_test(spark, data_dir)
    _, _, feats = design(spark, data_dir)
    pr = score.score_side_by_side(train, feats, _models(spark, data_dir), keep=["log_duration"])
    return rounded(evaluate.regression_metrics_by_model(
        pr, "log_duration", {m: f"pred_{m}" for m in ("linear", "tree", "forest")}))


@register("tree_importances")
def tree_importances(spark, data_dir):
    _, _, feats = design(spark, data_dir)
    return rounded(trees.importances(spark, _models(spark, data_dir, ["tree"])["tree"], feats))


@register("forest_importances")
def forest_importances(spark, data_dir):
    _, _, feats = design(spark, data_dir)
    return rounded(trees.importances(spark, _models(spark, data_dir, ["forest"])["forest"], feats))


@register("tree_nodes")
def tree_nodes(spark, data_dir):
    _, _, feats = design(spark, data_dir)
    return rounded(trees.tree_nodes(spark, _models(spark, data_dir, ["tree"])["tree"], feats))


@register("importance_vs_t")
def importance_vs_t(spark, data_dir):
    """Forest importance next to the OLS t statistic normalised by the sum of t values."""
    coefs = _ols_full(spark, data_dir)[1].where(F.col("feature") != "Intercept")
    tot = coefs.agg(F.sum("t")).first()[0]
    imp = forest_importances(spark, data_dir)
    return rounded(imp.join(coefs.select("feature", F.try_divide(F.col("t"), F.lit(tot)).alias("t_normalised")), "feature"))


def _test_predictions(spark, data_dir):
    _, test = train_test(spark, data_dir)
    _, _, feats = design(spark, data_dir)
    return score.score_side_by_side(test, feats, _models(spark, data_dir), keep=["log_duration"])


@register("model_test_metrics")
def model_test_metrics(spark, data_dir):
    """MAE, MSE, RMSE, R^2 of the linear model, tree and forest on the test split (one
    pass over the scored rows)."""
    pr = _test_predictions(spark, data_dir)
    return rounded(evaluate.regression_metrics_by_model(
        pr, "log_duration", {m: f"pred_{m}" for m in ("linear", "tree", "forest")}))


@register("model_accuracy")
def model_accuracy(spark, data_dir):
    """Average error, MAPE, accuracy per model (log scale and minutes) and the
    improvement over the tree, from one pass over the scored rows."""
    pr = _test_predictions(spark, data_dir)
    pairs = {}
    for m in ("linear", "tree", "forest"):
        pairs[(m, "log")] = (F.col("log_duration"), F.col(f"pred_{m}"))
        pairs[(m, "minutes")] = (F.exp("log_duration"), F.col(f"minutes_{m}"))
    rows = evaluate.accuracy_by_model(pr, pairs)
    # six rows: the tree's accuracy per scale as a column, by a grouped max (no join)
    base = F.max(F.when(F.col("model") == "tree", F.col("accuracy"))).over(Window.partitionBy("scale"))
    return rounded(rows.withColumn("improvement_vs_tree", evaluate.improvement(F.col("accuracy"), base)))


_TREES = ("tree", "forest")


def _trees(spark, data_dir):
    return _models(spark, data_dir, _TREES)


@register("tree_actual_predicted")
def tree_actual_predicted(spark, data_dir):
    """Actual and predicted values of tree and forest on the test split, on the log scale and as
    minutes: (model, key, actual, predicted, actual_exp, predicted_exp)."""
    pr = _test_predictions(spark, data_dir)
    rows = pr.select(F.inline(F.array(*[F.struct(F.lit(m).alias("model"), "key", F.col("log_duration").alias("actual"),
                                                 F.col(f"pred_{m}").alias("predicted")) for m in _TREES])))
    return rounded(rows.withColumns({"actual_exp": F.exp("actual"), "predicted_exp": F.exp("predicted")}))


def _fitted(spark, data_dir):
    """(key, log_duration, pred_tree, pred_forest) of the training split, written once."""

    def build():
        train, _ = train_test(spark, data_dir)
        _, _, feats = design(spark, data_dir)
        scores = score.score_side_by_side(train, feats, _trees(spark, data_dir), keep=["log_duration"])
        return write_and_read(scores.select("key", "log_duration", *[f"pred_{m}" for m in _TREES]), "fitted")

    return memo(spark, data_dir, "fitted", build)


@register("tree_fitted_by_position")
def tree_fitted_by_position(spark, data_dir):
    """Actual values of the training rows in key order with those fitted by tree and forest."""
    t = row_numbers(_fitted(spark, data_dir), ["key"], col="position")
    return rounded(t.select(F.col("position").cast("bigint"), "key", F.col("log_duration").alias("actual"),
                            *[F.col(f"pred_{m}").alias(f"fitted_{m}") for m in _TREES]))


@register("tree_residual_tables")
def tree_residual_tables(spark, data_dir):
    """Fitted values against residuals of tree and forest on the training split: 20 x 20 cells."""
    t = _fitted(spark, data_dir)
    df = t.select(*[F.col(f"pred_{m}").alias(f"fitted_{m}") for m in _TREES], *[(F.col("log_duration") - F.col(f"pred_{m}")).alias(f"resid_{m}") for m in _TREES])
    k = cube.BinCube.fit(df, df.columns, 20)
    return k.scatter([(f"fitted_{m}", f"resid_{m}") for m in _TREES])


# ---------------------------------------------------------------- the model on selected features
def _selected(spark, data_dir):
    """(features of the floating forward search's best size, least squares on them)."""

    def build():
        table = _search(spark, data_dir)
        feats = table.where("is_best AND method = 'SFFS'").first()["features"]
        train, _ = train_test(spark, data_dir)
        return list(feats), linear.ols_summary(train, list(feats), "log_duration", order=["key"])

    return memo(spark, data_dir, "selected", build)


@register("selected_ols_coefficients")
def selected_ols_coefficients(spark, data_dir):
    """Coefficient table of least squares on the features that the floating forward search keeps."""
    return rounded(_selected(spark, data_dir)[1][1], significant=["p_value"])


@register("selected_ols_statistics")
def selected_ols_statistics(spark, data_dir):
    """Fit statistics of that model."""
    st = _selected(spark, data_dir)[1][2]
    return rounded(st, significant=[c for c in st.columns if c.endswith("p_value")])


@register("selected_ols_test_metrics")
def selected_ols_test_metrics(spark, data_dir):
    """MAE, MSE, RMSE and R^2 on the test split of the model on selected features and on all."""
    feats, (fit, _, _) = _selected(spark, data_dir)
    _, test = train_test(spark, data_dir)
    full = _ols_full(spark, data_dir)[0]
    pr = test.select("log_duration", fit.prediction().alias("pred_selected"), full.prediction().alias("pred_all"))
    return rounded(evaluate.regression_metrics_by_model(pr, "log_duration", {m: f"pred_{m}" for m in ("selected", "all")}))


@register("selected_describe")
def selected_describe(spark, data_dir):
    """Count, mean, deviation, quartiles and extremes of the selected predictors."""
    feats, _ = _selected(spark, data_dir)
    _, enc, _ = design(spark, data_dir)
    return rounded(profile.describe(enc, feats))


def _open_scores(spark, data_dir):
    model, _, feats = design(spark, data_dir)
    _, op = clean.split_labelled(issues(spark, data_dir))
    enc = encode.encode(model, op)
    return score.score_side_by_side(enc, feats, _models(spark, data_dir))


@register("open_issue_predictions")
def open_issue_predictions(spark, data_dir):
    """Every open issue scored by the three models: log prediction, minutes, interval."""
    s = _open_scores(spark, data_dir)
    return rounded(s.select("key", *[c for c in s.columns if c.startswith(("pred_", "minutes_"))],
                            *[F.col(c).cast("string").alias(c) for c in s.columns if c.startswith("duration_")]))


@register("open_issue_case_report")
def open_issue_case_report(spark, data_dir):
    """The 10 open issues where the three models disagree most, with their raw fields."""
    _, op = clean.split_labelled(issues(spark, data_dir))
    rep = score.case_report(_open_scores(spark, data_dir), op.select("key", "status", "priority", "issue_type", "reporter",
                                                                   "assignee", "vote_count", "comment_count", "watch_count"),
                            top=10, models=["linear", "tree", "forest"])
    return rounded(rep.select(*[F.col(c).cast("string").alias(c) if c.startswith("duration_") else F.col(c) for c in rep.columns]))


@register("open_issue_chosen_cases")
def open_issue_chosen_cases(spark, data_dir):
    """The open issues at the case study's positions, in (created, key) order, with their raw fields
    and each model's prediction."""
    from .q_more import CASE_POSITIONS

    _, op = clean.split_labelled(issues(spark, data_dir))
    raw = row_numbers(op, ["created", "key"], col="_n").withColumn("position", (F.col("_n") - 1).cast("bigint")).where(
        F.col("position").isin(*CASE_POSITIONS))
    raw = raw.select("position", "key", "status", "priority", "issue_type", "reporter", "assignee", "vote_count", "comment_count", "watch_count")
    rep = score.case_report(_open_scores(spark, data_dir), raw, models=["linear", "tree", "forest"])
    return rounded(rep.select(*[F.col(c).cast("string").alias(c) if c.startswith("duration_") else F.col(c) for c in rep.columns]))


# ---------------------------------------------------------------- JSON and CSV sources
def _json_lines_path(spark, data_dir):
    """The events' JSON payloads written once as a JSON-lines folder (one object per
    line) with a nested ``transitions`` list of 0..2 elements per record."""

    def build():
        path = scratch_path(spark, "events-jsonl")
        ev = table(spark, data_dir, "events")
        k = F.get_json_object("props", "$.k").cast("int")
        # k % 3 transitions per record; sequence(1, 0) would count down, so the list is
        # built from 1..max(n, 1) and filtered (empty when k % 3 = 0)
        rec = F.to_json(F.struct(
            F.col("event_id").alias("event_id"), F.col("user_id").alias("user_id"),
            F.from_json("props", "map<string,int>").alias("props"),
            F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.pmod(k, F.lit(3)), F.lit(1))),
                                 lambda i: F.struct(F.col("event_type").alias("to"), i.alias("step"))),
                     lambda s: s["step"] <= F.pmod(k, F.lit(3))).alias("transitions")))
        ev.select(rec.alias("value")).write.mode("overwrite").text(path)
        cleanup_at_exit(spark, path)
        return path

    return memo(spark, data_dir, "jsonl", build)


# Declared record schema: no inference pass over the files.
EVENT_JSON_SCHEMA = ("event_id bigint, user_id bigint, props struct<k: bigint>, "
                     "transitions array<struct<to: string, step: int>>")


@register(
    "json_transitions_profile",
    """SELECT CAST(0 AS BIGINT) AS missing, CAST(count_if(n = 0) AS BIGINT) AS empty,
       CAST(count_if(n > 0) AS BIGINT) AS non_empty, CAST(sum(n) AS BIGINT) AS elements
FROM (SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS n FROM events)""",
)
def json_transitions_profile(spark, data_dir):
    """How many records carry a missing, empty or non-empty ``transitions`` list."""
    df = files.read_json_lines(spark, _json_lines_path(spark, data_dir), schema=EVENT_JSON_SCHEMA)
    return jsonops.list_profile(df, "transitions").select(
        *[F.col(c).cast("bigint").alias(c) for c in ["missing", "empty", "non_empty", "elements"]])


@register(
    "json_lines_scan",
    "SELECT CAST(count(*) AS BIGINT) AS records, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k FROM events",
)
def json_lines_scan(spark, data_dir):
    """Record count and a payload checksum of the JSON-lines export."""
    df = files.read_json_lines(spark, _json_lines_path(spark, data_dir), schema=EVENT_JSON_SCHEMA)
    return df.agg(F.count(F.lit(1)).alias("records"), F.sum("props.k").cast("bigint").alias("sum_k"))


@register(
    "json_transitions_explode",
    """SELECT event_id, CAST(CASE WHEN n = 0 THEN NULL ELSE i + 1 END AS BIGINT) AS step, CAST(n AS INTEGER) AS transitions_size
FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS n FROM events) e,
     range(0, greatest(n, 1)) t(i)""",
)
def json_transitions_explode(spark, data_dir):
    """One row per transition; records with an empty list keep one NULL row."""
    df = files.read_json_lines(spark, _json_lines_path(spark, data_dir), schema=EVENT_JSON_SCHEMA)
    out = jsonops.explode_list(df, "transitions", ["event_id"], "t")
    return out.select("event_id", F.col("t.step").cast("bigint").alias("step"), F.col("transitions_size").cast("int"))


@register(
    "json_top_keys",
    "SELECT event_id, unnest(json_keys(props)) AS json_key FROM events",
)
def json_top_keys(spark, data_dir):
    """Top-level keys of every event payload."""
    ev = table(spark, data_dir, "events")
    return ev.select("event_id", F.explode(jsonops.top_level_keys("props")).alias("json_key"))


def _json_sql() -> str:
    nl, pad = "chr(10)", lambda k: " " * k
    item = (f"""'{pad(8)}{{' || {nl} || '{pad(12)}"step": ' || i || ',' || {nl} || '{pad(12)}"to": "' || event_type || '"' || {nl} || '{pad(8)}}}'""")
    return f"""SELECT event_id, '{{' || {nl} || '{pad(4)}"event_id": ' || event_id || ',' || {nl} || '{pad(4)}"props": {{' || {nl} || '{pad(8)}"k": ' || k || {nl}
       || '{pad(4)}}},' || {nl} || '{pad(4)}"transitions": ' || CASE WHEN k % 3 = 0 THEN '[]' ELSE '[' || {nl}
       || array_to_string(list_transform(range(1, k % 3 + 1), lambda i: {item}), ',' || {nl}) || {nl} || '{pad(4)}]' END || ',' || {nl}
       || '{pad(4)}"user_id": ' || user_id || {nl} || '}}' AS pretty
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""


@register("json_canonical", _json_sql())
def json_canonical(spark, data_dir):
    """Sorted-key, indented text of each JSON-lines record."""
    raw = spark.read.text(_json_lines_path(spark, data_dir))
    return raw.select(F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"),
                      jsonops.canonical_json("value").alias("pretty"))


def _export_path(spark, data_dir, damaged=False):
    """The issue table in the form of a tracker's export: keys such as DEMO-1, timestamps with an
    offset, quotes and a line break in a field; ``damaged``: with timestamps that are none, and
    others that lost their offset."""

    def build():
        path = scratch_path(spark, "issue-export")
        stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'")
        out = issues(spark, data_dir).withColumns({
            "key": F.concat(F.lit("DEMO-"), F.col("key").cast("string")),
            "project": F.concat(F.col("project"), F.lit(' "alpha",\nsecond line')),
            **{c: stamp(c) for c in files.EXPORT_TIMESTAMPS},
        })
        if damaged:
            out = out.withColumns({
                "created": F.when(F.expr("int(substr(key, 6)) % 97 = 5"), F.lit("yesterday, \n about noon")).otherwise(F.col("created")),
                "resolutiondate": F.when(F.expr("int(substr(key, 6)) % 89 = 3"), F.substring("resolutiondate", 1, 23)).otherwise(F.col("resolutiondate"))})
        files.write_csv(out, path)
        return cleanup_at_exit(spark, path)

    return memo(spark, data_dir, f"issue_export_{damaged}", build)


@register("csv_export_profile", with_issues(
    """SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT key) AS BIGINT) AS n_keys, CAST(count(created) AS BIGINT) AS n_created,
       CAST(count(resolutiondate) AS BIGINT) AS n_resolved, min(created) AS first_created, max(resolutiondate) AS last_resolved,
       CAST(sum(CASE WHEN project = 'DEMO' THEN 1 ELSE 0 END) AS BIGINT) AS n_quoted, CAST(sum(bad) AS BIGINT) AS bad_timestamps
FROM (SELECT key, project, CASE WHEN key % 97 <> 5 THEN created END AS created, CASE WHEN key % 89 <> 3 THEN resolutiondate END AS resolutiondate,
        CASE WHEN key % 97 = 5 THEN 1 ELSE 0 END + CASE WHEN key % 89 = 3 AND resolutiondate IS NOT NULL THEN 1 ELSE 0 END AS bad FROM issues)"""))
def csv_export_profile(spark, data_dir):
    """Rows, keys, dates and malformed dates of a damaged export-form CSV file as read back with
    the export's types."""
    df = files.read_issue_export(spark, _export_path(spark, data_dir, damaged=True), strict=False)
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("key").alias("n_keys"), F.count("created").alias("n_created"),
        F.count("resolutiondate").alias("n_resolved"), F.min("created").alias("first_created"), F.max("resolutiondate").alias("last_resolved"),
        F.count_if((F.col("project") == 'DEMO "alpha",\nsecond line') & F.startswith("key", F.lit("DEMO-"))).alias("n_quoted"),
        F.sum("bad_timestamps").cast("bigint").alias("bad_timestamps"))


@register("csv_export_durations", with_issues(
    """SELECT concat('DEMO-', CAST(key AS VARCHAR)) AS key, CAST(date_diff('day', created, resolutiondate) AS BIGINT) * 1440 AS duration_min
FROM issues WHERE resolutiondate IS NOT NULL AND created IS NOT NULL"""))
def csv_export_durations(spark, data_dir):
    """Whole minutes to resolution of the labelled rows of the export."""
    labelled, _ = clean.split_labelled(files.read_issue_export(spark, _export_path(spark, data_dir)))
    return clean.add_duration(labelled).select("key", "duration_min")


@register("csv_roundtrip", with_issues("SELECT * FROM issues"))
def csv_roundtrip(spark, data_dir):
    """The issue table written as header CSV and read back with the declared schema."""
    path = scratch_path(spark, "issues-csv")
    files.write_csv(issues(spark, data_dir), path)
    cleanup_at_exit(spark, path)
    return files.read_issues_csv(spark, path)
