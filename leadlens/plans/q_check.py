"""Model queries small enough for closed-form SQL: two predictors by normal equations, one by
soft threshold, and the wide moment table. They run the same operators as the full models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import linear, modeling_data, select
from ..operators import moments as M
from ..sources.issues import issues
from .q_model import RIDGE_ALPHAS
from .q_prep import LAB_CTE
from .registry import register, rounded, with_issues

_PAIR = ["comment_count", "summary_length"]
_FOLDS = 5

# Centred sums of two predictors and the target, over all labelled rows.
_SUMS = f"""{LAB_CTE},
d AS (SELECT key, CAST(comment_count AS DOUBLE) AS a, CAST(summary_length AS DOUBLE) AS b, ln(duration_min) AS y FROM lab WHERE duration_min > 0),
m AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM d),
s AS (SELECT any_value(n) AS n, any_value(ma) AS ma, any_value(mb) AS mb, any_value(my) AS my,
             sum((a - ma) * (a - ma)) AS aa, sum((b - mb) * (b - mb)) AS bb, sum((a - ma) * (b - mb)) AS ab,
             sum((a - ma) * (y - my)) AS ay, sum((b - mb) * (y - my)) AS yb, sum((y - my) * (y - my)) AS yy FROM d, m),
f AS (SELECT *, aa * bb - ab * ab AS det, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS ca, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS cb FROM s),
o AS (SELECT *, my - ca * ma - cb * mb AS c0, yy - ca * ay - cb * yb AS rss, (yy - ca * ay - cb * yb) / (n - 3) AS v FROM f)"""


def _frame(spark, data_dir):
    return modeling_data.labelled_with_target(issues(spark, data_dir))


def _moments(spark, data_dir, features=None, group=None):
    return M.moments(_frame(spark, data_dir), features or _PAIR, "log_duration", group)


@register("two_predictor_coefficients", with_issues(
    """SELECT feature, round(coef, 6) AS coef, round(se, 6) AS std_err, round(coef / se, 6) AS t FROM (
  SELECT 'Intercept' AS feature, c0 AS coef, sqrt(v * (1 / n + (ma * ma * bb + mb * mb * aa - 2 * ma * mb * ab) / det)) AS se FROM o
  UNION ALL SELECT 'comment_count', ca, sqrt(v * bb / det) FROM o
  UNION ALL SELECT 'summary_length', cb, sqrt(v * aa / det) FROM o)""", _SUMS))
def two_predictor_coefficients(spark, data_dir):
    """Coefficients, standard errors and t of a least-squares fit with two predictors."""
    coefs, _ = linear.ols_tables(linear.ols(_moments(spark, data_dir)), spark)
    return rounded(coefs.select("feature", "coef", "std_err", "t"))


@register("two_predictor_statistics", with_issues(
    """SELECT CAST(n AS BIGINT) AS n, CAST(2 AS BIGINT) AS df_model, CAST(n - 3 AS BIGINT) AS df_resid, round(1 - rss / yy, 6) AS r2,
       round(1 - (rss / yy) * (n - 1) / (n - 3), 6) AS adj_r2, round(((yy - rss) / 2) / v, 6) AS f_stat,
       round(-n / 2 * (ln(2 * pi()) + ln(rss / n) + 1), 4) AS log_likelihood,
       round(n * (ln(2 * pi()) + ln(rss / n) + 1) + 6, 4) AS aic, round(n * (ln(2 * pi()) + ln(rss / n) + 1) + 3 * ln(n), 4) AS bic FROM o""", _SUMS))
def two_predictor_statistics(spark, data_dir):
    """R^2, adjusted R^2, F, log-likelihood, AIC and BIC of the same fit."""
    _, stats = linear.ols_tables(linear.ols(_moments(spark, data_dir)), spark)
    return rounded(stats.select("n", "df_model", "df_resid", "r2", "adj_r2", "f_stat",
                                *(F.round(c, 4).alias(c) for c in ("log_likelihood", "aic", "bic"))))


_ALPHAS = " UNION ALL ".join(f"SELECT CAST({a} AS DOUBLE) AS alpha" for a in RIDGE_ALPHAS)


@register("two_predictor_ridge", with_issues(
    f"""SELECT alpha, feature, round(coef, 6) AS coef FROM (
  SELECT alpha, (ay * (bb + alpha) - yb * ab) / ((aa + alpha) * (bb + alpha) - ab * ab) AS r1,
         (yb * (aa + alpha) - ay * ab) / ((aa + alpha) * (bb + alpha) - ab * ab) AS r2, ma, mb, my FROM s, ({_ALPHAS})) AS r,
  LATERAL (SELECT 'Intercept' AS feature, my - r1 * ma - r2 * mb AS coef UNION ALL SELECT 'comment_count', r1 UNION ALL SELECT 'summary_length', r2)""",
    _SUMS))
def two_predictor_ridge(spark, data_dir):
    """Ridge over the study's grid of alphas, 0 included."""
    mom = _moments(spark, data_dir)
    rows = [(float(a), n, float(c)) for a in RIDGE_ALPHAS for n, c in zip(["Intercept", *_PAIR], linear.ridge(mom, a))]
    return rounded(spark.createDataFrame(rows, "alpha double, feature string, coef double"))


_RAW = f"""{LAB_CTE},
d AS (SELECT CAST(comment_count AS DOUBLE) AS a, CAST(summary_length AS DOUBLE) AS b, ln(duration_min) AS y FROM lab WHERE duration_min > 0),
s AS (SELECT sum(a * a) AS aa, sum(b * b) AS bb, sum(a * b) AS ab, sum(a * y) AS ay, sum(b * y) AS yb FROM d)"""


@register("two_predictor_ridge_path", with_issues(
    f"""SELECT alpha, feature, CASE WHEN feature = 'comment_count' THEN round((ay * (bb + alpha) - yb * ab) / ((aa + alpha) * (bb + alpha) - ab * ab), 9)
       ELSE round((yb * (aa + alpha) - ay * ab) / ((aa + alpha) * (bb + alpha) - ab * ab), 9) END AS coef
FROM s, ({_ALPHAS}), (SELECT 'comment_count' AS feature UNION ALL SELECT 'summary_length')""", _RAW))
def two_predictor_ridge_path(spark, data_dir):
    """Ridge without an intercept on the raw predictors."""
    rows = linear.ridge_path(_moments(spark, data_dir), RIDGE_ALPHAS)
    return rounded(spark.createDataFrame(rows, "alpha double, feature string, coef double"), 9)


_LASSO = [0.0, 0.001, 0.01, 0.1, 1.0]
_LASSO_SQL = " UNION ALL ".join(f"SELECT CAST({a} AS DOUBLE) AS alpha" for a in _LASSO)


@register("one_predictor_lasso", with_issues(
    f"""SELECT alpha, round(my - c * ma, 6) AS intercept, round(c, 6) AS coef FROM (
  SELECT alpha, ma, my, sign(ay) * greatest(abs(ay) - alpha * n, 0) / aa AS c FROM s, ({_LASSO_SQL}))""", _SUMS))
def one_predictor_lasso(spark, data_dir):
    """Lasso with one predictor: the soft threshold."""
    mom = _moments(spark, data_dir, _PAIR[:1])
    rows = [(a, *map(float, linear.lasso(mom, a))) for a in _LASSO]
    return rounded(spark.createDataFrame(rows, "alpha double, intercept double, coef double"))


@register("two_predictor_cv_mse", with_issues(
    f"""SELECT CAST(2 AS INTEGER) AS k, round(avg(mse), 6) AS avg_mse FROM (
  SELECT t.fold, avg(power(t.y - (my - ca * ma - cb * mb) - ca * t.a - cb * t.b, 2)) AS mse FROM g AS t JOIN c ON c.fold = t.fold GROUP BY t.fold)""",
    f"""{LAB_CTE},
g AS (SELECT CAST(comment_count AS DOUBLE) AS a, CAST(summary_length AS DOUBLE) AS b, ln(duration_min) AS y, key % {_FOLDS} AS fold FROM lab WHERE duration_min > 0),
p AS (SELECT h.fold, g.a, g.b, g.y, avg(g.a) OVER w AS ma, avg(g.b) OVER w AS mb, avg(g.y) OVER w AS my
      FROM (SELECT DISTINCT fold FROM g) AS h JOIN g ON g.fold <> h.fold WINDOW w AS (PARTITION BY h.fold)),
q AS (SELECT fold, any_value(ma) AS ma, any_value(mb) AS mb, any_value(my) AS my, sum((a - ma) * (a - ma)) AS aa, sum((b - mb) * (b - mb)) AS bb,
             sum((a - ma) * (b - mb)) AS ab, sum((a - ma) * (y - my)) AS ay, sum((b - mb) * (y - my)) AS yb FROM p GROUP BY fold),
c AS (SELECT *, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS ca, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS cb FROM q)"""))
def two_predictor_cv_mse(spark, data_dir):
    """Mean cross-validated error of the two-predictor subset, from per-fold moments."""
    df = _frame(spark, data_dir).withColumn("fold", F.pmod("key", F.lit(_FOLDS)).cast("int"))
    best = select.exhaustive(spark, M.moments(df, _PAIR, "log_duration", "fold"), min_features=2)
    return rounded(best.select("k", "avg_mse"))


# Twelve predictors, past the width up to which the sums are one JVM aggregate.
_WIDE = {f"x{i}": f"CAST((key * {i + 3}) % {11 + i} AS DOUBLE)" for i in range(12)}


@register("moments_wide", with_issues(
    "\nUNION ALL\n".join(f"SELECT '{a}' AS x, '{b}' AS y, round(sum({a} * {b}), 2) AS xy FROM w" for a in [*_WIDE, "t"] for b in [*_WIDE, "t"]),
    f"{LAB_CTE},\nw AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _WIDE.items())}, CAST(duration_min AS DOUBLE) / 1440 AS t FROM lab)"))
def moments_wide(spark, data_dir):
    """Sums of products of twelve predictors and a target: the moment table's Arrow path."""
    df = _frame(spark, data_dir).selectExpr(*(f"CAST((key * {i + 3}) % {11 + i} AS DOUBLE) AS {n}" for i, n in enumerate(_WIDE)), "duration_min / 1440D AS t")
    zz, zy, yy, _ = M.moments(df, list(_WIDE), "t").raw()
    names = list(_WIDE)
    rows = [(a, b, float(zz[i + 1, j + 1])) for i, a in enumerate(names) for j, b in enumerate(names)]
    rows += [r for i, a in enumerate(names) for r in ((a, "t", float(zy[i + 1])), ("t", a, float(zy[i + 1])))] + [("t", "t", float(yy))]
    return rounded(spark.createDataFrame(rows, "x string, y string, xy double"), 2)
