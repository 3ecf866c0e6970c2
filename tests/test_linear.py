import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadlens.operators import linear, select
from leadlens.operators import moments as M


@pytest.fixture(scope="module")
def tiny(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(200, 3)) * [1.0, 3.0, 0.5] + [10.0, -2.0, 100.0]
    y = 1.5 + X @ [0.7, -0.2, 0.05] + rng.normal(scale=0.3, size=200)
    pdf = pd.DataFrame(X, columns=["a", "b", "c"]).assign(y=y, key=np.arange(200), fold=np.arange(200) % 5 + 1)
    return spark.createDataFrame(pdf), pdf


def test_moments_jvm_and_partials_agree(spark, tiny):
    df, _ = tiny
    a = M.moments(df, ["a", "b", "c"], "y", group="fold")
    old = M.JVM_MAX_FEATURES
    M.JVM_MAX_FEATURES = 0
    try:
        b = M.moments(df, ["a", "b", "c"], "y", group="fold")
    finally:
        M.JVM_MAX_FEATURES = old
    assert a.groups == b.groups
    assert np.allclose(a.zz, b.zz, atol=1e-8) and np.allclose(a.zy, b.zy, atol=1e-8)


def test_ols_equals_lstsq_and_inference(spark, tiny):
    df, pdf = tiny
    fit = linear.ols(M.moments(df, ["a", "b", "c"], "y"))
    X = np.column_stack([np.ones(200), pdf[["a", "b", "c"]]])
    b, res, *_ = np.linalg.lstsq(X, pdf.y, rcond=None)
    assert np.allclose(fit.coef, b, atol=1e-10)
    assert fit.rss == pytest.approx(res[0], rel=1e-9)
    cov = res[0] / (200 - 4) * np.linalg.inv(X.T @ X)
    assert np.allclose(fit.cov, cov, rtol=1e-7)
    assert fit.cond == pytest.approx(np.linalg.cond(X), rel=1e-6)
    coefs, stats = linear.ols_tables(fit, spark)
    st = stats.first()
    r2 = 1 - res[0] / ((pdf.y - pdf.y.mean()) ** 2).sum()
    assert st["r2"] == pytest.approx(r2)
    assert st["aic"] == pytest.approx(-2 * st["log_likelihood"] + 8)


def test_published_fit_statistics():
    # Closed forms reproduce the printed ones from n=907, k=15, R^2, logLik.
    n, k, r2 = 907, 15, 0.336
    adj = 1 - (1 - r2) * (n - 1) / (n - k)
    assert adj == pytest.approx(0.3256, abs=1e-4)
    ll = -1985.4
    assert -2 * ll + 2 * k == pytest.approx(4000.8, abs=0.1)
    assert -2 * ll + k * np.log(n) == pytest.approx(4072.95, abs=0.1)


def test_spark_ols_equals_moments(spark, tiny):
    df, _ = tiny
    m = linear.spark_ols(df, ["a", "b", "c"], "y")
    fit = linear.ols(M.moments(df, ["a", "b", "c"], "y"))
    assert m.intercept == pytest.approx(fit.coef[0], abs=1e-8)
    assert np.allclose(m.coefficients.toArray(), fit.coef[1:], atol=1e-8)


def test_ridge_closed_form_and_spark(spark, tiny):
    df, pdf = tiny
    mom = M.moments(df, ["a", "b", "c"], "y")
    c = linear.ridge(mom, 20.0)
    X = pdf[["a", "b", "c"]].to_numpy()
    Xc, yc = X - X.mean(0), pdf.y - pdf.y.mean()
    beta = np.linalg.solve(Xc.T @ Xc + 20 * np.eye(3), Xc.T @ yc)
    assert np.allclose(c[1:], beta, atol=1e-9)
    sm = linear.spark_ridge(df, ["a", "b", "c"], "y", 20.0)
    assert np.allclose(sm.coefficients.toArray(), beta, atol=1e-6)


def test_lasso_cd_kkt_and_spark(spark, tiny):
    df, pdf = tiny
    mom = M.moments(df, ["a", "b", "c"], "y")
    alpha = 0.3
    c = linear.lasso(mom, alpha)
    X = pdf[["a", "b", "c"]].to_numpy()
    Xc, yc = X - X.mean(0), pdf.y.to_numpy() - pdf.y.mean()
    grad = Xc.T @ (yc - Xc @ c[1:]) / len(yc)
    for g, b in zip(grad, c[1:]):
        if b != 0:
            assert g == pytest.approx(alpha * np.sign(b), abs=1e-7)
        else:
            assert abs(g) <= alpha + 1e-9
    sm = linear.spark_lasso(df, ["a", "b", "c"], "y", alpha)
    assert np.allclose(sm.coefficients.toArray(), c[1:], atol=1e-4)


def test_lars_path_ends_at_least_squares(spark, tiny):
    df, pdf = tiny
    X = pdf[["a", "b", "c"]].to_numpy()
    alphas, coefs = linear.lars_lasso_path(X.T @ X, X.T @ pdf.y.to_numpy(), 200)
    ls = np.linalg.lstsq(X, pdf.y, rcond=None)[0]
    assert np.allclose(coefs[-1], ls, atol=1e-8)
    assert all(np.diff(alphas) <= 1e-12)
    assert np.allclose(coefs[0], 0)


def test_cv_scores_equal_direct_refits(spark, tiny):
    df, pdf = tiny
    mom = select.fold_moments(df, ["a", "b", "c"], "y", "fold")
    got = select.cv_scores(mom, [0, 2])
    for i, f in enumerate(sorted(pdf.fold.unique())):
        tr, te = pdf[pdf.fold != f], pdf[pdf.fold == f]
        Xt = np.column_stack([np.ones(len(tr)), tr[["a", "c"]]])
        b = np.linalg.lstsq(Xt, tr.y, rcond=None)[0]
        pred = np.column_stack([np.ones(len(te)), te[["a", "c"]]]) @ b
        assert got[i] == pytest.approx(((te.y - pred) ** 2).mean(), rel=1e-9)


def test_forward_search_finds_true_features(spark, tiny):
    df, _ = tiny
    mom = select.fold_moments(df, ["a", "b", "c"], "y", "fold")
    best = select.sequential(mom, forward=True)
    assert set(best) == {1, 2, 3}
    t = select.search_table(spark, mom).where("is_best").collect()
    assert {r["method"] for r in t} == set(select.METHODS)


def test_exhaustive_best_per_size(spark, tiny):
    df, _ = tiny
    mom = select.fold_moments(df, ["a", "b", "c"], "y", "fold")
    ex = {r["k"]: r for r in select.exhaustive(spark, mom).collect()}
    assert sorted(ex) == [1, 2, 3]
    # size 3 has one subset: the full model
    assert ex[3]["avg_mse"] == pytest.approx(float(np.mean(select.cv_scores(mom, [0, 1, 2]))))
    with pytest.raises(ValueError):
        select.exhaustive(spark, mom, max_p=2)


def test_ols_model_transform_and_persist(spark, tiny, tmpdir_path):
    df, _ = tiny
    fit = linear.ols(M.moments(df, ["a", "b", "c"], "y"))
    m = linear.OLSModel.from_fit(fit, "p")
    m.write().overwrite().save(tmpdir_path + "/ols")
    m2 = linear.OLSModel.load(tmpdir_path + "/ols")
    a = m.transform(df).select("key", "p").orderBy("key").collect()
    b = m2.transform(df).select("key", "p").orderBy("key").collect()
    s = linear.spark_ols(df, ["a", "b", "c"], "y").transform(linear.assemble(df, ["a", "b", "c"]))
    c = s.select("key", "prediction").orderBy("key").collect()
    assert a == b
    assert max(abs(x["p"] - y["prediction"]) for x, y in zip(a, c)) < 1e-8


def test_ols_drops_constant_and_duplicate_columns(spark, tiny):
    df, pdf = tiny
    d2 = df.withColumn("const", F.lit(3.0)).withColumn("a_copy", F.col("a") * 2.0)
    fit, coefs, stats = linear.ols_summary(d2, ["a", "const", "b", "a_copy", "c"], "y")
    assert fit.names == ["a", "b", "c"]
    ref = linear.ols(M.moments(df, ["a", "b", "c"], "y"))
    assert np.allclose(fit.coef, ref.coef, atol=1e-9)
    flags = {r["feature"]: r["significant"] for r in coefs.collect()}
    assert flags["const"] == "aliased" and flags["a_copy"] == "aliased"


def test_lasso_of_nearly_collinear_columns(spark):
    """Coordinate descent alone creeps along the valley of two near copies; the minimum is met by
    its optimality conditions."""
    rng = np.random.default_rng(3)
    a, c = rng.normal(size=(2, 400))
    pdf = pd.DataFrame({"a": a, "b": a + 3e-4 * rng.normal(size=400), "c": c})
    pdf["y"] = 2 * pdf.a - 1.5 * pdf.b + 0.5 * pdf.c + 0.01 * rng.normal(size=400)
    mom = M.moments(spark.createDataFrame(pdf), ["a", "b", "c"], "y")
    for alpha in (1e-9, 1e-4, 0.05):
        coef = linear.lasso(mom, alpha)
        xx, xy, _, _, _, n = mom.centered()
        slope = (xy - xx @ coef[1:]) / n
        on = coef[1:] != 0
        assert np.allclose(slope[on], alpha * np.sign(coef[1:][on]), atol=1e-9) and (np.abs(slope[~on]) <= alpha + 1e-9).all()
