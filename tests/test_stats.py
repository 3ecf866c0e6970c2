import math

import numpy as np
import pytest

from leadlens.functions import dist
from leadlens.operators import stattests


def test_shapiro_textbook_sample(spark):
    xs = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    df = spark.createDataFrame([(float(v),) for v in xs], "x double")
    r = stattests.shapiro(df, "x").first()
    assert r["w"] == pytest.approx(0.78881, abs=5e-5)
    assert r["p_value"] == pytest.approx(0.006704, abs=5e-5)
    assert r["gaussian"] is False


def test_shapiro_normal_sample_not_rejected(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(size=500)], "x double")
    r = stattests.shapiro(df, "x").first()
    assert 0.99 < r["w"] <= 1.0 and r["p_value"] > 0.01


def test_published_residual_tests():
    jb, p = stattests.jarque_bera_from(907, -0.237, 3.270)
    assert jb == pytest.approx(11.246, abs=2e-3)
    assert math.exp(-11.273 / 2) == pytest.approx(0.00356, abs=1e-5)
    k2, _ = stattests.omnibus_from(907, -0.237, 3.270)
    assert k2 == pytest.approx(10.98, abs=0.01)


def test_normality_matches_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.gamma(2.0, size=3000)
    r = stattests.normality(spark.createDataFrame([(float(v),) for v in x], "x double"), "x").first()
    m = x.mean()
    s = ((x - m) ** 3).mean() / ((x - m) ** 2).mean() ** 1.5
    k = ((x - m) ** 4).mean() / ((x - m) ** 2).mean() ** 2
    assert r["skew"] == pytest.approx(s, rel=1e-9)
    assert r["kurtosis"] == pytest.approx(k, rel=1e-9)
    assert r["omnibus"] == pytest.approx(stattests._omnibus_py(len(x), s, k), rel=1e-9)


def test_distribution_tails():
    assert dist.t_sf2(1.917, 892) == pytest.approx(0.0556, abs=1e-4)
    assert dist.f_sf(32.24, 14, 892) == pytest.approx(8.27e-70, rel=0.02)
    assert dist.t_ppf(0.95, 4) == pytest.approx(2.1318, abs=1e-4)
    assert dist.norm_ppf(0.975) == pytest.approx(1.959963985, abs=1e-9)


def test_probit_column_matches_driver(spark):
    from pyspark.sql import functions as F

    ps = [1e-10, 0.001, 0.02425, 0.3, 0.5, 0.7, 0.97575, 0.999]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r[0] for r in df.select(dist.norm_ppf_col(F.col("p"))).collect()]
    for p, g in zip(ps, got):
        assert g == pytest.approx(dist.norm_ppf(p), abs=1e-12)


def test_qq_points_plotting_positions(spark):
    df = spark.createDataFrame([(float(v),) for v in [3, 1, 2, 5, 4]], "x double")
    q = stattests.qq_points(df, "x", "s").orderBy("rank").collect()
    assert [r["sample"] for r in q] == [1, 2, 3, 4, 5]
    assert q[2]["theoretical"] == pytest.approx(0.0, abs=1e-12)
    assert q[0]["theoretical"] == pytest.approx(dist.norm_ppf(1 / 6), abs=1e-12)


def test_durbin_watson(spark):
    e = [0.5, -0.2, 0.1, 0.4, -0.3, 0.0, 0.2]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(e)], "t int, e double")
    exp = sum((e[i] - e[i - 1]) ** 2 for i in range(1, len(e))) / sum(v * v for v in e)
    assert stattests.durbin_watson(df, "e", ["t"]).first()[0] == pytest.approx(exp)


def test_shapiro_reports_the_distance_between_distributions(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=400)
    r = stattests.shapiro(spark.createDataFrame([(float(v),) for v in x], "x double"), "x").first()
    xs = np.sort(x)
    cdf = np.array([dist.norm_cdf((v - x.mean()) / x.std(ddof=1)) for v in xs])
    d = max(np.max(np.arange(1, 401) / 400 - cdf), np.max(cdf - np.arange(0, 400) / 400))
    assert r["lilliefors"] == pytest.approx(d, abs=1e-9)
    assert r["lilliefors_p_value"] > 0.01


def test_lilliefors_equals_sorted_distances_and_handles_small_tables(spark):
    rng = np.random.default_rng(7)
    x = np.sort(np.round(rng.gamma(3.0, size=400), 1))  # with ties
    z = (x - x.mean()) / x.std(ddof=1)
    f = np.array([dist.norm_cdf(v) for v in z])
    n = len(x)
    d = max(((np.arange(1, n + 1) / n) - f).max(), (f - np.arange(n) / n).max())
    frame = spark.createDataFrame([(float(v),) for v in x], "x double")
    r = stattests.lilliefors(frame, "x").first()
    assert r["n"] == n and r["lilliefors"] == pytest.approx(d, abs=1e-12)
    assert r["lilliefors_p_value"] == pytest.approx(stattests.lilliefors_p(d, n))
    assert stattests.shapiro(frame, "x").first()["lilliefors"] == pytest.approx(d, abs=1e-12)
    for rows in ([], [(1.0,)] * 9, [(None,)] * 3):
        r = stattests.lilliefors(spark.createDataFrame(rows, "x double"), "x").first()
        assert r["lilliefors"] is None and r["gaussian"] is None


def test_lilliefors_rejects_about_one_in_twenty_normal_tables_of_twenty_thousand():
    from numpy.random import default_rng

    rng, rejected, tries, n = default_rng(11), 0, 400, 20_000
    grid = np.arange(1, n + 1) / n
    cells = np.linspace(-6, 6, 200_001)
    table = np.array([dist.norm_cdf(v) for v in cells])
    for _ in range(tries):
        x = np.sort(rng.normal(size=n))
        f = np.interp((x - x.mean()) / x.std(ddof=1), cells, table)
        rejected += stattests.lilliefors_p(max((grid - f).max(), (f - grid + 1 / n).max()), n) < 0.05
    assert 0.02 * tries < rejected < 0.09 * tries


def test_published_lilliefors_quantiles():
    # 5 % and 1 % points of the modified statistic
    assert stattests.lilliefors_p(0.895 / (100 - 0.01 + 0.85 / 100), 10_000) == pytest.approx(0.05, abs=0.004)
    assert stattests.lilliefors_p(1.035 / (100 - 0.01 + 0.85 / 100), 10_000) == pytest.approx(0.01, abs=0.002)
