"""Empty table, one row, constant and all-null columns (ANSI mode on: no division errors)."""

import math

import pytest
from pyspark.sql import functions as F

from leadlens.operators import bins, evaluate, profile, stattests


@pytest.fixture(scope="module")
def const(spark):
    return spark.createDataFrame([(i, 5.0, None) for i in range(10)], "k int, x double, z double")


def test_constant_column_tests(spark, const):
    r = stattests.normality(const, "x").first()
    assert r["n"] == 10 and r["omnibus"] is None or math.isnan(r["omnibus"])
    assert stattests.shapiro(const, "x").first()["w"] is None
    q = stattests.qq_points(const, "x", "45").collect()
    assert len(q) == 10 and all(row["sample"] is None for row in q)
    assert stattests.durbin_watson(const.withColumn("e", F.lit(0.0)), "e", ["k"]).first()[0] is None


def test_profiles_on_empty_one_row_and_all_null(spark, const):
    empty = spark.createDataFrame([], "g string, x double")
    assert bins.box_stats(empty, "x").first()["n"] == 0
    assert bins.box_stats(empty, "x", ["g"]).count() == 0
    one = spark.createDataFrame([("a", 3.0)], "g string, x double")
    b = bins.box_stats(one, "x").first()
    assert (b["q1"], b["median"], b["q3"], b["n_outliers"]) == (3.0, 3.0, 3.0, 0)
    d = {r["column"]: r for r in profile.describe(const, ["x", "z"]).collect()}
    assert d["z"]["count"] == 0 and d["z"]["mean"] is None
    assert d["x"]["std"] == 0.0 and d["x"]["p50"] == 5.0
    sh = profile.shares(empty, {"A": F.col("g") == "a"}).first()
    assert sh["count"] == 0 and sh["share"] is None


def test_metrics_constant_target(spark, const):
    m = evaluate.regression_metrics(const.withColumn("p", F.lit(5.0)), "x", "p").first()
    assert m["mse"] == 0.0 and m["r2"] is None
