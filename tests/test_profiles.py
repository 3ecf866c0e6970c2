import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.operators import bins, crosstab, profile, score


@pytest.fixture(scope="module")
def small(spark):
    rows = [("a", "x", float(v)) for v in [1, 2, 2, 3, 50]] + [("b", "y", float(v)) for v in [10, 11, 12]] + \
           [(None, "x", 7.0), ("a", None, None)]
    return spark.createDataFrame(rows, "g string, h string, v double")


def test_box_outliers_by_group(spark, small):
    out = bins.box_outliers(small, "v", ["g"], keep=["h"]).collect()
    assert [(r["g"], r["v"]) for r in out] == [("a", 50.0)]


def test_box_stats_null_group_and_counts(spark, small):
    st = {r["g"]: r for r in bins.box_stats(small, "v", ["g"]).collect()}
    assert st[None]["n"] == 1 and st[None]["median"] == 7.0
    assert st["a"]["n"] == 5 and st["a"]["n_outliers"] == 1 and st["a"]["upper_whisker"] == 3.0
    assert st["b"]["mean"] == pytest.approx(11.0)


def test_crosstab_wide_orders_columns_by_total(spark, small):
    pairs = crosstab.pair_counts(small, "g", "h")
    wide = crosstab.crosstab_wide(pairs, "g", "h")
    assert wide.columns == ["g", "x", "y"]  # x total 5 > y total 3
    got = {r["g"]: (r["x"], r["y"]) for r in wide.collect()}
    assert got == {"a": (5, 0), "b": (0, 3)}


def test_equal_width_hist_by_group(spark, small):
    h = bins.equal_width_hist(small, "v", 2, by=["g"]).where("g = 'b'").orderBy("bin").collect()
    assert [(r["bin"], r["count"]) for r in h] == [(0, 1), (1, 2)]  # 10 | 11, 12 (max in last bin)
    assert h[0]["lo"] == 10.0 and h[1]["hi"] == 12.0


def test_shares_and_stack_base(spark, small):
    sh = profile.shares(small, {"A": F.col("g") == "a", "B": F.col("g") == "b"}, chart="c").orderBy("position").collect()
    assert [(r["segment"], r["count"], r["base"]) for r in sh] == [("A", 6, 0), ("B", 3, 6)]
    assert sh[0]["share"] == pytest.approx(6 / 9)


def test_case_report_top_disagreement(spark):
    s = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, 5.0), (3, 2.0, 2.0)], "key int, pred_m1 double, pred_m2 double")
    raw = spark.createDataFrame([(1, "p"), (2, "q"), (3, "r")], "key int, f string")
    top = score.case_report(s, raw, top=2, models=["m1", "m2"]).collect()
    assert [r["key"] for r in top] == [2, 1]


def test_table_profile_and_null_profile(spark, small):
    tp = {r["column"]: r for r in profile.table_profile(small).collect()}
    assert tp["v"]["non_null"] == 9 and tp["v"]["nulls"] == 1 and tp["g"]["spark_type"] == "string"
    npf = {r["column"]: r["has_nulls"] for r in profile.null_profile(small).collect()}
    assert npf == {"g": True, "h": True, "v": True}


def test_value_counts_ties_ordered_by_value_nulls_dropped(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", None, None, None]], "s string")
    rows = profile.value_counts(df, "s").collect()
    assert [(r["s"], r["count"]) for r in rows] == [("c", 2), ("a", 1), ("b", 1)]


def test_pair_counts_ties_and_null_keys(spark):
    df = spark.createDataFrame([("x", "b"), ("x", "a"), ("y", "a"), (None, "a"), ("x", None)], "p string, q string")
    rows = crosstab.pair_counts(df, "p", "q", top=2).collect()
    assert [(r["p"], r["q"], r["n"]) for r in rows] == [("x", "a", 1), ("x", "b", 1)]


def test_not_fixed_keeps_null_resolution(spark):
    from leadlens.plans.q_profile import closure_rules

    df = spark.createDataFrame([("Closed", "Fixed", "u"), ("Closed", None, None), ("Closed", "Invalid", "u"),
                                ("Resolved", None, "u")], "status string, resolution string, assignee string")
    df = df.withColumn("resolutiondate", F.current_timestamp()).withColumn("created", F.current_timestamp())
    got = {r["subset"]: r["count"] for r in profile.subset_counts(df, closure_rules()).collect()}
    assert got["closed_not_fixed"] == 2 and got["resolved_not_fixed"] == 1  # NULL counts as not Fixed
    assert df.where(F.col("resolution") != "Fixed").count() == 1  # plain != would lose the NULL rows


def test_box_stats_approx_close_to_exact(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(("a", "b")[i % 2], float(v)) for i, v in enumerate(rng.normal(size=4000))], "g string, x double")
    ex = {r["g"]: r for r in bins.box_stats(df, "x", ["g"]).collect()}
    ap = {r["g"]: r for r in bins.box_stats(df, "x", ["g"], approx_accuracy=10000).collect()}
    for g in "ab":
        assert ap[g]["n"] == ex[g]["n"]
        assert abs(ap[g]["median"] - ex[g]["median"]) < 0.01
        assert ap[g]["max"] == ex[g]["max"]
