"""Joint-bin cube, hexagons of many pairs, and tables over many groupings."""

import math

import numpy as np
from pyspark.sql import functions as F

from leadlens.operators import bins, cube


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_projections_equal_tables_counted_one_by_one(spark):
    rng = np.random.default_rng(1)
    rows = [(float(a), float(int(b)), float(a + c), 1.0) for a, b, c in zip(rng.normal(size=500), rng.integers(0, 4, 500), rng.normal(size=500))]
    df = spark.createDataFrame(rows, "`a.x` double, b double, c double, k double")
    k = cube.BinCube.fit(df, ["a.x", "b", "c", "k"], 7)
    plain = df.toDF("a", "b", "c", "k")
    got = k.scatter([("a.x", "b"), ("c", "a.x"), ("k", "c")])
    for x, y, px, py in (("a.x", "b", "a", "b"), ("c", "a.x", "c", "a"), ("k", "c", "k", "c")):
        want = bins.hist2d(plain, px, py, nx=7, ny=7)
        assert _rows(got.where((F.col("x_col") == x) & (F.col("y_col") == y)), "bx", "by", "count") == _rows(want, "bx", "by", "count")
    for c, p in (("a.x", "a"), ("b", "b")):
        want = bins.equal_width_hist(plain, p, 7)
        mine = k.histograms().where(F.col("x_col") == c)
        assert [(r[0], round(r[1], 9), round(r[2], 9), r[3]) for r in _rows(mine, "bin", "lo", "hi", "count")] == [
            (r[0], round(r[1], 9), round(r[2], 9), r[3]) for r in _rows(want, "bin", "lo", "hi", "count")]


def test_pair_plot_is_mirrored(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([tuple(map(float, v)) for v in rng.normal(size=(200, 3))], "a double, b double, c double")
    got = {(r.x_col, r.y_col, r.bx, r.by): r["count"] for r in cube.BinCube.fit(df, ["a", "b", "c"], 5).pair_plot().collect()}
    want = {(r.x_col, r.y_col, r.bx, r.by): r["count"] for r in bins.pair_bins(df, ["a", "b", "c"], 5).collect()}
    assert got == want
    assert all(got[y, x, j, i] == n for (x, y, i, j), n in got.items() if x != y)


def test_nulls_non_finite_constant_and_empty(spark):
    nan, inf = math.nan, math.inf
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (None, 3.0, 5.0), (nan, 1.0, 5.0), (inf, 1.0, None), (3.0, None, 5.0)], "a double, b double, c double")
    k = cube.BinCube.fit(df, ["a", "b", "c"], 2)
    assert k.ranges["a"] == (1.0, 3.0)
    assert _rows(k.scatter([("a", "b")]), "bx", "by", "count") == [(0, 1, 1)]
    assert _rows(k.scatter([("a", "c")]), "bx", "by", "count") == [(0, 0, 1), (1, 0, 1)]
    assert _rows(cube.hexagons(df, [("a", "b")], 4), "x_col", "y_col", "count") == [("a", "b", 1)]
    none = df.where("a = 77")
    k = cube.BinCube.fit(none, ["a", "b"], 3)
    assert k.pair_plot().collect() == [] and k.histograms().collect() == []
    assert cube.hexagons(none, [("a", "b")]).collect() == []


def test_boxes_and_shares_of_groupings(spark):
    rng = np.random.default_rng(6)
    rows = [("ab"[int(g)], ["u", "v", None][int(h)], float(int(v))) for g, h, v in zip(rng.integers(0, 2, 300), rng.integers(0, 3, 300), rng.gamma(2, 9, 300))]
    df = spark.createDataFrame(rows, "g string, h string, v double")
    counts = cube.value_counts_by(df, {"g": F.col("g"), "h": F.col("h")}, {"v": F.col("v"), "log": F.when(F.col("v") > 0, F.ln("v"))})
    got = cube.boxes_by(counts)
    fields = ("n", "mean", "min", "q1", "median", "q3", "max", "lower_whisker", "upper_whisker", "n_outliers")
    for c in ("g", "h"):
        want = {r[c]: r for r in bins.box_stats(df, "v", [c]).collect()}
        mine = {r.level: r for r in got.where(f"grouping = '{c}' AND target = 'v'").collect()}
        assert set(mine) == set(want)
        for level, r in mine.items():
            assert all(abs(r[f] - want[level][f]) < 1e-9 for f in fields)
    shares = cube.shares_by(counts)
    sums = shares.groupBy("grouping", "level", "target").agg(F.sum("share").alias("s")).collect()
    assert len(sums) == 10 and all(abs(r.s - 1) < 1e-9 for r in sums)
    assert cube.boxes_by(counts.where("n < 0")).collect() == [] and cube.shares_by(counts.where("n < 0")).collect() == []


def test_pair_bins_leave_nulls_out(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (3.0, 1.0)], "a double, b double")
    assert _rows(bins.pair_bins(df, ["a", "b"], 2).where("x_col = 'a' AND y_col = 'b'"), "bx", "by", "count") == [(0, 1, 1), (1, 0, 1)]
