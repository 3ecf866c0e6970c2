import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadlens.operators.ordering import exact_quantiles, rank_rows, row_numbers


def _df(spark, n=2000, seed=1, hot=True):
    rng = np.random.default_rng(seed)
    g = rng.choice(["a", "b", "c", None], size=n, p=[0.2, 0.2, 0.2, 0.4]) if not hot else np.where(
        rng.random(n) < 0.34, "hot", rng.choice(["a", "b", "c"], size=n))
    x = rng.integers(0, 50, size=n).astype(float)  # many ties
    pdf = pd.DataFrame({"g": g, "x": x, "k": np.arange(n)})
    return spark.createDataFrame(pdf), pdf


def test_rank_rows_matches_pandas_with_ties_and_hot_group(spark):
    df, pdf = _df(spark)
    out = rank_rows(df, ["x", "k"], by=["g"], rank_col="r", size_col="n").toPandas().sort_values("k")
    exp = pdf.sort_values(["g", "x", "k"]).groupby("g", dropna=False).cumcount().sort_index()
    assert (out["r"].to_numpy() == exp.to_numpy()).all()
    sizes = pdf.groupby("g", dropna=False)["k"].transform("size")
    assert (out["n"].to_numpy() == sizes.to_numpy()).all()


def test_rank_rows_null_group_kept(spark):
    df, pdf = _df(spark, hot=False)
    out = rank_rows(df, ["x", "k"], by=["g"], rank_col="r")
    assert out.count() == len(pdf)
    assert out.where(F.col("g").isNull()).agg(F.max("r")).first()[0] == pdf["g"].isna().sum() - 1


def test_row_numbers_global_and_partition_invariant(spark):
    df, pdf = _df(spark)
    a = row_numbers(df.repartition(1), ["x", "k"]).toPandas().sort_values("k")["row_number"].to_numpy()
    b = row_numbers(df.repartition(7), ["x", "k"]).toPandas().sort_values("k")["row_number"].to_numpy()
    exp = pdf.sort_values(["x", "k"]).assign(rn=np.arange(1, len(pdf) + 1)).sort_values("k")["rn"].to_numpy()
    assert (a == exp).all() and (b == exp).all()


@pytest.mark.parametrize("probs", [[0.25, 0.5, 0.75], [0.0, 1.0, 0.1]])
def test_exact_quantiles_equal_numpy_linear(spark, probs):
    df, pdf = _df(spark)
    q = exact_quantiles(df, "x", probs, by=["g"], names=[f"p{i}" for i in range(len(probs))]).toPandas()
    for _, row in q.iterrows():
        vals = pdf.loc[pdf["g"] == row["g"], "x"].to_numpy()
        for i, p in enumerate(probs):
            assert row[f"p{i}"] == pytest.approx(np.quantile(vals, p), abs=1e-12)


def test_exact_quantiles_single_value_and_empty(spark):
    one = spark.createDataFrame([(5.0,)], "x double")
    assert exact_quantiles(one, "x", [0.5]).first()["q50"] == 5.0
    empty = spark.createDataFrame([], "x double")
    r = exact_quantiles(empty, "x", [0.5]).collect()  # one row, as a global SQL aggregate
    assert len(r) == 1 and r[0]["n"] == 0 and r[0]["q50"] is None


def test_cumulative_weights_hot_group(spark):
    from leadlens.operators.ordering import cumulative_weights

    df, pdf = _df(spark)
    counts = df.groupBy("g", "x").count()
    out = cumulative_weights(counts, ["x"], "count", ["g"], total_col="tot").toPandas()
    cp = pdf.groupby(["g", "x"], dropna=False).size().rename("count").reset_index().sort_values(["g", "x"])
    cp["exp"] = cp.groupby("g", dropna=False)["count"].cumsum() - cp["count"]
    m = out.merge(cp, on=["g", "x"])
    assert len(m) == len(cp) and (m["cum_before"] == m["exp"]).all()


def test_rank_rows_splits_a_hot_tied_value(spark):
    from pyspark.sql import functions as F

    # 3000 rows share one value: ranks stay correct and the tie spans several partitions.
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("x"))
    r = rank_rows(df, ["x"], rank_col="r", size_col="n").toPandas().sort_values("r")
    assert list(r["r"]) == list(range(9000)) and (r["n"] == 9000).all()
    assert list(r["x"]) == sorted(r["x"])


def test_tied_ranks_are_the_same_on_other_partitions(spark):
    df, _ = _df(spark)
    tied = df.select("g", "x", (F.col("k") % 7).alias("m"))  # ties, and rows equal in all columns
    runs = [sorted(tuple(r) for r in rank_rows(tied.repartition(n, *by), ["x"], by=["g"], rank_col="r").collect())
            for n, by in ((1, []), (5, ["m"]), (13, ["x", "m"]))]
    assert runs[0] == runs[1] == runs[2]
