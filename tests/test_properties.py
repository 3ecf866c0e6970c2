"""Property tests: distributed ranks and exact quantiles equal pandas/NumPy for random
data, group layouts (including a dominant group and NULL keys) and partition counts."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from leadlens.operators.ordering import exact_quantiles, rank_rows

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def _frame(seed, n, n_groups, hot_share, parts, spark):
    rng = np.random.default_rng(seed)
    groups = [f"g{i}" for i in range(n_groups)] + [None]
    g = np.where(rng.random(n) < hot_share, "hot", rng.choice(np.array(groups, dtype=object), size=n))
    x = np.round(rng.normal(size=n) * 10, 1)  # ties
    pdf = pd.DataFrame({"g": g, "x": x, "k": np.arange(n)})
    return spark.createDataFrame(pdf).repartition(parts), pdf


@SETTINGS
@given(seed=st.integers(0, 10_000), n=st.integers(1, 600), n_groups=st.integers(1, 6),
       hot=st.sampled_from([0.0, 0.34, 0.9]), parts=st.integers(1, 9))
def test_rank_rows_property(spark, seed, n, n_groups, hot, parts):
    df, pdf = _frame(seed, n, n_groups, hot, parts, spark)
    out = rank_rows(df, ["x", "k"], by=["g"], rank_col="r").toPandas().sort_values("k")
    exp = pdf.sort_values(["g", "x", "k"]).groupby("g", dropna=False).cumcount().sort_index()
    assert (out["r"].to_numpy() == exp.to_numpy()).all()


@SETTINGS
@given(seed=st.integers(0, 10_000), n=st.integers(1, 600), n_groups=st.integers(1, 6),
       hot=st.sampled_from([0.0, 0.34, 0.9]), parts=st.integers(1, 9),
       p=st.floats(0.0, 1.0, allow_nan=False))
def test_exact_quantiles_property(spark, seed, n, n_groups, hot, parts, p):
    df, pdf = _frame(seed, n, n_groups, hot, parts, spark)
    got = exact_quantiles(df, "x", [p], by=["g"], names=["q"]).toPandas()
    for _, row in got.iterrows():
        vals = pdf.loc[pdf["g"].isna() if row["g"] is None else pdf["g"] == row["g"], "x"].to_numpy()
        assert row["n"] == len(vals)
        assert row["q"] == pytest.approx(np.quantile(vals, p), abs=1e-9)
