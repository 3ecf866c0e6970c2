import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from leadlens.operators import encode
from leadlens.operators.blocked import BlockedMoments
from leadlens.operators.levels import SparseDesign, frequent_levels, keep_levels
from leadlens.plans import queries
from leadlens.session import write_and_read
from tests.conftest import SF_SMALL

ROWS = [(1, "a", "x", 2.0), (2, "b", "y", 0.0), (3, None, "y", 1.0), (4, "c", "zz", None), (5, "it's", "y", 3.0)]
SCHEMA = "_slot int, `p.q` string, `r``s` string, n double"


def entries(df):
    return {r[0]: dict(zip(r["indices"], r["values"])) for r in df.collect()}


def test_sparse_design_of_odd_names_nulls_rare_and_unseen_levels(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    d = SparseDesign.fit(df, ["n"], ["p.q", "r`s"], {"r`s": 1})
    names = {r.slot: r.feature for r in d.features().collect()}
    assert names == {0: "n", 1: "p.q_b", 2: "p.q_c", 3: "p.q_it's", 4: "r`s_y"} and d.width == 5
    assert {(r.column, r.level, r.n) for r in d.table.collect()} >= {("r`s", "Other", 2), ("r`s", "y", 3), ("p.q", "a", 1)}
    assert entries(d.rows(df, ["_slot"])) == {1: {0: 2.0}, 2: {1: 1.0, 4: 1.0}, 3: {0: 1.0, 4: 1.0}, 4: {2: 1.0}, 5: {0: 3.0, 3: 1.0, 4: 1.0}}
    new = spark.createDataFrame([(7, "new", "new", 1.0), (8, None, None, None), (9, "c", "y", 4.0)], SCHEMA)
    assert entries(d.rows(new, ["_slot"])) == {7: {0: 1.0}, 8: {}, 9: {0: 4.0, 2: 1.0, 4: 1.0}}
    # where Other is not the first level, rare, null and unseen values have its entry
    d = SparseDesign.fit(df, [], ["r`s"], {"r`s": 1}, other="zz-other")
    assert entries(d.rows(new, ["_slot"])) == {7: {0: 1.0}, 8: {0: 1.0}, 9: {}}
    assert SparseDesign.fit(df, [], ["r`s"], drop_first=False).width == 3
    empty = SparseDesign.fit(df.limit(0), ["n"], ["p.q"])
    assert empty.width == 1 and entries(empty.rows(df, ["_slot"]))[1] == {0: 2.0}


def test_sparse_design_persists_and_feeds_spark_ml(spark, tmpdir_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    d = SparseDesign.fit(df, ["n"], ["p.q", "r`s"], {"r`s": 1})
    d.save(tmpdir_path + "/d")
    again = SparseDesign.load(spark, tmpdir_path + "/d")
    assert entries(again.rows(df, ["_slot"])) == entries(d.rows(df, ["_slot"])) and again.width == d.width
    v = again.vectors(df, ["_slot"])
    assert {r[0]: r.features.toArray().tolist() for r in v.collect()}[5] == [3.0, 0.0, 0.0, 1.0, 1.0]
    assert LinearRegression(labelCol="_slot", regParam=0.1).fit(v).numFeatures == 5


def test_a_hundred_thousand_levels(spark):
    """No level on the driver, in the schema or in a plan."""
    df = spark.range(400_000).select("id", F.concat(F.lit("level "), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 100_000)).alias("c"), (F.col("id") % 7).alias("n"))
    d = SparseDesign.fit(df, ["n"], ["c"], {"c": 1})
    assert d.width > 66_000 and d.table.count() == d.width
    rows = d.rows(df, ["id"])
    assert len(rows._jdf.queryExecution().toString()) < 50_000
    assert rows.agg(F.sum(F.size("indices"))).first()[0] > 400_000
    model = encode.RareLevels(inputCol="c", minCount=1).fit(df)
    out = model.transform(df)
    assert "IN (" not in out._jdf.queryExecution().optimizedPlan().toString().upper()
    assert out.select("c").distinct().count() == model.levels().count()


def test_no_literal_list_in_the_plan_of_rare_levels(spark):
    plan = queries()["rare_customer_levels"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Customer#" not in plan and " IN " not in plan and "InSet" not in plan


def test_keep_levels_null_handling(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "`_level` string")
    kept = write_and_read(frequent_levels(df, "_level", 1), "t")
    assert sorted(map(str, (r[0] for r in keep_levels(df, "_level", kept, "O").collect()))) == ["O", "O", "a", "a"]
    assert sorted(map(str, (r[0] for r in keep_levels(df, "_level", kept, "O", False).collect()))) == ["None", "O", "a", "a"]


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(4)
    n, p = 6000, 2000
    rows, x = [], np.zeros((n, p))
    for r in range(n):
        at = np.unique(np.append(rng.integers(0, p, 6), r % p))
        x[r, at] = np.round(rng.normal(1, 1, len(at)), 3)
        rows.append((at.tolist(), x[r, at].tolist()))
    y = x @ rng.normal(0, 1, p) + 3 + rng.normal(0, 0.1, n)
    df = spark.createDataFrame([(i, v, float(t)) for (i, v), t in zip(rows, y)] + [([0], [1.0], None)], "indices array<int>, values array<double>, y double")
    return np.column_stack([np.ones(n), x]), y, BlockedMoments.of(df.repartition(4), p, "y", block=300)


def test_two_thousand_columns_equal_the_dense_table(spark, wide):
    z, y, m = wide
    dense = np.zeros((m.width, m.width))
    for r in m.cells().collect():
        dense[r.i, r.j] = dense[r.j, r.i] = r.v
    assert np.allclose(dense, z.T @ z, atol=1e-8) and np.allclose(m.xy, z.T @ y) and m.n == len(y) and np.isclose(m.yy, y @ y)
    assert m.blocks.count() == 28  # 7 x 7 blocks, upper triangle
    x = np.random.default_rng(5).normal(size=m.width)
    assert np.allclose(m.times(x), z.T @ (z @ x))


def test_conjugate_gradients_equal_direct_solutions(spark, wide):
    z, y, m = wide
    penalty = np.diag([0.0] + [2.0] * (m.width - 1))
    assert np.allclose(m.solve(2.0, 1e-10), np.linalg.solve(z.T @ z + penalty, z.T @ y), atol=1e-6)
    b = m.solve(0.0, 1e-9)
    assert np.isclose(m.rss(b), np.sum((y - z @ np.linalg.lstsq(z, y, rcond=None)[0]) ** 2), rtol=1e-5)
    with pytest.raises(RuntimeError):
        m.solve(0.0, 1e-12, most=2)


def test_blocked_moments_of_degenerate_tables(spark):
    schema = "indices array<int>, values array<double>, y double"
    m = BlockedMoments.of(spark.createDataFrame([], schema), 3, "y")
    assert m.n == 0 and m.solve().tolist() == [0.0] * 4
    # a column of zeros and two equal columns
    m = BlockedMoments.of(spark.createDataFrame([([1, 2], [v, v], 2 * v + 1) for v in (1.0, 2.0, 4.0)], schema), 3, "y")
    b = m.solve()
    assert np.allclose([b[0], b[1], b[2] + b[3]], [1.0, 0.0, 2.0], atol=1e-6)
