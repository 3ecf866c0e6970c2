import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadlens.operators import evaluate, score, trees
from leadlens.sources import files, jsonops
from leadlens.sources.issues import ISSUE_COLUMNS, ISSUE_SQL_TABLES, ISSUES_SQL, issues_from_tables
from tests.conftest import SF_SMALL


def test_issue_table_equals_sql_view(spark):
    for t in ISSUE_SQL_TABLES:
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").createOrReplaceTempView(t)
    a = issues_from_tables(spark, SF_SMALL)
    b = spark.sql(ISSUES_SQL)
    assert a.columns == ISSUE_COLUMNS == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    r = a.agg(F.count(F.lit(1)), F.count("resolutiondate"), F.sum("vote_count"), F.sum("watch_count")).first()
    assert tuple(r) == (1500, 1182, 1968, 4951)


def test_json_lines_lists(spark, tmpdir_path):
    lines = [{"id": 1, "transitions": []}, {"id": 2}, {"id": 3, "transitions": [{"to": "a"}, {"to": "b"}]}]
    p = tmpdir_path + "/x.json"
    with open(p, "w") as f:
        f.write("\n".join(json.dumps(x) for x in lines))
    df = files.read_json_lines(spark, p)
    ex = jsonops.explode_list(df, "transitions", ["id"], "t").orderBy("id").collect()
    assert [(r["id"], r["t"]["to"] if r["t"] else None) for r in ex] == [(1, None), (2, None), (3, "a"), (3, "b")]
    prof = jsonops.list_profile(df, "transitions").first()
    assert (prof["missing"], prof["empty"], prof["non_empty"], prof["elements"]) == (1, 1, 1, 2)


def test_canonical_json_sorts_keys(spark):
    df = spark.createDataFrame([('{"b": 1, "a": {"d": 2, "c": 3}}',)], "j string")
    flat = df.select(jsonops.canonical_json("j", pretty=False)).first()[0]
    assert flat == '{"a":{"c":3,"d":2},"b":1}'
    assert jsonops.canonical_json is not None
    keys = df.select(jsonops.top_level_keys("j")).first()[0]
    assert keys == ["b", "a"]


def test_csv_corrupt_rows_kept(spark, tmpdir_path):
    p = tmpdir_path + "/i.csv"
    with open(p, "w") as f:
        f.write(",".join(ISSUE_COLUMNS) + "\n")
        f.write("Open,Major,2020-01-01T00:00:00,Bug,r,2020-01-01T00:00:00,,1,P,,2,7,3.0,4,5,,1.0\n")
        f.write("Open,Major,2020-01-01T00:00:00,Bug,r,2020-01-01T00:00:00,,notanumber,P,,2,8,3.0,4,5,,1.0\n")
    df = files.read_issues_csv(spark, p, keep_corrupt=True).orderBy("key")
    rows = df.collect()
    assert len(rows) == 2 and rows[0]["_corrupt_record"] is None and rows[1]["_corrupt_record"] is not None


def test_metrics_and_accuracy(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (4.0, 5.0)], "y double, p double")
    m = evaluate.regression_metrics(df, "y", "p").first()
    e = np.array([-0.5, 0.5, -1.0])
    assert m["mae"] == pytest.approx(np.abs(e).mean()) and m["mse"] == pytest.approx((e ** 2).mean())
    y = np.array([1.0, 2.0, 4.0])
    assert m["r2"] == pytest.approx(1 - (e ** 2).sum() / ((y - y.mean()) ** 2).sum())
    a = evaluate.accuracy(df, "y", "p").first()
    assert a["mape"] == pytest.approx(100 * np.mean(np.abs(e) / y))


def test_trees_random_search_and_scores(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(rng.normal(size=(300, 3)), columns=["a", "b", "c"])
    pdf["y"] = (pdf.a > 0) * 2.0 + pdf.b * 0.1
    pdf["key"] = np.arange(300)
    df = spark.createDataFrame(pdf)
    t = trees.fit_tree(df, ["a", "b", "c"], "y", max_depth=5)
    imp = trees.importances(spark, t, ["a", "b", "c"]).orderBy("rank").first()
    assert imp["feature"] == "a"
    nodes = trees.tree_nodes(spark, t, ["a", "b", "c"])
    assert nodes.where("id = 0").first()["split_feature"] == "a"
    assert trees.depth_for(50) == 30 and trees.depth_for(None) == 30 and trees.depth_for(12) == 12
    cv, drawn = trees.random_search(df, ["a", "b", "c"], "y", n_iter=2, folds=2, max_trees=20, parallelism=2)
    assert len(cv.avgMetrics) == 2
    table = trees.search_table(spark, cv, drawn).collect()
    assert [r.draw for r in table] == [0, 1] and sum(r.best for r in table) == 1
    assert {d["max_depth"] for d in trees.draws(200)} == {*range(10, 111, 10), None}
    assert all(d["used_depth"] <= 30 and d["used_min_instances"] >= d["min_leaf"] for d in trees.draws(200))
    s = score.score_side_by_side(df, ["a", "b", "c"], {"tree": t})
    assert {"pred_tree", "minutes_tree", "duration_tree"} <= set(s.columns)
    rep = score.case_report(s, df.select("key", "a"), keys=[1, 2])
    assert rep.count() == 2


def test_native_canonical_json_equals_the_json_module(spark):
    import json

    values = [{}, [], {"a": [], "b": {}}, [[[[1]]]], {"q": 'a"b\\', "r": "\\\\\"{[,:]}", "s": "\n\té 😀", "t": ""}, "x", 7, None, True, [None, False, -2.5],
              {str(i): {"n": i, "l": list(range(i % 5))} for i in range(300)}, ["\\\"" * 20_000, {"deep": [{"er": "\\"}]}]]
    for _ in range(40):
        values[3] = [values[3], {"k": 1}]
    df = spark.createDataFrame([(i, json.dumps(v, ensure_ascii=i % 2 == 0)) for i, v in enumerate(values)], "i int, t string")
    got = df.select("i", jsonops.canonical_json("t").alias("p"), jsonops.canonical_json("t", indents=1).alias("one")).orderBy("i").collect()
    for r, v in zip(got, values):
        assert r.p == json.dumps(v, indent=4, sort_keys=True, ensure_ascii=False)
        assert r.one == json.dumps(v, indent=1, sort_keys=True, ensure_ascii=False)
    plan = df.select(jsonops.canonical_json("t"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_training_rows_are_dealt_out_evenly(spark):
    df = spark.range(1000).selectExpr("double(id) a", "double(id % 7) b", "double(id % 3) y").coalesce(1)
    out = trees.dealt(df, ["a", "b"], "y", rows_per_task=50)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == max(20, spark.sparkContext.defaultParallelism) and max(sizes) <= 2 * 1000 / len(sizes)
    assert sorted((*map(float, r.features), r.y) for r in out.collect()) == sorted(map(tuple, df.collect()))
    assert trees.dealt(df, ["a", "b"], "y").rdd.getNumPartitions() == 1


def test_search_keeps_the_nodes_of_its_rows(spark):
    """The same forests as without, though no pass walks the trees again."""
    from pyspark.ml.regression import RandomForestRegressor

    df = spark.range(400).selectExpr("double(hash(id) % 97) a", "double(id % 7) b", "double(hash(id, 1) % 31) y")
    cv, drawn = trees.random_search(df, ["a", "b"], "y", n_iter=2, folds=2, max_trees=10)
    assert cv.bestModel.getCacheNodeIds()
    d = drawn[max(range(2), key=lambda i: cv.avgMetrics[i])]
    plain = RandomForestRegressor(labelCol="y", seed=0, numTrees=d["trees"], featureSubsetStrategy=d["subset"], maxDepth=d["used_depth"],
                                  minInstancesPerNode=d["used_min_instances"], bootstrap=d["bootstrap"])
    assert plain.fit(trees.dealt(df, ["a", "b"], "y")).toDebugString.split("\n")[1:] == cv.bestModel.toDebugString.split("\n")[1:]


def test_only_the_models_asked_for_are_fitted(spark, monkeypatch):
    from leadlens.plans import q_model, shared

    shared.forget()
    monkeypatch.setattr(trees, "fit_forest", lambda *a, **k: pytest.fail("the forest is not asked for"))
    assert q_model.tree_importances(spark, SF_SMALL).where("rank = 1").count() == 1
    shared.forget()


def test_shuffles_grow_with_the_table(spark):
    from leadlens.session import shuffles_for

    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(k, None) for k in keys]
    with shuffles_for(spark, 100):
        assert [spark.conf.get(k, None) for k in keys] == before
    with pytest.raises(KeyError), shuffles_for(spark, 10**6, rows_per_task=1000):
        assert [spark.conf.get(k) for k in keys] == ["1000", "16m"]
        raise KeyError
    assert [spark.conf.get(k, None) for k in keys] == before


def test_serving_columns_of_all_open_issues(spark):
    """No level that any open issue has is missing from the serving side."""
    from leadlens.operators import clean
    from leadlens.plans import q_more
    from leadlens.sources.issues import issues

    _, op = clean.split_labelled(issues(spark, SF_SMALL))
    missing = {r.feature for r in q_more.serving_missing_columns(spark, SF_SMALL).collect()}
    assert not missing & {f"{c}_{r[0]}" for c in ("priority", "reporter") for r in op.select(c).distinct().collect()}
