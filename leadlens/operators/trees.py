"""Regression trees and forests (Spark ML), importances, node tables, random search."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, cleanup_at_exit, scratch_path
from .linear import assemble

MLLIB_MAX_DEPTH = 30
ROWS_PER_TASK = 500_000  # of the frame that MLlib holds binned, at about 0.6 KB a row of 100 bagged trees


def dealt(df: DataFrame, features: Sequence[str], label: str, rows_per_task: int | None = None) -> DataFrame:
    """(features, label) of ``df``; where there are more rows than ``rows_per_task``, dealt out evenly to
    as many tasks as they need, at least one a core: MLlib passes over its input's partitions many
    times, and a narrow Parquet file of one row group is one partition however many rows it has."""
    out = assemble(df, features).select("features", label)
    wanted = -(-df.count() // (rows_per_task or ROWS_PER_TASK))
    return out if wanted <= 1 else out.repartition(max(wanted, df.sparkSession.sparkContext.defaultParallelism))


def depth_for(max_depth: int | None) -> int:
    """The requested depth, at most 30 (MLlib's own limit); None means that limit. MLlib has no
    cap on leaves: pruning to a leaf count is not offered."""
    return max(1, min(MLLIB_MAX_DEPTH if max_depth is None else max_depth, MLLIB_MAX_DEPTH))


def fit_tree(df: DataFrame, features: Sequence[str], label: str, max_depth: int = 5,
             seed: int = 0):
    dt = DecisionTreeRegressor(featuresCol="features", labelCol=label, maxDepth=depth_for(max_depth), seed=seed)
    return dt.fit(dealt(df, features, label))


def fit_forest(df: DataFrame, features: Sequence[str], label: str, num_trees: int = 100, max_depth: int | None = 50,
               subset: str = "all", seed: int = 0, bootstrap: bool = True,
               min_instances: int = 1, max_memory_mb: int = 1024):
    """Forest of depth-limited trees; ``max_memory_mb`` is the per-iteration node
    statistics budget (larger = more nodes split per pass over the data = fewer passes)."""
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees,
                               maxDepth=depth_for(max_depth), featureSubsetStrategy=subset, seed=seed,
                               bootstrap=bootstrap, minInstancesPerNode=min_instances, maxMemoryInMB=max_memory_mb)
    return rf.fit(dealt(df, features, label))


def importances(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """(feature, importance, rank) with rank 1 = most important (ties by name)."""
    imp = model.featureImportances.toArray()
    rows = sorted(((f, float(v)) for f, v in zip(features, imp)), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame([(f, v, i + 1) for i, (f, v) in enumerate(rows)], "feature string, importance double, rank int")


def tree_nodes(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """Node table of a fitted tree read from the saved model's node data: id, prediction,
    impurity, gain, children, split feature name and threshold (the content of a .dot export)."""
    path = scratch_path(spark, f"tree-{model.uid}")
    model.write().overwrite().save(path)
    cleanup_at_exit(spark, path)
    nodes = spark.read.parquet(f"{path}/data")
    names = F.array(*[F.lit(f) for f in features])
    return nodes.select(
        F.col("id").cast("int").alias("id"),
        "prediction",
        "impurity",
        "gain",
        F.col("leftChild").cast("int").alias("left_child"),
        F.col("rightChild").cast("int").alias("right_child"),
        F.when(F.col("split.featureIndex") >= 0, F.element_at(names, F.col("split.featureIndex") + 1)).alias("split_feature"),
        F.when(F.col("leftChild") >= 0, F.element_at(F.col("split.leftCategoriesOrThreshold"), 1)).alias("threshold"),
    )


def draws(n_iter: int = 100, seed: int = 0, max_trees: int = 1000) -> list[dict]:
    """Seeded draws from the forest grid: trees 10..max_trees in 100 steps, 'all' or 'sqrt'
    features, depth 10..110 step 10 or none, least rows to split a node 2/5/10, least rows of a
    leaf 1/2/4, with or without bootstrap.

    What MLlib has no parameter for is stated, not dropped: ``used_depth`` is the depth within its
    limit of 30, and ``used_min_instances`` the least rows of a child that keeps every node below
    ``min_split`` whole (a child of at least half of them)."""
    rng = random.Random(seed)
    trees = sorted({int(round(10 + i * (max_trees - 10) / 99)) for i in range(100)})
    out = []
    for i in range(n_iter):
        d = {"draw": i, "trees": rng.choice(trees), "subset": rng.choice(["all", "sqrt"]),
             "max_depth": rng.choice([*range(10, 111, 10), None]), "min_split": rng.choice([2, 5, 10]),
             "min_leaf": rng.choice([1, 2, 4]), "bootstrap": rng.choice([True, False])}
        out.append(d | {"used_depth": depth_for(d["max_depth"]), "used_min_instances": max(d["min_leaf"], -(-d["min_split"] // 2))})
    return out


def random_search(df: DataFrame, features: Sequence[str], label: str, n_iter: int = 100, folds: int = 3,
                  seed: int = 0, parallelism: int = 4, max_trees: int = 1000):
    """Randomised hyper-parameter search scored by cross-validated R^2: (fitted CrossValidator
    model, its draws).

    Draws go as deep as MLlib can. The rows keep the node they have reached (checkpointed every ten
    passes), as else every pass sends all trees grown so far to every task and walks them again."""
    checkpoint_root(df.sparkSession)
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, seed=seed, cacheNodeIds=True, checkpointInterval=10)
    drawn = draws(n_iter, seed, max_trees)
    maps = [{rf.numTrees: d["trees"], rf.featureSubsetStrategy: d["subset"], rf.maxDepth: d["used_depth"],
             rf.minInstancesPerNode: d["used_min_instances"], rf.bootstrap: d["bootstrap"]} for d in drawn]
    cv = CrossValidator(estimator=rf, estimatorParamMaps=maps, evaluator=RegressionEvaluator(labelCol=label, metricName="r2"),
                        numFolds=folds, parallelism=parallelism, seed=seed)
    return cv.fit(dealt(df, features, label)), drawn


def search_table(spark: SparkSession, model, drawn: list[dict]) -> DataFrame:
    """One row per draw: its parameters, mean R^2 over the folds, and whether it is the best."""
    best = max(range(len(drawn)), key=lambda i: model.avgMetrics[i])
    rows = [(*d.values(), float(model.avgMetrics[i]), i == best) for i, d in enumerate(drawn)]
    return spark.createDataFrame(rows, "draw int, trees int, subset string, max_depth int, min_split int, min_leaf int, bootstrap boolean, "
                                       "used_depth int, used_min_instances int, mean_r2 double, best boolean")
