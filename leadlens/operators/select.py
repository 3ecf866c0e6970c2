"""Feature-subset search scored by k-fold cross-validated MSE of least squares.

The data is scanned once into per-fold moments; a subset's fold score is then exact
algebra: fit on the other folds' summed moments, score on the held-out fold's moments
(RSS = y'y - 2 b'Z'y + b'Z'Zb). Sequential searches (forward, backward and the floating
variants of Pudil et al. 1994) run on those p x p numbers; the exhaustive search fans the
2^p subsets out as Spark rows scored by ``mapInPandas``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dist import t_ppf
from .moments import Moments, moments


def fold_moments(df: DataFrame, features: Sequence[str], label: str, fold_col: str = "fold") -> Moments:
    return moments(df, features, label, group=fold_col)


def _fold_scores(zz: np.ndarray, zy: np.ndarray, yy: np.ndarray, n: np.ndarray, idx: Sequence[int]) -> np.ndarray:
    sel = [0] + [i + 1 for i in idx]
    zz_s = zz[:, sel][:, :, sel]
    zy_s = zy[:, sel]
    tr_zz = zz_s.sum(0) - zz_s  # training moments of each fold: all other folds
    tr_zy = zy_s.sum(0) - zy_s
    try:
        b = np.linalg.solve(tr_zz, tr_zy[..., None])[..., 0]  # all folds in one batched solve
    except np.linalg.LinAlgError:  # a column constant within some training part
        b = np.stack([np.linalg.lstsq(tr_zz[f], tr_zy[f], rcond=None)[0] for f in range(len(n))])
    rss = yy - 2 * np.einsum("fq,fq->f", b, zy_s) + np.einsum("fq,fqr,fr->f", b, zz_s, b)
    return rss / n


def cv_scores(mom: Moments, idx: Sequence[int]) -> np.ndarray:
    """Held-out MSE per fold for the features at positions ``idx``."""
    return _fold_scores(mom.zz, mom.zy, mom.yy, mom.n, idx)


def _score(mom, subset, cache):
    key = tuple(sorted(subset))
    if key not in cache:
        cache[key] = cv_scores(mom, key)
    return cache[key]


def sequential(mom: Moments, forward: bool = True, floating: bool = False, cache: dict | None = None) -> dict[int, tuple]:
    """{k: (subset tuple, fold scores)} for k = 1..p (``cache`` may be shared between
    searches over the same moments)."""
    p = mom.p
    cache = {} if cache is None else cache
    best: dict[int, tuple] = {}

    def mean(sub):
        return float(np.mean(_score(mom, sub, cache)))

    def record(sub):
        k = len(sub)
        if k and (k not in best or mean(sub) < float(np.mean(best[k][1])) - 1e-15):
            best[k] = (tuple(sorted(sub)), _score(mom, sub, cache))

    cur = set() if forward else set(range(p))
    if not forward:
        record(cur)
    while (len(cur) < p) if forward else (len(cur) > 1):
        if forward:
            j = min((f for f in range(p) if f not in cur), key=lambda f: (mean(cur | {f}), f))
            cur = cur | {j}
        else:
            j = min(cur, key=lambda f: (mean(cur - {f}), f))
            cur = cur - {j}
        record(cur)
        if floating:
            while True:
                if forward and len(cur) > 2:
                    r = min((f for f in cur if f != j), key=lambda f: (mean(cur - {f}), f))
                    cand = cur - {r}
                elif not forward and len(cur) < p - 1:
                    r = min((f for f in range(p) if f not in cur and f != j), key=lambda f: (mean(cur | {f}), f))
                    cand = cur | {r}
                else:
                    break
                k = len(cand)
                if k in best and mean(cand) < float(np.mean(best[k][1])) - 1e-15:
                    cur = cand
                    record(cur)
                else:
                    break
    return best


METHODS = {"SFS_f": (True, False), "SFS_b": (False, False), "SFFS": (True, True), "SFBS": (False, True)}


def search_table(spark: SparkSession, mom: Moments, methods: Sequence[str] = tuple(METHODS),
                 confidence: float = 0.90) -> DataFrame:
    """Per method and size k: feature set, fold scores, mean, population sd, standard
    error and the ``confidence`` half-width (t with folds-1 df), plus ``is_best`` on the
    size with the lowest mean MSE (sizes 1..p)."""
    rows = []
    cache: dict = {}
    for m in methods:
        fwd, flt = METHODS[m]
        res = sequential(mom, fwd, flt, cache)
        means = {k: float(np.mean(v[1])) for k, v in res.items()}
        kbest = min(means, key=lambda k: (means[k], k))
        for k, (sub, sc) in sorted(res.items()):
            nf = len(sc)
            sd = float(np.std(sc))
            se = sd / math.sqrt(nf - 1) if nf > 1 else math.nan
            tb = t_ppf((1 + confidence) / 2, nf - 1) if nf > 1 else math.nan
            rows.append((m, k, [mom.names[i] for i in sub], [float(x) for x in sc], means[k], sd, se, tb * se, k == kbest))
    df = spark.createDataFrame(
        rows,
        "method string, k int, features array<string>, cv_scores array<double>, avg_mse double, std_dev double, "
        "std_err double, ci_bound double, is_best boolean",
    )
    # The fold mean as an array aggregate (equal to the value used to pick is_best).
    mean = F.aggregate("cv_scores", F.lit(0.0), lambda acc, x: acc + x) / F.size("cv_scores")
    return df.withColumn("avg_mse", mean)


def consensus(table: DataFrame) -> DataFrame:
    """Union of the best subsets of each method and the feature x method membership
    matrix (1 = selected)."""
    best = table.where("is_best").select("method", F.explode("features").alias("feature"))
    methods = sorted(r[0] for r in table.select("method").distinct().collect())
    return best.groupBy("feature").pivot("method", methods).count().na.fill(0)


def exhaustive(spark: SparkSession, mom: Moments, min_features: int = 1, max_features: int | None = None,
               max_p: int = 30) -> DataFrame:
    """Every subset with min..max features, scored in parallel: subset ids are a Spark
    range, scored in Arrow batches by ``mapInPandas`` against the (p x p per fold)
    moments shipped as a broadcast. Returns (k, features, avg_mse) for the best subset of
    each size. 2^p grows fast: p above ``max_p`` is refused rather than truncated."""
    p = mom.p
    if p > max_p:
        raise ValueError(f"exhaustive search over {p} features ({2 ** p} subsets) exceeds max_p={max_p}")
    max_features = max_features or p
    bc = spark.sparkContext.broadcast((mom.zz, mom.zy, mom.yy, mom.n))

    def score(batches):
        zz, zy, yy, n = bc.value
        for b in batches:
            ids = b["id"].to_numpy()
            ks, ms = [], []
            for s in ids:
                idx = [i for i in range(p) if (int(s) >> i) & 1]
                ks.append(len(idx))
                ms.append(float(np.mean(_fold_scores(zz, zy, yy, n, idx))))
            yield pd.DataFrame({"subset_id": ids, "k": np.array(ks, dtype="int32"), "avg_mse": ms})

    # About 4,096 subsets per task, and at least one task per core.
    parts = max(spark.sparkContext.defaultParallelism, (2 ** p) // 4096)
    scored = spark.range(1, 2 ** p, numPartitions=parts).mapInPandas(score, "subset_id long, k int, avg_mse double")
    scored = scored.where((F.col("k") >= min_features) & (F.col("k") <= max_features))
    best = scored.groupBy("k").agg(F.min_by(F.struct("avg_mse", "subset_id"), F.struct("avg_mse", "subset_id")).alias("b"))
    names = "array(" + ", ".join("'" + n.replace("'", "''") + "'" for n in mom.names) + ")"
    picked = F.expr(f"transform(filter(sequence(0, {p - 1}), i -> (shiftright(b.subset_id, i) & 1) = 1), "
                    f"i -> element_at({names}, i + 1))")
    return best.select("k", picked.alias("features"), F.col("b.avg_mse").alias("avg_mse"))
