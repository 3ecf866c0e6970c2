"""The moment table (M0): n, sums, X'X, X'y and y'y per group in one scan.

Every linear fit, cross-validated subset score, ridge/lasso path and correlation below
is algebra on these p x p numbers, so the data is read once per question instead of once
per refit. Values are shifted by a first-pass mean before products are summed, which
keeps the sums well conditioned at any row count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import named


@dataclass
class Moments:
    names: list[str]
    groups: list  # group key per slot (None when ungrouped)
    n: np.ndarray  # (G,)
    zz: np.ndarray  # (G, p+1, p+1): shifted [1, x]' [1, x]
    zy: np.ndarray  # (G, p+1)
    yy: np.ndarray  # (G,)
    mu_x: np.ndarray  # (p,) shift of x (a data row)
    mu_y: float  # shift of y

    @property
    def p(self) -> int:
        return len(self.names)

    def total(self, exclude=None) -> "Moments":
        """Sum over groups (optionally all but the groups in ``exclude``)."""
        keep = np.array([g not in (exclude or ()) for g in self.groups])
        return Moments(self.names, [None], self.n[keep].sum(keepdims=True), self.zz[keep].sum(0, keepdims=True),
                       self.zy[keep].sum(0, keepdims=True), self.yy[keep].sum(keepdims=True), self.mu_x, self.mu_y)

    def group(self, g) -> "Moments":
        i = self.groups.index(g)
        return Moments(self.names, [g], self.n[i:i + 1], self.zz[i:i + 1], self.zy[i:i + 1], self.yy[i:i + 1],
                       self.mu_x, self.mu_y)

    def subset(self, idx: Sequence[int]) -> "Moments":
        """Restrict to feature positions ``idx`` (intercept slot kept)."""
        sel = [0] + [i + 1 for i in idx]
        return Moments([self.names[i] for i in idx], self.groups, self.n, self.zz[:, sel][:, :, sel], self.zy[:, sel],
                       self.yy, self.mu_x[list(idx)], self.mu_y)

    def _a(self) -> np.ndarray:
        a = np.eye(self.p + 1)
        a[0, 1:] = self.mu_x
        return a

    def raw(self, g: int = 0):
        """Unshifted (Z'Z, Z'y, y'y, n) with Z = [1, x] for slot ``g``."""
        a = self._a()
        zz = a.T @ self.zz[g] @ a
        zy = a.T @ (self.zy[g] + self.mu_y * self.zz[g][:, 0])
        yy = self.yy[g] + 2 * self.mu_y * self.zy[g][0] + self.n[g] * self.mu_y ** 2
        return zz, zy, yy, self.n[g]

    def centered(self, g: int = 0):
        """(Xc'Xc, Xc'yc, yc'yc, x mean, y mean, n): centred on the slot's own means."""
        n = self.n[g]
        sx, sy = self.zz[g][0, 1:], self.zy[g][0]
        xx = self.zz[g][1:, 1:] - np.outer(sx, sx) / n
        xy = self.zy[g][1:] - sx * sy / n
        yy = self.yy[g] - sy * sy / n
        return xx, xy, yy, self.mu_x + sx / n, self.mu_y + sy / n, n


# Above this many features the sums of products exceed whole-stage codegen's field limit;
# partial Gram matrices are then formed per partition with BLAS and summed by Spark.
JVM_MAX_FEATURES = 10


def _moments_partials(base: DataFrame, feats: list[str], group: str | None, mu_x: np.ndarray, mu_y: float) -> Moments:
    """Per partition (and group): n, shifted Z'Z, Z'y, y'y from Arrow batches with NumPy;
    emitted as (group, slot, value) rows and summed with a grouped aggregate, so only
    (p+1)(p+2)/2 + p + 2 numbers per group ever reach the driver."""
    p = len(feats)
    q = p + 1
    iu = np.triu_indices(q)
    n_tri = len(iu[0])
    xcols = [f"_x{i}" for i in range(p)]
    grouped = group is not None

    def partials(batches):
        acc: dict = {}
        for pdf in batches:
            keys = pdf["_g"] if grouped else None
            for g, sub in (pdf.groupby(keys, dropna=False, sort=False) if grouped else [(None, pdf)]):
                x = sub[xcols].to_numpy(dtype=np.float64) - mu_x
                y = sub["_y"].to_numpy(dtype=np.float64) - mu_y
                z = np.empty((len(sub), q))
                z[:, 0] = 1.0
                z[:, 1:] = x
                a = acc.setdefault(g, [np.zeros((q, q)), np.zeros(q), 0.0])
                a[0] += z.T @ z
                a[1] += z.T @ y
                a[2] += float(y @ y)
        for g, (zz, zy, yy) in acc.items():
            vals = np.concatenate([zz[iu], zy, [yy]])
            yield pd.DataFrame({"_g": [None if g is None else str(g)] * len(vals),
                                "slot": np.arange(len(vals), dtype=np.int32), "value": vals})

    gtype = "string"
    summed = (base.mapInPandas(partials, f"_g {gtype}, slot int, value double")
              .groupBy("_g", "slot").agg(F.sum("value").alias("value")).collect())
    by_g: dict = {}
    for r in summed:
        by_g.setdefault(r["_g"], np.zeros(n_tri + q + 1))[r["slot"]] = r["value"]
    # Recover the original group values' types from the data (few groups).
    if grouped:
        originals = {str(v): v for v in [r[0] for r in base.select("_g").distinct().collect()]}
        keys = sorted(by_g, key=lambda k: (originals.get(k) is None, originals.get(k)))
        groups = [originals.get(k) for k in keys]
    else:
        keys, groups = [None], [None]
    G = len(keys)
    zz = np.zeros((G, q, q))
    zy = np.zeros((G, q))
    yy = np.zeros(G)
    for gi, k in enumerate(keys):
        v = by_g.get(k, np.zeros(n_tri + q + 1))
        m = np.zeros((q, q))
        m[iu] = v[:n_tri]
        zz[gi] = m + np.triu(m, 1).T
        zy[gi] = v[n_tri:n_tri + q]
        yy[gi] = v[-1]
    return Moments(feats, groups, zz[:, 0, 0].copy(), zz, zy, yy, mu_x, mu_y)


def moments(df: DataFrame, features: Sequence[str], label: str, group: str | None = None,
            shift: bool = True) -> Moments:
    """Two aggregates: means (for the shift), then all sums of products per ``group``
    (partial aggregation per task, then one small shuffle)."""
    feats = list(features)
    cols = [named(c).cast("double") for c in feats]
    y = named(label).cast("double")
    base = df.select(*[c.alias(f"_x{i}") for i, c in enumerate(cols)], y.alias("_y"),
                     *([named(group).alias("_g")] if group else []))
    base = base.dropna(subset=[f"_x{i}" for i in range(len(feats))] + ["_y"])
    p = len(feats)
    if shift:
        # Shifted-data sums (Chan, Golub & LeVeque 1983): any value inside the data's
        # range keeps the sums well conditioned, so one row replaces a pass for the means.
        first = base.limit(1).collect()
        m = first[0] if first else [0.0] * (p + 1)
        mu_x = np.array([float(m[i]) for i in range(p)])
        mu_y = float(m[p])
    else:
        mu_x, mu_y = np.zeros(p), 0.0
    if p > JVM_MAX_FEATURES:
        return _moments_partials(base, feats, group, mu_x, mu_y)
    xs = [F.col(f"_x{i}") - F.lit(float(mu_x[i])) for i in range(p)]
    yv = F.col("_y") - F.lit(mu_y)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(xs[i]).alias(f"sx{i}") for i in range(p)]
    aggs += [F.sum(yv).alias("sy"), F.sum(yv * yv).alias("syy")]
    aggs += [F.sum(xs[i] * xs[j]).alias(f"sxx{i}_{j}") for i in range(p) for j in range(i, p)]
    aggs += [F.sum(xs[i] * yv).alias(f"sxy{i}") for i in range(p)]
    rows = (base.groupBy("_g") if group else base.groupBy()).agg(*aggs).collect()  # one row per group
    rows = sorted(rows, key=lambda r: (r["_g"] is None, r["_g"])) if group else rows
    G = len(rows)
    n = np.zeros(G)
    zz = np.zeros((G, p + 1, p + 1))
    zy = np.zeros((G, p + 1))
    yy = np.zeros(G)
    for g, r in enumerate(rows):
        n[g] = r["n"]
        zz[g, 0, 0] = r["n"]
        for i in range(p):
            zz[g, 0, i + 1] = zz[g, i + 1, 0] = r[f"sx{i}"]
            for j in range(i, p):
                zz[g, i + 1, j + 1] = zz[g, j + 1, i + 1] = r[f"sxx{i}_{j}"]
            zy[g, i + 1] = r[f"sxy{i}"]
        zy[g, 0] = r["sy"]
        yy[g] = r["syy"]
    groups = [r["_g"] for r in rows] if group else [None]
    return Moments(feats, groups, n, zz, zy, yy, mu_x, mu_y)


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlations of every column pair (long form: x, y, corr), pairwise
    complete, from one aggregate of ``corr`` expressions."""
    cols = list(cols)
    # Only the upper triangle is aggregated (corr is symmetric); it is mirrored after.
    uniq = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    slot = {p: f"_c{i}" for i, p in enumerate(uniq)}
    agg = df.agg(*[F.corr(named(a).cast("double"), named(b).cast("double")).alias(slot[(a, b)]) for a, b in uniq])
    structs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            c = slot[(a, b)] if i <= j else slot[(b, a)]
            structs.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), named(c).alias("corr")))
    return agg.select(F.inline(F.array(*structs)))
