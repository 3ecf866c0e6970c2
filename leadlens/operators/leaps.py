"""Best subset of every size by residual sum of squares, over all columns: leaps and bounds.

Taking columns away never lowers the residual sum of squares, so a set whose sum is already above
the best known one of each size below it can be left with everything under it (Furnival and Wilson
1974). A node of the tree is a set of columns, some of them fixed; its free columns are ordered by
what their removal costs, which keeps the large subtrees where the bound is high. All sums come
from the moment table. Open nodes are rows: in a round a task walks its share of them for a bounded
number of steps, starting from the best sums found so far, and hands back what is left, which the
next round deals out again. Per size the exact best subset results; its cross-validated score is
computed beside it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import write_and_read
from .moments import Moments
from .select import cv_scores

#: Nodes opened before any are dealt out; nodes that a task opens in a round; open nodes that a task
#: gets on average.
FIRST, STEPS, SHARE = 50, 20_000, 8
_ROWS = "fixed array<int>, free array<int>, k int, rss double, subset array<int>"


class Tree:
    """Sums of subsets of the columns of X'X (centred, scaled to a unit diagonal), X'y, y'y."""

    def __init__(self, xx: np.ndarray, xy: np.ndarray, yy: float):
        self.xx, self.xy, self.yy = xx, xy, yy

    def fit(self, columns: list[int]) -> tuple[float, np.ndarray]:
        """(sum of squares, what removing each column adds) for a set."""
        if not columns:
            return self.yy, np.empty(0)
        inverse = np.linalg.inv(self.xx[np.ix_(columns, columns)])
        b = inverse @ self.xy[columns]
        return float(self.yy - b @ self.xy[columns]), b * b / np.diag(inverse)

    def walk(self, node: tuple[list[int], list[int]], best: np.ndarray, subsets: list, steps: int) -> list[tuple[list[int], list[int]]]:
        """Search below ``node`` (fixed, free), improving ``best`` (by size) and ``subsets``; returns
        the nodes left open after ``steps``."""
        stack = [node]
        while stack and steps:
            steps -= 1
            fixed, free = stack.pop()
            columns = fixed + free
            rss, added = self.fit(columns)
            if rss < best[len(columns)]:
                best[len(columns)], subsets[len(columns)] = rss, sorted(columns)
            added = np.maximum(added[len(fixed):], 0.0)
            order = np.argsort(-added, kind="stable")
            free = [free[i] for i in order]
            below = []
            for i, c in enumerate(free):
                # without c: the columns before it stay, those behind it may go too
                least, size = rss + added[order[i]], len(columns) - 1
                if least < best[size]:
                    best[size], subsets[size] = least, sorted(fixed + free[:i] + free[i + 1:])
                if i + 1 < len(free) and least < best[len(fixed) + i:size].max():
                    below.append((fixed + free[:i], free[i + 1:]))
            stack += below  # the last, smallest subtree first: good sums are found early
        return [(f, r) for f, r in stack if self.fit(f + r)[0] < best[len(f):len(f) + len(r)].max()]


def independent(mom: Moments, tolerance: float = 1e-10) -> list[int]:
    """Positions of the columns that are no linear combination of those before them."""
    xx = mom.total().centered()[0]
    scale = np.sqrt(np.maximum(np.diag(xx), 0))
    keep, rows = [], []
    for j in range(mom.p):
        if scale[j] == 0:
            continue
        v = xx[j, keep] / scale[j] / scale[keep] if keep else np.empty(0)
        low = np.linalg.solve(np.array(rows), v) if keep else np.empty(0)
        rest = 1 - low @ low
        if rest > tolerance:
            rows = [np.append(r, 0.0) for r in rows] + [np.append(low, np.sqrt(rest))]
            keep.append(j)
    return keep


def best_subsets(spark: SparkSession, mom: Moments, max_rounds: int = 100) -> DataFrame:
    """(k, features, rss, avg_mse, cv_scores, is_best): for k = 1..p the subset of smallest residual
    sum of squares over all rows, with its held-out MSE in each fold of ``mom``; ``is_best`` marks
    the size of smallest mean MSE. Columns that others make up are left out. Raises if the search is
    not finished after ``max_rounds``."""
    keep = independent(mom)
    xx, xy, yy, *_ = mom.total().centered()
    scale = np.sqrt(np.diag(xx)[keep])
    tree = Tree(xx[np.ix_(keep, keep)] / np.outer(scale, scale), xy[keep] / scale, yy)
    p = len(keep)
    best, subsets = np.full(p + 1, np.inf), [None] * (p + 1)
    best[0], subsets[0] = yy, []
    # first sums: the path of least costly removals, and the tree's first nodes
    path = list(range(p))
    while path:
        rss, added = tree.fit(path)
        best[len(path)], subsets[len(path)] = rss, sorted(path)
        path.pop(int(np.argmin(added)))
    opened = tree.walk(([], list(range(p))), best, subsets, FIRST)
    nodes, count = spark.createDataFrame(opened, "fixed array<int>, free array<int>"), len(opened)
    for _ in range(max_rounds):
        if not count:
            break
        tasks = max(spark.sparkContext.defaultParallelism, count // SHARE)
        shared = spark.sparkContext.broadcast((tree, best, subsets))  # p x p numbers

        def search(batches):
            tree, best, subsets = shared.value
            best, subsets, left, steps = best.copy(), list(subsets), [], STEPS
            known = best.copy()
            for b in batches:
                for fixed, free in zip(b["fixed"], b["free"]):
                    each = max(1, steps // max(1, len(b)))
                    node = (list(map(int, fixed)), list(map(int, free)))
                    if tree.fit(sum(node, []))[0] < best[len(fixed):len(fixed) + len(free)].max():
                        left += tree.walk(node, best, subsets, each)
            found = [([], [], k, best[k], subsets[k]) for k in range(1, len(best)) if best[k] < known[k]]
            yield pd.DataFrame(found + [(f, r, None, None, None) for f, r in left], columns=["fixed", "free", "k", "rss", "subset"])

        out = write_and_read(nodes.repartition(tasks).mapInPandas(search, _ROWS), "open-nodes")
        for r in out.where("k IS NOT NULL").groupBy("k").agg(F.min(F.struct("rss", "subset")).alias("m")).collect():
            if r.m.rss < best[r.k]:
                best[r.k], subsets[r.k] = r.m.rss, list(r.m.subset)
        nodes = out.where("k IS NULL").select("fixed", "free")
        count = nodes.count()
        shared.destroy()
    if count:
        raise RuntimeError(f"{count} nodes still open after {max_rounds} rounds")
    rows = []
    for k in range(1, p + 1):
        at = [keep[i] for i in subsets[k]]
        scores = cv_scores(mom, at)
        rows.append((k, [mom.names[i] for i in at], float(best[k]), float(scores.mean()), scores.tolist()))
    least = min((r[3], r[0]) for r in rows)[1] if rows else 0
    return spark.createDataFrame([(*r, r[0] == least) for r in rows],
                                 "k int, features array<string>, rss double, avg_mse double, cv_scores array<double>, is_best boolean")
