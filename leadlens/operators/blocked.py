"""Moments of sparse design rows in blocks, for designs too wide for a p x p matrix on the driver.

X'X of the rows [1, x] is summed cell by cell by Spark, only where two entries meet in a row, and
kept as a Parquet table of blocks (sparse, upper triangle). Least squares and ridge then run as
conjugate gradients: an iteration is one pass over the blocks, and the driver holds vectors of
length p only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import named
from ..session import write_and_read
from .levels import SparseDesign

_CELLS = "array<struct<i:int,j:int,v:double>>"


class BlockedMoments:
    """``blocks`` (bi, bj, cells of i, j, v), position 0 being the intercept and x following from 1;
    ``xy`` = [1, X]'y, ``n`` rows, ``yy`` = y'y; ``width`` with the intercept."""

    def __init__(self, blocks: DataFrame, xy: np.ndarray, n: int, yy: float, width: int, block: int):
        self.blocks, self.xy, self.n, self.yy, self.width, self.block = blocks, xy, n, yy, width, block

    @classmethod
    def of(cls, rows: DataFrame, width: int, label: str, block: int = 512) -> BlockedMoments:
        """From sparse rows (indices ascending, values, ``label``); rows without a label are left out."""
        y = named(label).cast("double")
        one = F.array(F.struct(F.lit(0).alias("i"), F.lit(1.0).alias("v")))
        rest = F.zip_with("indices", "values", lambda i, v: F.struct((i + 1).alias("i"), v.alias("v")))
        e = write_and_read(rows.where(y.isNotNull()).select(F.concat(one, rest).alias("e"), y.alias("y")), "sparse-rows")
        pairs = F.flatten(F.transform("e", lambda a, k: F.transform(
            F.slice("e", k + 1, F.size("e")), lambda b: F.struct(a["i"].alias("i"), b["i"].alias("j"), (a["v"] * b["v"]).alias("v")))))
        cells = e.select(F.inline(pairs)).groupBy("i", "j").agg(F.sum("v").alias("v"))
        at = [F.floor(F.col(c) / block).cast("int").alias(f"b{c}") for c in "ij"]
        blocks = cells.groupBy(*at).agg(F.collect_list(F.struct("i", "j", "v")).alias("cells"))  # block^2 cells at most
        blocks = write_and_read(blocks, "gram-blocks")
        xy = e.select("y", F.inline("e")).groupBy("i").agg(F.sum(F.col("v") * F.col("y")).alias("v"))
        facts = e.agg(F.count(F.lit(1)), F.sum(F.col("y") * F.col("y"))).first()
        return cls(blocks, _vector(xy, width + 1), facts[0], facts[1] or 0.0, width + 1, block)

    def cells(self) -> DataFrame:
        """(i, j, v), i <= j: the non-zero cells."""
        return self.blocks.select(F.inline("cells"))

    def times(self, x: np.ndarray) -> np.ndarray:
        """X'X x: each task multiplies its blocks and their mirror images, Spark sums by position."""
        spark, block, width = self.blocks.sparkSession, self.block, self.width
        shared = spark.sparkContext.broadcast(x)  # width numbers, as in every step on the driver

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            v, out = shared.value, {}

            def add(at: np.ndarray, w: np.ndarray) -> None:
                if len(at):
                    first = int(at[0]) // block * block
                    own = out.setdefault(first, np.zeros(min(block, width - first)))
                    own += np.bincount(at - first, w, len(own))

            for batch in batches:
                for one in batch["cells"]:
                    i, j, c = (f.to_numpy(zero_copy_only=False) for f in one.values.flatten())
                    add(i, c * v[j])
                    up = i != j
                    add(j[up], (c * v[i])[up])
            for first, sums in out.items():
                yield pa.record_batch([pa.array(np.arange(first, first + len(sums), dtype=np.int32)), pa.array(sums)], names=["i", "v"])

        sums = self.blocks.select("cells").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
        out = _vector(sums, width)
        shared.destroy()
        return out

    def solve(self, alpha: float = 0.0, tolerance: float = 1e-12, most: int = 1000) -> np.ndarray:
        """Intercept and coefficients that minimise |y - Xb|^2 + alpha |b|^2 (intercept free), by
        conjugate gradients scaled by the diagonal. With collinear columns and no penalty it is one
        of the minima. Raises if ``most`` iterations do not reach the tolerance."""
        penalty = np.full(self.width, float(alpha))
        penalty[0] = 0.0
        diagonal = _vector(self.cells().where("i = j").select("i", "v"), self.width) + penalty
        scale = np.where(diagonal > 0, 1 / np.where(diagonal > 0, diagonal, 1), 0.0)
        x = np.zeros(self.width)
        r = np.where(diagonal > 0, self.xy, 0.0)  # a column of zeros keeps coefficient 0
        z = scale * r
        p, rz = z, float(r @ z)
        goal = tolerance ** 2 * rz
        for _ in range(most):
            if rz <= goal or rz == 0:
                return x
            q = self.times(p) + penalty * p
            step = rz / float(p @ q)
            x = x + step * p
            r = r - step * q
            z = scale * r
            p, rz = z + float(r @ z) / rz * p, float(r @ z)
        raise RuntimeError(f"no solution within {most} iterations (residual {np.sqrt(rz):.3g})")

    def rss(self, coef: np.ndarray) -> float:
        return float(self.yy - 2 * coef @ self.xy + coef @ self.times(coef))

    def coefficients(self, coef: np.ndarray, design: SparseDesign) -> DataFrame:
        """(feature, coef) by the design's names."""
        spark = self.blocks.sparkSession
        numbers = spark.createDataFrame(pa.table({"slot": np.arange(-1, self.width - 1), "coef": coef}))
        names = spark.createDataFrame([(-1, "Intercept")], "slot long, feature string").unionByName(design.features())
        return names.join(numbers, "slot").select("feature", "coef")


def _vector(cells: DataFrame, width: int) -> np.ndarray:
    """(i, v) as an array of length ``width``."""
    got = cells.select("i", "v").toArrow()
    out = np.zeros(width)
    out[got["i"].to_numpy()] = got["v"].to_numpy()
    return out
