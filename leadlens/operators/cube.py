"""Many tables from one scan: a sparse joint histogram of several columns, of which every scatter,
pair and one-column table is a projection; hexagons of many pairs; and one long table of
(grouping, level, target, value) counts for box plots and shares over many groupings.

All of them first reduce rows to cells by a partial aggregate, so what is shuffled is the number of
occupied cells or distinct values, not of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import named
from ..session import write_and_read
from . import bins


def _finite(name: str) -> Column:
    x = named(name).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def _ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """(least, largest) finite value of every column, from one aggregate."""
    r = df.agg(*[f(_finite(c)).alias(f"{f.__name__}{i}") for i, c in enumerate(columns) for f in (F.min, F.max)]).first()
    return {c: (r[f"min{i}"], r[f"max{i}"]) for i, c in enumerate(columns)}


class BinCube:
    """Counts of the occupied cells of a grid over several columns.

    ``cells`` has the 0-based bin of column i as ``b<i>`` (null for a null or non-finite value) and
    ``n``. Bins are of equal width over the column's own finite range, the last one closed; a
    constant column has bin 0 alone."""

    def __init__(self, columns: Sequence[str], n_bins: int, ranges: Mapping[str, tuple], cells: DataFrame):
        self.columns, self.n_bins, self.ranges, self.cells = list(columns), n_bins, dict(ranges), cells

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], n_bins: int = 20) -> BinCube:
        """One aggregate for the ranges, one scan and one exchange for the cells, which are written
        to the shared folder."""
        columns = list(columns)
        ranges = _ranges(df, columns)

        def place(c):
            lo, hi = ranges[c]
            if lo is None:
                return F.lit(None).cast("int")
            x = _finite(c)
            if lo == hi:
                return F.when(x.isNotNull(), F.lit(0))
            return F.when(x.isNotNull(), F.least(F.width_bucket(x, F.lit(lo), F.lit(hi), F.lit(n_bins)), F.lit(n_bins)).cast("int") - 1)

        placed = df.select(*[place(c).alias(f"b{i}") for i, c in enumerate(columns)])
        cells = placed.groupBy(*placed.columns).agg(F.count(F.lit(1)).alias("n"))
        return cls(columns, n_bins, ranges, write_and_read(cells, "bin-cube"))

    def _cell(self, x: str, y: str | None) -> Column:
        b = {c: F.col(f"b{i}") for i, c in enumerate(self.columns)}
        return F.struct(F.lit(x).alias("x_col"), F.lit(x if y is None else y).alias("y_col"), b[x].cast("bigint").alias("bx"),
                        (F.lit(0) if y is None else b[y]).cast("bigint").alias("by"))

    def _project(self, wanted: Sequence[tuple[str, str | None]]) -> DataFrame:
        cells = self.cells.select("n", F.inline(F.array(*[self._cell(x, y) for x, y in wanted])))
        return cells.where("bx IS NOT NULL AND by IS NOT NULL").groupBy("x_col", "y_col", "bx", "by").agg(F.sum("n").alias("count"))

    def scatter(self, pairs: Sequence[tuple[str, str]]) -> DataFrame:
        """(x_col, y_col, bx, by, count) of the occupied cells of each pair of columns, over rows
        that have both."""
        return self._project(list(pairs))

    def histograms(self) -> DataFrame:
        """(x_col, bin, lo, hi, count) of the occupied bins of each column."""
        lo, hi = (F.element_at(F.create_map(*[v for c in self.columns for v in (F.lit(c), F.lit(self.ranges[c][k]).cast("double"))]), F.col("x_col"))
                  for k in (0, 1))
        width = (hi - lo) / F.lit(self.n_bins)
        return self._project([(c, None) for c in self.columns]).select(
            "x_col", F.col("bx").alias("bin"), (lo + F.col("bx") * width).alias("lo"), (lo + (F.col("bx") + 1) * width).alias("hi"), "count")

    def pair_plot(self) -> DataFrame:
        """:meth:`scatter` of every ordered pair of columns, and each column against itself as its
        histogram (by = 0): the upper triangle is counted, the lower one mirrored from it."""
        c = self.columns
        upper = self._project([(x, y) for i, x in enumerate(c) for y in c[i + 1:]] + [(x, None) for x in c])
        same = F.struct("x_col", "y_col", "bx", "by")
        turned = F.struct(F.col("y_col").alias("x_col"), F.col("x_col").alias("y_col"), F.col("by").alias("bx"), F.col("bx").alias("by"))
        both = F.when(F.col("x_col") == F.col("y_col"), F.array(same)).otherwise(F.array(same, turned))
        return upper.select(F.inline(both), "count")


def hexagons(df: DataFrame, pairs: Sequence[tuple[str, str]], grid: int = 15) -> DataFrame:
    """(x_col, y_col, hq, hr, count): pointy-top hexagons (axial q, r) of each pair of columns, both
    scaled to [0, ``grid``] over their finite ranges, the hexagons of circumradius 1. All pairs come
    from one scan and one exchange; rows without a finite value of both are left out of a pair."""
    ranges = _ranges(df, sorted({c for p in pairs for c in p}))

    def scaled(c):
        lo, hi = ranges[c]
        if lo is None:
            return F.lit(None).cast("double")
        return F.lit(float(grid)) * (_finite(c) - F.lit(lo)) / F.lit(hi - lo if hi > lo else 1.0)

    points = [F.struct(F.lit(x).alias("x_col"), F.lit(y).alias("y_col"), scaled(x).alias("x"), scaled(y).alias("y")) for x, y in pairs]
    hq, hr = bins.hexagon(F.col("x"), F.col("y"), 1.0)  # once for all pairs
    flat = df.select(F.inline(F.array(*points))).where("x IS NOT NULL AND y IS NOT NULL").select("x_col", "y_col", hq.alias("hq"), hr.alias("hr"))
    return flat.groupBy("x_col", "y_col", "hq", "hr").agg(F.count(F.lit(1)).alias("count"))


def value_counts_by(df: DataFrame, groupings: Mapping[str, Column], targets: Mapping[str, Column]) -> DataFrame:
    """(grouping, level, target, value, n) over all ``groupings`` (name -> level) and ``targets``
    (name -> value): every grouping set of one scan, reduced before the one shuffle. Null values
    are left out; a null level is a level."""
    sets = [F.struct(F.lit(g).alias("grouping"), level.cast("string").alias("level"), F.lit(t).alias("target"), value.cast("double").alias("value"))
            for g, level in groupings.items() for t, value in targets.items()]
    cells = df.select(F.inline(F.array(*sets))).where("value IS NOT NULL")
    return cells.groupBy("grouping", "level", "target", "value").agg(F.count(F.lit(1)).alias("n"))


def boxes_by(counts: DataFrame) -> DataFrame:
    """Box statistics (as :func:`bins.box_stats`) of every (grouping, level, target) of
    :func:`value_counts_by`, from one ranking over all of them."""
    return bins.box_stats(counts, "value", ["grouping", "level", "target"], weight="n")


def shares_by(counts: DataFrame) -> DataFrame:
    """``counts`` with ``share``, the part of its (grouping, level, target) that a value has: the
    column-normalised crosstabs of all groupings."""
    keys = ["grouping", "level", "target"]
    totals = counts.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.sum("n").alias("_total"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return counts.join(totals, same).select(*keys, "value", "n", (F.col("n") / F.col("_total")).alias("share"))
