"""Fitted levels as tables, and sparse design rows.

Which levels of a column are kept, and where each stands in the design, is a Parquet table in the
shared folder (or one saved with the model). Encoding joins it from the left, by a broadcast while
it is small and by a shuffle beyond that (Spark decides by the table's size); no level ever is a
literal in a plan, a name in a schema or a row on the driver. A design row holds only its non-zero
positions and values, so its size does not depend on the number of levels.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import named
from ..session import cleanup_at_exit, scratch_path, write_and_read
from .ordering import row_numbers


def _fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Names like these that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return tuple(out)


def frequent_levels(df: DataFrame, col: str, min_count: int) -> DataFrame:
    """(level, n): the values of ``col``, as text, that stand in more than ``min_count`` rows."""
    value = df.select(named(col).cast("string").alias("level")).where("level IS NOT NULL")
    return value.groupBy("level").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_count)


def keep_levels(df: DataFrame, col: str, levels: DataFrame, other: str, null_to_other: bool = True) -> DataFrame:
    """``df`` with values of ``col`` that are not in ``levels`` (a written table with a column
    ``level``, each level once) replaced by ``other``; nulls too, unless ``null_to_other`` is off."""
    (level,) = _fresh(df, "_level")
    out = df.join(levels.select(F.col("level").alias(level)), named(col).cast("string") == named(level), "left")
    gone = named(level).isNull() if null_to_other else named(level).isNull() & named(col).isNotNull()
    new = F.when(gone, F.lit(other)).otherwise(named(col).cast("string")).alias(col)
    return out.select(*[new if c == col else named(c) for c in df.columns])


class SparseDesign:
    """Numeric columns and the dummies of categorical ones as sparse rows.

    Positions: the numeric columns in order, then for each categorical column its levels in order,
    without the first one if ``drop_first``. ``table`` has a row (column, level, n, slot) per level
    of the fitting data, slot being null for a dropped first level. Columns in ``other`` (column ->
    name) had their rare levels and nulls collapsed to that name, and do so with levels not seen at
    fitting; in other columns nulls and unseen levels have no entry.
    """

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str], other: Mapping[str, str], width: int, table: DataFrame):
        self.numeric, self.categorical, self.other = list(numeric), list(categorical), dict(other)
        self.width, self.table = width, table

    @classmethod
    def fit(cls, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], min_counts: Mapping[str, int] | None = None,
            other: str = "Other", drop_first: bool = True) -> SparseDesign:
        """Fit the levels of ``categorical``: one aggregate over all of them, then their positions by
        a distributed rank. ``min_counts`` (column -> rows) has the columns whose levels of no more
        rows become ``other``. A row for each categorical column is all that reaches the driver."""
        least = dict(min_counts or {})
        cells = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), named(c).cast("string").alias("level")) for c in categorical])))
        counts = cells.groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))
        rare = F.lit(False)
        for c, m in least.items():
            rare = F.when(F.col("column") == c, F.col("level").isNull() | (F.col("n") <= m)).otherwise(rare)
        kept = counts.withColumn("level", F.when(rare, F.lit(other)).otherwise(F.col("level"))).where("level IS NOT NULL")
        kept = write_and_read(kept.groupBy("column", "level").agg(F.sum("n").alias("n")), "levels")
        sizes = {r[0]: r[1] for r in kept.groupBy("column").agg(F.count(F.lit(1))).collect()}
        start, first = F.lit(None).cast("long"), int(drop_first)
        at = len(numeric)
        for c in categorical:
            start = F.when(F.col("column") == c, F.lit(at).cast("long")).otherwise(start)
            at += max(0, sizes.get(c, 0) - first)
        nth = F.col("nth") - 1 - first
        placed = row_numbers(kept, ["level"], ["column"], "nth").select("column", "level", "n", F.when(nth >= 0, start + nth).alias("slot"))
        return cls(numeric, categorical, {c: other for c in least}, at, write_and_read(placed, "level-slots"))

    def features(self) -> DataFrame:
        """(slot, feature): the name of each position."""
        spark = self.table.sparkSession
        numeric = spark.createDataFrame(list(enumerate(self.numeric)), "slot long, feature string")
        return numeric.unionByName(self.table.where("slot IS NOT NULL").select("slot", F.concat_ws("_", "column", "level").alias("feature")))

    def rows(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """(keep..., indices array<int>, values array<double>): the non-zero entries of each row of
        ``df``, positions ascending; null numbers count as 0. Works on streams too."""
        out, slots = df, []
        for c in self.categorical:
            level, slot = _fresh(out, "_level", "_slot")
            own = self.table.where(F.col("column") == c).select(F.col("level").alias(level), F.col("slot").alias(slot))
            out = out.join(own, named(c).cast("string") == named(level), "left")
            other = own.where(named(level) == self.other[c]).select(slot).first() if c in self.other else None  # a row at most
            unseen = F.lit(other[0] if other else None).cast("long")
            slots.append(F.when(named(level).isNull(), unseen).otherwise(named(slot)))
        entry = [F.struct(F.lit(i).alias("i"), F.coalesce(named(c).cast("double"), F.lit(0.0)).alias("v")) for i, c in enumerate(self.numeric)]
        entry += [F.struct(s.cast("int").alias("i"), F.lit(1.0).alias("v")) for s in slots]
        (e,) = _fresh(out, "_entries")
        out = out.withColumn(e, F.filter(F.array(*entry), lambda x: x["i"].isNotNull() & (x["v"] != 0)))
        return out.select(*map(named, keep), named(e)["i"].alias("indices"), named(e)["v"].alias("values"))

    def vectors(self, df: DataFrame, keep: Sequence[str] = (), col: str = "features") -> DataFrame:
        """(keep..., ``col``) with Spark ML sparse vectors, written once to the shared folder. A
        vector's stored form is a plain struct, so no row passes through Python."""
        sparse = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(self.width).alias("size"), "indices", "values")
        rows = self.rows(df, keep)
        rows = rows.select(*map(named, keep), sparse.alias(col))
        spark, path = df.sparkSession, scratch_path(df.sparkSession, "vectors")
        rows.write.mode("overwrite").parquet(path)
        schema = T.StructType([*rows.schema.fields[:-1], T.StructField(col, VectorUDT())])
        return spark.read.schema(schema).parquet(cleanup_at_exit(spark, path))

    def long(self, df: DataFrame, keep: Sequence[str] = ("key",)) -> DataFrame:
        """(keep..., feature, value) for each non-zero entry."""
        cells = self.rows(df, keep).select(*map(named, keep), F.inline(F.arrays_zip("indices", "values")).alias("slot", "value"))
        return cells.join(self.features(), "slot").select(*map(named, keep), "feature", "value")

    def save(self, path: str) -> None:
        """Write the fitted state under ``path``, replacing what is there."""
        spark = self.table.sparkSession
        state = {"numeric": self.numeric, "categorical": self.categorical, "other": self.other, "width": self.width}
        self.table.write.mode("overwrite").parquet(f"{path}/levels")
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/state")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SparseDesign:
        state = json.loads(spark.read.text(f"{path}/state").first()[0])
        return cls(state["numeric"], state["categorical"], state["other"], state["width"], spark.read.parquet(f"{path}/levels"))
