"""Level reduction, dummy encoding, scaling and the fit-on-train / serve-on-new feature
pipeline, as Spark ML Estimators and Transformers built from Column expressions.

Fitted state (tables of kept levels, the dummies' names, min/max per column) travels with the
model, so serving never recomputes it from the data being scored. Dummies are a column each here;
for columns of very many levels see :class:`levels.SparseDesign`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions.scalar import named
from ..session import cleanup_at_exit, scratch_path
from . import clean, levels

# Issue types that tend to resolve quickly.
SHORT_ISSUE_TYPES = ["Bug", "Improvement", "Task", "Test"]
# The alternative priority groupings.
MAJOR_PRIORITIES = ["Major", "Critical", "Blocker"]
MINOR_PRIORITIES = ["Minor", "Trivial"]
CATEGORICAL_FEATURES = ["priority", "issue_type", "reporter"]
NUMERIC_FEATURES = ["vote_count", "comment_count", "description_length", "summary_length", "watch_count"]


class _Persist(DefaultParamsReadable, DefaultParamsWritable):
    pass


class RareLevels(Estimator, _Persist):
    """Keep the levels of ``inputCol`` seen more than ``minCount`` times in the fitting
    data; map the rest (and NULL, and levels unseen at fit time) to ``other``. The kept levels are
    a Parquet table in the shared folder; nothing reaches the driver."""

    inputCol = Param(Params._dummy(), "inputCol", "column", TypeConverters.toString)
    minCount = Param(Params._dummy(), "minCount", "keep levels with count > minCount", TypeConverters.toInt)
    other = Param(Params._dummy(), "other", "replacement level", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol: str = "reporter", minCount: int = 10, other: str = "Other"):
        super().__init__()
        self._setDefault(minCount=10, other="Other")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "RareLevelsModel":
        c = self.getOrDefault("inputCol")
        folder = scratch_path(df.sparkSession, "kept-levels")
        levels.frequent_levels(df, c, self.getOrDefault("minCount")).write.parquet(folder)
        cleanup_at_exit(df.sparkSession, folder)
        return RareLevelsModel(inputCol=c, folder=folder, other=self.getOrDefault("other"))


class _LevelsWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.levels().write.parquet(f"{path}/levels")


class _LevelsReader(DefaultParamsReader):
    def load(self, path: str):
        return super().load(path)._set(folder=f"{path}/levels")


class RareLevelsModel(Model, _Persist):
    """Joins the kept levels from the left. A saved model has its own copy of their table."""

    inputCol = Param(Params._dummy(), "inputCol", "column", TypeConverters.toString)
    folder = Param(Params._dummy(), "folder", "Parquet table (level, n) of the kept levels", TypeConverters.toString)
    other = Param(Params._dummy(), "other", "replacement level", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol: str = "reporter", folder: str = "", other: str = "Other"):
        super().__init__()
        self._set(**self._input_kwargs)

    def levels(self) -> DataFrame:
        return SparkSession.active().read.parquet(self.getOrDefault("folder"))

    def write(self):
        return _LevelsWriter(self)

    @classmethod
    def read(cls):
        return _LevelsReader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        return levels.keep_levels(df, self.getOrDefault("inputCol"), self.levels(), self.getOrDefault("other"))


class GroupLevels(Transformer, _Persist):
    """Two-way mapping: ``inside`` for listed members, ``outside`` for everything else."""

    inputCol = Param(Params._dummy(), "inputCol", "column", TypeConverters.toString)
    members = Param(Params._dummy(), "members", "levels mapped to inside", TypeConverters.toListString)
    inside = Param(Params._dummy(), "inside", "label for members", TypeConverters.toString)
    outside = Param(Params._dummy(), "outside", "label for the rest", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol: str = "issue_type", members: list | None = None, inside: str = "Short",
                 outside: str = "Long"):
        super().__init__()
        self._setDefault(members=SHORT_ISSUE_TYPES, inside="Short", outside="Long")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.getOrDefault("inputCol")
        return df.withColumn(
            c, S.two_groups(c, self.getOrDefault("members"), self.getOrDefault("inside"), self.getOrDefault("outside"))
        )


class LogCounts(Transformer, _Persist):
    """ln(x+1) of the listed count columns."""

    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, inputCols: list | None = None):
        super().__init__()
        self._setDefault(inputCols=list(clean.SKEWED_COUNTS))
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.log1p(named(c).cast("double")) for c in self.getOrDefault("inputCols") if c in df.columns})


class DummyEncoder(Estimator, _Persist):
    """k-1 dummy columns ``<col>_<level>`` per categorical column: levels sorted, the
    first dropped (the baseline). Unseen levels and NULL encode as all zeros."""

    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)
    dropFirst = Param(Params._dummy(), "dropFirst", "drop the first level", TypeConverters.toBoolean)
    keepInput = Param(Params._dummy(), "keepInput", "keep the source columns", TypeConverters.toBoolean)
    maxLevels = Param(Params._dummy(), "maxLevels", "refuse to encode more levels than this", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCols: list | None = None, dropFirst: bool = True, keepInput: bool = False,
                 maxLevels: int = 10000):
        super().__init__()
        self._setDefault(inputCols=list(CATEGORICAL_FEATURES), dropFirst=True, keepInput=False, maxLevels=10000)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "DummyEncoderModel":
        cols = self.getOrDefault("inputCols")
        cap = self.getOrDefault("maxLevels")
        # All level sets in one job: (column, level) pairs, distinct.
        pairs = df.select(
            F.explode(F.array(*[F.struct(F.lit(c).alias("c"), named(c).cast("string").alias("v")) for c in cols])).alias("p")
        ).select("p.*").where(F.col("v").isNotNull()).distinct()
        # Each level becomes a column, so the level list is the schema: fetch at most
        # cap + 1 rows and refuse (collapse rare levels first) rather than truncate.
        rows = pairs.limit(cap + 1).collect()
        if len(rows) > cap:
            raise ValueError(f"more than {cap} levels in {cols}; reduce levels (RareLevels) before dummy encoding")
        found: dict[str, list[str]] = {c: [] for c in cols}
        for r in rows:
            found[r["c"]].append(r["v"])
        spec = []
        for c in cols:
            lv = sorted(found[c])
            if self.getOrDefault("dropFirst"):
                lv = lv[1:]
            spec.extend(f"{c}\u0001{v}" for v in lv)
        return DummyEncoderModel(inputCols=cols, spec=spec, keepInput=self.getOrDefault("keepInput"))


class DummyEncoderModel(Model, _Persist):
    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)
    spec = Param(Params._dummy(), "spec", "column\\x01level per output column", TypeConverters.toListString)
    keepInput = Param(Params._dummy(), "keepInput", "keep the source columns", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCols: list | None = None, spec: list | None = None, keepInput: bool = False):
        super().__init__()
        self._set(**self._input_kwargs)

    def pairs(self) -> list[tuple[str, str]]:
        return [tuple(s.split("\u0001", 1)) for s in self.getOrDefault("spec")]

    def output_columns(self) -> list[str]:
        return [f"{c}_{v}" for c, v in self.pairs()]

    def _transform(self, df: DataFrame) -> DataFrame:
        new = {f"{c}_{v}": (named(c) == F.lit(v)).cast("int") for c, v in self.pairs()}
        new = {k: F.coalesce(e, F.lit(0)) for k, e in new.items()}
        out = df.withColumns(new)
        return out if self.getOrDefault("keepInput") else out.drop(*self.getOrDefault("inputCols"))


class MinMaxScaling(Estimator, _Persist):
    """Scale columns to [0, 1] with the fitting data's min and max (no clipping when
    applied to other data); a constant column scales to 0."""

    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, inputCols: list | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "MinMaxScalingModel":
        cols = self.getOrDefault("inputCols")
        r = df.agg(*[F.min(named(c).cast("double")) for c in cols], *[F.max(named(c).cast("double")) for c in cols]).first()
        k = len(cols)
        return MinMaxScalingModel(inputCols=cols, mins=[float(r[i] or 0.0) for i in range(k)],
                                  maxs=[float(r[k + i] or 0.0) for i in range(k)])


class MinMaxScalingModel(Model, _Persist):
    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)
    mins = Param(Params._dummy(), "mins", "fitted minima", TypeConverters.toListFloat)
    maxs = Param(Params._dummy(), "maxs", "fitted maxima", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCols: list | None = None, mins: list | None = None, maxs: list | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, lo, hi in zip(self.getOrDefault("inputCols"), self.getOrDefault("mins"), self.getOrDefault("maxs")):
            x = named(c).cast("double")
            out[c] = F.lit(0.0) if hi == lo else (x - F.lit(lo)) / F.lit(hi - lo)
        return df.withColumns(out)


def poly2(df: DataFrame, cols: Sequence[str], bias: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Degree-2 polynomial terms: every x_i and every product x_i*x_j (i <= j), named
    ``a`` / ``a*b`` / ``a^2`` (plus ``1`` when ``bias``); ``keep`` columns pass through."""
    cols = list(cols)
    terms = {k: named(k) for k in keep}
    if bias:
        terms["1"] = F.lit(1.0)
    for c in cols:
        terms[c] = named(c).cast("double")
    for i, a in enumerate(cols):
        for b in cols[i:]:
            terms[f"{a}^2" if a == b else f"{a}*{b}"] = named(a).cast("double") * named(b).cast("double")
    return df.select(*[e.alias(n) for n, e in terms.items()])


def align_columns(df: DataFrame, columns: Sequence[str], fill=0) -> DataFrame:
    """Exactly ``columns`` in that order: missing ones filled with ``fill``, extra ones
    dropped (serving data aligned to the training layout)."""
    have = set(df.columns)
    return df.select(*[named(c) if c in have else F.lit(fill).alias(c) for c in columns])


def feature_pipeline(min_count: int = 10, short_types: Sequence[str] = SHORT_ISSUE_TYPES) -> Pipeline:
    """Fit on labelled issues, serve on open ones: rare reporters -> Other, issue type ->
    Short/Long, ln(x+1) counts, k-1 dummies (levels from the fitting data only)."""
    return Pipeline(
        stages=[
            RareLevels(inputCol="reporter", minCount=min_count),
            GroupLevels(inputCol="issue_type", members=list(short_types)),
            LogCounts(),
            DummyEncoder(inputCols=list(CATEGORICAL_FEATURES)),
        ]
    )


def encoded_feature_names(model: PipelineModel) -> list[str]:
    """Design-matrix columns of a fitted ``feature_pipeline``: numeric ones, then dummies."""
    enc = [s for s in model.stages if isinstance(s, DummyEncoderModel)][0]
    return list(NUMERIC_FEATURES) + enc.output_columns()


def encode(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("key",), target: str | None = None) -> DataFrame:
    """Feature table -> encoded rows with exactly the training design columns (training
    order; dummies missing from the serving data are 0), target last if given."""
    out = model.transform(clean.feature_table(df, target=target))
    names = encoded_feature_names(model)
    have = set(out.columns)
    cols = [*keep, *[named(c) if c in have else F.lit(0).alias(c) for c in names]]
    if target:
        cols.append(target)
    return out.select(*cols)
