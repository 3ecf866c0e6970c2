"""The modelling table: labelled issues -> ln target -> fitted feature pipeline ->
encoded design rows, and the same fitted pipeline applied to open issues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import named
from . import clean, encode


def labelled_with_target(issues: DataFrame) -> DataFrame:
    """Labelled issues with ``duration_min`` > 0 and ``log_duration`` = ln(minutes)."""
    lab, _ = clean.split_labelled(issues)
    lab = clean.add_duration(lab)
    return lab.where(F.col("duration_min") > 0).withColumn("log_duration", F.ln(F.col("duration_min").cast("double")))


def fit_features(train_rows: DataFrame, min_count: int = 10,
                 short_types: Sequence[str] = encode.SHORT_ISSUE_TYPES) -> PipelineModel:
    return encode.feature_pipeline(min_count, short_types).fit(clean.feature_table(train_rows, target=None))


def design(issues: DataFrame, min_count: int = 10, short_types: Sequence[str] = encode.SHORT_ISSUE_TYPES):
    """(fitted pipeline, encoded labelled rows: key, features..., log_duration)."""
    lab = labelled_with_target(issues)
    model = fit_features(lab, min_count, short_types)
    return model, encode.encode(model, lab, target="log_duration")


def to_long(encoded: DataFrame, ids: Sequence[str] = ("key",)) -> DataFrame:
    """(key, feature, value) rows of an encoded table (all values as double)."""
    vals = [c for c in encoded.columns if c not in ids]
    wide = encoded.select(*ids, *[named(c).cast("double").alias(c) for c in vals])
    return wide.unpivot([named(c) for c in ids], [named(c) for c in vals], "feature", "value")
