"""State shared by the registered queries of one application: the fitted feature
pipeline and the encoded design table (written once to the checkpoint folder)."""

from __future__ import annotations

from ..operators import encode, modeling_data, split
from ..session import write_and_read
from ..sources.issues import ISSUE_SQL_TABLES, fingerprint, issues

# The segments treated as "Short" issue types in the derived data.
SHORT_TYPES = ["BUILDING", "HOUSEHOLD", "MACHINERY"]

_CACHE: dict = {}


def memo(spark, data_dir, name, build):
    # Keyed by application and by the input files' sizes and times: a stopped and recreated session never sees stale frames.
    k = (spark.sparkContext.applicationId, spark.sparkContext.getCheckpointDir(), fingerprint(spark, data_dir, ISSUE_SQL_TABLES), name)
    if k not in _CACHE:
        _CACHE[k] = build()
    return _CACHE[k]


def forget() -> None:
    """Drop what the application's queries share, so that the next one computes its own."""
    _CACHE.clear()


def design(spark, data_dir):
    """(fitted feature pipeline, encoded labelled rows, feature names)."""

    def build():
        model, enc = modeling_data.design(issues(spark, data_dir), 10, SHORT_TYPES)
        # Reused by every model query: written once, read as narrow Parquet afterwards.
        return model, write_and_read(enc, "design"), encode.encoded_feature_names(model)

    return memo(spark, data_dir, "design", build)


def train_test(spark, data_dir, pct=80):
    _, enc, _ = design(spark, data_dir)
    return split.train_test(enc, "key", pct)
