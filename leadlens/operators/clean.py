"""Cleaning: labelled/open split, the duration target, the feature table, log transforms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S

# Columns that are identifiers, constant, or known only after resolution.
ID_AND_LEAK_COLUMNS = ["project", "updated", "created", "resolutiondate", "key", "days_in_current_status"]
POST_RESOLUTION_COLUMNS = ["assignee", "status", "resolution"]
# The four skewed counts that get ln(x+1).
SKEWED_COUNTS = ["vote_count", "comment_count", "description_length", "watch_count"]
FEATURE_COLUMNS = [
    "priority",
    "issue_type",
    "reporter",
    "vote_count",
    "comment_count",
    "description_length",
    "summary_length",
    "watch_count",
]


def is_labelled() -> F.Column:
    return F.col("resolutiondate").isNotNull() & F.col("created").isNotNull()


def split_labelled(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(resolved issues with both dates, every other issue). One predicate and its
    negation over the same scan; no anti-join needed."""
    lab = is_labelled()
    return df.where(lab), df.where(~lab)


def open_by_anti_join(df: DataFrame, labelled: DataFrame, key: str = "key") -> DataFrame:
    """The complement of an arbitrary labelled subset by row identity (left anti join)."""
    return df.join(labelled.select(key), key, "left_anti")


def add_duration(df: DataFrame, start: str = "created", end: str = "resolutiondate") -> DataFrame:
    """Target columns: whole minutes and whole days from ``start`` to ``end``."""
    return df.withColumns(
        {
            "duration_min": S.elapsed_minutes(start, end),
            "duration_days": S.elapsed_days(start, end),
        }
    )


def fixed_only(df: DataFrame, start: str = "created", end: str = "resolutiondate") -> DataFrame:
    """The 'Fixed resolutions only' training set with ``duration_min``. Text columns
    (export form such as ``2013-04-05T10:11:12.000+0000``) are parsed with their offset;
    timestamp columns are used as they are."""
    out = df.where(F.col("resolution") == "Fixed")
    types = dict(out.dtypes)

    def ts(c):
        return S.parse_timestamp(c, S.ISSUE_TS_PATTERN) if types[c] == "string" else F.col(c)

    return out.withColumn("duration_min", S.elapsed_minutes(ts(start), ts(end)))


def feature_table(df: DataFrame, target: str | None = "duration_min") -> DataFrame:
    """Drop identifiers, leak columns and post-resolution fields; missing description
    length becomes 0. Keeps ``key`` so rows stay identifiable downstream."""
    cols = [c for c in FEATURE_COLUMNS if c in df.columns]
    out = df.select("key", *cols, *([target] if target and target in df.columns else []))
    if "description_length" in cols:
        out = out.withColumn("description_length", S.zero_if_null("description_length").cast("double"))
    return out


def log_transform(df: DataFrame, counts: Sequence[str] = SKEWED_COUNTS, target: str | None = "duration_min",
                  target_out: str = "log_duration") -> DataFrame:
    """ln(x+1) on the skewed counts and ln(target) on the target. Rows whose target is
    <= 0 have no logarithm; they are removed here (count them with ``nonpositive_targets``)."""
    out = df.withColumns({c: F.log1p(F.col(c).cast("double")) for c in counts if c in df.columns})
    if target and target in df.columns:
        out = out.where(F.col(target) > 0).withColumn(target_out, F.ln(F.col(target).cast("double")))
    return out


def nonpositive_targets(df: DataFrame, target: str = "duration_min") -> DataFrame:
    return df.agg(F.count_if(F.col(target) <= 0).alias("n_nonpositive"), F.count(target).alias("n_target"))
