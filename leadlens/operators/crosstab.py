"""Two-way counts: top pairs, wide pivots ordered by column total, normalised shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import rank_rows


def pair_counts(df: DataFrame, a: str, b: str, top: int | None = None) -> DataFrame:
    """Counts of (a, b) pairs with both keys non-null, descending (ties by a, b);
    ``top`` keeps the first k (a TakeOrderedAndProject, no full sort)."""
    out = (
        df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(a, b)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(a), F.asc(b))
    )
    return out.limit(top) if top else out


def rank_columns_by_total(pairs: DataFrame, a: str, b: str, keep: int | None = None) -> DataFrame:
    """Long form of the wide table: add ``col_rank`` (1 = the ``b`` level with the largest
    total, ties by name) and keep the first ``keep`` levels."""
    totals = pairs.groupBy(b).agg((-F.sum("n")).alias("_neg_tot"))
    # Distributed ranking (largest total first, ties by name): no single-task window even
    # when ``pairs`` is not a small top-k.
    ranked = rank_rows(totals, ["_neg_tot", b], rank_col="_r")
    totals = ranked.select(b, (F.col("_r") + 1).cast("int").alias("col_rank"))
    out = pairs.join(totals, b)
    return out.where(F.col("col_rank") <= keep) if keep else out


def crosstab_wide(pairs: DataFrame, a: str, b: str, keep: int | None = None) -> DataFrame:
    """Wide matrix: one row per ``a`` level, one column per ``b`` level ordered by column
    total (descending), empty cells 0. The level list is passed to ``pivot`` so no
    extra distinct job runs; it is bounded by the (small, top-k) input."""
    ranked = rank_columns_by_total(pairs, a, b, keep)
    lv = [r[b] for r in ranked.select(b, "col_rank").distinct().orderBy("col_rank").collect()]
    return ranked.groupBy(a).pivot(b, lv).agg(F.sum("n")).na.fill(0)


def level_shares(df: DataFrame, value: str, level: str) -> DataFrame:
    """Column-normalised crosstab: for each (value, level) the count and the share of
    that value among the level's rows. Long form; the per-level total is a grouped
    aggregate joined back (no window over a possibly huge level)."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value, level).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(F.col(level).alias("_lvl")).agg(F.sum("n").alias("_tot"))
    return counts.join(totals, F.col(level).eqNullSafe(F.col("_lvl"))).select(
        value, level, "n", (F.col("n") / F.col("_tot")).alias("share")
    )
