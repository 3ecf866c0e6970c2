"""Order-dependent results without one-task windows.

A window ``ORDER BY`` with no (or a skewed) ``PARTITION BY`` runs in a single task. Here
rows are range-partitioned on (by, order) so that partition ids follow the global order
(AQE may merge adjacent ranges into fewer, right-sized partitions; order is kept),
positions (or running weights) are computed inside each partition, and a small
per-(partition, group) offset table (at most partitions + groups rows) turns them into
global ones. The range-partitioned rows are written once as Parquet under the shared
checkpoint folder before the offsets are taken, so offsets and rows come from the same
partitioning even when tasks are retried or executors are lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import named
from ..session import write_and_read

_LOW33 = (1 << 33) - 1


def _materialize(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder and read back (cuts lineage, pins the
    partition assignment computed above)."""
    return write_and_read(df, "rank")


def _join_offsets(ranged: DataFrame, blocks: DataFrame, by: list[str], keep: list[str]) -> DataFrame:
    blocks = blocks.select(*[F.col(c).alias(f"_b_{c}") for c in keep])
    cond = F.col("_pid") == F.col("_b__pid")
    for g in by:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_b_{g}"))
    # Without groups the offset table has at most one row per partition: a proven bound.
    right = F.broadcast(blocks) if not by else blocks
    return ranged.join(right, cond)


def rank_rows(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    rank_col: str = "row_rank",
    size_col: str | None = None,
) -> DataFrame:
    """Add ``rank_col``: the 0-based position of each row in ascending (nulls first)
    ``order`` within its ``by`` group; ``size_col`` (optional) is the group size.
    Ties get distinct consecutive ranks, in order of hashes of the whole row: the same on any
    partitioning and after a task is retried."""
    by, order = list(by), list(order)
    # A tie-break lets the range partitioner split a value shared by a huge number of rows (a third
    # of the table, say) over many partitions instead of one. It is a hash of the row, not a row
    # id: a retried task then deals the same rows to the same ranges. Rows equal in all columns
    # have one hash and stay together; which of them has which rank can't be told apart.
    row = [F.to_json(named(f.name)) if isinstance(f.dataType, T.MapType) else F.to_json(F.struct(named(f.name)))
           if isinstance(f.dataType, (T.StructType, T.ArrayType, T.VariantType)) else named(f.name) for f in df.schema.fields]
    keys = by + order + ["_tb", "_tc"]
    ranged = _materialize(
        df.withColumns({"_tb": F.xxhash64(*row), "_tc": F.xxhash64(F.lit(1), *row)})
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
        .drop("_tb", "_tc")
    )
    ranged = (ranged.withColumn("_pid", F.shiftright("_mid", 33))
              .withColumn("_idx", F.col("_mid").bitwiseAND(F.lit(_LOW33))).drop("_mid"))
    blocks = ranged.groupBy("_pid", *by).agg(F.min("_idx").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    keep = ["_pid", *by, "_first", "_before"]
    if size_col:
        blocks = blocks.withColumn("_size", F.sum("_cnt").over(Window.partitionBy(*by)))
        keep.append("_size")
    out = _join_offsets(ranged, blocks, by, keep)
    out = out.withColumn(rank_col, F.col("_b__before") + F.col("_idx") - F.col("_b__first"))
    if size_col:
        out = out.withColumn(size_col, F.col("_b__size"))
    return out.drop("_pid", "_idx", *[f"_b_{c}" for c in keep])


def cumulative_weights(
    df: DataFrame,
    order: Sequence[str],
    weight: str,
    by: Sequence[str] = (),
    before_col: str = "cum_before",
    total_col: str | None = None,
) -> DataFrame:
    """Add ``before_col``: the sum of ``weight`` over rows that sort before this one
    within its ``by`` group (``order`` should be unique within a group, e.g. distinct
    values with their counts). The running sum is a window per (range partition, group),
    so no window ever holds more than one range partition."""
    by, order = list(by), list(order)
    keys = by + order
    ranged = _materialize(df.repartitionByRange(*keys).withColumn("_pid", F.spark_partition_id()))
    local = Window.partitionBy("_pid", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranged = ranged.withColumn("_local", F.coalesce(F.sum(weight).over(local), F.lit(0)))
    blocks = ranged.groupBy("_pid", *by).agg(F.sum(weight).alias("_w"))
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_w").over(before), F.lit(0)))
    keep = ["_pid", *by, "_before"]
    if total_col:
        blocks = blocks.withColumn("_total", F.sum("_w").over(Window.partitionBy(*by)))
        keep.append("_total")
    out = _join_offsets(ranged, blocks, by, keep)
    out = out.withColumn(before_col, F.col("_b__before") + F.col("_local"))
    if total_col:
        out = out.withColumn(total_col, F.col("_b__total"))
    return out.drop("_pid", "_local", *[f"_b_{c}" for c in keep])


def with_previous(df: DataFrame, order: Sequence[str], col: str, prev_col: str) -> DataFrame:
    """Add ``prev_col``: ``col`` of the row before in ``order`` (unique), NULL for the first row.

    Rows are dealt into ranges; ``lag`` works inside each, and the first row of a range takes the
    last value of the range before it, from a table of one row per range. No self-join."""
    order = list(order)
    ranged = _materialize(df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()))
    local = Window.partitionBy("_pid").orderBy(*order)
    lasts = ranged.groupBy("_pid").agg(F.max_by(F.struct(F.col(col).alias("v")), F.struct(*order)).alias("_last"))
    before = lasts.select(F.col("_pid").alias("_b_pid"), F.lag("_last").over(Window.orderBy("_pid")).alias("_before"))
    out = ranged.withColumns({"_prev": F.lag(F.struct(F.col(col).alias("v"))).over(local)}).join(F.broadcast(before), F.col("_pid") == F.col("_b_pid"))
    return out.withColumn(prev_col, F.coalesce("_prev", "_before")["v"]).drop("_pid", "_b_pid", "_prev", "_before")


def row_numbers(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), col: str = "row_number") -> DataFrame:
    """1-based ``row_number()`` over (by, order) computed with :func:`rank_rows`."""
    return rank_rows(df, order, by, rank_col="_r0").withColumn(col, F.col("_r0") + 1).drop("_r0")


def ranked_value_counts(df: DataFrame, col: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """(by..., _x, _c, _cb, _n): each distinct non-null value of ``col`` per group with
    its count, the count of smaller values, and the group's non-null total. Only distinct
    values are shuffled and ranked (a partial aggregate runs first). A row counts once, or as
    often as its ``weight`` says."""
    by = list(by)
    times = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    vals = df.select(*by, F.col(col).cast("double").alias("_x"), times.alias("_w")).where(F.col("_x").isNotNull())
    counts = vals.groupBy(*by, "_x").agg((F.count(F.lit(1)) if weight is None else F.sum("_w")).alias("_c"))
    # Written once: callers aggregate it several times (quantiles, whiskers, moments).
    return write_and_read(cumulative_weights(counts, ["_x"], "_c", by, before_col="_cb", total_col="_n"), "ranked")


def quantiles_from_ranked(cum: DataFrame, probs: Sequence[float], by: Sequence[str] = (),
                          names: Sequence[str] | None = None) -> DataFrame:
    """Linear-interpolation quantiles from a :func:`ranked_value_counts` table."""
    by = list(by)
    names = list(names) if names else [f"q{int(round(p * 100))}" for p in probs]
    lo_end, hi_end = F.col("_cb"), F.col("_cb") + F.col("_c")
    aggs = [F.max("_n").alias("n")]
    for p, nm in zip(probs, names):
        h = (F.col("_n") - 1) * F.lit(float(p))
        for tag, r in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            aggs.append(F.max(F.when((lo_end <= r) & (r < hi_end), F.col("_x"))).alias(f"_{tag}_{nm}"))
    agg = cum.groupBy(*by).agg(*aggs)
    out = [*by, F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")]
    for p, nm in zip(probs, names):
        h = (F.col("n") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo_{nm}"), F.col(f"_hi_{nm}")
        out.append((lo + (h - F.floor(h)) * (hi - lo)).alias(nm))
    return agg.select(*out)


def approx_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
                     names: Sequence[str] | None = None, accuracy: int = 10000) -> DataFrame:
    """One-pass quantiles from mergeable sketches (``percentile_approx``; rank error about
    1/accuracy): for when an exact answer is not needed at very large scale."""
    by = list(by)
    names = list(names) if names else [f"q{int(round(p * 100))}" for p in probs]
    x = F.col(col).cast("double")
    qs = F.percentile_approx(x, [float(p) for p in probs], accuracy)
    agg = df.where(x.isNotNull()).groupBy(*by).agg(F.count(x).alias("n"), qs.alias("_q"))
    return agg.select(*by, F.col("n").cast("bigint"), *[F.col("_q")[i].alias(nm) for i, nm in enumerate(names)])


def exact_quantiles(
    df: DataFrame,
    col: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles (type 7, DuckDB ``quantile_cont``) of the
    non-null values of ``col`` per ``by`` group, plus the group's non-null count ``n``.

    Values are first reduced to (group, value, count) by a partial aggregate, so only
    distinct values are shuffled and ranked; cumulative counts then locate the two order
    statistics around each position h = (n-1)p. Memory per task stays bounded for any
    group size or number of distinct values."""
    return quantiles_from_ranked(ranked_value_counts(df, col, by), probs, by, names)
