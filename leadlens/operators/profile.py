"""Table profiles: shape, frequencies, nulls, subset counts, shares, summaries.

Every profile is one aggregate (partial aggregation before the shuffle), and profiles over
several columns are fused into one scan instead of one job per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordering import quantiles_from_ranked, ranked_value_counts


def _stack(df_row: DataFrame, names: Sequence[str], fields: Mapping[str, Sequence[Column]]) -> DataFrame:
    """Turn a one-row wide aggregate into one row per column name."""
    structs = [
        F.struct(F.lit(n).alias("column"), *[exprs[i].alias(k) for k, exprs in fields.items()])
        for i, n in enumerate(names)
    ]
    return df_row.select(F.inline(F.array(*structs)))


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, Spark type, non-null and null counts (a data-frame
    ``info``), from one aggregate over the table."""
    fields = df.schema.fields
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f.name)).alias(f"_nn{i}") for i, f in enumerate(fields)])
    structs = [
        F.struct(
            F.lit(i).cast("int").alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("spark_type"),
            F.col(f"_nn{i}").alias("non_null"),
            (F.col("_rows") - F.col(f"_nn{i}")).alias("nulls"),
        )
        for i, f in enumerate(fields)
    ]
    return agg.select(F.inline(F.array(*structs)))


def value_counts(df: DataFrame, col: str, order: str = "count", top: int | None = None,
                 with_log: bool = False) -> DataFrame:
    """Frequency of each non-null value: (value, count[, log_count]); ``order`` is
    "count" (descending, ties by value) or "value" (ascending)."""
    out = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if with_log:
        out = out.withColumn("log_count", F.ln(F.col("count").cast("double")))
    out = out.orderBy(F.desc("count"), F.asc(col)) if order == "count" else out.orderBy(col)
    return out.limit(top) if top else out


def distinct_levels(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Number of distinct non-null values per column, in one aggregate; ``exact=False``
    uses HyperLogLog++ (bounded memory on very high-cardinality columns)."""
    f = F.count_distinct if exact else (lambda c: F.approx_count_distinct(c, 0.01))
    agg = df.agg(*[f(F.col(c)).alias(f"_d{i}") for i, c in enumerate(cols)])
    return _stack(agg, cols, {"n_levels": [F.col(f"_d{i}").cast("bigint") for i in range(len(cols))]})


def subset_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Row counts of several predicate-defined subsets in one pass: (subset, count)."""
    names = list(rules)
    agg = df.agg(*[F.count_if(rules[n]).alias(f"_s{i}") for i, n in enumerate(names)])
    structs = [F.struct(F.lit(n).alias("subset"), F.col(f"_s{i}").cast("bigint").alias("count")) for i, n in enumerate(names)]
    return agg.select(F.inline(F.array(*structs)))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per-column null count and an any-null flag."""
    cols = list(cols or df.columns)
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    return _stack(
        agg,
        cols,
        {
            "null_count": [F.col(f"_n{i}").cast("bigint") for i in range(len(cols))],
            "has_nulls": [F.col(f"_n{i}") > 0 for i in range(len(cols))],
        },
    )


def shares(df: DataFrame, segments: Mapping[str, Column], chart: str = "pie") -> DataFrame:
    """Composition of named (possibly overlapping) segments: (chart, segment, position,
    count, share, base) where share is count / total of the listed segments and base is
    the running total of the segments before it (a stacked bar's bottom)."""
    names = list(segments)
    counts = subset_counts(df, segments).withColumn("position", F.array_position(F.array(*[F.lit(n) for n in names]), F.col("subset")).cast("int"))
    # Few rows (one per listed segment): a global window is fine here.
    w_all = Window.partitionBy(F.lit(chart))
    w_run = w_all.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        F.lit(chart).alias("chart"),
        F.col("subset").alias("segment"),
        "position",
        "count",
        F.try_divide(F.col("count"), F.sum("count").over(w_all)).alias("share"),
        F.coalesce(F.sum("count").over(w_run), F.lit(0)).cast("bigint").alias("base"),
    )


def shares_by_chart(df: DataFrame, charts: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """:func:`shares` for several charts from ONE aggregate over ``df``: (chart, segment,
    position, count, share, base)."""
    flat = {f"{c}\u0001{s}": rule for c, segs in charts.items() for s, rule in segs.items()}
    pos = {f"{c}\u0001{s}": i + 1 for c, segs in charts.items() for i, s in enumerate(segs)}
    counts = subset_counts(df, flat)
    key = F.split(F.col("subset"), "\u0001")
    lookup = F.create_map(*[x for k, v in pos.items() for x in (F.lit(k), F.lit(v))])
    counts = counts.select(key[0].alias("chart"), key[1].alias("segment"),
                           F.element_at(lookup, F.col("subset")).cast("int").alias("position"), "count")
    # One row per listed segment: windows over a handful of rows.
    w_all = Window.partitionBy("chart")
    w_run = w_all.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        "chart", "segment", "position", "count",
        F.try_divide(F.col("count"), F.sum("count").over(w_all)).alias("share"),
        F.coalesce(F.sum("count").over(w_run), F.lit(0)).cast("bigint").alias("base"),
    )


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 % (exact, interpolated), max per column.

    One scan of the data: the columns are unpivoted to (column, value) and reduced to
    distinct (column, value, count) rows; quartiles, count, mean, min and max come from
    one aggregate over that table and the standard deviation from a second, centred one
    (sum of count * (value - mean)^2), both over distinct values only."""
    cols = list(cols)
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])).alias("_p")
    ).select("_p.*")
    cum = ranked_value_counts(long, "value", ["column"])
    q = quantiles_from_ranked(cum, [0.25, 0.5, 0.75], ["column"], names=["p25", "p50", "p75"])
    x, c = F.col("_x"), F.col("_c")
    first = cum.groupBy("column").agg(
        (F.sum(x * c) / F.sum(c)).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"))
    spread = cum.join(first.select("column", F.col("mean").alias("_m")), "column").groupBy("column").agg(
        F.sum(c * (x - F.col("_m")) * (x - F.col("_m"))).alias("_ss"))
    out = q.join(first, "column").join(spread, "column")
    names = F.array(*[F.lit(c) for c in cols])
    every = df.sparkSession.range(1).select(F.explode(names).alias("column"))  # columns with no values too
    out = every.join(out, "column", "left")
    return out.select(
        "column",
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("count"),
        "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("_ss") / (F.col("n") - 1))).alias("std"),
        "min", "p25", "p50", "p75", "max",
    )


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    agg = df.agg(*[F.min(c).cast("double").alias(f"_a{i}") for i, c in enumerate(cols)],
                 *[F.max(c).cast("double").alias(f"_b{i}") for i, c in enumerate(cols)])
    return _stack(agg, cols, {"min": [F.col(f"_a{i}") for i in range(len(cols))],
                              "max": [F.col(f"_b{i}") for i in range(len(cols))]})


def levels(df: DataFrame, col: str) -> DataFrame:
    """Distinct values including NULL (a set of a column, null kept)."""
    return df.select(col).distinct()


def categorical_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def columns_except_last(df: DataFrame) -> DataFrame:
    return df.select(df.columns[:-1])


def move_to_end(df: DataFrame, col: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c != col], col)
