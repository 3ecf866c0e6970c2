"""Bivariate tables over every predictor, grouping and scale, each family from one scan; and the
tables of whole designs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import bins, clean, crosstab, cube, encode, levels, modeling_data, profile, split
from ..session import write_and_read
from ..sources.issues import ISSUE_SCHEMA, issues
from .q_more import _wb
from .q_prep import _SHORT_SQL, _TR, LAB_CTE, _long_sql
from .q_profile import _PAIR_SQL
from .registry import register, rounded, with_issues
from .shared import SHORT_TYPES, design, memo

RAW = ["vote_count", "comment_count", "description_length", "summary_length", "watch_count", "duration_min"]
LOG = [*RAW[:-1], "log_duration"]
TR = LAB_CTE + ",\n" + _TR
# The feature table on both scales, as the SQL side sees it.
_SCALES = {"raw": (RAW, f"(SELECT {', '.join(c for c in RAW if c != 'description_length')}, coalesce(description_length, 0) AS description_length FROM tgt)"),
           "log": (LOG, "tr")}


def _scale(spark, data_dir, scale):
    """The labelled rows' predictors and target, raw or logarithmic."""
    lab = modeling_data.labelled_with_target(issues(spark, data_dir))
    raw = clean.feature_table(lab, target="duration_min")
    return raw.select(*RAW) if scale == "raw" else clean.log_transform(raw).select(*LOG)


def _cube(spark, data_dir, scale, n):
    return memo(spark, data_dir, f"cube_{scale}_{n}", lambda: cube.BinCube.fit(_scale(spark, data_dir, scale), _SCALES[scale][0], n))


def _ranged(scale: str, n: int) -> str:
    cols, src = _SCALES[scale]
    rng = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in cols)
    placed = ", ".join(f"{_wb(f'CAST({c} AS DOUBLE)', f'lo_{c}', f'hi_{c}', n)} AS {c}" for c in cols)
    return f"{scale}_b AS (SELECT {placed} FROM {src} s, (SELECT {rng} FROM {src}) r)"


def _pairs_sql(wanted: list[tuple[str, str, str]], n: int) -> str:
    parts = [f"SELECT '{s}' AS scale, '{a}' AS x_col, '{b}' AS y_col, CAST({a} AS BIGINT) AS bx, CAST({b if a != b else 0} AS BIGINT) AS \"by\" FROM {s}_b"
             for s, a, b in wanted]
    body = "SELECT scale, x_col, y_col, bx, \"by\", CAST(count(*) AS BIGINT) AS count FROM (" + "\nUNION ALL\n".join(parts) + ") GROUP BY ALL"
    return with_issues(body, TR + ",\n" + ",\n".join(_ranged(s, n) for s in _SCALES))


def _both(spark, data_dir, n, take):
    raw, log = (take(_cube(spark, data_dir, s, n), s).select(F.lit(s).alias("scale"), "x_col", "y_col", "bx", "by", "count") for s in _SCALES)
    return raw.unionAll(log)


@register("scatter_tables", _pairs_sql([(s, c, cols[-1]) for s, (cols, _) in _SCALES.items() for c in cols[:-1]], 20))
def scatter_tables(spark, data_dir):
    """Each of the five numeric predictors against the target, raw and logarithmic: ten 20 x 20
    tables, projected from one joint histogram a scale."""
    return _both(spark, data_dir, 20, lambda k, s: k.scatter([(c, k.columns[-1]) for c in k.columns[:-1]]))


@register("pair_plot_tables", _pairs_sql([(s, a, b) for s, (cols, _) in _SCALES.items() for a in cols for b in cols], 10))
def pair_plot_tables(spark, data_dir):
    """The pair plots of the predictors and the target, raw and logarithmic: 10 x 10 cells a pair,
    histograms on the diagonal."""
    return _both(spark, data_dir, 10, lambda k, s: k.pair_plot())


@register("hist_all_columns", with_issues(
    "\nUNION ALL\n".join(
        f"""SELECT '{s}' AS scale, '{c}' AS x_col, CAST(b.{c} AS BIGINT) AS bin, round(any_value(lo + b.{c} * (hi - lo) / 10), 6) AS lo,
       round(any_value(lo + (b.{c} + 1) * (hi - lo) / 10), 6) AS hi, CAST(count(*) AS BIGINT) AS count
FROM {s}_b b, (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM {src}) r GROUP BY b.{c}"""
        for s, (cols, src) in _SCALES.items() for c in cols), TR + ",\n" + ",\n".join(_ranged(s, 10) for s in _SCALES)))
def hist_all_columns(spark, data_dir):
    """Ten-bin histograms of every numeric predictor and the target, raw and logarithmic."""
    raw, log = (_cube(spark, data_dir, s, 10).histograms().select(F.lit(s).alias("scale"), "x_col", "bin", "lo", "hi", "count") for s in _SCALES)
    return rounded(raw.unionAll(log))


_HEX = [(c, "duration_min") for c in RAW[:-1]]


def _hex_sql() -> str:
    one = """SELECT '{x}' AS x_col, '{y}' AS y_col, 15.0::DOUBLE * (CAST({x} AS DOUBLE) - lx) / (hx - lx) AS x, 15.0::DOUBLE * (CAST({y} AS DOUBLE) - ly) / (hy - ly) AS y
FROM {src} s, (SELECT min({x}) AS lx, max({x}) AS hx, min({y}) AS ly, max({y}) AS hy FROM {src}) r"""
    pts = "\nUNION ALL\n".join(one.format(x=x, y=y, src=_SCALES["raw"][1]) for x, y in _HEX)
    return with_issues(
        f"""SELECT x_col, y_col, CAST(CASE WHEN dq > dr AND dq > ds THEN -r - s ELSE q END AS BIGINT) AS hq,
       CAST(CASE WHEN dq > dr AND dq > ds THEN r WHEN dr > ds THEN -q - s ELSE r END AS BIGINT) AS hr, CAST(count(*) AS BIGINT) AS count
FROM (SELECT x_col, y_col, q, r, s, abs(q - qf) AS dq, abs(r - rf) AS dr, abs(s - sf) AS ds
      FROM (SELECT x_col, y_col, qf, rf, -qf - rf AS sf, round(qf) AS q, round(rf) AS r, round(-qf - rf) AS s
            FROM (SELECT x_col, y_col, ({bins.HEX_Q!r}::DOUBLE * x - y / 3.0::DOUBLE) / 1.0::DOUBLE AS qf, ({bins.HEX_R!r}::DOUBLE * y) / 1.0::DOUBLE AS rf FROM pts)))
GROUP BY ALL""", TR + f",\npts AS ({pts})")


@register("hexagon_tables", _hex_sql())
def hexagon_tables(spark, data_dir):
    """Hexagonal bins, 15 across the range, of every numeric predictor against the target."""
    return cube.hexagons(_scale(spark, data_dir, "raw"), _HEX, 15)


# ---------------------------------------------------------------- categorical groupings
# The priorities that the derived data counts as pressing.
URGENT = ["1-URGENT", "2-HIGH"]
_GROUPS_SQL = f"""gr AS (SELECT *, coalesce(description_length, 0) AS d0,
       CASE WHEN issue_type IN ({_SHORT_SQL}) THEN 'Short' ELSE 'Long' END AS type_reduced,
       CASE WHEN priority IN ('1-URGENT', '2-HIGH') THEN 'Major' ELSE 'Minor' END AS priority_reduced,
       CASE WHEN reporter IN (SELECT reporter FROM tgt GROUP BY reporter
                              HAVING count(*) > (SELECT count(*) // count(DISTINCT reporter) FROM tgt)) THEN reporter ELSE 'Other' END AS reporter_reduced
       FROM tgt)"""
_GROUPINGS = {"issue_type": "issue_type", "priority": "priority", "reporter": "reporter", "issue_type_reduced": "type_reduced",
              "priority_reduced": "priority_reduced", "reporter_reduced": "reporter_reduced"}


def _grouped(spark, data_dir):
    """(labelled rows with their reduced reporter, level of each grouping): a reporter is kept if it
    has more issues than the mean of all reporters."""
    lab = modeling_data.labelled_with_target(issues(spark, data_dir)).select(
        "priority", "issue_type", "reporter", F.col("reporter").alias("reporter_reduced"), "duration_min", "duration_days", "log_duration")
    n, k = lab.agg(F.count(F.lit(1)), F.count_distinct("reporter")).first()
    kept = write_and_read(levels.frequent_levels(lab, "reporter", n // max(1, k)), "levels")
    return levels.keep_levels(lab, "reporter_reduced", kept, "Other"), {
        "issue_type": F.col("issue_type"), "priority": F.col("priority"), "reporter": F.col("reporter"),
        "issue_type_reduced": S.two_groups("issue_type", SHORT_TYPES, "Short", "Long"),
        "priority_reduced": S.two_groups("priority", URGENT, "Major", "Minor"),
        "reporter_reduced": F.col("reporter_reduced")}


def _cells_sql(targets: dict[str, str]) -> str:
    return "cells AS (" + "\nUNION ALL\n".join(
        f"SELECT '{g}' AS grouping, {c} AS level, '{t}' AS target, CAST({e} AS DOUBLE) AS x FROM gr"
        for g, c in _GROUPINGS.items() for t, e in targets.items()) + ")"


@register("box_all_groupings", with_issues(
    """SELECT c.grouping, c.level, c.target, CAST(count(*) AS BIGINT) AS n, round(avg(x), 6) AS mean, round(min(x), 6) AS min, round(any_value(q1), 6) AS q1,
       round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3, round(max(x), 6) AS max, round(any_value(q3 - q1), 6) AS iqr,
       round(min(x) FILTER (x >= q1 - 1.5 * (q3 - q1)), 6) AS lower_whisker, round(max(x) FILTER (x <= q3 + 1.5 * (q3 - q1)), 6) AS upper_whisker,
       CAST(count(*) FILTER (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers
FROM cells c JOIN (SELECT grouping, level, target, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3
                   FROM cells GROUP BY ALL) q ON c.grouping = q.grouping AND c.level = q.level AND c.target = q.target
GROUP BY c.grouping, c.level, c.target""",
    TR + ",\n" + _GROUPS_SQL + ",\n" + _cells_sql({"duration_min": "duration_min", "log_duration": "ln(duration_min)"})))
def box_all_groupings(spark, data_dir):
    """Box statistics of the target, raw and logarithmic, by issue type, priority and reporter, with
    all levels and reduced: twelve breakdowns from one scan and one ranking."""
    df, groupings = _grouped(spark, data_dir)
    return rounded(cube.boxes_by(cube.value_counts_by(df, groupings, {c: F.col(c) for c in ("duration_min", "log_duration")})))


@register("duration_shares_all_groupings", with_issues(
    """SELECT grouping, level, target, x AS value, CAST(count(*) AS BIGINT) AS n,
       round(count(*) / sum(count(*)) OVER (PARTITION BY grouping, level, target), 6) AS share FROM cells GROUP BY grouping, level, target, x""",
    TR + ",\n" + _GROUPS_SQL + ",\n" + _cells_sql({"duration_days": "duration_days"})))
def duration_shares_all_groupings(spark, data_dir):
    """The share of each duration in whole days within every level of every grouping."""
    df, groupings = _grouped(spark, data_dir)
    return rounded(cube.shares_by(cube.value_counts_by(df, groupings, {"duration_days": F.col("duration_days")})))


@register("top_reporters", with_issues(
    "SELECT reporter, CAST(count(*) AS BIGINT) AS count FROM lab WHERE reporter IS NOT NULL GROUP BY reporter ORDER BY count DESC, reporter LIMIT 40", LAB_CTE))
def top_reporters(spark, data_dir):
    """The 40 reporters with the most labelled issues."""
    lab, _ = clean.split_labelled(issues(spark, data_dir))
    return profile.value_counts(lab, "reporter").orderBy(F.desc("count"), "reporter").limit(40)


@register("assignee_reporter_wide", with_issues(
    """SELECT assignee, coalesce(COLUMNS(* EXCLUDE (assignee)), 0) FROM (PIVOT pairs ON reporter USING CAST(sum(n) AS BIGINT) GROUP BY assignee)""", _PAIR_SQL))
def assignee_reporter_wide(spark, data_dir):
    """The matrix of the 30 largest assignee-reporter pairs, a column per reporter, by total."""
    labelled, _ = clean.split_labelled(issues(spark, data_dir))
    return crosstab.crosstab_wide(crosstab.pair_counts(labelled, "assignee", "reporter", top=30), "assignee", "reporter")


_TEXT = [f.name for f in ISSUE_SCHEMA.fields if f.dataType.simpleString() == "string"]


@register("categorical_profile", with_issues("\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS n_levels FROM issues" for c in _TEXT)))
def categorical_profile(spark, data_dir):
    """The columns picked by text type, with their numbers of levels."""
    df = issues(spark, data_dir)
    return profile.distinct_levels(df, profile.categorical_columns(df))


@register("elapsed_intervals", with_issues(
    """SELECT key, CAST(epoch(resolutiondate - created) AS BIGINT) AS seconds, round(epoch(resolutiondate - created) / 60 / nullif(comment_count, 0), 6) AS minutes_per_comment,
       round(100.0 * (duration_min - mean) / mean, 6) AS pct_from_mean FROM lab, (SELECT avg(duration_min) AS mean FROM lab) m""", LAB_CTE))
def elapsed_intervals(spark, data_dir):
    """The exact time to resolution as an interval (its seconds), minutes per comment, and the
    change in per cent from the mean time."""
    lab = clean.add_duration(clean.split_labelled(issues(spark, data_dir))[0])
    mean = lab.agg(F.avg("duration_min")).first()[0]
    seconds = F.expr("cast(extract(DAY FROM gap) * 86400 + extract(HOUR FROM gap) * 3600 + extract(MINUTE FROM gap) * 60 + floor(extract(SECOND FROM gap)) AS bigint)")
    out = lab.withColumn("gap", S.duration_interval("created", "resolutiondate")).withColumn("seconds", seconds)
    return rounded(out.select("key", "seconds", S.ratio(F.col("seconds") / F.lit(60), "comment_count").alias("minutes_per_comment"),
                              S.pct_change("duration_min", F.lit(mean)).alias("pct_from_mean")))


# ---------------------------------------------------------------- whole designs
@register("describe_design", with_issues(
    """SELECT feature AS "column", CAST(count(value) AS BIGINT) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
       round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS max
FROM dl GROUP BY feature""", TR + f",\ndl AS ({_long_sql('tr', False).replace('round(', 'round(1.0 * ').replace(', 6) AS value', ', 15) AS value')})"))
def describe_design(spark, data_dir):
    """Count, mean, deviation, quartiles and extremes of every predictor of the encoded design."""
    _, enc, feats = design(spark, data_dir)
    return rounded(profile.describe(enc, feats))


@register("minmax_design_long", with_issues(
    f"""SELECT key, dl.feature, round((value - lo) / (hi - lo), 6) AS value
FROM dl JOIN (SELECT feature, min(value) AS lo, max(value) AS hi FROM dl WHERE {{bucket}} < 75 GROUP BY feature) m ON dl.feature = m.feature
WHERE {{bucket}} >= 75""".format(bucket="('0x' || substr(md5(CAST(key AS VARCHAR)), 1, 8))::BIGINT % 100"),
    TR + f",\ndl AS ({_long_sql('tr', False).replace('round(', 'round(1.0 * ').replace(', 6) AS value', ', 15) AS value')})"))
def minmax_design_long(spark, data_dir):
    """All predictors scaled to [0, 1] by the ranges of the 75 % training part, for the test part."""
    _, enc, feats = design(spark, data_dir)
    train, test = split.train_test(enc, "key", 75)
    scaled = encode.MinMaxScaling(inputCols=feats).fit(train).transform(test)
    return rounded(modeling_data.to_long(scaled.select("key", *[S.named(f) for f in feats])))
