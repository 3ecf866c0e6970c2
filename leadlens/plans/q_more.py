"""2-D bins, hexagonal bins, pair-plot bins, positional tables and number grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bins, clean
from ..operators.ordering import row_numbers
from ..sources.issues import issues
from .q_model import _SIMPLE, _simple, design
from .q_prep import _SERVE, _TR, LAB_CTE
from .registry import register, rounded, with_issues

TR = LAB_CTE + ",\n" + _TR


def _wb(expr: str, lo: str, hi: str, n: int) -> str:
    """SQL for Spark's least(width_bucket(x, lo, hi, n), n) - 1 (same operation order)."""
    return f"CASE WHEN {hi} = {lo} THEN 0 ELSE least(CAST(floor({n} * ({expr} - {lo}) / ({hi} - {lo})) AS BIGINT), {n - 1}) END"


@register(
    "hist2d_comments_vs_log_duration",
    with_issues(
        f"""SELECT {_wb('x', 'lx', 'hx', 20)} AS bx, {_wb('y', 'ly', 'hy', 20)} AS "by", CAST(count(*) AS BIGINT) AS count
FROM (SELECT comment_count AS x, log_duration AS y, min(comment_count) OVER () AS lx, max(comment_count) OVER () AS hx,
             min(log_duration) OVER () AS ly, max(log_duration) OVER () AS hy FROM tr)
GROUP BY 1, 2""",
        TR,
    ),
)
def hist2d_comments_vs_log_duration(spark, data_dir):
    """Counts on a 20 x 20 grid: ln(comments+1) against ln(minutes) (the scatter's table)."""
    _, enc, _ = design(spark, data_dir)
    return bins.hist2d(enc, "comment_count", "log_duration", nx=20, ny=20).select(
        F.col("bx").cast("bigint"), F.col("by").cast("bigint"), "count")


@register(
    "hexbin_comments_vs_log_duration",
    with_issues(
        f"""SELECT CAST(CASE WHEN dq > dr AND dq > ds THEN -r - s ELSE q END AS BIGINT) AS hq,
       CAST(CASE WHEN dq > dr AND dq > ds THEN r WHEN dr > ds THEN -q - s ELSE r END AS BIGINT) AS hr,
       CAST(count(*) AS BIGINT) AS count
FROM (SELECT q, r, s, abs(q - qf) AS dq, abs(r - rf) AS dr, abs(s - sf) AS ds
      FROM (SELECT qf, rf, -qf - rf AS sf, round(qf) AS q, round(rf) AS r, round(-qf - rf) AS s
            FROM (SELECT ({bins.HEX_Q!r}::DOUBLE * comment_count - log_duration / 3.0::DOUBLE) / 0.5::DOUBLE AS qf,
                         ({bins.HEX_R!r}::DOUBLE * log_duration) / 0.5::DOUBLE AS rf FROM tr)))
GROUP BY 1, 2""",
        TR,
    ),
)
def hexbin_comments_vs_log_duration(spark, data_dir):
    """Hexagonal-bin counts (size 0.5) of ln(comments+1) against ln(minutes)."""
    _, enc, _ = design(spark, data_dir)
    return bins.hexbin(enc, "comment_count", "log_duration", 0.5)


_PAIR = ["vote_count", "comment_count", "watch_count", "log_duration"]


def _pair_sql() -> str:
    rng = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _PAIR)
    binned = ", ".join(f"{_wb(c, f'lo_{c}', f'hi_{c}', 10)} AS {c}" for c in _PAIR)
    parts = []
    for a in _PAIR:
        for b in _PAIR:
            yb = b if a != b else "0"
            parts.append(f"SELECT '{a}' AS x_col, '{b}' AS y_col, {a} AS bx, {yb} AS \"by\" FROM b")
    return with_issues(
        "SELECT x_col, y_col, CAST(bx AS BIGINT) AS bx, CAST(\"by\" AS BIGINT) AS \"by\", CAST(count(*) AS BIGINT) AS count FROM ("
        + "\nUNION ALL\n".join(parts) + ") GROUP BY 1, 2, 3, 4",
        TR + f",\nrg AS (SELECT {rng} FROM tr),\nb AS (SELECT {binned} FROM tr, rg)",
    )


@register("pair_plot_bins", _pair_sql())
def pair_plot_bins(spark, data_dir):
    """Pair-plot table of the log counts and ln(minutes): 10 x 10 bins per pair, 1-D
    histograms on the diagonal."""
    _, enc, _ = design(spark, data_dir)
    out = bins.pair_bins(enc, _PAIR, 10)
    return out.select("x_col", "y_col", F.col("bx").cast("bigint"), F.col("by").cast("bigint"), "count")


@register(
    "simple_ols_fitted_by_position",
    with_issues(
        """SELECT CAST(row_number() OVER (ORDER BY key) AS BIGINT) AS position, key, round(log_duration, 6) AS actual,
       round(b0 + b1 * comment_count, 6) AS fitted
FROM trs, co WHERE is_train""",
        _SIMPLE,
    ),
)
def simple_ols_fitted_by_position(spark, data_dir):
    """Actual and fitted values along the training rows in key order (the x axis of an
    actual-vs-fitted line plot)."""
    fit, train, _ = _simple(spark, data_dir)
    t = train.select("key", F.col("log_duration").alias("actual"), fit.prediction().alias("fitted"))
    return rounded(row_numbers(t, ["key"], col="position").select(
        F.col("position").cast("bigint"), "key", "actual", "fitted"))


# The positions of the issues examined one by one in the case study.
CASE_POSITIONS = [77, 113, 120, 231, 235, 243, 321]


@register(
    "open_issue_rows_at_positions",
    with_issues(
        f"""SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY created, key) - 1 AS BIGINT) AS position, key, status,
       priority, issue_type, reporter, assignee, vote_count, comment_count, watch_count
  FROM issues WHERE NOT (resolutiondate IS NOT NULL AND created IS NOT NULL))
WHERE position IN ({', '.join(str(p) for p in CASE_POSITIONS)})"""
    ),
)
def open_issue_rows_at_positions(spark, data_dir):
    """Open issues renumbered in (created, key) order and fetched at chosen positions."""
    _, op = clean.split_labelled(issues(spark, data_dir))
    numbered = row_numbers(op, ["created", "key"], col="_rn").withColumn("position", (F.col("_rn") - 1).cast("bigint"))
    return numbered.where(F.col("position").isin(*CASE_POSITIONS)).select(
        "position", "key", "status", "priority", "issue_type", "reporter", "assignee", "vote_count", "comment_count",
        "watch_count")


@register(
    "numeric_predictors",
    with_issues(
        """SELECT vote_count AS x_vote_count, comment_count AS x_comment_count, description_length AS x_description_length,
       summary_length AS x_summary_length, watch_count AS x_watch_count FROM lab""",
        LAB_CTE,
    ),
)
def numeric_predictors(spark, data_dir):
    """Numeric columns picked by type (identifiers and the day count excluded), the
    target moved last, every column but the last kept, then renamed with an ``x_``
    prefix: the predictor matrix of the labelled issues."""
    from ..operators import profile

    lab = clean.add_duration(clean.split_labelled(issues(spark, data_dir))[0])
    num = profile.numeric_columns(lab, exclude=["key", "days_in_current_status", "duration_days"])
    table = profile.move_to_end(lab.select(*num), "duration_min")
    x = profile.columns_except_last(table)
    return x.toDF(*[f"x_{c}" for c in x.columns])


@register(
    "serving_missing_columns",
    with_issues(
        f"""SELECT lv.c || '_' || lv.v AS feature FROM lv
WHERE NOT EXISTS (SELECT 1 FROM (
    SELECT 'priority' AS c, priority AS v FROM op UNION SELECT 'issue_type', issue_type FROM op
    UNION SELECT 'reporter', reporter FROM op) s WHERE s.c = lv.c AND s.v = lv.v)""",
        TR + ",\n" + _SERVE,
    ),
)
def serving_missing_columns(spark, data_dir):
    """Training design columns that the open issues' own level values would not produce
    (the columns the serving side fills with 0)."""
    from ..operators import encode

    model, _, _ = design(spark, data_dir)
    _, op = clean.split_labelled(issues(spark, data_dir))
    # every stage but the dummy encoder: reduced levels as the encoder would see them
    enc = [s for s in model.stages if isinstance(s, encode.DummyEncoderModel)][0]
    served = clean.feature_table(op, target=None)
    for st in model.stages:
        if st is not enc:
            served = st.transform(served)
    pairs = enc.pairs()
    present = served.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in enc.getOrDefault("inputCols")
    ])).alias("p")).select("p.*").distinct()
    wanted = spark.createDataFrame([(c, v) for c, v in pairs], "c string, v string")
    return wanted.join(present, ["c", "v"], "left_anti").select(F.concat_ws("_", "c", "v").alias("feature"))


@register(
    "box_event_gap_minutes",
    """WITH g AS (SELECT CAST(date_sub('minute', ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS DOUBLE) AS x
             FROM events),
d AS (SELECT x FROM g WHERE x IS NOT NULL),
st AS (SELECT CAST(count(x) AS BIGINT) AS n, round(avg(x), 6) AS mean, round(min(x), 6) AS min,
              round(quantile_cont(x, 0.25), 6) AS q1, round(quantile_cont(x, 0.5), 6) AS median,
              round(quantile_cont(x, 0.75), 6) AS q3, round(max(x), 6) AS max,
              round(quantile_cont(x, 0.75) - quantile_cont(x, 0.25), 6) AS iqr,
              quantile_cont(x, 0.25) AS q1r, quantile_cont(x, 0.75) AS q3r FROM d)
SELECT st.n, st.mean, st.min, st.q1, st.median, st.q3, st.max, st.iqr,
       round(min(CASE WHEN d.x >= st.q1r - 1.5 * (st.q3r - st.q1r) THEN d.x END), 6) AS lower_whisker,
       round(max(CASE WHEN d.x <= st.q3r + 1.5 * (st.q3r - st.q1r) THEN d.x END), 6) AS upper_whisker,
       CAST(count_if(d.x < st.q1r - 1.5 * (st.q3r - st.q1r) OR d.x > st.q3r + 1.5 * (st.q3r - st.q1r)) AS BIGINT) AS n_outliers
FROM d CROSS JOIN st
GROUP BY st.n, st.mean, st.min, st.q1, st.median, st.q3, st.max, st.iqr""",
)
def box_event_gap_minutes(spark, data_dir):
    """Box statistics of sub-day durations: minutes between a user's consecutive events
    (zero-minute gaps included, the open last gap of each user excluded)."""
    from ..sources.issues import event_gaps

    return rounded(bins.box_stats(clean.add_duration(event_gaps(spark, data_dir)), "duration_min"))
