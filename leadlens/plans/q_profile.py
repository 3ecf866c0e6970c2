"""Profiling queries over the issue table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bins, clean, crosstab, profile
from ..sources.issues import ISSUE_SCHEMA, issues
from ..sources.tables import table
from .registry import register, rounded, with_issues


def resolved_with_minutes(spark, data_dir):
    lab, _ = clean.split_labelled(issues(spark, data_dir))
    return clean.add_duration(lab)


_BOX_SQL_COLS = """
  CAST(count(x) AS BIGINT) AS n, round(avg(x), 6) AS mean, round(min(x), 6) AS min,
  round(quantile_cont(x, 0.25), 6) AS q1, round(quantile_cont(x, 0.5), 6) AS median,
  round(quantile_cont(x, 0.75), 6) AS q3, round(max(x), 6) AS max,
  round(quantile_cont(x, 0.75) - quantile_cont(x, 0.25), 6) AS iqr"""


def _box_sql(by: str | None) -> str:
    g = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    join = f"JOIN st ON d.{by} IS NOT DISTINCT FROM st.{by}" if by else "CROSS JOIN st"
    sel_by = f"st.{by}, " if by else ""
    return with_issues(
        f"""
SELECT {sel_by}st.n, st.mean, st.min, st.q1, st.median, st.q3, st.max, st.iqr,
       round(min(CASE WHEN d.x >= st.q1r - 1.5 * st.iqrr THEN d.x END), 6) AS lower_whisker,
       round(max(CASE WHEN d.x <= st.q3r + 1.5 * st.iqrr THEN d.x END), 6) AS upper_whisker,
       CAST(count_if(d.x < st.q1r - 1.5 * st.iqrr OR d.x > st.q3r + 1.5 * st.iqrr) AS BIGINT) AS n_outliers
FROM d {join}
GROUP BY {sel_by}st.n, st.mean, st.min, st.q1, st.median, st.q3, st.max, st.iqr""",
        f"""d AS (SELECT {g}CAST(date_sub('minute', created, resolutiondate) AS DOUBLE) AS x
      FROM issues WHERE resolutiondate IS NOT NULL AND created IS NOT NULL),
st AS (SELECT {g}{_BOX_SQL_COLS},
       quantile_cont(x, 0.25) AS q1r, quantile_cont(x, 0.75) AS q3r,
       quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqrr
      FROM d {grp})""",
    )


@register("box_duration_by_issue_type", _box_sql("issue_type"))
def box_duration_by_issue_type(spark, data_dir):
    """Box statistics of resolution minutes per issue type (flagship)."""
    return rounded(bins.box_stats(resolved_with_minutes(spark, data_dir), "duration_min", ["issue_type"]))


@register("box_duration_by_priority", _box_sql("priority"))
def box_duration_by_priority(spark, data_dir):
    return rounded(bins.box_stats(resolved_with_minutes(spark, data_dir), "duration_min", ["priority"]))


@register("box_duration", _box_sql(None))
def box_duration(spark, data_dir):
    return rounded(bins.box_stats(resolved_with_minutes(spark, data_dir), "duration_min"))


# ---------------------------------------------------------------- shape and frequencies

LABELLED = "resolutiondate IS NOT NULL AND created IS NOT NULL"


@register("issue_count", with_issues("SELECT CAST(count(*) AS BIGINT) AS n_rows FROM issues"))
def issue_count(spark, data_dir):
    return issues(spark, data_dir).agg(F.count(F.lit(1)).alias("n_rows"))


def _table_profile_sql() -> str:
    parts = []
    for i, f in enumerate(ISSUE_SCHEMA.fields):
        parts.append(
            f"SELECT CAST({i} AS INTEGER) AS position, '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS spark_type, "
            f"CAST(count({f.name}) AS BIGINT) AS non_null, CAST(count(*) - count({f.name}) AS BIGINT) AS nulls FROM issues"
        )
    return with_issues("\nUNION ALL\n".join(parts))


@register("table_profile", _table_profile_sql())
def table_profile(spark, data_dir):
    return profile.table_profile(issues(spark, data_dir))


def _vc_sql(col: str) -> str:
    return with_issues(
        f"SELECT {col}, CAST(count(*) AS BIGINT) AS count FROM issues WHERE {col} IS NOT NULL GROUP BY {col}"
    )


def _vc(col):
    def run(spark, data_dir):
        return profile.value_counts(issues(spark, data_dir), col)

    return run


for _c in ["status", "priority", "issue_type", "resolution", "reporter", "assignee"]:
    register(f"value_counts_{_c}", _vc_sql(_c))(_vc(_c))


def _vc_log_sql(col: str) -> str:
    return with_issues(
        f"SELECT {col}, CAST(count(*) AS BIGINT) AS count, round(ln(count(*)), 6) AS log_count "
        f"FROM issues WHERE {col} IS NOT NULL GROUP BY {col}"
    )


def _vc_log(col):
    def run(spark, data_dir):
        return rounded(profile.value_counts(issues(spark, data_dir), col, order="value", with_log=True))

    return run


for _c in ["vote_count", "comment_count", "watch_count", "summary_length", "description_length"]:
    register(f"value_counts_{_c}", _vc_log_sql(_c))(_vc_log(_c))

_CATEGORICAL = ["status", "priority", "issue_type", "reporter", "project", "assignee", "resolution"]


@register(
    "distinct_levels",
    with_issues(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS n_levels FROM issues" for c in _CATEGORICAL
        )
    ),
)
def distinct_levels(spark, data_dir):
    return profile.distinct_levels(issues(spark, data_dir), _CATEGORICAL)


def closure_rules():
    st, res, asg = F.col("status"), F.col("resolution"), F.col("assignee")
    not_fixed = ~res.eqNullSafe("Fixed")  # NULL resolution counts as "not Fixed"
    return {
        "closed": st == "Closed",
        "closed_unassigned": (st == "Closed") & asg.isNull(),
        "closed_unassigned_fixed": (st == "Closed") & asg.isNull() & (res == "Fixed"),
        "resolved": st == "Resolved",
        "fixed": res == "Fixed",
        "closed_or_resolved": st.isin("Closed", "Resolved"),
        "closed_not_fixed": (st == "Closed") & not_fixed,
        "resolved_not_fixed": (st == "Resolved") & not_fixed,
        "labelled": F.col("resolutiondate").isNotNull() & F.col("created").isNotNull(),
        "open": ~(F.col("resolutiondate").isNotNull() & F.col("created").isNotNull()),
    }


_CLOSURE_SQL = {
    "closed": "status = 'Closed'",
    "closed_unassigned": "status = 'Closed' AND assignee IS NULL",
    "closed_unassigned_fixed": "status = 'Closed' AND assignee IS NULL AND resolution = 'Fixed'",
    "resolved": "status = 'Resolved'",
    "fixed": "resolution = 'Fixed'",
    "closed_or_resolved": "status IN ('Closed', 'Resolved')",
    "closed_not_fixed": "status = 'Closed' AND resolution IS DISTINCT FROM 'Fixed'",
    "resolved_not_fixed": "status = 'Resolved' AND resolution IS DISTINCT FROM 'Fixed'",
    "labelled": LABELLED,
    "open": f"NOT ({LABELLED})",
}


@register(
    "closure_subsets",
    with_issues(
        "\nUNION ALL\n".join(
            f"SELECT '{k}' AS subset, CAST(count_if({v}) AS BIGINT) AS count FROM issues" for k, v in _CLOSURE_SQL.items()
        )
    ),
)
def closure_subsets(spark, data_dir):
    return profile.subset_counts(issues(spark, data_dir), closure_rules())


@register(
    "null_counts",
    with_issues(
        "\nUNION ALL\n".join(
            f"SELECT '{f.name}' AS \"column\", CAST(count_if({f.name} IS NULL) AS BIGINT) AS null_count, "
            f"count_if({f.name} IS NULL) > 0 AS has_nulls FROM issues"
            for f in ISSUE_SCHEMA.fields
        )
    ),
)
def null_counts(spark, data_dir):
    return profile.null_profile(issues(spark, data_dir))


def _composition(df):
    r = closure_rules()
    return rounded(profile.shares_by_chart(df, {
        "resolution": {"Fixed": F.col("resolution") == "Fixed", "AllOthers-closed": r["closed_not_fixed"],
                       "AllOthers-resolved": r["resolved_not_fixed"]},
        "status": {"Closed": r["closed"], "Resolved": r["resolved"]},
    }))


def _composition_sql() -> str:
    segs = [
        ("resolution", "Fixed", 1, "resolution = 'Fixed'"),
        ("resolution", "AllOthers-closed", 2, _CLOSURE_SQL["closed_not_fixed"]),
        ("resolution", "AllOthers-resolved", 3, _CLOSURE_SQL["resolved_not_fixed"]),
        ("status", "Closed", 1, _CLOSURE_SQL["closed"]),
        ("status", "Resolved", 2, _CLOSURE_SQL["resolved"]),
    ]
    c = "\nUNION ALL\n".join(
        f"SELECT '{ch}' AS chart, '{s}' AS segment, CAST({p} AS INTEGER) AS position, CAST(count_if({w}) AS BIGINT) AS count FROM issues"
        for ch, s, p, w in segs
    )
    return with_issues(
        """SELECT chart, segment, position, count,
       round(count / sum(count) OVER (PARTITION BY chart), 6) AS share,
       CAST(coalesce(sum(count) OVER (PARTITION BY chart ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS base
FROM c""",
        f"c AS ({c})",
    )


@register("resolution_composition", _composition_sql())
def resolution_composition(spark, data_dir):
    return _composition(issues(spark, data_dir))


_NUMERIC = ["vote_count", "comment_count", "description_length", "summary_length", "watch_count"]


def _describe_sql() -> str:
    parts = []
    for c in _NUMERIC:
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
            f"round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
            f"round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM lab"
        )
    return with_issues("\nUNION ALL\n".join(parts), f"lab AS (SELECT * FROM issues WHERE {LABELLED})")


@register("describe_numeric", _describe_sql())
def describe_numeric(spark, data_dir):
    lab, _ = clean.split_labelled(issues(spark, data_dir))
    return rounded(profile.describe(lab, _NUMERIC))


@register(
    "numeric_min_max",
    with_issues(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM issues"
            for c in _NUMERIC
        )
    ),
)
def numeric_min_max(spark, data_dir):
    return profile.min_max(issues(spark, data_dir), _NUMERIC)


@register(
    "closed_resolution_levels",
    with_issues("SELECT DISTINCT resolution FROM issues WHERE status = 'Closed'"),
)
def closed_resolution_levels(spark, data_dir):
    """Distinct resolutions among closed issues, NULL kept."""
    return profile.levels(issues(spark, data_dir).where(F.col("status") == "Closed"), "resolution")


@register(
    "open_status_levels",
    with_issues(f"SELECT DISTINCT status FROM issues WHERE NOT ({LABELLED})"),
)
def open_status_levels(spark, data_dir):
    _, op = clean.split_labelled(issues(spark, data_dir))
    return profile.levels(op, "status")


# ---------------------------------------------------------------- crosstabs
_PAIR_SQL = """pairs AS (SELECT assignee, reporter, CAST(count(*) AS BIGINT) AS n FROM issues
  WHERE resolutiondate IS NOT NULL AND assignee IS NOT NULL AND reporter IS NOT NULL GROUP BY assignee, reporter
  ORDER BY n DESC, assignee, reporter LIMIT 30)"""


@register("assignee_reporter_top_pairs", with_issues("SELECT * FROM pairs", _PAIR_SQL))
def assignee_reporter_top_pairs(spark, data_dir):
    labelled, _ = clean.split_labelled(issues(spark, data_dir))
    return crosstab.pair_counts(labelled, "assignee", "reporter", top=30)


@register(
    "assignee_reporter_matrix",
    with_issues(
        """SELECT p.reporter, p.assignee, p.n, t.col_rank FROM pairs p JOIN
  (SELECT reporter, CAST(row_number() OVER (ORDER BY sum(n) DESC, reporter) AS INTEGER) AS col_rank
   FROM pairs GROUP BY reporter) t ON p.reporter = t.reporter
WHERE t.col_rank <= 10""",
        _PAIR_SQL,
    ),
)
def assignee_reporter_matrix(spark, data_dir):
    """Long form of the top-30 assignee x reporter matrix restricted to the 10 reporter
    columns with the largest totals."""
    labelled, _ = clean.split_labelled(issues(spark, data_dir))
    pairs = crosstab.pair_counts(labelled, "assignee", "reporter", top=30)
    return crosstab.rank_columns_by_total(pairs, "assignee", "reporter", keep=10).select(
        "reporter", "assignee", "n", "col_rank"
    )


@register(
    "duration_share_by_issue_type",
    with_issues(
        """SELECT duration_days, issue_type, n, round(n / sum(n) OVER (PARTITION BY issue_type), 6) AS share
FROM (SELECT CAST(date_sub('day', created, resolutiondate) AS BIGINT) AS duration_days, issue_type,
             CAST(count(*) AS BIGINT) AS n
      FROM issues WHERE resolutiondate IS NOT NULL AND created IS NOT NULL GROUP BY 1, 2)"""
    ),
)
def duration_share_by_issue_type(spark, data_dir):
    df = resolved_with_minutes(spark, data_dir)
    return rounded(crosstab.level_shares(df, "duration_days", "issue_type"))


# ---------------------------------------------------------------- histograms
def _hist_sql(expr: str, src: str, edges: list[int], where: str = "TRUE") -> str:
    nb = len(edges) - 1
    step = edges[1] - edges[0]
    e0, el = edges[0], edges[-1]
    return with_issues(
        f"""SELECT f.bin, f.lo, f.hi, CAST(count(b.bin) AS BIGINT) AS count
FROM (SELECT i AS bin, CAST({e0} + i * {step} AS DOUBLE) AS lo, CAST({e0} + (i + 1) * {step} AS DOUBLE) AS hi
      FROM range(0, {nb}) t(i)) f
LEFT JOIN (SELECT CASE WHEN x >= {e0} AND x <= {el} THEN least(CAST(floor((x - {e0}) / {step}) AS BIGINT), {nb - 1}) END AS bin
           FROM (SELECT CAST({expr} AS DOUBLE) AS x FROM {src} WHERE {where})) b ON b.bin = f.bin
GROUP BY f.bin, f.lo, f.hi"""
    )


_DESC_EDGES = list(range(0, 2000, 100))
_SUMM_EDGES = list(range(0, 150, 5))
_DAY_EDGES = list(range(0, 200, 1))


@register("hist_description_length", _hist_sql("description_length", "issues", _DESC_EDGES))
def hist_description_length(spark, data_dir):
    return bins.hist(issues(spark, data_dir), "description_length", _DESC_EDGES)


@register("hist_summary_length", _hist_sql("summary_length", "issues", _SUMM_EDGES))
def hist_summary_length(spark, data_dir):
    return bins.hist(issues(spark, data_dir), "summary_length", _SUMM_EDGES)


@register(
    "hist_duration_days",
    _hist_sql("date_sub('day', created, resolutiondate)", "issues", _DAY_EDGES, LABELLED),
)
def hist_duration_days(spark, data_dir):
    return bins.hist(resolved_with_minutes(spark, data_dir), "duration_days", _DAY_EDGES)


@register("hist_document_chars", _hist_sql("n_chars", "documents", _DESC_EDGES))
def hist_document_chars(spark, data_dir):
    return bins.hist(table(spark, data_dir, "documents"), "n_chars", _DESC_EDGES)


@register(
    "hist_log_duration_auto",
    with_issues(
        """SELECT bin, round(lo_ + bin * (hi_ - lo_) / 20, 6) AS lo, round(lo_ + (bin + 1) * (hi_ - lo_) / 20, 6) AS hi,
       CAST(count(*) AS BIGINT) AS count
FROM (SELECT CASE WHEN hi_ = lo_ THEN 0 ELSE least(CAST(floor(20 * (x - lo_) / (hi_ - lo_)) AS BIGINT), 19) END AS bin, lo_, hi_
      FROM (SELECT x, min(x) OVER () AS lo_, max(x) OVER () AS hi_
            FROM (SELECT ln(date_sub('minute', created, resolutiondate)) AS x FROM issues
                  WHERE resolutiondate IS NOT NULL AND created IS NOT NULL
                    AND date_sub('minute', created, resolutiondate) > 0)))
GROUP BY bin, lo_, hi_"""
    ),
)
def hist_log_duration_auto(spark, data_dir):
    df = clean.log_transform(resolved_with_minutes(spark, data_dir), counts=[])
    return rounded(bins.equal_width_hist(df, "log_duration", 20))
