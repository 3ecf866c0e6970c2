"""Cleaning, target, splitting and encoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import clean, encode, levels, modeling_data, split
from ..session import write_and_read
from ..sources.issues import issues
from ..sources.tables import table
from .registry import register, rounded, with_issues
from .shared import SHORT_TYPES, design

_SHORT_SQL = ", ".join(f"'{t}'" for t in SHORT_TYPES)
LAB = "resolutiondate IS NOT NULL AND created IS NOT NULL"

LAB_CTE = f"""lab AS (SELECT *, date_sub('minute', created, resolutiondate) AS duration_min,
                 date_sub('day', created, resolutiondate) AS duration_days
          FROM issues WHERE {LAB})"""


@register(
    "duration_targets",
    with_issues(
        """SELECT key, duration_min, duration_days,
       round(CASE WHEN duration_min > 0 THEN ln(duration_min) END, 6) AS log_duration,
       round(exp(CASE WHEN duration_min > 0 THEN ln(duration_min) END), 6) AS back_minutes
FROM lab""",
        LAB_CTE,
    ),
)
def duration_targets(spark, data_dir):
    lab = clean.add_duration(clean.split_labelled(issues(spark, data_dir))[0])
    return rounded(
        lab.select(
            "key", "duration_min", "duration_days",
            S.ln_positive("duration_min").alias("log_duration"),
            F.exp(S.ln_positive("duration_min")).alias("back_minutes"),
        )
    )


@register(
    "timestamp_text_parse",
    with_issues(
        """SELECT key, txt,
       CAST(strptime(replace(txt, '+0000', ''), '%Y-%m-%dT%H:%M:%S.%g') AS TIMESTAMP) AS parsed_stripped,
       CAST(txt AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS parsed_iso,
       date_sub('minute', CAST(txt AS TIMESTAMPTZ) AT TIME ZONE 'UTC',
                CAST(strftime(resolutiondate, '%Y-%m-%dT%H:%M:%S.%g+0000') AS TIMESTAMPTZ) AT TIME ZONE 'UTC') AS duration_min
FROM (SELECT key, resolutiondate, strftime(created, '%Y-%m-%dT%H:%M:%S.%g+0000') AS txt FROM issues WHERE resolution = 'Fixed')"""
    ),
)
def timestamp_text_parse(spark, data_dir):
    """Export-style text timestamps: strip the offset literally and parse with a pattern,
    or parse the ISO text with its offset; the 'Fixed only' durations from text."""
    fx = issues(spark, data_dir).where(F.col("resolution") == "Fixed")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'"
    txt = F.date_format("created", iso)
    end_txt = F.date_format("resolutiondate", iso)
    return fx.select(
        "key",
        txt.alias("txt"),
        S.parse_timestamp(S.strip_text(txt, "+0000"), "yyyy-MM-dd'T'HH:mm:ss.SSS").cast("timestamp_ntz").alias("parsed_stripped"),
        S.parse_timestamp(txt, S.ISSUE_TS_PATTERN).cast("timestamp_ntz").alias("parsed_iso"),
        S.elapsed_minutes(S.parse_timestamp(txt, S.ISSUE_TS_PATTERN), S.parse_timestamp(end_txt, S.ISSUE_TS_PATTERN)).alias("duration_min"),
    )


@register(
    "fixed_only_durations",
    with_issues("SELECT key, date_sub('minute', created, resolutiondate) AS duration_min FROM issues WHERE resolution = 'Fixed'"),
)
def fixed_only_durations(spark, data_dir):
    """The alternative training set: 'Fixed' resolutions only, with their durations."""
    return clean.fixed_only(issues(spark, data_dir)).select("key", "duration_min")


@register(
    "duration_text_parse",
    with_issues(
        """SELECT key, txt,
       CAST(regexp_extract(txt, '^(-?\\d+) days', 1) AS BIGINT) * 1440
         + CAST(regexp_extract(txt, ' (\\d{2}):', 1) AS BIGINT) * 60
         + CAST(regexp_extract(txt, ':(\\d{2}):', 1) AS BIGINT) AS minutes
FROM (SELECT key, printf('%d days %02d:%02d:%02d', s // 86400, (s % 86400) // 3600, (s % 3600) // 60, s % 60) AS txt
      FROM (SELECT key, date_sub('second', created, resolutiondate) AS s FROM issues WHERE """ + LAB + "))"
    ),
)
def duration_text_parse(spark, data_dir):
    """Durations written as 'N days HH:MM:SS' text and parsed back to minutes."""
    lab = clean.split_labelled(issues(spark, data_dir))[0]
    s = F.timestamp_diff("SECOND", F.col("created"), F.col("resolutiondate"))
    txt = F.format_string("%d days %02d:%02d:%02d", F.floor(s / 86400), F.floor((s % 86400) / 3600),
                          F.floor((s % 3600) / 60), s % 60)
    return lab.select("key", txt.alias("txt")).withColumn("minutes", S.duration_text_minutes("txt"))


@register(
    "level_groupings",
    with_issues(
        f"""SELECT key,
       CASE WHEN issue_type IN ({_SHORT_SQL}) THEN 'Short' ELSE 'Long' END AS issue_group,
       CASE WHEN priority IN ('Major', 'Critical', 'Blocker') THEN 'Major' ELSE 'Minor' END AS priority_group,
       CASE WHEN priority IN (SELECT priority FROM issues WHERE priority IS NOT NULL GROUP BY priority HAVING count(*) < 50)
            THEN 'Others' ELSE priority END AS priority_reduced
FROM issues"""
    ),
)
def level_groupings(spark, data_dir):
    df = issues(spark, data_dir)
    kept = write_and_read(levels.frequent_levels(df, "priority", 49), "levels")
    out = df.select(
        "key",
        S.two_groups("issue_type", SHORT_TYPES, "Short", "Long").alias("issue_group"),
        S.two_groups("priority", encode.MAJOR_PRIORITIES, "Major", "Minor").alias("priority_group"),
        F.col("priority").alias("priority_reduced"),
    )
    return levels.keep_levels(out, "priority_reduced", kept, "Others", null_to_other=False)


_FEAT_SQL = f"""SELECT key, priority, issue_type, reporter, vote_count, comment_count,
       CAST(coalesce(description_length, 0) AS DOUBLE) AS description_length, summary_length, watch_count,
       duration_min FROM lab"""


@register("feature_table", with_issues(_FEAT_SQL, LAB_CTE))
def feature_table(spark, data_dir):
    lab = clean.add_duration(clean.split_labelled(issues(spark, data_dir))[0])
    return clean.feature_table(lab, target="duration_min")


@register(
    "log_features",
    with_issues(
        """SELECT key, round(ln(vote_count + 1), 6) AS vote_count, round(ln(comment_count + 1), 6) AS comment_count,
       round(ln(coalesce(description_length, 0) + 1), 6) AS description_length, summary_length,
       round(ln(watch_count + 1), 6) AS watch_count, round(ln(duration_min), 6) AS log_duration
FROM lab WHERE duration_min > 0""",
        LAB_CTE,
    ),
)
def log_features(spark, data_dir):
    lab = clean.add_duration(clean.split_labelled(issues(spark, data_dir))[0])
    ft = clean.feature_table(lab, target="duration_min")
    out = clean.log_transform(ft).select(
        "key", "vote_count", "comment_count", "description_length", "summary_length", "watch_count", "log_duration"
    )
    return rounded(out)


@register(
    "nonpositive_durations",
    "SELECT CAST(count_if(m <= 0) AS BIGINT) AS n_nonpositive, CAST(count(m) AS BIGINT) AS n_target "
    "FROM (SELECT date_sub('minute', ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS m FROM events)",
)
def nonpositive_durations(spark, data_dir):
    """Sub-day gaps between a user's events: zero-minute targets have no logarithm."""
    from ..sources.issues import event_gaps

    return clean.nonpositive_targets(clean.add_duration(event_gaps(spark, data_dir)))


@register(
    "event_gap_minutes",
    "SELECT event_id AS key, user_id, date_sub('minute', ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS duration_min FROM events",
)
def event_gap_minutes(spark, data_dir):
    from ..sources.issues import event_gaps

    return clean.add_duration(event_gaps(spark, data_dir)).select("key", "user_id", "duration_min")


@register(
    "hash_split_flags",
    with_issues(
        """SELECT key, CAST(('0x' || substr(md5(CAST(key AS VARCHAR)), 1, 8))::BIGINT % 100 AS BIGINT) AS bucket,
       ('0x' || substr(md5(CAST(key AS VARCHAR)), 1, 8))::BIGINT % 100 < 80 AS is_train
FROM lab""",
        LAB_CTE,
    ),
)
def hash_split_flags(spark, data_dir):
    lab = clean.split_labelled(issues(spark, data_dir))[0]
    return split.hash_split(lab.select("key"), "key", 80).select("key", split.hash_bucket("key").alias("bucket"), "is_train")


@register(
    "contiguous_folds",
    with_issues("SELECT key, CAST(ntile(5) OVER (ORDER BY created, key) AS INTEGER) AS fold FROM lab", LAB_CTE),
)
def contiguous_folds(spark, data_dir):
    lab = clean.split_labelled(issues(spark, data_dir))[0]
    return split.contiguous_folds(lab.select("key", "created"), ["created", "key"], 5).select("key", "fold")


@register(
    "labelled_open_split",
    with_issues(
        f"""SELECT 'labelled' AS part, CAST(count(*) AS BIGINT) AS n FROM issues WHERE {LAB}
UNION ALL SELECT 'open', CAST(count(*) AS BIGINT) FROM issues WHERE key NOT IN (SELECT key FROM issues WHERE {LAB})"""
    ),
)
def labelled_open_split(spark, data_dir):
    """Labelled rows and their complement by row identity (left anti join)."""
    df = issues(spark, data_dir)
    lab, _ = clean.split_labelled(df)
    op = clean.open_by_anti_join(df, lab)
    return lab.agg(F.count(F.lit(1)).alias("n")).select(F.lit("labelled").alias("part"), "n").unionByName(
        op.agg(F.count(F.lit(1)).alias("n")).select(F.lit("open").alias("part"), "n")
    )


@register(
    "rare_customer_levels",
    """SELECT level, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN c_name IN (SELECT c_name FROM orders JOIN customer ON c_custkey = o_custkey
                              GROUP BY c_name HAVING count(*) > 10) THEN c_name ELSE 'Other' END AS level
  FROM orders JOIN customer ON c_custkey = o_custkey) GROUP BY level""",
)
def rare_customer_levels(spark, data_dir):
    """The > 10 rule on a many-level column (customer name per order)."""
    o = table(spark, data_dir, "orders").select("o_custkey")
    c = table(spark, data_dir, "customer").select("c_custkey", "c_name")
    df = o.join(c, F.col("c_custkey") == F.col("o_custkey"))
    m = encode.RareLevels(inputCol="c_name", minCount=10).fit(df)
    return m.transform(df).groupBy(F.col("c_name").alias("level")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- encoded design, SQL side
_TR = f"""tgt AS (SELECT * FROM lab WHERE duration_min > 0),
kept AS (SELECT reporter FROM tgt WHERE reporter IS NOT NULL GROUP BY reporter HAVING count(*) > 10),
tr AS (SELECT key, priority,
       CASE WHEN issue_type IN ({_SHORT_SQL}) THEN 'Short' ELSE 'Long' END AS issue_type,
       CASE WHEN reporter IN (SELECT reporter FROM kept) THEN reporter ELSE 'Other' END AS reporter,
       ln(vote_count + 1) AS vote_count, ln(comment_count + 1) AS comment_count,
       ln(coalesce(description_length, 0) + 1) AS description_length, CAST(summary_length AS DOUBLE) AS summary_length,
       ln(watch_count + 1) AS watch_count, ln(duration_min) AS log_duration
       FROM tgt),
lv AS (SELECT c, v FROM (
         SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY v) AS rn FROM (
           SELECT DISTINCT 'priority' AS c, priority AS v FROM tr WHERE priority IS NOT NULL
           UNION SELECT DISTINCT 'issue_type', issue_type FROM tr WHERE issue_type IS NOT NULL
           UNION SELECT DISTINCT 'reporter', reporter FROM tr WHERE reporter IS NOT NULL))
       WHERE rn > 1)"""


def _long_sql(src: str, with_target: bool) -> str:
    nums = ["vote_count", "comment_count", "description_length", "summary_length", "watch_count"]
    parts = [f"SELECT key, '{c}' AS feature, round({c}, 6) AS value FROM {src}" for c in nums]
    parts.append(
        f"""SELECT s.key, lv.c || '_' || lv.v AS feature,
       CAST(CASE WHEN (lv.c = 'priority' AND s.priority = lv.v) OR (lv.c = 'issue_type' AND s.issue_type = lv.v)
                   OR (lv.c = 'reporter' AND s.reporter = lv.v) THEN 1 ELSE 0 END AS DOUBLE) AS value
FROM {src} s, lv"""
    )
    if with_target:
        parts.append(f"SELECT key, 'log_duration', round(log_duration, 6) FROM {src}")
    return "\nUNION ALL\n".join(parts)


@register("encoded_design_long", with_issues(_long_sql("tr", True), LAB_CTE + ",\n" + _TR))
def encoded_design_long(spark, data_dir):
    """The encoded training design (numeric logs, k-1 dummies, ln target) in long form."""
    _, enc, _ = design(spark, data_dir)
    return rounded(modeling_data.to_long(enc))


_SERVE = f"""op AS (SELECT key, priority,
       CASE WHEN issue_type IN ({_SHORT_SQL}) THEN 'Short' ELSE 'Long' END AS issue_type,
       CASE WHEN reporter IN (SELECT reporter FROM kept) THEN reporter ELSE 'Other' END AS reporter,
       ln(vote_count + 1) AS vote_count, ln(comment_count + 1) AS comment_count,
       ln(coalesce(description_length, 0) + 1) AS description_length, CAST(summary_length AS DOUBLE) AS summary_length,
       ln(watch_count + 1) AS watch_count
       FROM issues WHERE NOT ({LAB}))"""


@register("serving_design_long", with_issues(_long_sql("op", False), LAB_CTE + ",\n" + _TR + ",\n" + _SERVE))
def serving_design_long(spark, data_dir):
    """Open issues encoded with the pipeline fitted on labelled ones (training levels,
    training column order, unseen levels all-zero)."""
    df = issues(spark, data_dir)
    model, _, _ = design(spark, data_dir)
    _, op = clean.split_labelled(df)
    return rounded(modeling_data.to_long(encode.encode(model, op)))


@register(
    "minmax_scaled",
    with_issues(
        """SELECT key, round((comment_count - mn_c) / (mx_c - mn_c), 6) AS comment_count,
       round((watch_count - mn_w) / (mx_w - mn_w), 6) AS watch_count,
       round((summary_length - mn_s) / (mx_s - mn_s), 6) AS summary_length
FROM tr, (SELECT min(comment_count) mn_c, max(comment_count) mx_c, min(watch_count) mn_w, max(watch_count) mx_w,
                 min(summary_length) mn_s, max(summary_length) mx_s
          FROM tr WHERE ('0x' || substr(md5(CAST(key AS VARCHAR)), 1, 8))::BIGINT % 100 < 75) m
WHERE ('0x' || substr(md5(CAST(key AS VARCHAR)), 1, 8))::BIGINT % 100 >= 75""",
        LAB_CTE + ",\n" + _TR,
    ),
)
def minmax_scaled(spark, data_dir):
    """Min-max scaling fitted on the 75 % training part, applied to the test part."""
    _, enc, _ = design(spark, data_dir)
    train, test = split.train_test(enc, "key", 75)
    cols = ["comment_count", "watch_count", "summary_length"]
    sc = encode.MinMaxScaling(inputCols=cols).fit(train)
    return rounded(sc.transform(test).select("key", *cols))


@register(
    "poly2_terms",
    with_issues(
        """SELECT key, round(comment_count, 6) AS comment_count, round(watch_count, 6) AS watch_count,
       round(comment_count * comment_count, 6) AS "comment_count^2",
       round(comment_count * watch_count, 6) AS "comment_count*watch_count",
       round(watch_count * watch_count, 6) AS "watch_count^2"
FROM tr""",
        LAB_CTE + ",\n" + _TR,
    ),
)
def poly2_terms(spark, data_dir):
    _, enc, _ = design(spark, data_dir)
    return rounded(encode.poly2(enc, ["comment_count", "watch_count"], keep=["key"]))
