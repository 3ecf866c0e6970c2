"""Queries over level tables and sparse designs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import clean, encode, modeling_data
from ..operators.blocked import BlockedMoments
from ..operators.levels import SparseDesign
from ..sources.issues import issues
from ..sources.tables import table
from .q_prep import _SHORT_SQL, LAB, LAB_CTE
from .registry import register, rounded, with_issues
from .shared import SHORT_TYPES, memo

NUMERIC = encode.NUMERIC_FEATURES
LEAST = 600  # rows a reporter needs

_COLS = f"""key, priority, CASE WHEN issue_type IN ({_SHORT_SQL}) THEN 'Short' ELSE 'Long' END AS issue_type,
       coalesce(k.reporter, 'Other') AS reporter, ln(vote_count + 1) AS vote_count, ln(comment_count + 1) AS comment_count,
       ln(coalesce(description_length, 0) + 1) AS description_length, CAST(summary_length AS DOUBLE) AS summary_length,
       ln(watch_count + 1) AS watch_count"""


def _ctes(fit_rows: str) -> str:
    """CTEs: fitting rows ``fr``, slots ``lv`` (c, v) without each column's first level."""
    return f"""{LAB_CTE}, tgt AS (SELECT * FROM lab WHERE duration_min > 0 AND {fit_rows}),
kept AS (SELECT reporter FROM tgt GROUP BY reporter HAVING count(*) > {LEAST}),
fr AS (SELECT {_COLS}, ln(duration_min) AS y FROM tgt LEFT JOIN kept k USING (reporter)),
lv AS (SELECT c, v FROM (SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY v) AS rn FROM (
         SELECT DISTINCT 'priority' AS c, priority AS v FROM fr UNION SELECT DISTINCT 'issue_type', issue_type FROM fr
         UNION SELECT DISTINCT 'reporter', reporter FROM fr) WHERE v IS NOT NULL) WHERE rn > 1),
op AS (SELECT {_COLS} FROM issues LEFT JOIN kept k USING (reporter) WHERE NOT ({LAB}))"""


def _long(src: str) -> str:
    parts = [f"SELECT key, '{c}' AS feature, {c} AS value FROM {src} WHERE {c} <> 0" for c in NUMERIC]
    parts += [f"SELECT key, '{c}_' || v AS feature, 1.0 AS value FROM {src} JOIN lv ON lv.c = '{c}' AND lv.v = {src}.{c}"
              for c in ("priority", "issue_type", "reporter")]
    return " UNION ALL ".join(parts)


def features(df):
    """The feature table with grouped types and log counts; levels are left to the design."""
    out = clean.feature_table(df, target=None)
    for stage in (encode.GroupLevels(inputCol="issue_type", members=SHORT_TYPES), encode.LogCounts()):
        out = stage.transform(out)
    return out


def fit(rows) -> SparseDesign:
    return SparseDesign.fit(features(rows), NUMERIC, encode.CATEGORICAL_FEATURES, {"reporter": LEAST})


def _labelled(spark, data_dir):
    return modeling_data.labelled_with_target(issues(spark, data_dir))


@register("sparse_design_long", with_issues(f"SELECT key, feature, round(value, 6) AS value FROM ({_long('fr')})", _ctes("true")))
def sparse_design_long(spark, data_dir):
    """Non-zero entries of the training design, reporters of at most 600 rows collapsed."""
    rows = _labelled(spark, data_dir)
    return rounded(fit(rows).long(features(rows)))


@register("sparse_serving_long", with_issues(f"SELECT key, feature, round(value, 6) AS value FROM ({_long('op')})", _ctes("priority <> '5-LOW'")))
def sparse_serving_long(spark, data_dir):
    """Open issues in a design fitted without the priority '5-LOW': there an unseen level, so
    without an entry; reporters not kept at fitting are Other."""
    design = fit(_labelled(spark, data_dir).where("priority <> '5-LOW'"))
    return rounded(design.long(features(clean.split_labelled(issues(spark, data_dir))[1])))


def _moments(spark, data_dir):
    def build():
        rows = _labelled(spark, data_dir)
        design = fit(rows)
        sparse = design.rows(features(rows).join(rows.select("key", "log_duration"), "key"), ["log_duration"])
        return design, BlockedMoments.of(sparse, design.width, "log_duration", block=16)

    return memo(spark, data_dir, "sparse-moments", build)


@register("sparse_gram_cells", with_issues(
    """SELECT least(a.feature, b.feature) AS a, greatest(a.feature, b.feature) AS b, round(sum(a.value * b.value), 4) AS value
FROM d a JOIN d b USING (key) WHERE a.feature <= b.feature GROUP BY 1, 2""",
    _ctes("true") + f", d AS (SELECT key, 'Intercept' AS feature, 1.0 AS value FROM fr UNION ALL {_long('fr')})"))
def sparse_gram_cells(spark, data_dir):
    """X'X of the training design, from its blocks."""
    design, moments = _moments(spark, data_dir)
    names = spark.createDataFrame([(0, "Intercept")], "slot long, feature string").unionByName(
        design.features().select((F.col("slot") + 1).alias("slot"), "feature"))
    cells = moments.cells().join(names.withColumnsRenamed({"slot": "i", "feature": "fa"}), "i").join(
        names.withColumnsRenamed({"slot": "j", "feature": "fb"}), "j")
    return rounded(cells.select(F.least("fa", "fb").alias("a"), F.greatest("fa", "fb").alias("b"), F.col("v").alias("value")), 4)


ALPHA = 5.0


@register("customer_ridge_effects", with_issues(
    f"""SELECT 'Intercept' AS feature, round(b0, 6) AS coef FROM b
UNION ALL SELECT 'c_name_' || level, round((m - b0) * n / (n + {ALPHA}), 6) FROM g, b WHERE level <> (SELECT min(level) FROM g)""",
    LAB_CTE + f""", t AS (SELECT c_name, ln(duration_min) AS y FROM lab JOIN orders ON o_orderkey = key JOIN customer ON c_custkey = o_custkey WHERE duration_min > 0),
f AS (SELECT c_name FROM t GROUP BY c_name HAVING count(*) > 10),
g AS (SELECT coalesce(f.c_name, 'Other') AS level, count(*) AS n, avg(y) AS m FROM t LEFT JOIN f USING (c_name) GROUP BY 1),
b AS (SELECT sum(w * m) / sum(w) AS b0 FROM (SELECT m, CASE WHEN level = (SELECT min(level) FROM g) THEN n ELSE n * {ALPHA} / (n + {ALPHA}) END AS w FROM g))"""))
def customer_ridge_effects(spark, data_dir):
    """Ridge of ln minutes on a dummy per customer of more than 10 issues: hundreds of columns, by
    conjugate gradients over the blocked moments."""
    lab = _labelled(spark, data_dir).select("key", "log_duration")
    names = table(spark, data_dir, "orders").join(table(spark, data_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("o_orderkey").alias("key"), "c_name")
    rows = lab.join(names, "key")
    design = SparseDesign.fit(rows, [], ["c_name"], {"c_name": 10})
    moments = BlockedMoments.of(design.rows(rows, ["log_duration"]), design.width, "log_duration")
    return rounded(moments.coefficients(moments.solve(ALPHA), design))


#: Priorities by the names of a tracker, one of them rare.
_NAMED = """CASE WHEN key % 401 = 0 THEN 'Unset' WHEN priority LIKE '1%' THEN 'Blocker' WHEN priority LIKE '2%' THEN 'Critical'
  WHEN priority LIKE '3%' THEN 'Major' WHEN priority LIKE '4%' THEN 'Minor' ELSE 'Trivial' END"""


@register("priority_groupings", with_issues(
    """SELECT key, CASE WHEN priority IN ('Major', 'Critical', 'Blocker') THEN 'Major' ELSE 'Minor' END AS priority_group,
  CASE WHEN priority IN (SELECT priority FROM p GROUP BY priority HAVING count(*) >= 50) THEN priority ELSE 'Others' END AS priority_reduced
FROM p""", f"p AS (SELECT key, {_NAMED} AS priority FROM issues)"))
def priority_groupings(spark, data_dir):
    """Both alternative priority mappings where each branch has rows: Major and Minor, and
    priorities of fewer than 50 issues as Others."""
    from ..operators.levels import frequent_levels, keep_levels
    from ..session import write_and_read

    df = issues(spark, data_dir).select("key", F.expr(_NAMED).alias("priority"))
    out = df.withColumn("priority_group", S.two_groups("priority", encode.MAJOR_PRIORITIES, "Major", "Minor"))
    kept = write_and_read(frequent_levels(df, "priority", 49), "levels")
    return keep_levels(out, "priority", kept, "Others").withColumnRenamed("priority", "priority_reduced")
