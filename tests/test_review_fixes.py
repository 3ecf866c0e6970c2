"""Cases that a review found wrong: the real export form, intervals, nested JSON, alpha 0."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.functions import scalar
from leadlens.operators import linear
from leadlens.operators import moments as M
from leadlens.sources import files, jsonops

HEADER = ",".join(f.name for f in files.EXPORT_SCHEMA.fields)
LINE = 'Closed,Major,2013-04-06T10:11:12.500+0000,Bug,ann.b,{created},2013-04-05T12:11:12.000+0200,1,"DEMO ""x"",\nline",,2,DEMO-{k},,30,4,Fixed,1.5'


def export(tmp_path, *created):
    path = tmp_path / "export.csv"
    path.write_text("\n".join([HEADER, *(LINE.format(created=c, k=i) for i, c in enumerate(created))]) + "\n")
    return str(path)


def test_real_export_is_read_whole(spark, tmp_path):
    rows = files.read_issue_export(spark, export(tmp_path, "2013-04-05T10:11:12.000+0000", "")).orderBy("key").collect()
    assert [r.key for r in rows] == ["DEMO-0", "DEMO-1"] and rows[0].project == 'DEMO "x",\nline'
    assert rows[0].created == rows[0].resolutiondate == dt.datetime(2013, 4, 5, 10, 11, 12)
    assert rows[0].updated == dt.datetime(2013, 4, 6, 10, 11, 12, 500000) and rows[1].created is None


def test_malformed_timestamps_fail_or_are_counted(spark, tmp_path):
    path = export(tmp_path, "2013-04-05T10:11:12.000+0000", "5 April 2013")
    with pytest.raises(ValueError, match="1 timestamps"):
        files.read_issue_export(spark, path)
    rows = files.read_issue_export(spark, path, strict=False).orderBy("key").collect()
    assert [r.bad_timestamps for r in rows] == [0, 1] and rows[1].created is None


def test_minutes_to_interval_keeps_seconds_and_bounds(spark):
    values = [90.75, -90.75, 0.0, 3e9, 1.5e11, 1e12, float("nan"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, m double")
    got = [r.t for r in df.select("i", scalar.minutes_to_interval("m").cast("string").alias("t")).orderBy("i").collect()]
    assert got[0] == "INTERVAL '0 01:30:45' DAY TO SECOND" and got[1] == "INTERVAL '-0 01:30:45' DAY TO SECOND"
    assert got[3] == "INTERVAL '2083333 08:00:00' DAY TO SECOND" and got[4] is not None
    assert got[5:] == [None, None, None]


def test_canonical_json_indents_and_sorts_everywhere(spark):
    value = {"b": [1, {"d": None, "c": "é"}], "a": {"z": [], "y": {}}}
    text = json.dumps(value)
    df = spark.createDataFrame([(0, text), (1, "[3, 1]"), (2, "no json"), (3, None), (4, '"s"')], "i int, t string")
    rows = df.select("i", jsonops.canonical_json("t").alias("p"), jsonops.canonical_json("t", pretty=False, sort=False).alias("f"),
                     jsonops.canonical_json("t", indents=1).alias("one"), jsonops.invalid_json("t").alias("bad")).orderBy("i").collect()
    assert rows[0].p == json.dumps(value, indent=4, sort_keys=True, ensure_ascii=False) and "\n            " in rows[0].p
    assert rows[0].f == '{"b":[1,{"d":null,"c":"é"}],"a":{"z":[],"y":{}}}' and rows[0].one.startswith('{\n "a": {\n  "y"')
    assert rows[1].p == "[\n    3,\n    1\n]" and rows[2].p is None and rows[3].p is None and rows[4].p == '"s"'
    assert [r.bad for r in rows] == [False, False, True, False, False]


def test_ridge_without_penalty_on_constant_and_duplicate_columns(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=80)
    df = spark.createDataFrame([(float(x), float(x), 1.0, float(3 * x + 2)) for x in a], "a double, b double, c double, y double")
    mom = M.moments(df, ["a", "b", "c"], "y")
    assert np.allclose(linear.ridge(mom, 0.0), [2, 1.5, 1.5, 0], atol=1e-8)
    assert np.allclose([r[2] for r in linear.ridge_path(mom, [0.0])], [1.5, 1.5, 2], atol=1e-8)
    one = df.select("a", F.lit(1.0).alias("c"), "y")
    plain = linear.ridge(M.moments(one, ["a", "c"], "y"), 0.0)
    assert np.allclose(plain, [2, 3, 0], atol=1e-8)


def test_names_with_dots_and_backticks(spark):
    from leadlens.operators import encode, modeling_data

    df = spark.createDataFrame([(i, float(i % 5), float(i % 3), 2.0 * (i % 5) - (i % 3) + 1) for i in range(60)], ["key", "lvl_b.c", "a`b", "y"])
    long = modeling_data.to_long(df)
    assert long.where(F.col("feature") == "lvl_b.c").count() == 60
    fit = linear.ols(M.moments(df, ["lvl_b.c", "a`b"], "y"))
    assert np.allclose(fit.coef, [1, 2, -1])
    assert df.select(fit.prediction().alias("p"), "y").where("abs(p - y) > 1e-9").count() == 0
    assert encode.align_columns(df, ["a`b", "new.x", "lvl_b.c"]).columns == ["a`b", "new.x", "lvl_b.c"]
    assert encode.poly2(df, ["lvl_b.c", "a`b"]).count() == 60


def test_tails_at_huge_degrees_of_freedom():
    from leadlens.functions import dist

    for df in (1e8, 1e10, 1e13, 1e16):
        assert dist.t_sf2(1.96, df) == pytest.approx(0.049995790296440, rel=1e-9)
        assert dist.f_sf(1.96**2, 1, df) == pytest.approx(dist.t_sf2(1.96, df), rel=1e-5)


def test_cache_key_follows_the_input(spark, tmp_path):
    from leadlens.sources.issues import fingerprint

    spark.range(3).write.parquet(f"{tmp_path}/t.parquet")
    first = fingerprint(spark, str(tmp_path), ["t"])
    assert first == fingerprint(spark, f"file://{tmp_path}", ["t"])
    spark.range(30).write.mode("overwrite").parquet(f"{tmp_path}/t.parquet")
    assert fingerprint(spark, str(tmp_path), ["t"]) != first
