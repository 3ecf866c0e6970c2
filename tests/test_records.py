import csv
import random

import pytest
from pyspark.sql import functions as F

from leadlens.sources import files
from leadlens.sources.records import quoted_records, read_quoted_csv

SCHEMA = files.T.StructType([files.T.StructField(c, files.T.StringType()) for c in "abc"])


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, str(n)) for k in old]
    for k, v in old.items():
        spark.conf.set(k, v)


def write(path, rows, end="\r\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerows([["a", "b", 'head\n"er"']] + rows)


def random_rows(rng, n):
    pool = ["", "x", 'say "hi"', "two\nlines", "\n", "\n\n\n", "a,b", "é日本", '"', '""', "word " * 30, "\n".join("long field, line %d" % i for i in range(40))]
    return [[str(i), rng.choice(pool), rng.choice(pool)] for i in range(n)]


def known(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_rows_as_multi_line_reads_them(spark, tmp_path, small_splits, seed):
    """Files cut into splits of any size, some wholly inside one field, against what was written and
    Spark's own reader (which takes CRLF for two ends if the header holds a line break)."""
    rng, written = random.Random(seed), []
    for i in range(3):
        rows = random_rows(rng, rng.choice([0, 1, 60, 300]))
        write(tmp_path / f"f{i}.csv", rows, "\n" if seed % 2 else "\r\n")
        written += [tuple(x or None for x in r) for r in rows]
    want = sorted(written, key=repr)
    if seed % 2:
        assert known(files.read_issues_csv(spark, str(tmp_path), SCHEMA, multi_line=True)) == want
    small_splits(rng.choice([64, 100, 333, 5000]))
    got = read_quoted_csv(spark, str(tmp_path), SCHEMA)
    assert known(got) == want


def test_a_file_is_read_in_many_tasks(spark, tmp_path, small_splits):
    rows = [[str(i), "line one\nline two of the same field", 'q"%d"' % i] for i in range(40_000)]
    write(tmp_path / "one.csv", rows, "\n")
    size = (tmp_path / "one.csv").stat().st_size
    small_splits(size // 10)
    df = read_quoted_csv(spark, str(tmp_path / "one.csv"), SCHEMA)
    assert files.read_issues_csv(spark, str(tmp_path), SCHEMA, multi_line=True).rdd.getNumPartitions() == 1
    assert df.select(F.spark_partition_id()).distinct().count() >= 10
    assert df.count() == 40_000 and df.where("b = 'line one\nline two of the same field'").count() == 40_000
    assert sorted(int(r.a) for r in df.select("a").collect()) == list(range(40_000))


def test_edges(spark, tmp_path, small_splits):
    (tmp_path / "x.csv").write_text('a,b,c\n1,"open to the end\nof the file')
    (tmp_path / "y.csv").write_text("")
    (tmp_path / "z.csv").write_text('a,b,c\n\n2,"",\r\n3,x')
    for n in (16, 1 << 20):
        small_splits(n)
        got = {r.record: r.first for r in quoted_records(spark, str(tmp_path)).collect()}
        assert got == {"a,b,c": True, '1,"open to the end\nof the file': False, '2,"",': False, "3,x": False}
        rows = {r.a: (r.b, r.c) for r in read_quoted_csv(spark, str(tmp_path), SCHEMA).collect()}
        assert rows["2"] == (None, None) and rows["3"] == ("x", None)  # Spark reads a quoted empty field as null
        assert known(read_quoted_csv(spark, str(tmp_path / "y.csv"), SCHEMA)) == []


def test_malformed_rows_keep_their_text(spark, tmp_path):
    (tmp_path / "x.csv").write_text('n,t\n1,"a\nb"\nx,"c\nd"\n')
    schema = files.T.StructType.fromDDL("n int, t string, _corrupt_record string")
    rows = {r.n: (r.t, r._corrupt_record) for r in read_quoted_csv(spark, str(tmp_path), schema).collect()}
    assert rows == {1: ("a\nb", None), None: ("c\nd", 'x,"c\nd"')}
