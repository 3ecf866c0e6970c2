"""File sources and sinks: CSV and JSON-lines issue exports, Parquet between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import ISSUE_TS_PATTERN, parse_timestamp
from .issues import ISSUE_SCHEMA
from .records import read_quoted_csv

CORRUPT = "_corrupt_record"


# The export's own types: the key and the timestamps are text.
EXPORT_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType() if f.name == "key" or isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
     for f in ISSUE_SCHEMA.fields]
)
EXPORT_TIMESTAMPS = [f.name for f in ISSUE_SCHEMA.fields if isinstance(f.dataType, T.TimestampNTZType)]


def read_issues_csv(spark: SparkSession, path: str, schema: T.StructType = ISSUE_SCHEMA,
                    keep_corrupt: bool = False, multi_line: bool = False) -> DataFrame:
    """Header CSV with the declared schema (no inference pass). A quote inside a quoted field is
    doubled; ``multi_line`` lets such fields hold line breaks (a file is then one split; see
    :func:`records.read_quoted_csv` for large files).
    Malformed rows are kept with NULL fields; with ``keep_corrupt`` their raw text is in
    ``_corrupt_record``."""
    sch = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())]) if keep_corrupt else schema
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"').option("multiLine", multi_line).schema(sch)
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(path)


def read_issue_export(spark: SparkSession, path: str, multi_line: bool = True, strict: bool = True,
                      pattern: str = ISSUE_TS_PATTERN) -> DataFrame:
    """A tracker's own CSV export: text keys (``DEMO-1``) and timestamps with an offset
    (``2013-04-05T10:11:12.000+0000``), parsed to UTC wall-clock timestamps.

    With ``strict`` a non-empty timestamp that does not parse fails the read with its count;
    otherwise it becomes NULL and ``bad_timestamps`` tells how many of the row's did. With
    ``multi_line`` quoted fields may hold line breaks; files are read in splits on either way."""
    raw = read_quoted_csv(spark, path, EXPORT_SCHEMA) if multi_line else read_issues_csv(spark, path, EXPORT_SCHEMA)
    parsed = {c: F.to_timestamp_ntz(F.date_format(F.to_utc_timestamp(parse_timestamp(c, pattern), F.current_timezone()), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
              for c in EXPORT_TIMESTAMPS}
    bad = sum((F.when(F.trim(F.col(c)).isNotNull() & (F.trim(F.col(c)) != "") & parse_timestamp(c, pattern).isNull(), 1).otherwise(0)
               for c in EXPORT_TIMESTAMPS), F.lit(0))
    out = raw.withColumn("bad_timestamps", bad).withColumns(parsed)
    if strict:
        n = out.agg(F.sum("bad_timestamps")).first()[0] or 0
        if n:
            raise ValueError(f"{n} timestamps of {path} do not match {pattern}")
        return out.drop("bad_timestamps")
    return out


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One JSON object per line; schema inferred unless given."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV, no index column, parents created, existing output replaced."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
