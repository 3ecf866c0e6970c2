"""CSV records with line breaks inside quotes, from splits of a file.

Spark's ``multiLine`` option reads such a file in one task. Here the physical lines are read from
ordinary splits, and a line break ends a record if an even number of quotes stands before it in the
file. The parity of each split's quotes, added up over the splits before, tells which splits begin
inside quotes; a task then cuts its lines into records by itself. Only the pieces of records that
go over the end of a split (two a split at most) are brought together by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_and_read

WHOLE, HEAD, TAIL = 0, 1, 2
_PIECES = "file long, start long, kind int, first boolean, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, start): lines without their ``\\n``, the file's name as a hash, and where the
    split begins that the line begins in. A scan gives a split's lines in order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _open_splits(lines: DataFrame) -> DataFrame:
    """(file, start) of the splits that begin inside quotes: a row per split is added up, not data."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    splits = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = splits.withColumn("inside", F.sum("odd").over(before) % 2).where("inside = 1")
    return write_and_read(inside.select("file", "start"), "open-splits")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of (value, file, start, inside), lines of each split in order."""
    split, inside, first, held = None, False, True, []  # held: lines of the record not yet ended

    def out(kinds: list[int], firsts: list[bool], texts: list[str]) -> pa.RecordBatch:
        n = len(texts)
        return pa.record_batch([pa.array([split[0]] * n, pa.int64()), pa.array([split[1]] * n, pa.int64()), pa.array(kinds, pa.int32()),
                                pa.array(firsts, pa.bool_()), pa.array(texts, pa.string())], names=["file", "start", "kind", "first", "text"])

    def end() -> Iterator[pa.RecordBatch]:
        if held:  # the split's last record goes on; if it has no beginning here either, it is all one piece
            yield out([HEAD if inside else TAIL], [first and split[1] == 0 and not inside], ["\n".join(held)])

    for b in batches:
        key = np.stack([b["file"].to_numpy(), b["start"].to_numpy()])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), len(b)]
        for i, j in pairwise(cuts):
            if i == j:
                continue
            if (mine := (int(key[0, i]), int(key[1, i]))) != split:
                yield from end()
                split, inside, first, held = mine, b["inside"][i].as_py(), True, []
            values = b["value"].slice(i, j - i)
            odd = (pc.count_substring(values, '"').to_numpy(zero_copy_only=False).cumsum() + inside + sum(x.count('"') for x in held)) % 2
            ends = np.flatnonzero(odd == 0) + 1  # behind these lines a record ends
            texts, at, kinds, firsts, got = values.to_pylist(), 0, [], [], []
            for e in ends.tolist():
                got.append("\n".join([*held, *texts[at:e]]) if held or e - at > 1 else texts[at])
                kinds.append(HEAD if inside else WHOLE)
                firsts.append(first and split[1] == 0 and not inside)
                first, inside, held, at = first and inside, False, [], e
            held += texts[at:]
            if got:
                yield out(kinds, firsts, got)
    if split:
        yield from end()


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, first): the records of the CSV files at ``path`` as text, without the line break
    behind them, and whether a record is its file's first. Quotes inside quoted fields are doubled;
    a quote inside an unquoted field is not CSV and makes the rest of its file one field."""
    lines = _lines(spark, path)
    opened = _open_splits(lines)
    inside = F.broadcast(opened.withColumn("inside", F.lit(True)))  # a row of 17 bytes per split at most
    pieces = lines.join(inside, ["file", "start"], "left").select("value", "file", "start", F.coalesce("inside", F.lit(False)).alias("inside"))
    pieces = pieces.mapInArrow(_pieces, _PIECES)
    records = pieces.where(F.col("kind") == WHOLE).select(F.col("text").alias("record"), "first")
    if opened.isEmpty():
        last = pieces.where(F.col("kind") == TAIL)  # quotes that a file's end leaves open
        records = records.unionByName(last.select(F.col("text").alias("record"), "first"))
    else:
        parts = write_and_read(pieces.where(F.col("kind") != WHOLE), "record-pieces")
        order = Window.partitionBy("file").orderBy("start", "kind")  # a head comes before its split's tail
        parts = parts.withColumn("nth", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(order))
        whole = parts.groupBy("file", "nth").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "text"))).alias("p"), F.max("first").alias("first"))
        records = records.unionByName(whole.select(F.array_join(F.col("p.text"), "\n").alias("record"), "first"))
    end = F.when(F.endswith("record", F.lit("\r")), F.substring("record", F.lit(1), F.length("record") - 1)).otherwise(F.col("record"))
    return records.select(end.alias("record"), "first").where("record <> ''")


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, options: dict[str, str] | None = None) -> DataFrame:
    """The rows of CSV files whose quoted fields may hold line breaks, as ``multiLine`` reads them
    but in as many tasks as the files have splits; ``header`` drops each file's first record. Rows
    that do not fit the schema have nulls; a column ``_corrupt_record`` of it gets their text."""
    records = quoted_records(spark, path)
    if header:
        records = records.where(~F.col("first"))
    how = {"escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "columnNameOfCorruptRecord": "_corrupt_record"} | (options or {})
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    return records.select(F.from_csv("record", fields, how).alias("r")).select("r.*")
