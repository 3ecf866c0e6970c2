"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Bytes of a text: A-Z to a-z and white space (0x09-0x0D, 0x20) kept as it is; bytes.split()
#: then cuts exactly at those six bytes, so non-ASCII letters and spaces stay inside words.
def lower_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def values(column: pa.Array) -> list:
    """A column's strings, bytes or numbers without nulls as a list: ``to_pylist`` makes a scalar of each first, at
    some ten times the cost."""
    return column.to_numpy(zero_copy_only=False).tolist()


def coded_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, code of each word, number of words up to each text's end): as
    :func:`lower_words`, a batch at a time. Looking words up once a batch, in Arrow's hash table,
    costs far less than a dictionary probe for each."""
    # lower-cased before the cast: a slice cast first keeps offsets that ascii_lower reads wrongly
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")).cast(pa.large_string()))
    flat = split.flatten()
    there = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    cuts = split.offsets.to_numpy() - split.offsets[0].as_py()
    ends = np.concatenate([[0], np.cumsum(there)])[cuts[1:]]
    coded = flat.filter(pa.array(there)).dictionary_encode()
    return values(coded.dictionary.cast(pa.large_binary())), coded.indices.to_numpy().astype(np.int64), ends


def small_batches(spark: SparkSession, most: int = 1000, most_bytes: int = 4 << 20) -> None:
    """Have Spark hand texts to Python at most ``most`` rows at a time, and no further row once they
    take ``most_bytes``: at the default of 10,000 long texts fill both the executor's off-heap buffers
    and the workers. Plans are read lazily, so the settings stay for the rest of the session."""
    for key, limit in (("maxRecordsPerBatch", most), ("maxBytesPerBatch", most_bytes)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key).removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= limit:  # a size in a larger unit too
            spark.conf.set(key, str(limit))


def slices(batch: pa.RecordBatch, column: int, rows: int = 1000, size: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """``batch`` cut into runs of at most ``rows`` rows whose texts in ``column`` have together at most
    ``size`` bytes, or of one longer text: what is made of a run then takes memory by its text, not
    by its rows."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + size, "right"))))
        yield batch.slice(at, to - at)
        at = to


def give_back() -> None:
    """Return to the system what Arrow's allocator and glibc hold in reserve."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """``run`` for mapInArrow, giving memory back at a task's end: Python workers live on, idle,
    beside those of later stages."""

    def whole(batches):
        yield from run(batches)
        give_back()

    return whole


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A fresh folder URI under the shared checkpoint folder, made through Hadoop, for files
    that tasks write themselves. Removed when the application ends."""
    path = scratch_path(spark, tag)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return fs.getFileStatus(p).getPath().toString()


def filesystem(uri: str):
    """(pyarrow file system, path) of a Hadoop-style URI: file:, hdfs:, s3:, gs: ..."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def private_names(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Column names built from ``names`` that no column of ``df`` has (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return tuple(out)


def by_position(docs: DataFrame, *kept: str):
    """``docs`` with all columns but ``kept`` renamed by their place, and a function that gives a
    frame of the same columns their names back: for operators that pass columns through, whatever
    dots or clashing names they have."""
    names = docs.columns
    return docs.toDF(*(c if c in kept else f"_c{i}" for i, c in enumerate(names))), lambda out: out.toDF(*names)
