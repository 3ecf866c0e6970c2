"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

Two permutations make the whole signature: the first scatters the 32-bit universe of shingle
values, the second, shifted circularly by k, gives coordinate k (Li and Li, "C-MinHash", 2021).

1. Texts with equal shingle sets form a class at once (an aggregate; copies cost nothing more).
2. Classes that share a band of the signature meet in that band's bucket. Large buckets are dealt
   into blocks, and each pair of blocks is one unit of work, so no task holds an unbounded group.
   Pairs whose signatures agree in fewer than ``least_agreement`` of the coordinates cannot, but
   for a chance below 1e-5, be links. Of the others a unit returns a spanning forest, never pairs.
3. The connected components of these forests are clusters of possible links. Their full shingle
   sets are dealt in blocks again and compared exactly; verified links give the final components.

A pair at the threshold 0.75 shares none of 40 bands of 4 with a chance of 2.5e-7.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_and_read
from .common import by_position, lower_words, small_batches, tidy
from .graph import components, small

WORDS, BANDS, ROWS = 5, 40, 4
K = BANDS * ROWS
#: Odd multipliers and shift widths: any would do; they are part of the stored values' meaning.
_WEIGHTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit values of the text's 5-word shingles; of a shorter text, one value
    for all its words; none without words."""
    words = lower_words(text)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(w) - WORDS + 1
    if not len(w):
        return w
    if n < 1:
        return _mix64(np.array([(w * _WEIGHTS[: len(w)]).sum() + np.uint64(len(w))]))
    h = w[:n] * _WEIGHTS[0]
    for j in range(1, WORDS):
        h = h + w[j : n + j] * _WEIGHTS[j]
    return np.unique(_mix64(h))


def signature(values: np.ndarray) -> np.ndarray:
    """K coordinates. The first permutation is the finaliser above, cut to 32 bits; the second a
    32-bit bijection, taken at positions shifted by 0 ... K - 1 around the universe."""
    place = (_mix64(values ^ np.uint64(0x5BD1E995)) >> np.uint64(32)).astype(np.uint32)
    out = np.full(K, 0xFFFFFFFF, np.uint32)
    shift = np.arange(K, dtype=np.uint32)[:, None]
    for a in range(0, len(place), 2048):
        x = place[None, a : a + 2048] - shift
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        np.minimum(out, x.min(1), out=out)
    return out


SKETCH = "doc_id bigint, text_hash bigint, n_shingles bigint, class binary, bands array<bigint>, low binary"


def sketch(docs: DataFrame) -> DataFrame:
    """Per row: hash of the text, set size, class (128-bit hash of the set; null without words), band keys, and the
    low byte of every coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.arange(BANDS, dtype=np.uint64)
        for b in batches:
            n, cls, bands, low = [], [], [], []
            for t in b.column(1):
                s = shingles(t.as_py())
                n.append(len(s))
                if not len(s):
                    cls.append(None), bands.append([]), low.append(None)
                    continue
                sig = signature(s)
                r = sig.reshape(BANDS, ROWS).astype(np.uint64)
                key = _mix64(_mix64(r[:, 0] << np.uint64(32) | r[:, 1]) ^ (r[:, 2] << np.uint64(32) | r[:, 3]) ^ salt * _WEIGHTS[0])
                cls.append(xxhash.xxh3_128_digest(s.tobytes()))
                bands.append(key.view(np.int64))
                low.append(sig.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                 pa.array(low, pa.binary())], names=["doc_id", "text_hash", "n_shingles", "class", "bands", "low"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(tidy(run), SKETCH)


def _blocks(df: DataFrame, key: str, size: int) -> DataFrame:
    """Rows of ``df`` (with ``key``, the group's row count ``n`` and ``class``) dealt to the units
    of their group: (key, i, j), i <= j, ``block`` being i or j. A group of at most ``size`` rows
    is one unit; a larger one has blocks of about that size and a unit for each two blocks."""
    parts = F.ceil(F.col("n") / size).cast("int")
    block = F.pmod(F.xxhash64("class"), parts).cast("int")
    dealt = df.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")


def _per_unit(df: DataFrame, key: str, schema: str, links: Callable[[list[dict]], list[tuple]]) -> DataFrame:
    """Rows of a unit, together and in order of ``class``, through ``links``."""
    unit = [key, "i", "j"]
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, found = None, [], []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                r = dict(zip(names, row, strict=True))
                here = tuple(r[c] for c in unit)
                if here != at:
                    found += links(held)
                    at, held = here, []
                held.append(r)
            if len(found) > 10_000:
                yield _edges(found)
                found = []
        yield _edges(found + links(held))

    return df.repartition(*unit).sortWithinPartitions(*unit, "class").mapInArrow(tidy(run), schema)


def _edges(found: list[tuple]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[x] = y
        return x != y


def _agreeing(rows: list[dict], least: int, size_ratio: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each row x: later rows y that it is compared with (in another block, or both in the
    unit's only one) and whose signatures agree in at least ``least`` coordinates."""
    low = np.frombuffer(b"".join(r["low"] for r in rows), np.uint8).reshape(len(rows), K)
    n = np.array([r["n_shingles"] for r in rows])
    block = np.array([r["block"] for r in rows])
    across = rows[0]["i"] != rows[0]["j"]
    for x in range(len(rows) - 1):
        agree = (low[x + 1 :] == low[x]).sum(1)
        ok = (agree >= least) & (np.minimum(n[x + 1 :], n[x]) >= size_ratio * np.maximum(n[x + 1 :], n[x]))
        if across:
            ok &= block[x + 1 :] != block[x]
        y = np.flatnonzero(ok)
        if len(y):
            yield x, y + x + 1, agree[y]


def link(docs: DataFrame, percent: int = 75, least_agreement: float = 0.5, block: int = 1024,
         broadcast_rows: int = 2_000_000) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Rows are linked if 100 * intersection >= percent * union of their shingle sets. component_id is
    the smallest doc_id reachable; kept tells whether it is the row's own. Rows without words are
    linked with nothing. Rows that repeat a doc_id are alike in everything that follows; a null
    doc_id is never the smallest, unless its component has no other (then it is kept).
    """
    return _linked(docs, percent, least_agreement, block, broadcast_rows).select("doc_id", "n_shingles", "component_id", "kept")


def _linked(docs: DataFrame, percent: int = 75, least_agreement: float = 0.5, block: int = 1024, broadcast_rows: int = 2_000_000) -> DataFrame:
    """The columns of :func:`link`, and each row's text_hash and component (of its class; null
    without words)."""
    docs = docs.select("doc_id", "text")
    small_batches(docs.sparkSession)
    rows = write_and_read(sketch(docs), "sketch")
    classes = write_and_read(
        rows.where("class IS NOT NULL").groupBy("class")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("low").alias("low")),
        "classes")
    least = int(least_agreement * K)
    ratio = percent / 100

    def alike(unit: list[dict]) -> list[tuple]:
        forest, out = _Forest(len(unit)), []
        for x, ys, _ in _agreeing(unit, least, ratio) if len(unit) > 1 else ():  # candidates, by their sketches
            out += [(unit[x]["class"], unit[y]["class"]) for y in ys.tolist() if forest.join(x, y)]
        return out

    in_band = classes.select("class", F.explode("bands").alias("bucket"))
    shared = in_band.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = write_and_read(in_band.join(shared, "bucket"), "members")
    sketches = write_and_read(classes.join(members.select("class").distinct(), "class", "left_semi").select("class", "n_shingles", "low", "first_id"), "sketches")
    units = _blocks(members.join(sketches.drop("first_id"), "class"), "bucket", block)
    clusters = write_and_read(components(_per_unit(units, "bucket", "a binary, b binary", alike)), "clusters")

    def verified(unit: list[dict]) -> list[tuple]:
        if len(unit) < 2:
            return []
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in unit]
        pairs = [(x, ys, agree) for x, ys, agree in _agreeing(unit, 0, ratio)]  # the sketches only give the order
        if not pairs:
            return []
        xs = np.repeat([p[0] for p in pairs], [len(p[1]) for p in pairs])
        ys, agree = np.concatenate([p[1] for p in pairs]), np.concatenate([p[2] for p in pairs])
        forest, out = _Forest(len(unit)), []
        for k in np.argsort(-agree, kind="stable").tolist():  # likely links first: they spare the others
            x, y = int(xs[k]), int(ys[k])
            if forest.root(x) == forest.root(y):
                continue
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                forest.join(x, y)
                out.append((unit[x]["class"], unit[y]["class"]))
        return out

    sized = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    wanted = write_and_read(clusters.join(sketches, clusters.node == sketches["class"]).drop("node").join(sized, "root"), "wanted")
    ids = small(wanted.select(F.col("first_id").alias("id")).distinct(), broadcast_rows)
    sets = _sets(docs.join(ids, docs.doc_id.eqNullSafe(ids.id), "left_semi")).groupBy("class").agg(F.first("shingles").alias("shingles"))
    links = _per_unit(_blocks(wanted.join(sets, "class").drop("first_id"), "root", block // 2), "root", "a binary, b binary", verified)
    comp = write_and_read(components(links), "components")

    least_id = comp.join(classes.select("class", "first_id"), comp.node == classes["class"]).groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = comp.join(least_id, "root").select(F.col("node").alias("class"), "root", "component_id")
    of_class = classes.select("class", "first_id", "copies").join(named, "class", "left").where("copies > 1 OR root IS NOT NULL").select(
        "class", F.coalesce("root", "class").alias("component"),
        F.when(F.col("component_id").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"), F.lit(True).alias("met"))
    # the only text of its set, linked with none, is a component of its own: no row of it is joined
    of_class = small(write_and_read(of_class, "linked-classes"), broadcast_rows)
    out = rows.select("doc_id", "text_hash", "n_shingles", "class").join(of_class, "class", "left").withColumn("component", F.coalesce("component", "class"))
    found = F.when(F.col("met").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", found.alias("component_id"), F.col("doc_id").eqNullSafe(found).alias("kept"), "text_hash", "component")


def _sets(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t.as_py()).tobytes() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(s) if s else None for s in sets], pa.binary()), pa.array(sets, pa.binary())],
                names=["class", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(tidy(run), T.StructType([T.StructField("class", T.BinaryType()), T.StructField("shingles", T.BinaryType())]))


def deduplicate(docs: DataFrame, broadcast_rows: int = 2_000_000, **options) -> DataFrame:
    """The rows of ``docs`` that stay: one row of each component, with all its columns, and of the
    texts without words one row of each doc_id and text. Of a component, the row of the smallest
    doc_id stays (a null one is the largest), of its texts the one of the least hash, of its rows
    with that text the one whose columns have the least hash. Columns may have any names."""
    docs, named_back = by_position(docs, "doc_id", "text")
    rows = write_and_read(_linked(docs, broadcast_rows=broadcast_rows, **options).select("doc_id", "text_hash", "component"), "linked")
    met = rows.where("component IS NOT NULL")
    first = met.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_hash")).alias("first"))
    first = small(write_and_read(first.where("n > 1").select("component", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash")), "firsts"), broadcast_rows)
    stays = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    gone = write_and_read(met.join(first, "component").where(~stays).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "gone")
    twice = rows.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    twice = write_and_read(twice, "repeated-rows")

    def same(listed: DataFrame):
        return docs["doc_id"].cast("long").eqNullSafe(listed["_id"]) & (F.xxhash64(docs["text"]) == listed["_hash"])

    gone = small(gone, broadcast_rows)
    if not twice.limit(1).count():
        return named_back(docs.join(gone, same(gone), "left_anti"))
    several = small(twice, broadcast_rows)
    single = docs.join(gone, same(gone), "left_anti").join(several, same(several), "left_anti")
    row = F.struct(*(docs[c] for c in docs.columns))
    least = F.min_by(row, F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)).alias("row")
    of_several = docs.join(gone, same(gone), "left_anti").join(several, same(several), "left_semi").groupBy(
        docs["doc_id"].cast("long").alias("_id"), F.xxhash64(docs["text"]).alias("_hash")).agg(least)
    return named_back(single.unionByName(of_several.select("row.*")))
