"""Removal of repeated passages: every byte covered by a ``length``-byte string that also starts
elsewhere in the corpus.

Suffix-sorting all bytes of a corpus would shuffle many times its size. So the suffixes are first
dealt to shards in which equal strings must meet, and most are settled on the way, exactly:

1. A window (``length`` bytes from some start) belongs to its anchor, the leftmost least hash among
   its 32-byte grams; equal windows have equal anchors at equal places. Consecutive windows of one
   anchor are a run; the bytes they span are its context. Anchors met once settle their runs.
2. Runs with equal contexts repeat each other. One context of each kind stays.
3. Contexts that share an anchor form a shard, suffix-sorted by the difference-cover algorithm
   (Karkkainen and Sanders): sort the triples at positions 1 and 2 mod 3, recurse on their names,
   sort the remaining suffixes by byte and rank, merge; then adjacent prefixes are compared.
4. A shard of over ``shard_contexts`` contexts is not collected: blocks of its windows are matched
   by hashes of what their windows share and span, and single windows where these don't decide,
   all as aggregates.

Equal documents are one class throughout; a class of several documents repeats as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import write_and_read
from .common import by_position, small_batches, tidy
from .graph import small

GRAM = 32
_BASE = 0x9E3779B97F4A7C15
_SEGMENT = 1 << 20  # starts handled at a time; positions in one fit the low bits of a key
_LOW = np.uint64((1 << 21) - 1)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    """64-bit hashes of all GRAM-byte grams, doubling the gram from one byte on."""
    h = _mix64(b.astype(np.uint64) + np.uint64(_BASE))
    step = 1
    while step < GRAM:
        h = _mix64(h[:-step] * np.uint64(_BASE) + h[step:])
        step *= 2
    return h


def runs(raw: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, number of starts, anchor's offset from the first start, anchor) of each run
    of the windows of ``raw``."""
    parts = []
    for at in range(0, len(raw) - length + 1, _SEGMENT):
        b = np.frombuffer(raw, np.uint8)[at : at + _SEGMENT + length - 1]
        h = _gram_hashes(b)
        span = length - GRAM + 1  # grams in a window
        m = len(h)
        key = (h & ~_LOW) | np.arange(m, dtype=np.uint64)
        padded = np.full(-(-m // span) * span, np.iinfo(np.uint64).max, np.uint64)
        padded[:m] = key
        rows = padded.reshape(-1, span)
        left = np.minimum.accumulate(rows, 1).ravel()
        right = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
        n = m - span + 1
        best = np.minimum(right[:n], left[span - 1 : span - 1 + n])
        first = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
        place = (best[first] & _LOW).astype(np.int64)
        parts.append((first + at, np.diff(np.r_[first, n]), place - first, h[place].view(np.int64)))
    if not parts:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``s`` (integers from 1 on) in order; an end sorts first."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate([s.astype(np.int64), [0, 0, 0]])
    n1, n2 = (n + 1) // 3 + (n % 3 == 1), n // 3  # a position n is sampled if n = 1 mod 3
    sample = np.concatenate([np.arange(n1) * 3 + 1, np.arange(n2) * 3 + 2])
    top = int(t.max()) + 1
    if top < 1 << 20:
        names = np.unique((t[sample] * top + t[sample + 1]) * top + t[sample + 2], return_inverse=True)[1]
    else:  # two steps keep the keys within 64 bits
        pair = np.unique(t[sample] * top + t[sample + 1], return_inverse=True)[1]
        names = np.unique(pair * top + t[sample + 2], return_inverse=True)[1]
    names = names.ravel() + 1
    if names.max() < len(names):
        order = suffix_array(names)
        names = np.empty(len(names), np.int64)
        names[order] = np.arange(1, len(names) + 1)
    rank = np.zeros(n + 4, np.int64)
    rank[sample] = names
    wide = len(sample) + 2
    zero = np.arange(0, n, 3)
    zero = zero[np.argsort(t[zero] * wide + rank[zero + 1], kind="stable")]
    ones, twos = sample[:n1], sample[n1:]
    ones = ones[np.argsort(rank[ones])]
    ones, twos = ones[ones < n], twos[np.argsort(rank[twos])]
    # places of 0-suffixes among 1-suffixes: both are (symbol, a sampled suffix)
    below1 = np.searchsorted(t[ones] * wide + rank[ones + 1], t[zero] * wide + rank[zero + 1])
    both = np.zeros(n + 4, np.int64)  # ranks of 0- and 1-suffixes together
    both[zero] = below1 + np.arange(len(zero)) + 1
    above0 = np.searchsorted(below1, np.arange(len(ones)), "right")
    both[ones] = above0 + np.arange(len(ones)) + 1
    # places of 2-suffixes among 0-suffixes: both are (symbol, a 0- or 1-suffix)
    wide = n + 2
    below2 = np.searchsorted(t[twos] * wide + both[twos + 1], t[zero] * wide + both[zero + 1])
    above02 = np.searchsorted(below2, np.arange(len(twos)), "right")
    # and among 1-suffixes: the sample's ranks
    two_one = np.searchsorted(rank[ones], rank[twos])
    one_two = np.searchsorted(rank[twos], rank[ones])
    out = np.empty(n, np.int64)
    out[below1 + below2 + np.arange(len(zero))] = zero
    out[above0 + one_two + np.arange(len(ones))] = ones
    out[above02 + two_one + np.arange(len(twos))] = twos
    return out


def repeated_starts(raw: bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes from each of ``starts`` (ascending) also follow another."""
    b = np.frombuffer(raw, np.uint8)
    wanted = np.zeros(len(b), bool)
    wanted[starts] = True
    order = suffix_array(b.astype(np.int64) + 1)
    order = order[wanted[order]]
    words = np.lib.stride_tricks.sliding_window_view(b, 8).copy().view("<u8").ravel()
    pair = np.arange(len(order) - 1)  # adjacent prefixes, eight bytes at a time
    for at in [*range(0, length - 8, 8), length - 8]:
        pair = pair[words[order[pair] + at] == words[order[pair + 1] + at]]
    hit = np.zeros(len(b), bool)
    hit[order[pair]] = hit[order[pair + 1]] = True
    return hit[starts]


def _spans(flags: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last positions of the runs of True."""
    edge = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return edge[::2].tolist(), (edge[1::2] - 1).tolist()


_SCAN = "class binary, doc_id bigint, n_bytes bigint, lo bigint, n bigint, off bigint, anchor bigint, ctx bigint"


def _raw(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def _scan(docs: DataFrame, length: int, batch: int = 50_000) -> DataFrame:
    """For each document a row with its class (SHA-256 of the bytes), doc_id and n_bytes, and a
    row with the class for each of its runs."""
    kinds = [pa.binary()] + [pa.int64()] * 7
    names = [x.split(" ")[0] for x in _SCAN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads: list[list] = [[], [], []]
            held, size = [], 0
            for doc_id, text in zip(b.column(0), b.column(1), strict=True):
                raw = _raw(text.as_py())
                cls = hashlib.sha256(raw).digest()
                for column, value in zip(heads, (cls, doc_id.as_py(), len(raw)), strict=True):
                    column.append(value)
                lo, count, off, anchor = runs(raw, length)
                ends = lo + count + length - 1
                ctx = np.fromiter((xxhash.xxh3_64_intdigest(raw[i:j]) for i, j in zip(lo.tolist(), ends.tolist(), strict=True)), np.uint64, len(lo))
                held.append((cls, lo, count, off, anchor, ctx.view(np.int64)))
                size += len(lo)
                if size >= batch:
                    yield from flush(held)
                    held, size = [], 0
            yield from flush(held)
            none = pa.nulls(len(heads[0]), pa.int64())
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(heads, kinds, strict=False)), *[none] * 5], names=names)

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        sizes = [len(h[1]) for h in held]
        if sum(sizes):
            cls = pa.array([h[0] for h in held], pa.binary()).take(pa.array(np.repeat(np.arange(len(held)), sizes)))
            none = pa.nulls(len(cls), pa.int64())
            flat = pa.RecordBatch.from_arrays([cls, none, none, *(pa.array(np.concatenate([h[i] for h in held])) for i in range(1, 6))], names=names)
            for a in range(0, len(cls), batch):
                yield flat.slice(a, batch)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), _SCAN)


def _contexts(docs: DataFrame, need: DataFrame, classes: DataFrame, length: int, broadcast_rows: int) -> DataFrame:
    """The bytes of the contexts in ``need``: anchor, ctx, n, off, text."""
    listed = need.groupBy("class").agg(F.collect_list(F.struct("anchor", "ctx", "lo", "n", "off")).alias("list"))
    listed = listed.join(classes.select("class", "first_id"), "class").select(F.col("first_id").alias("id"), "class", "list")
    listed = small(write_and_read(listed, "wanted-contexts"), broadcast_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("anchor", "ctx", "n", "off", "text")
        for b in batches:
            rows = []
            for text, cls, wanted in zip(*(c.to_pylist() for c in b.columns), strict=True):
                raw = _raw(text)
                if hashlib.sha256(raw).digest() == cls:  # else another text of a repeated doc_id
                    rows += [(w["anchor"], w["ctx"], w["n"], w["off"], raw[w["lo"] : w["lo"] + w["n"] + length - 1]) for w in wanted]
            kinds = [pa.int64()] * 4 + [pa.binary()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))

    joined = docs.join(listed, docs.doc_id.eqNullSafe(listed.id)).select("text", "class", "list")
    return joined.mapInArrow(tidy(run), "anchor bigint, ctx bigint, n bigint, off bigint, text binary")


_FOUND = "anchor bigint, ctx bigint, firsts array<bigint>, lasts array<bigint>"


def _sorted_shards(contexts: DataFrame, length: int, buffer: int = 300_000) -> DataFrame:
    """Suffix-sort shards, several small ones at a time; repeated starts as spans of each context."""

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        out: list[list] = [[], [], [], []]
        if rows:
            at = np.cumsum([0, *(len(r[3]) for r in rows)])
            n = np.array([r[2] for r in rows])
            starts = np.concatenate([a + np.arange(k) for a, k in zip(at, n, strict=False)])
            hit = repeated_starts(b"".join(r[3] for r in rows), starts, length)
            for r, flags in zip(rows, np.split(hit, np.cumsum(n)[:-1]), strict=True):
                if flags.any():
                    for column, value in zip(out, (r[0], r[1], *_spans(flags)), strict=True):
                        column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                                          names=["anchor", "ctx", "firsts", "lasts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and row[:2] == held[-1][:2]:
                    continue  # the same context from a repeated row of its document
                if size >= buffer and row[0] != held[-1][0]:
                    yield settle(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        yield settle(held)

    return contexts.select("anchor", "ctx", "n", "text").repartition("anchor").sortWithinPartitions("anchor", "ctx").mapInArrow(tidy(run), _FOUND)


def _counted_shards(contexts: DataFrame, length: int, block: int = 16) -> DataFrame:
    """The same for shards too large for one task. Windows of a shard are equal only at equal
    offsets of the anchor; for each block of offsets a context gives hashes of what all windows of
    the block share (``core``), of all they span, and of each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.binary())]
        for b in batches:
            rows = []
            for anchor, ctx, n, off, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for k in range((off - n + 1) // block, off // block + 1):
                    a, z = max(0, off - k * block - block + 1), min(n - 1, off - k * block)  # starts with offsets in the block
                    core = raw[off - k * block : off - k * block - block + 1 + length]
                    rows.append((anchor, ctx, k, digest(core), digest(raw[a : z + length] + bytes([off - k * block - a])), a,
                                 [digest(raw[i : i + length]) for i in range(a, z + 1)]))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                             names=["anchor", "ctx", "k", "core", "span", "first", "windows"])

    blocks = contexts.select("anchor", "ctx", "n", "off", "text").mapInArrow(
        tidy(run), "anchor bigint, ctx bigint, k bigint, core binary, span binary, first bigint, windows array<binary>")
    blocks = write_and_read(blocks.dropDuplicates(["anchor", "ctx", "k"]), "window-blocks")
    key = ["anchor", "k", "core"]
    spans = blocks.groupBy(*key, "span").agg(F.count(F.lit(1)).alias("same"))
    cores = spans.groupBy(*key).agg(F.count(F.lit(1)).alias("kinds"))
    judged = write_and_read(blocks.join(spans, [*key, "span"]).join(cores, key), "judged-blocks")
    last = F.col("first") + F.size("windows") - 1
    whole = judged.where("same > 1").select("anchor", "ctx", F.array("first").alias("firsts"), F.array(last).alias("lasts"))
    single = judged.where("kinds > 1").dropDuplicates([*key, "span"]).select(  # one of equal spans tells
        "anchor", "ctx", "first", "same", F.posexplode("windows").alias("p", "window"))
    twice = single.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("anchor", "window")
    at = F.col("first") + F.col("p")
    hit = single.where("same = 1").join(twice, ["anchor", "window"], "left_semi").select(
        "anchor", "ctx", F.array(at).alias("firsts"), F.array(at).alias("lasts"))
    return whole.union(hit)


def repeats(docs: DataFrame, length: int = 400, shard_contexts: int = 1000, broadcast_rows: int = 500_000) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): doc_id, class, n_bytes of every row of ``docs`` (doc_id, text), and for each
    class with removed bytes its first_id and ``spans``, the maximal removed runs [from, to)."""
    small_batches(docs.sparkSession)
    scan = write_and_read(_scan(docs, length), "runs")
    rows = scan.where("lo IS NULL").select("doc_id", "class", "n_bytes")
    every = scan.where("lo IS NOT NULL").select("class", "lo", "n", "off", "anchor", "ctx")
    classes = write_and_read(rows.groupBy("class").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"), F.first("n_bytes").alias("n_bytes")), "classes")
    shared = write_and_read(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("anchor"), "shared-anchors")
    # a class's copies count once; its runs of one context, as of a line that it repeats, are one row
    met = write_and_read(every.join(small(shared, 4 * broadcast_rows), "anchor").groupBy("class", "anchor", "ctx", "n", "off").agg(
        F.collect_set("lo").alias("los")), "met-runs")
    kinds = met.groupBy("anchor", "ctx").agg(
        F.sum(F.size("los")).alias("times"), F.min(F.struct("class", F.array_min("los").alias("lo"), "n", "off")).alias("one"))
    kinds = write_and_read(kinds.select("anchor", "ctx", "times", "one.*"), "contexts")
    wide = write_and_read(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "open-anchors")
    need = write_and_read(kinds.join(small(wide, 4 * broadcast_rows), "anchor"), "open-contexts")
    large = need.where(F.col("kinds") > shard_contexts)
    found = _sorted_shards(_contexts(docs, need.where(F.col("kinds") <= shard_contexts), classes, length, broadcast_rows), length)
    if large.limit(1).count():
        found = found.union(_counted_shards(_contexts(docs, large, classes, length, broadcast_rows), length))
    of_kind = found.groupBy("anchor", "ctx").agg(F.flatten(F.collect_list(F.arrays_zip("firsts", "lasts"))).alias("hits"))
    both = kinds.join(of_kind, ["anchor", "ctx"], "left").select("anchor", "ctx", F.when(
        F.col("times") > 1, F.array(F.struct(F.lit(0).cast("long").alias("firsts"), (F.col("n") - 1).alias("lasts")))).otherwise(F.col("hits")).alias("hits"))
    both = write_and_read(both.where("hits IS NOT NULL"), "repeated-contexts")
    found_at = F.flatten(F.transform("los", lambda lo: F.transform("hits", lambda h: F.struct(
        (lo + h["firsts"]).alias("a"), (lo + h["lasts"] + length).alias("b")))))
    hits = met.join(small(both, broadcast_rows), ["anchor", "ctx"]).select("class", F.inline(found_at))
    # in order of their starts, an interval beyond all earlier ends opens a new removed run
    order = Window.partitionBy("class").orderBy("a", "b")
    before = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = hits.withColumn("opens", (before.isNull() | (F.col("a") > before)).cast("int"))
    island = opened.withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    inner = island.groupBy("class", "island").agg(F.min("a").alias("a"), F.max("b").alias("b")).groupBy("class").agg(
        F.array_sort(F.collect_list(F.struct("a", "b"))).alias("inner"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("n_bytes").alias("b")))
    full = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    spans = classes.select("class", "first_id", "copies", "n_bytes").join(inner, "class", "left").select(
        "class", "first_id", F.when(full, whole).otherwise(F.col("inner")).alias("spans")).where("spans IS NOT NULL")
    return rows, write_and_read(spans, "removed-spans")


def _cut(raw: bytes, spans: list[dict]) -> bytes:
    out, end = [], 0
    for s in spans:
        out.append(raw[end : s["a"]])
        end = s["b"]
    return b"".join([*out, raw[end:]])


def remove(docs: DataFrame, length: int = 250, broadcast_rows: int = 500_000, **options) -> DataFrame:
    """``docs`` with the covered bytes cut out of ``text``; of characters cut in part, the rest
    goes too. Other columns, whatever their names, and all rows stay as they are: null and short
    texts too, and repeated rows are cut alike. An empty table gives an empty one."""
    inner, named_back = by_position(docs, "doc_id", "text")
    rows, spans = repeats(inner.select("doc_id", "text"), length, broadcast_rows=broadcast_rows, **options)
    listed = rows.select(F.col("doc_id").alias("_id"), "class").distinct().join(small(spans.drop("first_id"), broadcast_rows), "class")
    cuts = listed.groupBy("_id").agg(F.collect_list(F.struct("class", "spans")).alias("_cuts"))
    cuts = small(write_and_read(cuts, "cuts"), broadcast_rows)
    met = inner.join(cuts, inner["doc_id"].eqNullSafe(cuts["_id"]), "left").select(*inner.columns, "_cuts")
    names, at = inner.columns, inner.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns, held = list(b.columns[:-1]), b.column(b.num_columns - 1)
            there = np.flatnonzero(held.is_valid().to_numpy(zero_copy_only=False))
            if len(there):
                texts = columns[at].to_pylist()
                for i, cut in zip(there.tolist(), held.take(pa.array(there)).to_pylist(), strict=True):
                    left = _kept(texts[i], cut)
                    texts[i] = texts[i] if left is None else left.decode("utf-8", "ignore")
                columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return named_back(met.mapInArrow(tidy(run), inner.schema))


def _kept(text: str | None, cuts: list) -> bytes | None:
    """What is left of a text, or None if none of ``cuts`` is of this text."""
    raw = _raw(text)
    cls = hashlib.sha256(raw).digest()
    spans = next((c["spans"] for c in cuts if bytes(c["class"]) == cls), None)
    return None if spans is None else _cut(raw, spans)


def digest(docs: DataFrame, length: int = 400, broadcast_rows: int = 500_000, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs`` (doc_id, text);
    null texts are empty, texts shorter than ``length`` lose nothing, repeated rows repeat each
    other."""
    docs = docs.select("doc_id", "text")
    rows, spans = repeats(docs, length, broadcast_rows=broadcast_rows, **options)
    listed = spans.select(F.col("first_id").alias("_id"), "class", "spans")
    part = listed.groupBy("_id").agg(F.collect_list(F.struct("class", "spans")).alias("_cuts"))
    part = small(write_and_read(part, "cuts"), broadcast_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for text, cuts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                raw = _raw(text)
                cls = hashlib.sha256(raw).digest()
                out += [(cls, sum(s["b"] - s["a"] for s in c["spans"]), len(c["spans"]), hashlib.sha256(_cut(raw, c["spans"])).hexdigest())
                        for c in cuts if c["class"] == cls]
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["class", "n_removed", "n_spans", "kept_sha256"])

    held = docs.join(part, docs.doc_id.eqNullSafe(part["_id"])).select("text", "_cuts")
    cut = held.mapInArrow(tidy(run), "class binary, n_removed bigint, n_spans bigint, kept_sha256 string").dropDuplicates(["class"])
    cut = small(write_and_read(cut, "cut-classes"), broadcast_rows)  # copies of one text are many rows of a class
    return rows.join(cut, "class", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept_sha256", F.lower(F.hex("class"))).alias("kept_sha256"))
