"""Fill-in-the-middle transformation over content-defined chunks with a memo.

A rolling hash cuts each text into chunks where its content says so, so that passages which many
texts share fall into the same chunks. What the cuts need of a chunk (its line breaks, its code
points, whether a sentinel stands in it) is worked out once for each different content and kept in
a cache that compares whole contents; a summary's first and last two bytes join it to its
neighbours. A document's line count is the sum over its chunks, and a cut is found by bisecting the
running counts and looking into one chunk.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.scalar import named
from .common import small_batches, tidy

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
#: Bytes of a chunk: none shorter but a text's last, none longer; about ``1 << BITS`` more than the least.
LEAST, MOST, BITS = 256, 16384, 10
#: A hash takes in the 32 bytes before a place, fewer than LEAST: so it never sees another chunk.
_GEAR = np.random.default_rng(12).integers(0, 1 << 32, 256, dtype=np.uint32)
#: Bytes hashed at a time, and bytes of contents that a worker's memo holds in each of two generations.
SLAB, MEMO = 1 << 22, 1 << 24


def breaks(data: np.ndarray) -> np.ndarray:
    """Places after which a chunk may end: the top BITS bits of the rolling hash are all zero."""
    found = []
    for at in range(0, len(data), SLAB):
        lead = min(at, 31)
        h = _GEAR[data[at - lead:at + SLAB]]
        for k in (1, 2, 4, 8, 16):  # h[i] = sum of gear[byte i-j] << j over the last 2k bytes
            h[k:] += h[:-k] << np.uint32(k)
        found.append(np.flatnonzero(h[lead:] >> np.uint32(32 - BITS) == 0) + at + 1)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunk_ends(places: list[int], start: int, end: int) -> list[int]:
    """Ends of the chunks of the text at start..end, given the sorted places of :func:`breaks`."""
    ends, at, i = [], start, bisect_left(places, start + LEAST)
    while end - at > LEAST:
        while i < len(places) and places[i] < at + LEAST:
            i += 1
        at = min(places[i] if i < len(places) else end, at + MOST, end)
        ends.append(at)
    if at < end:
        ends.append(end)
    return ends


def code_points(part: bytes) -> int:
    """Code points that start in ``part``, which may begin and end inside one."""
    if part.isascii():
        return len(part)
    return int(np.count_nonzero((np.frombuffer(part, np.uint8) & 0xC0) != 0x80))


class Memo:
    """Summaries by chunk content, in two generations of bounded bytes: the older one goes when the
    newer one is full, so contents seen again and again stay."""

    def __init__(self, most: int = MEMO):
        self.new: dict[bytes, tuple] = {}
        self.old: dict[bytes, tuple] = {}
        self.size, self.most, self.hits, self.misses = 0, most, 0, 0

    def summary(self, part: bytes) -> tuple[int, int, bool, bytes, bytes]:
        """(line breaks, code points, holds a sentinel, first two bytes, last two bytes)."""
        if found := self.new.get(part):
            self.hits += 1
            return found
        found = self.old.get(part)
        self.hits, self.misses = self.hits + (found is not None), self.misses + (found is None)
        found = found or (part.count(b"\n"), code_points(part), any(s in part for s in SENTINELS), part[:2], part[-2:])
        if self.size > self.most:
            self.old, self.new, self.size = self.new, {}, 0
        self.new[part] = found
        self.size += len(part) + 200
        return found


class Text:
    """One text as chunks and their running counts."""

    def __init__(self, text: bytes, ends: list[int], memo: Memo):
        self.text, self.ends = text, ends
        lines, points, self.marked, tail = [], [], False, b""
        at = 0
        for e in ends:
            n, c, marked, head, last = memo.summary(text[at:e])
            joint = tail + head
            self.marked |= marked or any(s in joint for s in SENTINELS)
            tail = last if e - at > 1 else (tail + last)[-2:]
            lines.append(n)
            points.append(c)
            at = e
        self.lines, self.points = list(accumulate(lines)), list(accumulate(points))
        #: lines, the last of which may lack its break
        self.n = (self.lines[-1] if ends else 0) + (bool(text) and not text.endswith(b"\n"))

    def cut(self, k: int) -> tuple[int, int]:
        """(bytes, code points) of the first ``k`` lines."""
        if k == 0:
            return 0, 0
        i = bisect_left(self.lines, k)
        if i == len(self.lines):  # the last line, without a break
            return len(self.text), self.points[-1]
        start = self.ends[i - 1] if i else 0
        part = self.text[start:self.ends[i]]
        nth = k - (self.lines[i - 1] if i else 0)
        off = int(np.flatnonzero(np.frombuffer(part, np.uint8) == 10)[nth - 1]) + 1
        return start + off, (self.points[i - 1] if i else 0) + code_points(part[:off])


def arrange(text: Text, key: bytes, seed: int, fim_percent: int, spm_percent: int) -> tuple:
    """(form, code points of prefix and middle or None, output) of one text."""
    if not text.text or text.marked:
        return "plain", None, None, text.text
    dice = hashlib.sha256(b"%d:%s" % (seed, key)).hexdigest()
    h1, h2, h3, h4 = (int(dice[i:i + 8], 16) for i in (0, 8, 16, 24))
    if h3 % 100 >= fim_percent:
        return "plain", None, None, text.text
    first, second = sorted((h1 % (text.n + 1), h2 % (text.n + 1)))
    (a, ca), (b, cb) = text.cut(first), text.cut(second)
    t = text.text
    if h4 % 100 < spm_percent:
        return "spm", ca, cb - ca, b"".join((SUFFIX, t[b:], PREFIX, t[:a], MIDDLE, t[a:b]))
    return "psm", ca, cb - ca, b"".join((PREFIX, t[:a], SUFFIX, t[b:], MIDDLE, t[a:b]))


def transform(docs: DataFrame, seed: int = 7, fim_percent: int = 100, spm_percent: int = 50,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row for each row of ``docs``.

    A text of n lines (``[^\\n]*\\n|[^\\n]+``) is cut twice at line ends by the digits of sha256 of
    ``seed:doc_id``: ``psm`` puts suffix before middle, ``spm`` the suffix first. Texts that are
    empty or hold a sentinel, and those beyond ``fim_percent``, are ``plain``: the text as it is, the
    character counts null. A null text counts as empty, a null id as no digits after the colon;
    repeated rows come out alike. Columns other than the two are not looked at. An empty table
    gives an empty one. Long texts are handled whole.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(named(id_col).alias("doc_id"), F.coalesce(named(id_col).cast("string"), F.lit("")).alias("key"),
                       F.coalesce(named(text_col), F.lit("")).alias("text"))
    schema = StructType([rows.schema["doc_id"], StructField("n", LongType()), StructField("form", StringType()),
                         StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
                         StructField("output", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo()
        for batch in batches:
            texts = batch["text"].cast(pa.large_string())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1].tolist()
            data = np.frombuffer(texts.buffers()[2], np.uint8) if offsets[-1] else np.empty(0, np.uint8)
            base = offsets[0]
            places = (breaks(data[base:offsets[-1]]) + base).tolist()
            out: list[tuple] = []
            first = size = 0
            for i, key in enumerate(batch["key"].to_pylist()):
                start, end = offsets[i], offsets[i + 1]
                text = Text(data[start:end].tobytes(), [e - start for e in chunk_ends(places, start, end)], memo)
                out.append((text.n, *arrange(text, key.encode(), seed, fim_percent, spm_percent)))
                size += end - start
                if size > SLAB or i + 1 == len(batch):  # hand over a few megabytes at a time
                    n, form, prefix, middle, output = zip(*out)
                    yield pa.record_batch([batch["doc_id"].slice(first, len(out)), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                                           pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())], names=schema.names)
                    out, first, size = [], i + 1, 0

    return rows.mapInArrow(tidy(run), schema)


def restored(output: Column, form: Column) -> Column:
    """The text that :func:`transform` was given, from its output: sentinels stand in no cut text, so
    splitting at them gives the three parts."""
    parts = F.split(output, "<[PSM]>", -1)  # an empty part stands before the first sentinel
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))


def digest(docs: DataFrame) -> DataFrame:
    """:func:`transform` with sha256 of the output and of the text :func:`restored` from it."""
    return transform(docs).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                                  F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
