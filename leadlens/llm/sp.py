"""SentencePiece encoding and decoding with a relational lattice.

A text with a space in front is cut before every run of spaces into segments, and these into units:
runs of letters, single digits, runs of other marks, each with the spaces in front. No piece may join
two units: the loaded model's pieces are tried against this rule, units stay whole where a piece
crosses (``Pieces.glue``), and if one crosses into a run of spaces, whole texts are the units. The
model writes spaces as U+2581; here they stay spaces, so that a U+2581 of the text itself
is told apart (it becomes its bytes). Each distinct unit is encoded once; those of more than ``MOST``
characters by :func:`cheapest`, which carries the paths along the unit, the others by the lattice:

* its substrings up to the longest piece are exploded and equi-joined with the piece table;
* the matches, as edges (end, start, id), stand together by unit: the units are hash-partitioned and
  sorted before they are exploded, so no edge is shuffled, sorted or held beyond its batch;
* many units' edges at a time are folded in order of their ends to the cheapest paths (Viterbi);
  a character without a piece costs ``FALLBACK`` and becomes its bytes.

A piece costs ln(H r), r being its rank in the model's order: its negative log probability under
Zipf's law (a BPE model has merge ranks, no probabilities; segmentations therefore are those of the
unigram lattice, not of the merges). Of equal costs, the path whose last piece starts first wins.

Documents are then encoded by looking units up: the encoded units, the most frequent first, up to
``shared_units``, are looked up by the tasks in index files in the shared folder; the units beyond are
joined to the documents that hold them. Decoding concatenates the pieces' bytes.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import uuid
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import write_and_read
from .common import by_position, filesystem, give_back, private_names, shared_folder, slices, small_batches, tidy, values

SPACE = " "
_MODEL_SPACE = "▁"
MOST = 1000
FALLBACK = 1000.0
_UNIT = re.compile(rf"{SPACE}*[^\W\d_]+|{SPACE}*\d|{SPACE}*(?:[^\w{SPACE}]+|_+)+|{SPACE}+")
_SEGMENT = re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Pieces:
    """The model's piece table: ids and costs of pieces, ids of bytes, bytes of ids. Of fixed size."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.raw: list[bytes] = []
        self.byte = [0] * 256
        self.piece: dict[str, int] = {}
        for i in range(sp.get_piece_size()):
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(text[3:5], 16)] = i
                self.raw.append(bytes([int(text[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                text = text.replace(_MODEL_SPACE, SPACE)
                self.piece[text] = i
                self.raw.append(text.encode())
        total = math.log(sum(1 / r for r in range(1, len(self.piece) + 1)))
        self.cost = {i: total + math.log(r) for r, i in enumerate(self.piece.values(), 1)}
        self.longest = max(map(len, self.piece), default=1)
        #: Whether a piece has a space behind another character; else, where pieces join units.
        self.whole = any(SPACE in p.lstrip(SPACE) for p in self.piece)
        joined = {a[-1] + b[0] for p in self.piece for a, b in pairwise(_UNIT.findall(p))}
        self.glue = None if self.whole or not joined else re.compile("|".join(map(re.escape, sorted(joined))))

    def cut(self, segment: str) -> list[str]:
        """Units of a segment, given with its spaces in front."""
        if self.whole:
            return [segment]
        found = _UNIT.findall(segment)
        if not self.glue or not self.glue.search(segment):
            return found
        out = found[:1]
        for u in found[1:]:
            if self.glue.fullmatch(out[-1][-1] + u[0]):
                out[-1] += u
            else:
                out.append(u)
        return out


def units(text: str | None, pieces: Pieces | None = None) -> list[str]:
    cut = pieces.cut if pieces else _UNIT.findall
    whole = pieces is not None and pieces.whole
    return [u for x in ([SPACE + text] if whole else _SEGMENT.findall(SPACE + text)) for u in cut(x)] if text else []


def segments(texts: pa.Array, whole: bool = False) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct segments without the first space in front, code of each segment, segments up to
    each text's end)."""
    full = texts.fill_null("").cast(pa.large_string())
    if whole:
        there = pc.greater(pc.binary_length(full), 0)
        coded = full.filter(there).dictionary_encode()
        return values(coded.dictionary), coded.indices.to_numpy().astype(np.int64), np.cumsum(there.to_numpy(zero_copy_only=False))
    split = pc.split_pattern(full, SPACE)
    cuts = split.offsets.to_numpy() - split.offsets[0].as_py()
    parts = split.flatten()
    # empty parts are the spaces before the next part, or the last ones of the text
    ends = pc.greater(pc.binary_length(parts), 0).to_numpy(zero_copy_only=False).copy()
    ends[cuts[1:][np.diff(cuts) > 0] - 1] = True
    there = ends & np.repeat(pc.greater(pc.binary_length(full), 0).to_numpy(zero_copy_only=False), np.diff(cuts))
    at = np.flatnonzero(there)
    kept = parts.filter(pa.array(there, pa.bool_()))
    before = np.diff(np.concatenate([[-1], np.flatnonzero(ends)]))[there[ends]] - 1
    if before.any():
        spaces = pc.binary_repeat(pa.scalar(SPACE, pa.large_string()), pa.array(before))
        kept = pc.binary_join_element_wise(spaces, kept, pa.scalar("", pa.large_string()))
    coded = kept.dictionary_encode()
    return values(coded.dictionary), coded.indices.to_numpy().astype(np.int64), np.searchsorted(at, cuts[1:])


def cheapest(unit: str, pieces: Pieces) -> list[int]:
    """The ids of the unit's cheapest path, -1 for a character without a piece: as the lattice's
    fold, in time and memory that grow with the unit's length alone."""
    cost, last = [0.0], [(0, -1)]
    for end in range(1, len(unit) + 1):
        best, step = math.inf, (0, -1)
        for start in range(max(0, end - pieces.longest), end):
            i = pieces.piece.get(unit[start:end], -1)
            if i >= 0 or start == end - 1:
                c = cost[start] + (pieces.cost[i] if i >= 0 else FALLBACK)
                if c < best:
                    best, step = c, (start, i)
        cost.append(best)
        last.append(step)
    out, at = [], len(unit)
    while at:
        at, i = last[at]
        out.append(i)
    return out[::-1]


def _count(docs: DataFrame, text: str, known) -> DataFrame:
    """(uid, unit, times): segments are counted by batches, then over the corpus, then cut."""

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 0):
                words, codes, _ = segments(b.column(0), known.value.whole)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(np.bincount(codes, minlength=len(words)))], names=["segment", "times"])
                give_back()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter = Counter()
            for x, n in zip(values(b.column(0)), values(b.column(1)), strict=True):
                for u in known.value.cut(SPACE + x):
                    seen[u] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["unit", "times"])

    counted = docs.select(F.col(f"`{text}`")).mapInArrow(tidy(batch), "segment string, times bigint").groupBy("segment").agg(F.sum("times").alias("times"))
    found = counted.mapInArrow(tidy(cut), "unit string, times bigint").groupBy("unit").agg(F.sum("times").alias("times"))
    return write_and_read(found.withColumn("uid", F.monotonically_increasing_id()), "counted-units")


def encode_units(counted: DataFrame, pieces: Pieces, known) -> DataFrame:
    """(unit, times, ids) from (uid, unit, times), uid unique; -1 in ids stands for a character
    without a piece.

    An edge is one number, end * 2^48 + start * 2^32 + id + 1 (id + 1 is 0 for a character without a
    piece). Units are dealt and sorted by uid before they are exploded; neither that nor the join
    with the broadcast pieces moves rows, so a unit's edges stay together and need no other sort."""
    costs = np.array([FALLBACK, *(pieces.cost.get(i, FALLBACK) for i in range(len(pieces.raw)))])
    table = counted.sparkSession.createDataFrame([(p, i + 1) for p, i in pieces.piece.items()], "piece string, id int")
    dealt = counted.where(F.length("unit") <= MOST).repartition("uid").sortWithinPartitions("uid")
    tails = dealt.select("uid", "times", F.explode(F.sequence(F.lit(1), F.length("unit"))).alias("s"), "unit").select(
        "uid", "s", F.expr(f"substring(unit, s, {pieces.longest})").alias("tail"), *(F.when(F.col("s") == 1, F.col(c)).alias(c) for c in ("unit", "times")))
    cuts = tails.select("uid", "s", "tail", "unit", "times", F.explode(F.sequence(F.lit(1), F.length("tail"))).alias("l")).select(
        "uid", "s", "l", F.expr("substring(tail, 1, l)").alias("piece"), *(F.when(F.col("l") == 1, F.col(c)).alias(c) for c in ("unit", "times")))
    # a character that is no piece keeps an edge of its own, without an id; that of the first one brings the unit along
    edges = cuts.join(F.broadcast(table), "piece", "left").where("id IS NOT NULL OR l = 1")
    edge = F.expr(f"(s + l - 1) * {1 << 48}L + (s - 1) * {1 << 32}L + coalesce(id, 0)")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, last = 0, -1

        def close() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            there = t.filter(pc.is_valid(t.column("unit")))
            size, ids = cheapest_paths(t.column("uid").to_numpy(), t.column("edge").to_numpy(), costs)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(ids, pa.int32()))
            return pa.RecordBatch.from_arrays([*(there.column(c).combine_chunks() for c in ("unit", "times")), lists], names=["unit", "times", "ids"])

        for b in batches:
            if not b.num_rows:
                continue
            uid = b.column(0).to_numpy()
            if uid[0] < last or (np.diff(uid) < 0).any():
                raise RuntimeError("the edges of a unit are not together")
            last = uid[-1]
            if rows < _EDGES:
                held.append(b)
                rows += b.num_rows
                continue
            # what goes before this batch's last unit, or before the batch if that unit has begun there, is whole
            cut = int(np.searchsorted(uid, last))
            if cut or held[-1].column(0)[-1].as_py() != last:
                held.append(b.slice(0, cut))
                yield close()
                held, rows = [], 0
            held.append(b.slice(cut))
            rows += b.num_rows - cut
        if held:
            yield close()

    folded = edges.select("uid", edge.alias("edge"), "unit", "times").mapInArrow(tidy(fold), "unit string, times bigint, ids array<int>")

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [cheapest(u, known.value) for u in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.list_(pa.int32()))], names=["unit", "times", "ids"])

    long = counted.where(F.length("unit") > MOST).select("unit", "times")
    return folded.unionByName(long.mapInArrow(tidy(carried), "unit string, times bigint, ids array<int>"))


_EDGES = 100_000  # of lattices folded at a time


def cheapest_paths(uid: np.ndarray, edge: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of ids, ids one unit after the other) of the cheapest path of each unit, whose edges stand
    together: the edges that end at the first character of all units are folded, then those at the
    second, and so on. Of equal costs the edge that starts first is taken."""
    unit = np.cumsum(np.concatenate([[True], uid[1:] != uid[:-1]])) - 1
    end, start, piece = edge >> 48, (edge >> 32) & 65535, edge & ((1 << 32) - 1)
    size = np.zeros(unit[-1] + 1, np.int64)
    np.maximum.at(size, unit, end)
    base = np.cumsum(size + 1) - size - 1  # a unit's position 0
    order = np.lexsort((start, unit, end))
    node, before, price = (base[unit] + end)[order], (base[unit] + start)[order], costs[piece[order]]
    cost, back, taken = np.zeros(int((size + 1).sum())), np.zeros(int((size + 1).sum()), np.int64), np.zeros(int((size + 1).sum()), np.int64)
    piece = piece[order]
    layers = np.searchsorted(end[order], np.arange(1, size.max() + 2))
    for a, b in pairwise(layers.tolist()):
        at, found = node[a:b], cost[before[a:b]] + price[a:b]
        heads = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        least = np.minimum.reduceat(found, heads)
        best = np.flatnonzero(found == np.repeat(least, np.diff(np.append(heads, len(at)))))
        best = best[np.concatenate([[True], at[best][1:] != at[best][:-1]])]  # the first of equal ones
        cost[at[heads]], back[at[heads]], taken[at[heads]] = least, before[a:b][best], piece[a:b][best]
    which, now, steps = np.arange(len(size)), base + size, []
    while len(which):
        steps.append((which, taken[now] - 1))
        now = back[now]
        more = now > base[which]
        which, now = which[more], now[more]
    who, ids = (np.concatenate(x[::-1]) for x in zip(*steps, strict=True))
    return np.bincount(who, minlength=len(size)), ids[np.argsort(who, kind="stable")].astype(np.int32)


_PARTS = 16
_HEAD = "<QQ"  # units, ids


def _write_index(table: DataFrame, known) -> tuple[str, list[str]]:
    """Write the encoded units of ``table`` (unit, ids) as index files, one for each range of the
    units' hashes: (folder, file of each range). A file holds its units' sorted hashes, the starts
    of their ids, and the ids."""
    folder = shared_folder(table.sparkSession, "units-index")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = values(b.column(0))
            size, flat = spelled(texts, b.column(1), known.value)
            h = np.fromiter(map(xxhash.xxh3_64_intdigest, texts), np.uint64, len(texts))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array((h >> np.uint64(60)).astype(np.int64)), pa.array(h.view(np.int64)), lists], names=["part", "h", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        at, held = None, []

        def close() -> pa.RecordBatch:
            h = np.concatenate([x[0] for x in held])
            order = np.argsort(h)
            size, flat = np.concatenate([x[1] for x in held]).astype(np.int64), np.concatenate([x[2] for x in held])
            ids, ends = _gather(flat, np.cumsum(size) - size, size, order)
            name = f"{uuid.uuid4().hex}.units"
            with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(struct.pack(_HEAD, len(h), len(ids)) + h[order].tobytes() + np.concatenate([[0], ends]).astype("<u4").tobytes() + ids.astype("<i4").tobytes())
            return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([name])], names=["part", "file"])

        for b in batches:
            part = b.column(0).to_numpy()
            cut = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for i, j in zip(cut, cut[1:], strict=False):
                if i < j:
                    if part[i] != at:
                        if held:
                            yield close()
                        at, held = int(part[i]), []
                    lists = b.column(2).slice(i, j - i)
                    held.append((b.column(1).to_numpy()[i:j].view(np.uint64), np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()))
        if held:
            yield close()

    rows = table.mapInArrow(tidy(hashed), "part bigint, h bigint, ids array<int>").repartitionByRange(_PARTS, "part").sortWithinPartitions("part")
    files = {r.part: r.file for r in write_and_read(rows.mapInArrow(tidy(write), "part bigint, file string"), "units-files").collect()}
    return folder, [files.get(i, "") for i in range(_PARTS)]


class Shared:
    """The index files, opened once by each Python worker: mapped into memory where the shared
    folder is a mounted one (a machine's workers then share the pages), read whole elsewhere."""

    held: dict[str, Shared] = {}

    def __init__(self, folder: str, files: list[str]):
        from pyarrow import fs as afs

        fs, root = filesystem(folder)
        self.parts = []
        for name in files:
            if not name:
                self.parts.append((np.empty(0, np.uint64), np.zeros(1, "<u4"), np.empty(0, "<i4")))
                continue
            path = f"{root}/{name}"
            raw = np.memmap(path, np.uint8, "r") if isinstance(fs, afs.LocalFileSystem) else np.frombuffer(fs.open_input_file(path).read(), np.uint8)
            size = struct.calcsize(_HEAD)
            n, m = struct.unpack(_HEAD, raw[:size].tobytes())
            a, b = size + 8 * n, size + 8 * n + 4 * (n + 1)
            self.parts.append((raw[size:a].view("<u8"), raw[a:b].view("<u4"), raw[b : b + 4 * m].view("<i4")))

    @classmethod
    def of(cls, folder: str, files: list[str]) -> Shared:
        if folder not in cls.held:
            cls.held.clear()  # one index at a time
            cls.held[folder] = cls(folder, files)
        return cls.held[folder]

    def find(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of the words found, one after the other; start and size for each word, size -1
        for one that is not there)."""
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        start, size = np.zeros(len(h), np.int64), np.full(len(h), -1, np.int64)
        out, total = [], 0
        order = np.argsort(h)
        bounds = np.searchsorted(h[order] >> np.uint64(60), np.arange(_PARTS + 1, dtype=np.uint64))
        for (known, starts, ids), i, j in zip(self.parts, bounds[:-1], bounds[1:], strict=True):
            if i < j and len(known):
                mine = order[i:j]
                at = np.minimum(np.searchsorted(known, h[mine]), len(known) - 1)
                there = known[at] == h[mine]
                mine, at = mine[there], at[there]
                first = starts[at].astype(np.int64)
                n = starts[at + 1].astype(np.int64) - first
                found, ends = _gather(ids, first, n, np.arange(len(at)))
                out.append(found)
                start[mine], size[mine] = total + ends - n, n
                total += len(found)
        return np.concatenate([np.empty(0, np.int32), *out]), start, size


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the runs of ``flat`` that ``which`` names, one after the other; their ends)."""
    n = size[which].astype(np.int64)
    ends = np.cumsum(n)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[which] - ends + n, n)], ends


def spelled(texts: list[str], ids: pa.ListArray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, flat ids) with the bytes of the characters that -1 stands for."""
    size = np.diff(ids.offsets.to_numpy()).astype(np.int64)
    flat = ids.flatten().to_numpy().astype(np.int32)
    if not (flat < 0).any():
        return size, flat
    ends = np.cumsum(size)
    out = []
    for i, text in enumerate(texts):
        own = flat[ends[i] - size[i] : ends[i]]
        if (own < 0).any():
            full, at = [], 0
            for x in own.tolist():
                step = len(pieces.raw[x].decode()) if x >= 0 else 1
                full += [x] if x >= 0 else [pieces.byte[c] for c in text[at].encode("utf-8", "surrogatepass")]
                at += step
            own = np.array(full, np.int32)
        out.append(own)
    return np.array([len(o) for o in out], np.int64), np.concatenate(out)


def _least(table: DataFrame, room: int) -> float:
    """The smallest count that at most ``room`` units reach, on a ladder of quarter doublings."""
    ladder = table.groupBy(F.floor(F.log2("times") * 4).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    least = math.inf
    for step, k in sorted(((r.step, r.n) for r in ladder), reverse=True):
        room -= k
        if room < 0:
            break
        least = 2 ** (step / 4) - 1e-9
    return least


def encode(docs: DataFrame, model_file: str, text: str = "text", ids: str = "ids", shared_units: int = 6_000_000,
           finish: Callable[[pa.RecordBatch, Pieces], pa.RecordBatch] | None = None, schema: str | None = None) -> DataFrame:
    """``docs`` with the piece ids of ``text`` in column ``ids`` (one of that name gives way).
    Null and empty texts have none; every text decodes to itself. ``finish`` turns each batch of
    the result into one of ``schema``, in the same Python worker."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    pieces = Pieces(model_file)
    docs = docs.drop(ids)
    known = spark.sparkContext.broadcast(pieces)
    table = write_and_read(encode_units(_count(docs, text, known), pieces, known), "units")
    least = _least(table, shared_units)
    index = _write_index(table.where(F.col("times") >= F.lit(least)).select("unit", "ids"), known)
    at = docs.columns.index(text)
    frame, rest, others = docs, None, table.where(F.col("times") < F.lit(least))
    if others.limit(1).count():
        frame, rest = _with_rare(docs, others, text, index, known)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = known.value
        shared = Shared.of(*index)
        for whole in batches:
            for b in slices(whole, at):
                words, codes, ends = segments(b.column(at), pieces.whole)
                cut = [pieces.cut(SPACE + w) for w in words]
                coded = pa.array([u for c in cut for u in c], pa.string()).dictionary_encode()
                found = values(coded.dictionary)
                flat, start, size = shared.find(found)
                missing = np.flatnonzero(size < 0)
                if len(missing):  # in the join's lists
                    own = {}
                    for pairs in b.column(b.schema.get_field_index(rest)).to_pylist():
                        own.update((p["unit"], p["ids"]) for p in pairs or ())
                    texts = [found[i] for i in missing]
                    more_size, more = spelled(texts, pa.array([own[t] for t in texts], pa.list_(pa.int32())), pieces)
                    size[missing], start[missing] = more_size, len(flat) + np.cumsum(more_size) - more_size
                    flat = np.concatenate([flat, more])
                of_units, unit_ends = _gather(flat, start, size, coded.indices.to_numpy())
                upto = np.concatenate([[0], unit_ends])[np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))] if cut else np.empty(0, np.int64)
                first = np.concatenate([[0], upto])[:-1]
                out, word_ends = _gather(of_units, first, upto - first, codes)
                cuts = np.concatenate([[0], word_ends])[np.concatenate([[0], ends])]
                column = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(out, pa.int32()))
                done = pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names))), column], names=[*names, ids])
                yield finish(done, pieces) if finish else done
                give_back()

    own_schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), f"`{ids}` array<int>"])
    return frame.mapInArrow(tidy(run), schema if finish else own_schema)


def _with_rare(docs: DataFrame, rare: DataFrame, text: str, index: tuple[str, list[str]], known) -> tuple[DataFrame, str]:
    """``docs`` with a last column: its units that are not shared, and their ids. Documents meet
    their lists by the hash of the text."""
    column, key = private_names(docs, "_rare", "_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = Shared.of(*index)
        for b in batches:
            key, unit = [], []
            for t, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = list(dict.fromkeys(units(t, known.value)))
                mine = [words[i] for i in np.flatnonzero(shared.find(words)[2] < 0)]
                unit += mine
                key += [k] * len(mine)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(unit, pa.string())], names=["key", "unit"])

    texts = docs.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{text}`").alias("t")).withColumn("k", F.sha2("t", 256))
    lists = texts.mapInArrow(tidy(run), "key string, unit string").distinct().join(rare.select("unit", "ids"), "unit").groupBy("key").agg(
        F.collect_list(F.struct("unit", "ids")).alias(column))
    lists = write_and_read(lists, "rare-units").withColumnRenamed("key", key)
    keyed = docs.withColumn(key, F.sha2(F.col(f"`{text}`"), 256))
    return keyed.join(lists, key, "left").select(*(f"`{c}`" for c in docs.columns), column), column


def spell_out(lists: pa.ListArray, raw: pa.Array) -> list[str | None]:
    """The texts of lists of piece ids; ``raw``: the bytes of each id."""
    taken = raw.take(lists.flatten())
    ends, data = np.frombuffer(taken.buffers()[1], "<i8", len(taken) + 1, 8 * taken.offset), taken.buffers()[2]
    view = memoryview(data) if data is not None else memoryview(b"")
    size = lists.value_lengths().fill_null(0).to_numpy()
    cut = ends[np.concatenate([[0], np.cumsum(size, dtype=np.int64)])].tolist()
    return [None if null else bytes(view[i:j]).decode("utf-8", "replace").removeprefix(" ")
            for i, j, null in zip(cut, cut[1:], lists.is_null().to_pylist(), strict=False)]


def decode(df: DataFrame, model_file: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with the text of the piece ids in column ``ids`` as ``text`` (one of that name gives
    way): the pieces' bytes one after the other, without the space in front. Null ids give null;
    bytes that are no UTF-8 become U+FFFD."""
    known = df.sparkSession.sparkContext.broadcast(Pieces(model_file).raw)
    frame = df.drop(text) if ids != text else df
    at, names = frame.columns.index(ids), frame.columns
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = pa.array(known.value, pa.large_binary())
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                b = whole.slice(a, 1000)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(spell_out(b.column(at), raw), pa.string())], names=[*names, text])

    return frame.mapInArrow(tidy(run), f"{columns}, `{text}` string")


def with_check(docs: DataFrame, model_file: str, text: str = "text", **options) -> DataFrame:
    """``docs`` with ``ids`` in place of ``text``, n_pieces, and same: whether the ids decode to the
    text (a null text, to the empty one). Other columns, whatever their names, stay."""
    names = [c for c in docs.columns if c not in (text, "ids", "n_pieces", "same")]
    places = [i for i, c in enumerate(docs.columns) if c in names]
    docs, _ = by_position(docs, text)
    kept = [docs.schema.fields[i] for i in places]

    def finish(b: pa.RecordBatch, pieces: Pieces) -> pa.RecordBatch:
        lists = b.column("ids")
        back = spell_out(lists, pa.array(pieces.raw, pa.large_binary()))
        same = [(t or "") == d for t, d in zip(b.column(text).to_pylist(), back, strict=True)]
        return pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), lists, lists.value_lengths().cast(pa.int64()), pa.array(same, pa.bool_())],
                                          names=[*(f.name for f in kept), "ids", "n_pieces", "same"])

    docs = docs.select(*(f"`{f.name}`" for f in kept), f"`{text}`")
    columns = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "ids array<int>", "n_pieces bigint", "same boolean"])
    return encode(docs, model_file, text, finish=finish, schema=columns, **options).toDF(*names, "ids", "n_pieces", "same")


def digest(docs: DataFrame, model_file: str, **options) -> DataFrame:
    """Per document: doc_id, n_pieces, ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers), decoded_sha256 (of the decoded text) and same (whether it is the text itself; of a
    null text, the empty one)."""

    def finish(b: pa.RecordBatch, pieces: Pieces) -> pa.RecordBatch:
        lists = b.column("ids")
        size = lists.value_lengths().to_numpy().astype(np.int64)
        view, cuts = memoryview(lists.flatten().to_numpy().astype("<u4").tobytes()), (4 * np.concatenate([[0], np.cumsum(size)])).tolist()
        back = spell_out(lists, pa.array(pieces.raw, pa.large_binary()))
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(size), pa.array([zlib.crc32(view[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)], pa.int64()),
             pa.array([hashlib.sha256((t or "").encode()).hexdigest() for t in back], pa.string()),
             pa.array([(t or "") == d for t, d in zip(b.column("text").to_pylist(), back, strict=True)], pa.bool_())],
            names=["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "same"])

    return encode(docs.select("doc_id", "text"), model_file, finish=finish,
                  schema="doc_id bigint, n_pieces bigint, ids_crc32 bigint, decoded_sha256 string, same boolean", **options)
