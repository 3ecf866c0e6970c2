"""Language-model scoring by online logistic context mixing.

A text is its lower-cased words and an end. Every word has a class, a function of the word: for
frequent words the group of documents (their ``lang``, if there is such a column) in which they
occur most, for others the likeliest group by their letters. A text is coded as the class of each
word after the two classes before it, the end being a class of its own, and each word, byte by byte
and closed by a space, within its class. These codes are prefix-free, so the bits' probabilities
multiply to a distribution over texts. Every bit of a word is predicted by

* hashed contexts: the class and the last 0, 1, 2, 3, 4 and 6 bytes of the word so far, each with
  counts of how often the bit was 0 and 1 over the distinct training words;
* the whole prefix of the word in its class, with counts over all training tokens (exact, from a
  trie of the sorted vocabulary).

The predictions' logits are mixed with weights that a gate selects by the evidence behind the
whole prefix; the weights learn online, and an adaptive map then corrects the mixed probability.
A word's probability within its class is computed once for the whole corpus.

What is counted covers all training documents: the vocabulary is aggregated by Spark and sorted
into chunks, the counts of contexts are summed over chunks, and chunks exchange the counts of
prefixes that reach across their ends. The gates' weights (8 x 8 x 8 numbers) and the correction
learn online from every training word of each chunk, each with one occurrence left out of the
counts, as in coding it before it is learnt; the chunks' weights are averaged.

A word's score in its class knows no other word; :mod:`follow` adds what the two words before say
about it, counted over the token stream of all training documents.

Scoring: words met at least so often that ``frequent_words`` of them go to all tasks are looked up
there; the other words of a document, few, are joined.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_and_read
from .common import coded_words, give_back, small_batches, tidy, values
from .follow import gains, rare_ids

END = b"\n"
ORDERS = (0, 1, 2, 3, 4, 6)
SLOT_BITS = (12, 17, 19, 19, 19, 19)
DEPTH = 26  # bytes of a word that the trie follows; no whole-prefix evidence beyond
GATES = 8
_STARTS = np.concatenate([[0], np.cumsum([2 << b for b in SLOT_BITS])])
_CELLS = int(_STARTS[-1])
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_BLOCK = 1 << 14  # cells of the summed table in one row
_LETTER_BITS = 16  # cells of the letters' counts by class
_MAP = np.linspace(-8, 8, 33)  # the correction's points on the logit scale


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def groups(docs: DataFrame, by: str | None, most: int) -> list[str]:
    """Values of ``by`` with the most training documents, at most ``most``; they are the classes."""
    if by is None or by not in docs.columns:
        return []
    seen = docs.where(~_held_out(F.col("doc_id")) & F.col(by).isNotNull()).groupBy(F.col(by).cast("string").alias("g")).count()
    return [r.g for r in seen.orderBy(F.desc("count"), "g").limit(most).collect()]


def _held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def vocabulary(docs: DataFrame, names: list[str]) -> DataFrame:
    """(word, by_group, times, learnt) for every word of ``docs`` (doc_id, text, g), an end among
    them as a newline: tokens in the training documents of each group and of none, in all
    documents, and in all training documents."""
    place = {g: i for i, g in enumerate(names)}
    width = len(names) + 1
    columns = [f"c{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                b = whole.slice(a, 1000)
                words, codes, ends = coded_words(b.column(1))
                group = np.array([width if held_out(d) else place.get(g, width - 1) for d, g in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)], np.int64)
                cell = codes * (width + 1) + np.repeat(group, np.diff(np.concatenate([[0], ends])))
                counts = np.bincount(cell, minlength=len(words) * (width + 1)).reshape(-1, width + 1)
                counts = np.vstack([counts, np.bincount(group, minlength=width + 1)])  # the last word is the end
                yield pa.RecordBatch.from_arrays([pa.array([*words, END], pa.binary()), *(pa.array(counts[:, i]) for i in range(width)), pa.array(counts.sum(1))],
                                                 names=["word", *columns, "times"])
                give_back()

    counted = docs.mapInArrow(tidy(run), ", ".join(["word binary", *(f"{c} bigint" for c in columns), "times bigint"]))
    summed = counted.groupBy("word").agg(*(F.sum(c).alias(c) for c in columns), F.sum("times").alias("times"))
    return summed.select("word", F.array(*columns).alias("by_group"), "times", sum((F.col(c) for c in columns), F.lit(0)).alias("learnt"))


class Letters:
    """Class of a word by its letters: log counts of hashed runs of three bytes, per class."""

    def __init__(self, counts: np.ndarray):
        total = counts.sum(0)
        self.logs = np.log((counts + 0.1) / (total + 0.1 * len(counts)))
        self.first = np.log((total + 1) / (total.sum() + len(total)))

    @staticmethod
    def cells(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(cell of each byte's run, index of its word); a word counts with spaces around it."""
        b = np.frombuffer(b"  " + b"  ".join(words) + b" ", np.uint8).astype(np.uint64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), sizes + 1)
        at = (np.cumsum(sizes + 2) - sizes - 2)[word] + np.arange(len(word)) - np.repeat(np.cumsum(sizes + 1) - sizes - 1, sizes + 1)
        h = ((b[at] * np.uint64(257) + b[at + 1]) * np.uint64(257) + b[at + 2]) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - _LETTER_BITS)).astype(np.int64), word

    def classes(self, words: list[bytes]) -> np.ndarray:
        if not words or self.logs.shape[1] == 1:
            return np.zeros(len(words), np.int64)
        cell, word = self.cells(words)
        return np.argmax(np.stack([np.bincount(word, self.logs[cell, g], len(words)) + self.first[g] for g in range(self.logs.shape[1])]), 0)


def _letters(words: DataFrame, width: int) -> Letters:
    """Counts over the distinct training words, shared out to the groups that use a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((1 << _LETTER_BITS, width))
        for b in batches:
            got, share = values(b.column(0)), b.column(1).flatten().to_numpy().astype(float).reshape(-1, width + 1)[:, :width]
            share = share / np.maximum(share.sum(1, keepdims=True), 1)
            if got:
                cell, word = Letters.cells(got)
                for g in range(width):
                    table[:, g] += np.bincount(cell, share[word, g], 1 << _LETTER_BITS)
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([table.tobytes()])], names=["k", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width << _LETTER_BITS)
        for b in batches:
            for counts in b.column(1):
                total += np.frombuffer(counts.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([total.tobytes()])], names=["k", "counts"])

    schema = "k bigint, counts binary"
    parts = words.where((F.col("learnt") > 0) & (F.col("word") != F.lit(bytearray(END)))).select("word", "by_group").mapInArrow(tidy(run), schema)
    rows = parts.repartition(8).mapInArrow(tidy(add), schema).collect()  # eight tables of fixed size
    return Letters(sum((np.frombuffer(r.counts) for r in rows), np.zeros(width << _LETTER_BITS)).reshape(-1, width))


CHUNK = "chunk string, n bigint, words binary, sizes binary, learnt binary"


def _chunks(words: DataFrame, size: int) -> DataFrame:
    """Sorted words in rows of at most ``size``: their bytes, lengths (u4) and counts (f8)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, held, counts = TaskContext.get().partitionId(), 0, [], []

        def row() -> pa.RecordBatch:
            nonlocal k, held, counts
            values = (f"{part}-{k}", len(held), b"".join(held), np.array([len(w) for w in held], "<u4").tobytes(), np.array(counts, "<f8").tobytes())
            k, held, counts = k + 1, [], []
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=[x.split(" ")[0] for x in CHUNK.split(", ")])

        for b in batches:
            for w, c in zip(values(b.column(0)), values(b.column(1)), strict=True):
                held.append(w)
                counts.append(c)
                if len(held) >= size:
                    yield row()
        if held:
            yield row()

    return words.select("key", "learnt").repartitionByRange("key").sortWithinPartitions("key").mapInArrow(tidy(run), CHUNK)


class Chunk:
    """A chunk's words as flat byte arrays: word, depth and context hashes of each byte."""

    def __init__(self, words: bytes, sizes: bytes, learnt: bytes):
        self.bytes = np.frombuffer(words, np.uint8)
        self.sizes = np.frombuffer(sizes, "<u4").astype(np.int64)
        self.learnt = np.frombuffer(learnt, "<f8")
        self.n = len(self.sizes)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])

    def take(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(positions of the kept words' bytes, index of each one's word among the kept, depth)."""
        sizes = self.sizes[keep] - 1  # the class byte in front is not coded here
        word = np.repeat(np.arange(len(keep)), sizes)
        depth = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        return self.starts[keep][word] + depth, word, depth

    def word(self, i: int) -> bytes:
        return self.bytes[self.starts[i] : self.starts[i] + self.sizes[i]].tobytes()

    def trie(self, ends: dict[bytes, tuple[float, float]] | None) -> np.ndarray:
        """Counts (0 and 1) of each bit after each word's whole prefix, for the bytes within DEPTH:
        shape (bytes, 8, 2). ``ends`` has the sums over all chunks for the prefixes of the first
        and the last word."""
        out = np.zeros((len(self.bytes), 8, 2), np.float32)
        width = int(min(self.sizes.max(), DEPTH))
        grid = np.zeros((self.n, width), np.uint8)
        for d in range(width):
            has = self.sizes > d
            grid[has, d] = self.bytes[self.starts[has] + d]
        differ = np.zeros((self.n, width), bool)  # from the word before, at this byte or an earlier one
        differ[0] = True
        differ[1:] = np.logical_or.accumulate(grid[1:] != grid[:-1], 1)
        before = np.zeros(self.n, bool)
        before[0] = True
        first, last = self.word(0), self.word(self.n - 1)
        for d in range(width):
            has = np.flatnonzero(self.sizes > d)
            byte = grid[:, d].astype(np.int64)
            for bit in range(8):
                new = before.copy()
                if bit:
                    new[1:] |= byte[1:] >> (8 - bit) != byte[:-1] >> (8 - bit)
                heads = np.flatnonzero(new)
                one = self.learnt * ((byte >> (7 - bit)) & 1)
                ones, total = np.add.reduceat(one, heads), np.add.reduceat(self.learnt, heads)
                if ends is not None:
                    for edge, at in ((first, 0), (last, -1)):
                        if len(edge) > d:
                            zero_sum, one_sum = ends[_prefix(edge, d, bit)]
                            ones[at], total[at] = one_sum, zero_sum + one_sum
                group = np.cumsum(new) - 1
                place = self.starts[has] + d
                out[place, bit, 1] = ones[group[has]]
                out[place, bit, 0] = (total - ones)[group[has]]
            before = differ[:, d]
        return out

    def ends(self) -> Iterator[tuple[bytes, float, float]]:
        """The chunk's own counts for every prefix of its first and last word."""
        seen = set()
        for i in (0, self.n - 1):
            word, same = self.word(i), np.arange(self.n)
            for d in range(min(len(word), DEPTH)):
                same = same[self.sizes[same] > d]
                byte = self.bytes[self.starts[same] + d].astype(np.int64)
                for bit in range(8):
                    key = _prefix(word, d, bit)
                    if key not in seen:
                        seen.add(key)
                        here = byte >> (8 - bit) == word[d] >> (8 - bit)
                        one = here & (byte >> (7 - bit) & 1 == 1)
                        ones = float(self.learnt[same[one]].sum())
                        yield key, float(self.learnt[same[here]].sum()) - ones, ones
                same = same[byte == word[d]]

    def hashes(self, at: np.ndarray, depth: np.ndarray) -> list[np.ndarray]:
        """Hash of the last k bytes of the word before each of the bytes ``at``, for all orders."""
        out, h = [], self.bytes[at - depth].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        for k in range(ORDERS[-1] + 1):
            if k:
                back = self.bytes[np.maximum(at - k, 0)].astype(np.uint64) + np.uint64(1)
                h = (h + np.where(depth > k, back, np.uint64(0))) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            if k in ORDERS:
                out.append(h * _SPREAD)
        return out


def _prefix(word: bytes, d: int, bit: int) -> bytes:
    return word[:d] + bytes([bit, word[d] >> (8 - bit)])


def _cells(hashes: list[np.ndarray], node: np.ndarray) -> list[np.ndarray]:
    """Slot of each order's context and the byte's bits so far (``node``, with a leading 1); the
    counts of 0 and 1 stand at twice the slot and after it."""
    more = node.astype(np.uint64) * _SPREAD
    return [_STARTS[k] // 2 + ((hashes[k] + more) >> np.uint64(64 - SLOT_BITS[k])).view(np.int64) for k in range(len(ORDERS))]


def _count_contexts(chunks: DataFrame) -> np.ndarray:
    """Summed counts over the distinct training words of all chunks; of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(_CELLS)
        for b in batches:
            for words, sizes, learnt in zip(*(b.column(c).to_pylist() for c in ("words", "sizes", "learnt")), strict=True):
                chunk = Chunk(words, sizes, learnt)
                at, _, depth = chunk.take(np.flatnonzero(chunk.learnt > 0))
                if not len(at):
                    continue
                hashes, byte = chunk.hashes(at, depth), chunk.bytes[at].astype(np.int64)
                for bit in range(8):
                    one = (byte >> (7 - bit)) & 1
                    for slot in _cells(hashes, (byte | 256) >> (8 - bit)):
                        lo = 2 * int(slot.min())
                        found = np.bincount(2 * slot + one - lo)
                        table[lo : lo + len(found)] += found
        table = table.astype("<f4")
        for i in range(0, _CELLS, _BLOCK):
            part = table[i : i + _BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i // _BLOCK]), pa.array([part.tobytes()])], names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for b in batches:
            for i, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if i != at:
                    if at is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([total.astype("<f4").tobytes()])], names=["block", "counts"])
                    at, total = i, 0.0
                total = total + np.frombuffer(counts, "<f4").astype(float)
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([total.astype("<f4").tobytes()])], names=["block", "counts"])

    parts = chunks.select("words", "sizes", "learnt").mapInArrow(tidy(run), "block bigint, counts binary")
    summed = parts.repartition("block").sortWithinPartitions("block").mapInArrow(tidy(add), "block bigint, counts binary")
    out = np.zeros(_CELLS, np.float32)
    for r in summed.toLocalIterator():
        part = np.frombuffer(r.counts, "<f4")
        out[r.block * _BLOCK : r.block * _BLOCK + len(part)] = part
    return out


class Mixer:
    """Gated weights and the correction of the mixed logit; both learn online."""

    def __init__(self) -> None:
        self.weights = np.zeros((GATES * 8, len(ORDERS) + 2))
        self.weights[:8, :-2] = 0.2  # without evidence for the whole prefix
        self.weights[8:, :-2] = 0.03
        self.weights[8:, -2] = 0.9
        self.map = np.tile(1 / (1 + np.exp(-_MAP)), (GATES, 1))

    def inputs(self, table: np.ndarray, cells: list[np.ndarray], less: np.ndarray | None, one: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Logits of the predictors: from counts, less what is left out of each word's own, or with
        ``less`` None from a table of :func:`logits`."""
        x = np.empty((len(one), len(ORDERS) + 2), np.float32)
        for k, slot in enumerate(cells):
            if less is None:  # the table has logits
                x[:, k] = table[slot]
            else:
                zero, ones = np.maximum(table[2 * slot] - less * (1 - one), 0), np.maximum(table[2 * slot + 1] - less * one, 0)
                x[:, k] = np.log((ones + 0.2) / (zero + 0.2))
        x[:, -2] = np.log((whole[:, 1] + 0.02) / (whole[:, 0] + 0.02))
        x[:, -1] = 0.3
        return x

    @staticmethod
    def gate(whole: np.ndarray) -> np.ndarray:
        return np.searchsorted([0.5, 1.5, 2.5, 5, 10, 40, 300], whole.sum(1))

    def mixed(self, x: np.ndarray, row: np.ndarray) -> np.ndarray:
        return np.clip(np.einsum("ij,ij->i", x, self.weights.astype(np.float32)[row]), -14, 14)

    def place(self, logit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = np.clip((logit + 8) * 2, 0, 31.999)
        low = z.astype(np.int64)
        return low, z - low

    def probability(self, logit: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Of a 1: mean of the mixed and the corrected probability."""
        low, part = self.place(logit)
        flat = self.map.astype(np.float32)
        fixed = flat[gate, low] * (1 - part) + flat[gate, low + 1] * part
        plain = 1 / (1 + np.exp(-logit))
        inside = np.abs(logit) < 8
        return np.where(inside, (plain + fixed) / 2, plain)

    def learn(self, x: np.ndarray, row: np.ndarray, gate: np.ndarray, one: np.ndarray, weight: np.ndarray, rate: float) -> None:
        logit = self.mixed(x, row)
        wrong = (one - 1 / (1 + np.exp(-logit))) * weight
        step, mass = np.zeros_like(self.weights), np.bincount(row, weight, len(self.weights))
        for j in range(x.shape[1]):
            step[:, j] = np.bincount(row, wrong * x[:, j], len(self.weights))
        met = mass > 0
        self.weights[met] += rate * step[met] / mass[met, None]
        low, part = self.place(logit)
        for side, share in ((low, weight * (1 - part)), (low + 1, weight * part)):
            cell = gate * len(_MAP) + side
            n = np.bincount(cell, share, self.map.size).reshape(self.map.shape)
            ones = np.bincount(cell, share * one, self.map.size).reshape(self.map.shape)
            pull = np.minimum(n / (n + 50), 0.3) * rate
            self.map += pull * (ones / np.maximum(n, 1e-9) - self.map)


def _learn(chunk: Chunk, trie: np.ndarray, table: np.ndarray, mixer: Mixer, batch: int = 500) -> None:
    """One online pass over the training words, in an order of their hashes."""
    known = np.flatnonzero(chunk.learnt > 0)
    order = np.argsort((known.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20), kind="stable")
    known = known[order]
    for turn, a in enumerate(range(0, len(known), batch)):
        keep = known[a : a + batch]
        at, word, depth = chunk.take(keep)
        hashes, byte = chunk.hashes(at, depth), chunk.bytes[at].astype(np.int64)
        times = chunk.learnt[keep]
        less, weight = (times == 1)[word].astype(np.float32), times[word]
        for bit in range(8):
            one = ((byte >> (7 - bit)) & 1).astype(np.float32)
            whole = trie[at, bit].copy()  # one occurrence of the word itself left out
            whole[np.arange(len(at)), one.astype(int)] -= depth < DEPTH
            whole = np.maximum(whole, 0)
            x = mixer.inputs(table, _cells(hashes, (byte | 256) >> (8 - bit)), less, one, whole)
            gate = mixer.gate(whole)
            mixer.learn(x, gate * 8 + bit, gate, one, weight, 0.1 / (1 + turn / 30) ** 0.5)


def logits(table: np.ndarray) -> np.ndarray:
    """Of each slot's counts."""
    return np.log((table[1::2] + np.float32(0.2)) / (table[::2] + np.float32(0.2)))


def _score(chunk: Chunk, trie: np.ndarray, table: np.ndarray, mixer: Mixer, step: int = 8_000) -> np.ndarray:
    """log10 probability of each word, its closing byte included. ``table``: of :func:`logits`."""
    out = np.zeros(chunk.n)
    for a in range(0, chunk.n, step):
        keep = np.arange(a, min(chunk.n, a + step))
        at, word, depth = chunk.take(keep)
        hashes, byte = chunk.hashes(at, depth), chunk.bytes[at].astype(np.int64)
        total = np.zeros(len(at))
        for bit in range(8):
            one = (byte >> (7 - bit)) & 1
            whole = trie[at, bit]
            x = mixer.inputs(table, _cells(hashes, (byte | 256) >> (8 - bit)), None, one, whole)
            gate = mixer.gate(whole)
            p = np.clip(mixer.probability(mixer.mixed(x, gate * 8 + bit), gate), 1e-6, 1 - 1e-6)
            total += np.log10(np.where(one == 1, p, 1 - p).astype(np.float64))
        out[keep] = np.bincount(word, total, len(keep))
    return out


def word_scores(keys: DataFrame, chunk_words: int = 40_000) -> DataFrame:
    """(key, score): log10 of the model's probability, of its class, for every key: a class byte, the word's bytes
    and a space."""
    spark = keys.sparkSession
    chunks = write_and_read(_chunks(keys, chunk_words), "vocabulary-chunks")
    table = spark.sparkContext.broadcast(_count_contexts(chunks))

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, w, s, c in zip(*(b.column(x).to_pylist() for x in ("chunk", "words", "sizes", "learnt")), strict=True):
                rows = list(Chunk(w, s, c).ends())
                key, zero, one = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array(key, pa.binary()), pa.array(zero), pa.array(one)],
                                                 names=["chunk", "prefix", "zero", "one"])

    own = write_and_read(chunks.select("chunk", "words", "sizes", "learnt").mapInArrow(tidy(edges), "chunk string, prefix binary, zero double, one double"), "chunk-ends")
    summed = own.groupBy("prefix").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one"))
    ends = own.select("chunk", "prefix").join(summed, "prefix").groupBy("chunk").agg(F.collect_list(F.struct("prefix", "zero", "one")).alias("ends"))
    full = write_and_read(chunks.join(ends, "chunk"), "joined-chunks")

    def each(b: pa.RecordBatch) -> Iterator[tuple[Chunk, np.ndarray]]:
        for w, s, c, e in zip(*(b.column(x).to_pylist() for x in ("words", "sizes", "learnt", "ends")), strict=True):
            chunk = Chunk(w, s, c)
            yield chunk, chunk.trie({x["prefix"]: (x["zero"], x["one"]) for x in e})

    start = Mixer()
    sums = "n bigint, weights binary, map binary"

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, weights, fix = 0, np.zeros_like(start.weights), np.zeros_like(start.map)
        for b in batches:
            for chunk, trie in each(b):
                if (chunk.learnt > 0).any():
                    mixer = Mixer()
                    _learn(chunk, trie, table.value, mixer)
                    n, weights, fix = n + 1, weights + mixer.weights, fix + mixer.map
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([weights.tobytes()]), pa.array([fix.tobytes()])], names=["n", "weights", "map"])

    # a chunk is work for seconds whatever its bytes: tasks by their number
    frame = full.repartition(max(1, -(-full.count() // 4)), "chunk").select("words", "sizes", "learnt", "ends")
    learnt = frame.mapInArrow(tidy(learn), sums).collect()  # a few KB a task
    mixer = Mixer()
    if n := sum(r.n for r in learnt):
        mixer.weights = sum(np.frombuffer(r.weights) for r in learnt).reshape(start.weights.shape) / n
        mixer.map = sum(np.frombuffer(r["map"]) for r in learnt).reshape(start.map.shape) / n
    final = spark.sparkContext.broadcast((mixer.weights, mixer.map))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Mixer()
        best.weights, best.map = final.value
        logit = logits(table.value)
        for b in batches:
            for chunk, trie in each(b):
                found = _score(chunk, trie, logit, best)
                cuts = [*chunk.starts.tolist(), len(chunk.bytes)]
                raw = chunk.bytes.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([raw[i:j] for i, j in zip(cuts, cuts[1:], strict=False)], pa.binary()), pa.array(found)], names=["key", "score"])

    return frame.mapInArrow(tidy(score), "key binary, score double")


def _least_count(words: DataFrame, room: int) -> float:
    """The smallest count that at most ``room`` words reach, on a ladder of quarter doublings."""
    ladder = words.groupBy(F.floor(F.log2("times") * 4).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    least = math.inf
    for step, k in sorted(((r.step, r.n) for r in ladder), reverse=True):
        room -= k
        if room < 0:
            break
        least = 2 ** (step / 4) - 1e-9
    return least


def score_documents(docs: DataFrame, by: str | None = "lang", max_groups: int = 12, frequent_words: int = 200_000, **options) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, and the column ``by`` if there is one): doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score and bits_per_byte (of the coded bytes).

    A null text is empty: it has its end alone. A document with a null doc_id is learnt from. With
    nothing to learn from, base_score is 0 and the model is the untrained one. A null ``by``, or one
    beyond the ``max_groups`` largest, says nothing about the words' classes.
    """
    spark = docs.sparkSession
    small_batches(spark)
    group = F.col(by).cast("string") if by in docs.columns else F.lit(None).cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", group.alias("g")).withColumn("id", F.xxhash64("doc_id", "text"))
    names = groups(docs, "g", max_groups)
    width = max(1, len(names))
    counted = write_and_read(vocabulary(docs, names), "vocabulary")
    sums = counted.agg(F.sum("learnt"), F.sum(F.when(F.col("learnt") > 0, 1)), F.sum("times")).first()
    n, v, tokens = (int(x or 0) for x in sums)
    least = _least_count(counted, frequent_words)
    letters = spark.sparkContext.broadcast(_letters(counted, width) if names else Letters(np.ones((1, 1))))
    often = F.col("times") >= F.lit(least)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, share = values(b.column(0)), b.column(1).flatten().to_numpy().reshape(-1, len(names) + 1)[:, :width]
            kind = letters.value.classes(words)
            times = b.column(3).to_numpy()
            sure = (times >= least) & (share.sum(1) > 0) & bool(names)
            kind = np.where(sure, share.argmax(1), kind)
            keys = [bytes([k]) + w + b" " for k, w in zip(kind.tolist(), words, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), b.column(0), b.column(2), b.column(3), pa.array(rare_ids(words))],
                                             names=["key", "word", "learnt", "times", "word_id"])

    words = counted.where(F.col("word") != F.lit(bytearray(END))).select("word", "by_group", "learnt", "times")
    keys = write_and_read(words.mapInArrow(tidy(keyed), "key binary, word binary, learnt bigint, times bigint, word_id bigint"), "keys")
    scored = write_and_read(keys.join(word_scores(keys, **options), "key"), "word-scores")
    rows = scored.where(often).orderBy(F.desc("times"), "key").select("key", "learnt", "score").toArrow()
    shared = spark.sparkContext.broadcast(tuple(rows.column(c).combine_chunks() for c in ("key", "learnt", "score")))

    def frequent() -> tuple[list[bytes], np.ndarray, np.ndarray]:
        key, _, score = shared.value
        key = values(key)
        return [k[1:-1] for k in key], np.array([k[0] for k in key], np.int64), score.to_numpy(zero_copy_only=False)

    following = gains(docs, tokens, frequent, scored.where(~often).select("word_id", "score"), held_out)
    ends_learnt = counted.where(F.col("word") == F.lit(bytearray(END))).select("learnt").first()
    ends_learnt = int(ends_learnt.learnt) if ends_learnt else 0
    scale = n + v + 1
    end_base = math.log10((ends_learnt + 1) / scale)
    side = width + 2  # classes, end, and what stands before a text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, learnt, score = shared.value
        key = values(key)
        place = {k[1:-1]: i for i, k in enumerate(key)}
        missing = len(key)
        kind = np.array([k[0] for k in key] + [0], np.int64)
        count = np.append(learnt.to_numpy(zero_copy_only=False), -1).astype(np.int64)
        value = np.append(score.to_numpy(zero_copy_only=False), 0.0)
        base, known = np.where(count >= 0, np.log10((np.maximum(count, 0) + 1) / scale), 0.0), count > 0
        part, row = TaskContext.get().partitionId() << 40, 0
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.map_(pa.int64(), pa.int64()), pa.int64()]
        for whole in batches:
            for a in range(0, whole.num_rows, 500):
                b = whole.slice(a, 500)
                k = b.num_rows
                words, codes, ends = coded_words(b.column(1))
                at = np.fromiter((place.get(w, missing) for w in words), np.int64, len(words))
                rare = np.flatnonzero(at == missing)
                kinds = kind[at]
                kinds[rare] = letters.value.classes([words[i] for i in rare])
                n = np.diff(np.concatenate([[0], ends]))
                doc = np.repeat(np.arange(k), n)
                total = lambda x, doc=doc, k=k: np.bincount(doc, x, k).astype(float)
                size = np.fromiter(map(len, words), np.int64, len(words)) + 1
                # classes in order, each text after two marks of its start and before its end
                line = np.full(len(codes) + 3 * k, width + 1)
                line[np.arange(len(codes)) + 3 * doc + 2] = kinds[codes]
                line[ends + 3 * np.arange(1, k + 1) - 1] = width
                steps = (line[:-2] * side + line[1:-1]) * side + line[2:]
                inside = np.repeat(np.arange(k), n + 3)[:-2]
                step, times = np.unique((inside * side**3 + steps)[line[2:] != width + 1], return_counts=True)
                cuts = np.searchsorted(step // side**3, np.arange(k + 1))
                moves = pa.MapArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(step % side**3), pa.array(times))
                ids = b.column(0).to_pylist()
                uid = part + row + np.arange(k)
                row += k
                heads = [pa.array(uid), b.column(0), pa.array([held_out(d) for d in ids], pa.bool_()), pa.array(n + 1),
                         pa.array(total(known[at][codes]).astype(np.int64) + (ends_learnt > 0)), pa.array(total(base[at][codes]) + end_base),
                         pa.array(total(value[at][codes])), pa.array(total(size[codes]).astype(np.int64)), moves, b.column(2)]
                yield pa.RecordBatch.from_arrays([*heads, pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64())], names=fields)
                lone = (at == missing)[codes]
                pair, times = np.unique(doc[lone] * len(words) + codes[lone], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid[pair // max(1, len(words))]), *(pa.nulls(len(pair), t) for t in types[1:]),
                     pa.array(words, pa.binary()).take(pa.array(pair % max(1, len(words)))), pa.array(times)], names=fields)
                give_back()

    schema = ("row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, value double, size bigint, "
              "steps map<bigint;bigint>, id bigint, word binary, k bigint")
    fields = [x.split(" ")[0] for x in schema.split(", ")]
    parts = write_and_read(docs.select("doc_id", "text", "id").mapInArrow(tidy(run), schema.replace(";", ",")), "scored-parts")
    heads = parts.where("word IS NULL")
    seen = heads.where("NOT held_out").select(F.explode("steps").alias("step", "k")).groupBy("step").agg(F.sum("k").alias("k")).collect()
    table = np.zeros(side**3)
    for r in seen:  # at most (classes + 2) cubed
        table[r.step] = r.k
    table = table.reshape(-1, side)
    pair = table.reshape(side, side, side).sum(0)  # by the class just before
    start = (pair + 0.1) / (pair + 0.1).sum(1, keepdims=True)
    likely = np.log10((table + 2 * np.tile(start, (side, 1))) / (table.sum(1, keepdims=True) + 2)).ravel()
    steps = spark.createDataFrame(list(enumerate(likely.tolist())), "step bigint, p double")
    moved = heads.select("row", F.explode("steps").alias("step", "k")).join(F.broadcast(steps), "step").groupBy("row").agg(
        F.sum(F.col("k") * F.col("p")).alias("moves"))
    log = F.log10((F.col("learnt") + 1) / F.lit(float(scale)))
    rest = parts.where("word IS NOT NULL").select("row", "word", "k").join(scored.where(~often).select("word", "learnt", "score"), "word").groupBy("row").agg(
        F.sum(F.when(F.col("learnt") > 0, F.col("k")).otherwise(0)).alias("more_known"),
        F.sum(F.col("k") * log).alias("more_base"), F.sum(F.col("k") * F.col("score")).alias("more_value"))
    out = heads.drop("steps", "word", "k").join(moved, "row").join(rest, "row", "left").join(following, "id", "left")
    total = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    score = total("value", "more_value") + F.col("moves") + F.coalesce("gain", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", total("known", "more_known").cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        total("base", "more_base").alias("base_score"), score.alias("score"), (-score * math.log2(10) / (F.col("size") + 1)).alias("bits_per_byte"))
