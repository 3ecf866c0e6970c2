"""What follows two words: the part of the language model that crosses words.

In every context of the two words before, over the token stream of all training documents, the
word that follows most often is expected (ties: smallest id). Where a context has been met, one
more bit of a text's code says whether its next word is the expected one; it is predicted by an
adaptive map from the counts that speak for and against that word and from its probability by the
word model. The map learns from every token of every training document. A training document's
token is left out of the counts that predict it, once, as in coding it before it is learnt. Where
the bit is 1 the word needs no further code; where it is 0 the expected word's share of its class
goes to the others, if both words are frequent (else that share is lost).

Tokens are sent in compressed columns by a hash of their context, not as rows; a task counts a
range of hashes at a time. What it finds goes back by groups of documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_and_read
from .common import coded_words, give_back, tidy

GROUP, RANGE = 1_000_000, 1_000_000  # tokens that a task holds before it sends them; about as many of a range
START, FIRST = 0, 1  # id of what stands before a text; of the most frequent word
RARE = 1 << 55  # ids from here on are hashes
CTX_BITS = 44  # of a context's hash, behind those of its range
LEVELS, CHANCES = 24, 9
CELLS = LEVELS * LEVELS * CHANCES
ZSTD = pa.Codec("zstd", compression_level=1)


def rare_ids(words: list[bytes]) -> np.ndarray:
    """Ids of words that are not among the frequent ones."""
    digests = b"".join(hashlib.blake2b(w, digest_size=8).digest() for w in words)
    return (np.frombuffer(digests, "<u8") >> np.uint64(9)).astype(np.int64) | RARE


def pack(*columns: tuple[np.ndarray, int]) -> bytes:
    """Columns of whole numbers below 256 ** width, byte by byte, compressed."""
    return ZSTD.compress(b"".join(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :w].T).tobytes() for x, w in columns), asbytes=True)


def unpack(blob: bytes, n: int, *widths: int) -> list[np.ndarray]:
    raw, out, at = np.frombuffer(ZSTD.decompress(blob, n * sum(widths), asbytes=True), np.uint8), [], 0
    for w in widths:
        x = np.zeros((n, 8), np.uint8)
        x[:, :w] = raw[at : at + n * w].reshape(w, n).T
        out.append(x.view("<u8").ravel().astype(np.int64))
        at += n * w
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    for by in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


def contexts(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hash of the ids of the two words before each word, in texts that follow one another (``doc``)."""
    line = np.full(len(ids) + 2 * (int(doc[-1]) + 1 if len(doc) else 0), START, np.uint64)
    at = np.arange(len(ids)) + 2 * doc + 2
    line[at] = ids
    return _mix(_mix(line[at - 2] + np.uint64(0x9E3779B97F4A7C15)) + line[at - 1])


def level(x: np.ndarray) -> np.ndarray:
    """0 to 3 as they are, then by doublings."""
    return np.where(x < 4, x, np.minimum(np.log2(np.maximum(x, 1)).astype(np.int64) + 2, LEVELS - 1))


def expected(ctx: np.ndarray, word: np.ndarray, learnt: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row (``times`` occurrences of ``word`` after ``ctx`` in a document that is learnt or
    not) the word expected there, the count that speaks for it, and that against; one occurrence of
    the row itself, if learnt, is left out. Without any count the word is -1."""
    order = np.lexsort((word, ctx))
    c, w = ctx[order], word[order]
    new = np.ones(len(c), bool)
    new[1:] = (c[1:] != c[:-1]) | (w[1:] != w[:-1])
    heads = np.flatnonzero(new)
    count = np.add.reduceat(times[order] * learnt[order], heads)  # of each context's words
    c, w = c[heads], w[heads]
    first = np.ones(len(c), bool)
    first[1:] = c[1:] != c[:-1]
    starts, which = np.flatnonzero(first), np.cumsum(first) - 1
    total = np.add.reduceat(count, starts)
    ranked = np.lexsort((w, -count, which))
    best = ranked[starts]
    sizes = np.diff(np.append(starts, len(c)))
    next_at = np.where(sizes > 1, starts + 1, starts)
    second = ranked[next_at]
    second_count, second_word = np.where(sizes > 1, count[second], 0), np.where(sizes > 1, w[second], -1)
    pair = np.empty(len(ctx), np.int64)
    pair[order] = np.cumsum(new) - 1
    at = which[pair]
    less = learnt.astype(np.int64)
    n = total[at] - less
    own = (best[at] == pair) & learnt
    left = count[best[at]] - own
    yields = own & ((left < second_count[at]) | ((left == second_count[at]) & (second_word[at] < word) & (second_word[at] >= 0)))
    likely, good = np.where(yields, second_word[at], w[best[at]]), np.where(yields, second_count[at], left)
    return np.where((n > 0) & (good > 0), likely, -1), good, n - good


def chances(score: np.ndarray) -> np.ndarray:
    """Level of each frequent word's log10 probability in its class, from 1; 0 stands for rare words."""
    return np.clip((score + 4.5) * 2, 0, CHANCES - 2).astype(np.int64) + 1


def map_of(hits: np.ndarray, met: np.ndarray) -> np.ndarray:
    """Probability of a 1 in each cell; without experience, that of the counts alone."""
    at = np.arange(CELLS) // CHANCES
    middle = np.where(np.arange(LEVELS) < 4, np.arange(LEVELS), 1.5 * 2.0 ** (np.arange(LEVELS) - 2))
    good, bad = middle[at // LEVELS], middle[at % LEVELS]
    return np.clip((hits + (good + 0.2) / (good + bad + 2)) / (met + 1), 1e-6, 1 - 1e-6)


def gains(docs: DataFrame, tokens: int, frequent: Callable, scored_rare: DataFrame, held_out: Callable) -> DataFrame:
    """(id, gain) for (id, doc_id, text) rows: what is added to the log10 probability of a text by the word
    model. Rows of equal ``id`` must be equal. ``tokens``: about how many there are. ``frequent`` gives the
    frequent words, their classes and log10 probabilities, in each task; ``scored_rare`` has (word_id, score)
    of the others; ``held_out`` says whether a doc_id is."""
    bits = max(0, int(np.ceil(np.log2(max(1, tokens) / RANGE))))
    spark = docs.sparkSession
    sent = "bucket int, batch bigint, n int, blob binary"

    def rows(*columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["bucket", "batch", "n", "blob"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: i + FIRST for i, w in enumerate(frequent()[0])}
        part, k, kept, keys, size = TaskContext.get().partitionId() << 32, 0, [], [], 0

        def group() -> Iterator[pa.RecordBatch]:
            nonlocal k, kept, keys, size
            ctx, word, doc = (np.concatenate(x) for x in zip(*kept, strict=True))
            # a document's repeats of one word after the same two are one row
            same = _mix(_mix(ctx + word.view(np.uint64)) + doc.view(np.uint64))
            _, at, times = np.unique(same, return_index=True, return_counts=True)
            order = np.argsort(ctx[at], kind="stable")
            at, times = at[order], times[order]
            ctx, word, doc = ctx[at], word[at], doc[at]
            bucket = (ctx >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64)
            short = ((ctx << np.uint64(bits)) >> np.uint64(64 - CTX_BITS)).astype(np.int64)
            cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket)) if len(bucket) else [0]
            yield rows([-1 - k % 64], [part + k], [sum(map(len, keys))], [pack((np.concatenate(keys).view(np.uint64), 8))])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                blob = pack((np.diff(short[a:b], prepend=0), 6), (word[a:b], 7), (doc[a:b], 4), (times[a:b], 4))
                yield rows([bucket[a]], [part + k], [b - a], [blob])
            k, kept, keys, size = k + 1, [], [], 0
            give_back()

        for whole in batches:
            for a in range(0, whole.num_rows, 500):
                b = whole.slice(a, 500)
                words, codes, ends = coded_words(b.column(2))
                at = np.fromiter((place.get(w, -1) for w in words), np.int64, len(words))
                rare = np.flatnonzero(at < 0)
                at[rare] = rare_ids([words[i] for i in rare])
                ids, doc = at[codes], np.repeat(np.arange(b.num_rows), np.diff(np.concatenate([[0], ends])))
                out = np.fromiter(map(held_out, b.column(1).to_pylist()), bool, b.num_rows)
                kept.append((contexts(ids, doc), ids, ((doc + sum(map(len, keys))) * 2 + out[doc]).astype(np.int64)))
                keys.append(b.column(0).to_numpy())
                size += len(ids) + b.num_rows
                if size >= GROUP:
                    yield from group()
        if keys:
            yield from group()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, kind, score = frequent()
        chance, hits, met = np.append(0, chances(score)), np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int64)
        kind = np.append(-1, kind)

        def found(blobs: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
            parts = [unpack(blob, n, 6, 7, 4, 4) for _, n, blob in blobs]
            ctx, word, doc, times = (np.concatenate(x) for x in zip(*((np.cumsum(c), *rest) for c, *rest in parts), strict=True))
            of = np.repeat(np.arange(len(blobs)), [n for _, n, _ in blobs])
            likely, good, bad = expected(ctx, word, doc % 2 == 0, times)
            usual, mine = np.where(likely < RARE, likely, 0), np.where(word < RARE, word, 0)
            coded = (likely >= 0) & ((usual <= 0) | (mine == 0) | (kind[np.maximum(usual, 0)] == kind[mine]))
            at = np.flatnonzero(coded)
            one = likely[at] == word[at]
            cell = (level(good[at]) * LEVELS + level(bad[at])) * CHANCES + chance[usual[at]]
            known = doc[at] % 2 == 0
            for table, which in ((met, known), (hits, known & one)):
                table += np.bincount(cell[which], times[at[which]], CELLS).astype(np.int64)
            # the others share what the expected word has in its class, if all are known to be of it
            usual = np.where(one | (mine[at] > 0), usual[at], 0)
            lone = np.where(one & (word[at] >= RARE), word[at], 0)
            cuts = np.searchsorted(of[at], np.arange(len(blobs) + 1))
            for (batch, _, _), a, b in zip(blobs, cuts[:-1], cuts[1:], strict=True):
                if a < b:
                    blob = pack((doc[at[a:b]] >> 1, 4), (cell[a:b] * 2 + one[a:b], 2), (times[at[a:b]], 4), (usual[a:b], 4), (lone[a:b], 7))
                    yield rows([0], [batch], [b - a], [blob])
            give_back()

        waiting, now = [], None
        for b in batches:
            for bucket, batch, n, blob in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if bucket < 0:
                    yield rows([bucket], [batch], [n], [blob])
                    continue
                if bucket != now and waiting:
                    yield from found(waiting)
                    waiting = []
                now = bucket
                waiting.append((batch, n, blob))
        if waiting:
            yield from found(waiting)
        cell = np.flatnonzero(met)
        if len(cell):
            yield rows([1], [None], [len(cell)], [pack((cell, 8), (hits[cell], 8), (met[cell], 8))])

    tasks = max(1, min(1 << bits, max(spark.sparkContext.defaultParallelism, (1 << bits) // 4)))
    parts = docs.select("id", "doc_id", "text").mapInArrow(tidy(send), sent).repartition(tasks, "bucket").sortWithinPartitions("bucket")
    parts = write_and_read(parts.mapInArrow(tidy(count), sent), "followers")
    hits, met = np.zeros(CELLS), np.zeros(CELLS)
    for r in parts.where("bucket = 1").toLocalIterator():  # a task's map, of fixed size at most
        cell, one, all_ = unpack(r.blob, r.n, 8, 8, 8)
        hits[cell] += one
        met[cell] += all_
    p = map_of(hits, met)
    chosen = spark.sparkContext.broadcast((np.log10(p), np.log10(1 - p)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = np.append(0.0, frequent()[2])
        rest = np.append(0.0, np.log10(np.maximum(1 - 10.0 ** np.minimum(score[1:], 0), 1e-9)))
        yes, no = chosen.value
        now, keys, sums, lone = None, None, None, []

        def done() -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums), pa.array(np.ones(len(keys), np.int64)), pa.nulls(len(keys), pa.int64())], names=["id", "gain", "rows", "word_id"])
            for at, times, word in lone:
                yield pa.RecordBatch.from_arrays([pa.array(keys[at]), pa.array(times.astype(float)), pa.array(np.zeros(len(at), np.int64)), pa.array(word)], names=["id", "gain", "rows", "word_id"])

        for b in batches:
            for bucket, batch, n, blob in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if batch != now:
                    if now is not None:
                        yield from done()
                    now, keys, lone = batch, unpack(blob, n, 8)[0], []  # the keys of a batch come first
                    sums = np.zeros(len(keys))
                    assert bucket < 0
                    continue
                doc, cell, times, usual, word = unpack(blob, n, 4, 2, 4, 4, 7)
                one = cell % 2 == 1
                value = np.where(one, yes[cell >> 1] - score[usual], no[cell >> 1] - rest[usual])
                sums += np.bincount(doc, value * times, len(keys))
                at = np.flatnonzero(word)
                if len(at):
                    lone.append((doc[at], times[at], word[at]))
        if now is not None:
            yield from done()

    batches = parts.where("bucket < 1").repartition("batch").sortWithinPartitions("batch", "bucket")
    found = write_and_read(batches.mapInArrow(tidy(add), "id bigint, gain double, rows bigint, word_id bigint"), "follower-gains")
    rare = found.where("word_id IS NOT NULL").join(scored_rare.dropDuplicates(["word_id"]), "word_id").select("id", (-F.col("gain") * F.col("score")).alias("gain"), "rows")
    every = found.where("word_id IS NULL").select("id", "gain", "rows").unionByName(rare)
    return every.groupBy("id").agg((F.sum("gain") / F.sum("rows")).alias("gain"))
