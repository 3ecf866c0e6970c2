"""Spelling variants: words one edit apart, found in dense tiles of padded code-point matrices.

Words are counted over all texts. Two words with one edit between them agree in the first or the
last half of the shorter one (the edit falls into the other half), so words meet in buckets by that
half and by the shorter one's length. A bucket is cut into blocks of a bounded number of words, and
each pair of blocks is a tile: the words of both as matrices of code points, padded to a common
width, compared pair by pair from the left and, aligned at their ends, from the right. A common
prefix and suffix of together at least the longer length minus one is exactly one edit. A tile gives
back what it found per word, not its pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import named
from ..session import write_and_read
from .common import small_batches, tidy
from .graph import small

#: Maximal runs of these letters are words (A-Z are lower case by then).
LETTERS = "a-zÀ-ÿ"
#: Most words and most code points of a block; pairs compared, and code points gathered, at a time.
BLOCK_WORDS, BLOCK_CELLS, PAIRS, CELLS = 2048, 1 << 21, 1 << 16, 1 << 21
#: Different words that a task counts before it hands them over; pairs that a task is to compare.
HELD, TASK_PAIRS = 200_000, 10_000_000


def word_counts(docs: DataFrame, least_chars: int = 6, least_count: int = 5, slip: int = 199,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of at least ``least_chars`` code points that occur ``least_count`` times.

    A run whose crc32 (of "<doc_id>:<run>") ``slip`` divides loses one code point, at the checksum
    modulo its length. A null text has no words; a null id is written as nothing before the colon;
    repeated rows count each time. Counts are combined in each task before the shuffle.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(named(id_col).cast("string"), F.lit("")).alias("id"), named(text_col).alias("text")).where("text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(f"[{LETTERS}]{{{least_chars},}}").findall  # shorter runs can't grow
        seen: Counter = Counter()

        def hand_over():
            out = pa.record_batch([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for key, text in zip(batch["id"].to_pylist(), batch["text"]):
                start = zlib.crc32(f"{key}:".encode())
                for word, n in Counter(find(text.as_py().encode().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % slip == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least_chars:
                            continue
                    seen[word] += n
                if len(seen) > HELD:
                    yield hand_over()
        yield hand_over()

    counted = texts.mapInArrow(tidy(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


TILE = ["s", "left", "half", "i", "j"]


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` marked for a join by a shuffle. Spark would broadcast it by the size of its files, which
    hold many times as many rows as the driver can, and which an explode behind them does not raise."""
    return df.hint("merge")


def _tiles(words: DataFrame, least_chars: int) -> DataFrame:
    """(s, left, half, i, j, block, word, n): the words of each tile. ``s`` is the shorter length of
    the pairs that meet there, ``half`` a hash of the first or last s // 2 code points. Dealt out by
    tile to a number of tasks that follows from the pairs, not the bytes."""
    length = F.char_length("word")
    met = words.withColumn("s", F.explode(F.array(length, length - 1))).where(F.col("s") >= least_chars)
    k = F.floor(F.col("s") / 2).cast("int")
    ends = F.array(F.struct(F.lit(True).alias("left"), F.xxhash64(F.substring("word", F.lit(1), k)).alias("half")),
                   F.struct(F.lit(False).alias("left"), F.xxhash64(F.right("word", k)).alias("half")))
    met = met.select("word", "n", "s", F.inline(ends))
    bucket = ["s", "left", "half"]
    # a bucket without a word of length s has no pair, nor has one of a single word
    sizes = met.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size"), F.min(F.char_length("word")).alias("shortest"))
    sizes = write_and_read(sizes.where("size > 1 AND shortest = s").drop("shortest"), "variant-buckets")
    blocks = F.ceil(F.col("size") / F.greatest(F.lit(16), F.least(F.lit(BLOCK_WORDS), F.floor(F.lit(BLOCK_CELLS) / F.col("s"))))).cast("int")
    big = sizes.withColumn("blocks", blocks).where("blocks > 1").drop("size")
    met = met.join(shuffled(sizes.drop("size")), bucket, "left_semi").join(small(big, 100_000), bucket, "left")
    met = met.withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = met.withColumn("other", other)
    met = met.select(*bucket, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "word", "n")
    pairs = sizes.agg(F.sum(F.col("size").cast("double") * F.col("size") / 2)).first()[0] or 0.0
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(int(pairs / TASK_PAIRS), 100_000))
    return met.repartition(tasks, *TILE)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(matrix padded at the end, matrix of the words reversed, lengths)."""
    a = np.array(words)
    width = a.dtype.itemsize // 4
    return (a.view(np.uint32).reshape(len(words), width), np.array([w[::-1] for w in words], a.dtype).view(np.uint32).reshape(len(words), width),
            np.fromiter(map(len, words), np.int64, len(words)))


def common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of each row pair's common beginning, at most ``most``."""
    equal = a == b
    return np.minimum(np.where(equal.all(axis=1), a.shape[1], equal.argmin(axis=1)), most)


def one_edit(front: np.ndarray, back: np.ndarray, length: np.ndarray, x: np.ndarray, y: np.ndarray,
             s: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Mask of the pairs (x, y) of rows that one edit parts, each in one bucket only: that of the
    shorter one's length ``s``, and of its first half if both agree there, else of its last."""
    half = s // 2
    shorter, longer = np.minimum(length[x], length[y]), np.maximum(length[x], length[y])
    prefix = common(front[x], front[y], shorter)
    suffix = common(back[x], back[y], shorter)
    return (shorter == s) & (longer - s <= 1) & (prefix + suffix >= longer - 1) & ((prefix >= half) == left) & (left | (suffix >= half))


def _pairs(starts: np.ndarray, split: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(tile, x, y), a bounded number at a time: all pairs of rows start..end of each tile, or, where
    the tile has two blocks, those of a row before ``split`` with one behind."""
    for x_from, x_to, y_to, t in zip(starts.tolist(), split.tolist(), ends.tolist(), range(len(starts))):
        two = x_to < y_to
        for x in range(x_from, x_to if two else y_to - 1):
            yield t, x, x_to if two else x + 1, y_to


def _compare(words: list[str], n: np.ndarray, s: np.ndarray, left: np.ndarray, starts: np.ndarray, split: np.ndarray,
             ends: np.ndarray) -> tuple[dict[int, int], dict[int, tuple[int, str]]]:
    """Near words of whole tiles: (number by row, best (-n, word) by row)."""
    front, back, length = code_points(words)
    # row x meets the rows from..to: counts per x, spread out as pairs a bounded number at a time
    lines = np.array(list(_pairs(starts, split, ends)), np.int64).reshape(-1, 4)
    count = lines[:, 3] - lines[:, 2]
    number: dict[int, int] = Counter()
    best: dict[int, tuple[int, str]] = {}
    most = max(1, min(PAIRS, CELLS // max(1, front.shape[1])))
    upto = np.cumsum(count)
    for at in range(0, int(upto[-1]) if len(upto) else 0, most):
        # the pairs at..at+most of the whole enumeration
        p = np.arange(at, min(at + most, int(upto[-1])))
        row = np.searchsorted(upto, p, side="right")
        t, x = lines[row, 0], lines[row, 1]
        y = lines[row, 2] + (p - (upto[row] - count[row]))
        hit = np.flatnonzero(one_edit(front, back, length, x, y, s[t], left[t]))
        for a, b in zip(x[hit].tolist(), y[hit].tolist()):
            for me, you in ((a, b), (b, a)):
                number[me] += 1
                found = (-int(n[you]), words[you])
                best[me] = min(best.get(me, found), found)
    return number, best


def near_words(words: DataFrame, least_chars: int = 6) -> DataFrame:
    """(word, n_near, form_n, form): for each word with a near one their number, and the one of
    largest n (ties: smallest in code-point order). ``words`` (word, n) should be a written table
    with each word once."""
    small_batches(words.sparkSession, 10_000)
    tiles = _tiles(words, least_chars).sortWithinPartitions(*TILE, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: pa.Table) -> pa.RecordBatch:
            col = {c: rows[c].to_numpy() for c in (*TILE, "block", "n")}
            words = rows["word"].to_pylist()
            new = np.zeros(len(words), bool)
            new[0] = True
            for c in TILE:
                new[1:] |= col[c][1:] != col[c][:-1]
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(words))
            # behind the first block of a tile of two; a tile of one block ends there
            first = np.add.reduceat((col["block"] == col["i"]).astype(np.int64), starts)
            split = np.where(col["i"][starts] < col["j"][starts], starts + first, ends)
            number, best = _compare(words, col["n"], col["s"][starts], col["left"][starts].astype(bool), starts, split, ends)
            at = sorted(number)
            return pa.record_batch([pa.array([words[i] for i in at], pa.string()), pa.array([number[i] for i in at], pa.int64()),
                                    pa.array([-best[i][0] for i in at], pa.int64()), pa.array([best[i][1] for i in at], pa.string())],
                                   names=["word", "n_near", "form_n", "form"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            if sum(map(len, held)) < 2 * BLOCK_WORDS:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            # whole tiles: all but the last, which may go on in the next batch
            last = np.zeros(len(rows), bool)
            for c in TILE:
                v = rows[c].to_numpy()
                last |= v != v[-1]
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            if cut:
                yield found(rows.slice(0, cut))
            held = rows.slice(cut).to_batches()
        if held:
            yield found(pa.Table.from_batches(held).combine_chunks())

    parts = tiles.mapInArrow(tidy(run), "word string, n_near long, form_n long, form string")
    least = F.min(F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("form")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("best")).select(
        "word", "n_near", (-F.col("best.m")).alias("form_n"), F.col("best.form").alias("form"))


def _roots(forms: DataFrame, salts: int = 16) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last. A step joins each word's furthest
    form so far with that one's own, so the distance doubles; a form is much more frequent than its
    word, which bounds the chain. The furthest form of very many words is dealt out by salts."""
    reach = write_and_read(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("next"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
        step = reach.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(salts)).cast("int")).join(shuffled(further), ["root", "salt"], "left")
        step = write_and_read(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        reach = step.select("word", "root")


def group_variants(words: DataFrame, least_chars: int = 6, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of ``words`` (word, n), words being distinct
    and not null: ``form`` is the near word of largest n if that is at least ``times`` the word's,
    else null; ``root`` the end of the chain of forms, the word itself without one. An empty table
    gives an empty one."""
    near = words.join(near_words(words, least_chars), "word", "left")
    is_form = F.col("form_n") >= times * F.col("n")
    all_words = write_and_read(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                           F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n")), "variant-forms")
    roots = _roots(all_words.where("form IS NOT NULL"))
    return all_words.join(shuffled(roots), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def digest(docs: DataFrame) -> DataFrame:
    """The variants among the words of ``docs``."""
    return group_variants(write_and_read(word_counts(docs), "variant-words"))
