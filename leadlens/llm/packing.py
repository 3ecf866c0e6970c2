"""Token ids in fixed-width bit-packed files.

A file holds blocks of ``block`` ids, each id in ``bits`` bits, least significant first; then a
footer: block offsets, documents' ids and their first token. Any range of ids is read through
the block offsets and unpacked with numpy. Documents go to files by range of doc_id, so the
files in order hold them in ascending order.

    magic | block 0 | block 1 | ... | footer | footer length (8 bytes) | magic
"""

from __future__ import annotations

import os
import struct
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import write_and_read
from .common import filesystem, shared_folder, tidy

MAGIC = b"LLPACK01"
_HEAD = struct.Struct("<IIQQQ")  # bits, ids per block, blocks, documents, ids
FILES = "part bigint, file string, n_docs bigint, n_ids bigint"


def width(vocabulary: int) -> int:
    """Bits that the ids 0 ... vocabulary - 1 need."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):  # whole bytes: the same layout without the bit matrix
        return ids.astype(f"<u{bits // 8}").tobytes()
    matrix = (ids.astype("<u4")[:, None] >> np.arange(bits, dtype="<u4")) & 1
    return np.packbits(matrix.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    matrix = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: n * bits].reshape(n, bits)
    return (matrix.astype("<u4") << np.arange(bits, dtype="<u4")).sum(1, dtype="<u4")


class Writer:
    """Streams documents into one file; holds less than a block of ids and the footer."""

    def __init__(self, out, bits: int, block: int):
        self.out, self.bits, self.block = out, bits, block
        self.rest = np.empty(0, "<u4")
        self.offsets, self.docs, self.starts, self.n = [len(MAGIC)], [], [0], 0
        out.write(MAGIC)

    def add(self, doc_ids: list, counts: list[int] | np.ndarray, ids: np.ndarray) -> None:
        self.docs += doc_ids
        self.starts += (self.n + np.cumsum(counts, dtype=np.int64)).tolist()
        self.n += len(ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // self.block * self.block
        for a in range(0, whole, self.block):
            self._put(ids[a : a + self.block])
        self.rest = ids[whole:]

    def _put(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.out.write(data)
        self.offsets.append(self.offsets[-1] + len(data))

    def close(self) -> None:
        if len(self.rest):
            self._put(self.rest)
        known = np.array([d is not None for d in self.docs], np.uint8)
        foot = _HEAD.pack(self.bits, self.block, len(self.offsets) - 1, len(self.docs), self.n) + b"".join(
            [np.array(self.offsets, "<i8").tobytes(), np.array([d or 0 for d in self.docs], "<i8").tobytes(),
             known.tobytes(), np.array(self.starts, "<i8").tobytes()])
        self.out.write(foot + struct.pack("<Q", len(foot)) + MAGIC)
        self.out.close()


class Reader:
    """Random access to a file: ``ids(a, b)`` reads only the blocks that hold that range."""

    def __init__(self, file):
        self.file, size = file, file.size()
        n, magic = struct.unpack("<Q8s", file.read_at(16, size - 16))
        if magic != MAGIC:
            raise ValueError("not a packed token file")
        foot = file.read_at(n, size - 16 - n)
        self.bits, self.block, blocks, docs, self.n = _HEAD.unpack_from(foot)
        at = _HEAD.size
        self.offsets = np.frombuffer(foot, "<i8", blocks + 1, at)
        self.docs = np.frombuffer(foot, "<i8", docs, at + 8 * (blocks + 1))
        self.known = np.frombuffer(foot, np.uint8, docs, at + 8 * (blocks + 1 + docs)).astype(bool)
        self.starts = np.frombuffer(foot, "<i8", docs + 1, at + 8 * (blocks + 1 + docs) + docs)

    def ids(self, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.empty(0, "<u4")
        i, j = a // self.block, (b - 1) // self.block
        data = self.file.read_at(int(self.offsets[j + 1] - self.offsets[i]), int(self.offsets[i]))
        size, have = int(self.offsets[1] - self.offsets[0]), []
        for k in range(i, j + 1):  # blocks end on whole bytes, so each is unpacked by itself
            at = int(self.offsets[k] - self.offsets[i])
            have.append(unpack(data[at : at + size], self.bits, min(self.block, self.n - k * self.block)))
        return np.concatenate(have)[a - i * self.block : b - i * self.block]


class WordCache:
    """ids of white-space separated words, as little-endian unsigned 32-bit bytes.

    For a tokenizer that drops white space, lower-cases, and parts runs of letters from runs of
    marks (:func:`fits` tries it), a text's ids are those of its words in order, and those of a
    word that ends in marks are those of its letters, then of the marks, if its letters are still
    letters alone when normalised (:meth:`letters`). A run of ASCII letters goes straight to the
    tokenizer's model, other words through the whole tokenizer.

    Two generations of at most about ``most`` words each are held: what the older one still serves
    moves to the younger, the rest is forgotten with it.
    """

    held: dict[str, list] = {}
    MARKS = b",.;:!?"

    def __init__(self, model: str, most: int = 400_000):
        from tokenizers import Tokenizer

        key = str(zlib.crc32(model.encode()))
        if key not in self.held:  # Python workers serve many tasks
            self.held[key] = [Tokenizer.from_str(model), {}, {}, {}, {}]
        self.state, self.most = self.held[key], most

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids), each text closed by ``end_id``."""
        split = pc.ascii_split_whitespace(texts.fill_null("").cast(pa.large_string()))
        cuts = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        ids = self._of(coded.dictionary.cast(pa.large_binary()).to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.concatenate([[0], np.cumsum(sizes)])
        flat, word = np.frombuffer(b"".join(ids), "<u4"), coded.indices.to_numpy()
        n = sizes[word]
        ends = np.cumsum(n)
        out = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[word] - ends + n, n)]
        upto = np.concatenate([[0], ends])[cuts]
        return np.diff(upto) + 1, np.insert(out, upto[1:], end_id)

    def _of(self, wanted: list[bytes]) -> list[bytes]:
        if len(self.state[1]) > self.most:
            self.state[1:3] = {}, self.state[1]
        if len(self.state[3]) > self.most:
            self.state[3:5] = {}, self.state[3]
        _, words, old, runs, _ = self.state
        found = [words.get(w) or old.get(w) for w in wanted]
        missing = [i for i, x in enumerate(found) if x is None]
        parts = [(w, c.lower(), w[len(c) :]) if self.letters(c := w.rstrip(self.MARKS)) else (w, w, b"") for w in map(wanted.__getitem__, missing)]
        self._runs({x for p in parts for x in p[1:]})
        for i, (_, c, m) in zip(missing, parts, strict=True):
            found[i] = runs[c] + runs[m]
        words.update(zip(wanted, found, strict=True))
        return found

    @staticmethod
    def letters(word: bytes) -> bool:
        """Whether marks behind the word stand apart from it: it normalises to letters of the Latin,
        Greek or Cyrillic alphabet. A capital I with a dot, say, leaves a combining dot in lower
        case, which forms one run with the marks; on rarer letters versions of Unicode differ."""
        if word.isalpha():  # of bytes: ASCII letters only
            return True
        text = unicodedata.normalize("NFC", word.decode()).lower()
        return text.isalpha() and max(text) < "\u0500"

    def _runs(self, wanted: set[bytes]) -> None:
        tokenizer, _, _, runs, old = self.state
        wanted = wanted.difference(runs)
        known = wanted.intersection(old)
        runs.update((w, old[w]) for w in known)
        new = list(wanted - known)
        tokenize = tokenizer.model.tokenize
        plain = [w for w in new if w.isalpha() and w.islower()]  # of bytes: ASCII letters only
        runs.update((w, array("I", [t.id for t in tokenize(w.decode())]).tobytes()) for w in plain)
        rest = [w for w in new if not (w.isalpha() and w.islower())]
        for a in range(0, len(rest), 20_000):
            part = rest[a : a + 20_000]
            done = tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            runs.update((w, array("I", e.ids).tobytes()) for w, e in zip(part, done, strict=True))


def fits(tokenizer_json: str) -> bool:
    """Whether the tokenizer encodes a text as its words, in trials of what could tell."""
    from tokenizers import Tokenizer

    whole, words = Tokenizer.from_str(tokenizer_json), WordCache(tokenizer_json)
    trials = ["The cat, it's 12 B.C.!  a\tb\n\nc?! ", "Élan über; ÇA va: ñandú, I'll we've... don't", "x", "a ,b . c d's 's", "İstanbul ΑΣ ΑΣ. ﬁne e\u0301t\u00a0o \u0301",
              "TARİHİ. ŞEHRİ! GÜZELLİĞİ, ÉTÉ? МИР; ΤΈΛΟΣ: \u0958. ǅ, क़! ﬀ. e\u0301. 語。語."]
    return all(words.encode(pa.array([t]), 0)[1].tolist() == [*whole.encode(t, add_special_tokens=False).ids, 0] for t in trials)


def write_tokens(docs: DataFrame, tokenizer_json: str, folder: str, end_id: int = 1, block: int = 4096) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write packed files below ``folder``; returns the
    committed table FILES, ``part`` ascending with doc_id. Rows of equal doc_id keep together
    in order of their texts' hashes; null ids come first; a null text is empty. ``end_id`` closes
    each document. The tokenizer's JSON text goes to the tasks (a few MB, fixed)."""
    from tokenizers import Tokenizer

    if not fits(tokenizer_json):
        raise ValueError("this tokenizer's ids of a text are not those of its words")
    bits = width(max(Tokenizer.from_str(tokenizer_json).get_vocab_size(with_added_tokens=True), end_id + 1))
    model = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        cache, writer, name = None, None, f"{uuid.uuid4().hex}.ids"
        for whole in batches:
            for a in range(0, whole.num_rows, 3000):
                b = whole.slice(a, 3000)
                if writer is None:
                    fs, root = filesystem(folder)
                    writer, cache = Writer(fs.open_output_stream(f"{root}/{name}", compression=None), bits, block), WordCache(model.value)
                writer.add(b.column(0).to_pylist(), *cache.encode(b.column(1), end_id))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (TaskContext.get().partitionId(), name, len(writer.docs), writer.n)],
                names=["part", "file", "n_docs", "n_ids"])

    order = [F.col("doc_id"), F.xxhash64("text")]
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    return write_and_read(dealt.mapInArrow(tidy(run), FILES), "token-files")


def read_tokens(files: DataFrame, folder: str, step: int = 4_000_000) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers) and file, read from the files of FILES, one task
    per file."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    rows = files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).select("file", "base").collect()
    spark = files.sparkSession
    places = spark.createDataFrame(spark.sparkContext.parallelize([tuple(r) for r in rows], max(1, len(rows))), "file string, base bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for b in batches:
            for name, base in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with fs.open_input_file(f"{root}/{name}") as f:
                    yield from _documents(Reader(f), name, base, step)

    return places.mapInArrow(tidy(run), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, file string")


def _documents(r: Reader, name: str, base: int, step: int) -> Iterator[pa.RecordBatch]:
    i, n = 0, len(r.docs)
    while i < n:
        j = max(i + 1, int(np.searchsorted(r.starts, r.starts[i] + step, "right")) - 1)
        starts = r.starts[i : j + 1]
        data = memoryview(r.ids(int(starts[0]), int(starts[-1])).tobytes())
        cuts = (4 * (starts - starts[0])).tolist()
        sums = [zlib.crc32(data[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(r.docs[i:j], mask=~r.known[i:j]), pa.array(base + starts[:-1]), pa.array(np.diff(starts)),
             pa.array(sums, pa.int64()), pa.array([name] * (j - i))], names=["doc_id", "start", "n_tokens", "ids_crc32", "file"])
        i = j


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 1, block: int = 4096) -> DataFrame:
    """Encode and pack ``docs``, read the files back: a row per document, none for an empty table."""
    with open(tokenizer_path, encoding="utf-8") as f:
        model = f.read()
    folder = shared_folder(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, model, folder, end_id, block), folder)
