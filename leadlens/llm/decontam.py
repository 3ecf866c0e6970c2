"""Benchmark decontamination with a generalised suffix automaton of the benchmark's words.

The automaton is built on the driver from the benchmark items and sent to the tasks; its size
is proportional to the items' words, so items are dealt into automata of at most
``max_item_bytes`` of text each and the documents make one pass per automaton (one, for any
usual benchmark). Each task streams its documents' words through the automaton and tracks the
longest suffix of what it has read that occurs in an item. Memory: one Arrow batch of texts
and one automaton; there is no shuffle.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_and_read
from .common import by_position, private_names, tidy

#: A-Z fall to a-z; bytes 0x30-0x39, 0x61-0x7A and 0x80-0xFF belong to words, the rest parts them.
_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)
_WORD = re.compile(rb"[^\x20]+")


def words(text: str | None) -> list[bytes]:
    """Normalised words of a text (null: none)."""
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences. ``n``: the window of a long item; an item
    of fewer words is one window as a whole."""

    def __init__(self, items: list[tuple[str, list[bytes]]], n: int):
        self.n = n
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = array("q", [-1])
        self.length = array("q", [0])
        coded = [(key, [self.ids.setdefault(w, len(self.ids)) for w in ws]) for key, ws in items if ws]
        for _, ws in coded:
            state = 0
            for w in ws:
                state = self._extend(state, w)
        #: state of a window -> keys of the items that have it; (state, length) for short items
        self.at: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for key, ws in coded:
            if len(ws) < n:
                state, _ = self._run(ws, len(ws))
                self.short.setdefault(state, {}).setdefault(len(ws), set()).add(key)
            else:
                for state in self._windows(ws):
                    self.at.setdefault(state, set()).add(key)
        self._chains()

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:  # another item already has this path
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, w, q)
        cur = self._state(self.length[last] + 1, {})
        p = last
        while p != -1 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p == -1:
            self.link[cur] = 0
        else:
            q = self.next[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, w, q)
        return cur

    def _state(self, length: int, nxt: dict[int, int]) -> int:
        self.next.append(nxt)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        c = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[c] = self.link[q]
        self.link[q] = c
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def _up(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of what ``state`` has matched."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _run(self, ws: list[int], length: int) -> tuple[int, int]:
        state = 0
        for w in ws:
            state = self.next[state][w]
        return self._up(state, length), length

    def _windows(self, ws: list[int]) -> Iterator[int]:
        state = 0
        for i, w in enumerate(ws):
            state = self.next[state][w]
            if i + 1 >= self.n:
                state = self._up(state, self.n)
                yield state

    def _chains(self) -> None:
        """For each state, the short items among it and its suffix links: longest first."""
        self.ends: list[tuple | None] = [None] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            own = tuple(sorted(self.short.get(s, {}).items(), reverse=True))
            above = self.ends[self.link[s]] or ()
            self.ends[s] = (own + above) or None

    def hits(self, ws: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Spans [first, last + 1) of hit words, merged and in order, and the items met."""
        get, nxt, link, length, n, ends = self.ids.get, self.next, self.link, self.length, self.n, self.ends
        spans: list[list[int]] = []
        met: set[str] = set()
        state = matched = 0
        for i, w in enumerate(ws):
            c = get(w)
            if c is None:
                state = matched = 0
                continue
            to = nxt[state].get(c)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = nxt[state].get(c)
            if to is None:
                continue
            state = to
            matched += 1
            longest = 0
            if matched >= n:
                longest = matched
                met |= self.at.get(self._up(state, n), ())
            if ends[state] is not None:
                for m, keys in ends[state]:
                    if m <= matched:
                        longest = max(longest, m)
                        met |= keys
            if longest:
                first = i + 1 - longest
                while spans and spans[-1][0] >= first:
                    spans.pop()
                if spans and spans[-1][1] >= first:
                    spans[-1][1] = i + 1
                else:
                    spans.append([first, i + 1])
        return spans, met


def _merge(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _cut(text: str, spans: list[list[int]]) -> str:
    """``text`` without its words of ``spans`` and what stands between words of one span."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [(m.start(), m.end()) for m in _WORD.finditer(raw.translate(_WORDS))]
    out, end = [], 0
    for a, b in spans:
        out.append(raw[end : at[a][0]])
        end = at[b - 1][1]
    out.append(raw[end:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def _automata(benchmark: DataFrame, item: str, text: str, max_item_bytes: int, n: int) -> Iterator[Automaton]:
    part: list[tuple[str, list[bytes]]] = []
    size = 0
    for key, value in benchmark.select(F.col(f"`{item}`").cast("string"), F.col(f"`{text}`")).toLocalIterator():
        if value is None or key is None:
            continue
        if part and size + len(value) > max_item_bytes:
            yield Automaton(part, n)
            part, size = [], 0
        part.append((key, words(value)))
        size += len(value)
    yield Automaton(part, n)


def match(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
          n: int = 10, max_item_bytes: int = 64_000_000) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (merged word ranges hit, [first, end)) and ``items``
    (sorted ids, as strings, of the items with an occurring window). Names that ``docs``
    already has get underscores in front (see :func:`added_names`).

    Null or empty texts have no words and no hits; items that are null, empty or have a null
    id are never met; repeated items count once by id; an empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    n_words, spans, items = added_names(docs)
    out = docs
    first = True
    for auto in _automata(benchmark, item, item_text, max_item_bytes, n):
        if not first:
            out = write_and_read(out, "decontam-pass")
        out = _one_pass(out, spark.sparkContext.broadcast(auto), text, n_words, spans, items)
        first = False
    return out


def added_names(docs: DataFrame) -> tuple[str, str, str]:
    return private_names(docs, "n_words", "spans", "items")


def _one_pass(docs: DataFrame, shared, text: str, n_words: str, spans: str, items: str) -> DataFrame:
    kept = [f for f in docs.schema.fields if f.name not in (n_words, spans, items)]
    again = spans in docs.columns
    schema = T.StructType([*kept, T.StructField(n_words, T.LongType()),
                           T.StructField(spans, T.ArrayType(T.ArrayType(T.LongType()))),
                           T.StructField(items, T.ArrayType(T.StringType()))])
    columns, names = docs.columns, [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = shared.value
        for b in batches:
            counts, hit, met = [], [], []
            for value in b.column(columns.index(text)):
                ws = words(value.as_py())
                s, m = auto.hits(ws)
                counts.append(len(ws))
                hit.append(s)
                met.append(m)
            if again:
                hit = [_merge(x + y) for x, y in zip(hit, b.column(columns.index(spans)).to_pylist(), strict=True)]
                met = [x.union(y) for x, y in zip(met, b.column(columns.index(items)).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(columns.index(c)) for c in names), pa.array(counts, pa.int64()),
                 pa.array(hit, pa.list_(pa.list_(pa.int64()))), pa.array([sorted(x) for x in met], pa.list_(pa.string()))],
                names=[*names, n_words, spans, items])

    return docs.mapInArrow(tidy(run), schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = 10,
                  max_coverage: float = 0.8, **options) -> DataFrame:
    """``docs`` with benchmark spans cut out of ``text``; a document of whose words at least
    ``max_coverage`` are hit goes whole. Other columns, whatever their names, stay as they are."""
    inner, named_back = by_position(docs, text)
    n_words, spans, items = added_names(inner)
    found = match(inner, benchmark, text=text, n=n, **options)
    covered = F.expr(f"aggregate(`{spans}`, 0L, (a, s) -> a + s[1] - s[0])")
    kept = found.where((F.col(n_words) == 0) | (covered < max_coverage * F.col(n_words))).drop(n_words, items)
    names, at = inner.columns, inner.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns, hits = list(b.columns[:-1]), b.column(b.num_columns - 1).to_pylist()
            if any(hits):
                columns[at] = pa.array([_cut(t, s) if s else t for t, s in zip(columns[at].to_pylist(), hits, strict=True)], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return named_back(kept.mapInArrow(tidy(run), inner.schema))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = match(docs.select("doc_id", "text"), benchmark)
    n_hit = F.expr("aggregate(spans, 0L, (a, s) -> a + s[1] - s[0])")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def brute_force(texts: dict, items: dict, n: int = 10) -> dict:
    """The same digest by comparing every window with every position (for tests)."""
    out = {}
    for d, t in texts.items():
        ws = words(t)
        hit, met = set(), set()
        for key, value in items.items():
            iw = words(value)
            k = min(n, len(iw))
            for a in range(len(iw) - k + 1 if k else 0):
                for i in range(len(ws) - k + 1):
                    if ws[i : i + k] == iw[a : a + k]:
                        hit.update(range(i, i + k))
                        met.add(str(key))
        out[d] = (len(ws), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit))
    return out
