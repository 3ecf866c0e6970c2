"""Nearest neighbours by inner product: a forest of random-projection trees, searched through one
priority queue over all trees, then exact reranking of what the visited leaves hold.

Inner products become distances by one more coordinate, sqrt(M^2 - |x|^2), with M the largest norm
(queries have 0 there; all is then divided by M). The trees are fitted on a bounded sample: a node's plane is normal to the
difference of two of its sample vectors and halves them. Every row is then routed to its leaf of
every tree. A query's leaves of all trees stand in one queue, by the least margin on the way to
them; leaves are taken until they hold ``visits`` rows, over all trees.

Rows and queries of a leaf meet in tasks by leaf; a leaf of over ``leaf_block`` rows is dealt into
blocks, each met by the leaf's queries, so hot leaves (many equal vectors) are shared out. A task
keeps the best ``k`` of each query it has met; the rest is an aggregate over tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import write_and_read


class Forest:
    """Perfect binary trees in heap order: node i has children 2i and 2i + 1, 1 is the root."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, longest: float, seed: int = 11):
        self.depth, self.longest = depth, longest
        x = self.lifted(sample)
        rng = np.random.default_rng(seed)
        self.normals = np.zeros((trees, 1 << depth, x.shape[1]), np.float32)
        self.cuts = np.zeros((trees, 1 << depth), np.float32)
        for t in range(trees):
            node = np.ones(len(x), np.int64)
            for i in range(1, 1 << depth):
                here = np.flatnonzero(node == i)
                if len(here) > 1:
                    a, b = x[rng.choice(here, 2, replace=False)]
                    normal = a - b
                    normal /= np.linalg.norm(normal) or 1.0
                    at = x[here] @ normal
                    self.normals[t, i], self.cuts[t, i] = normal, np.median(at)
                    node[here] = 2 * i + (at >= self.cuts[t, i])

    def lifted(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64) / self.longest
        more = np.sqrt(np.maximum(1 - (x**2).sum(1), 0))
        return np.concatenate([x, more[:, None]], 1).astype(np.float32)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree: shape (trees, rows)."""
        x, out = self.lifted(x), []
        for normals, cuts in zip(self.normals, self.cuts, strict=True):
            node = np.ones(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + (np.einsum("ij,ij->i", x, normals[node]) >= cuts[node])
            out.append(node - (1 << self.depth))
        return np.stack(out)

    def queue(self, q: np.ndarray) -> np.ndarray:
        """All trees' leaves (tree * leaves + leaf) of each query, in the order in which a shared
        priority queue yields them: a leaf's priority is the least margin on its path."""
        q = np.concatenate([q / self.longest, np.zeros((len(q), 1))], 1).astype(np.float32)
        found = []
        for normals, cuts in zip(self.normals, self.cuts, strict=True):
            margin, best = q @ normals.T - cuts, np.full((len(q), 1), np.inf, np.float32)
            for level in range(self.depth):
                m = margin[:, 1 << level : 2 << level]
                best = np.stack([np.minimum(best, -m), np.minimum(best, m)], 2).reshape(len(q), -1)
            found.append(best)
        return np.argsort(-np.concatenate(found, 1), 1, kind="stable")


def _matrix(b: pa.RecordBatch, column: str, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(b.column(column).to_pylist()), kind).reshape(-1, width)


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v) of the rows that take part: id not null, vector not null, not empty, not zero,
    all components finite, of the table's commonest length (the longer, if two are). Rows that
    repeat id and vector count once."""
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL").where(ok)
    common = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1)
    return rows.join(F.broadcast(common.select("width")), F.size("v") == F.col("width")).drop("width").distinct()


def search(df: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", trees: int = 8, leaf_rows: int = 1024,
           visit_share: float = 1.3, visits: int | None = None, sample_rows: int = 16_384, max_depth: int = 14, leaf_block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of largest inner product found for the rows
    that satisfy ``is_query`` (a condition on ``vec_id``), the query's own id left out; ties go to
    the smaller id. Scores are in double precision on the original vectors.

    A query visits leaves that hold ``visits`` rows (``visit_share`` of all rows, if not given; a
    row counts once for each tree). At most ``leaf_rows`` usable rows are one leaf, so all of them
    are compared. The sample is at most ``sample_rows`` rows, those of the least hashes.
    """
    spark = df.sparkSession
    double = dict(df.dtypes)[vector] != "array<float>"
    kind = "<f8" if double else "<f4"
    rows = write_and_read(usable(df, vec_id, vector), "vectors")
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"),
                     F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("longest")).first()
    n, width = facts.n, facts.width or 1
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    depth = min(max_depth, max(0, math.ceil(math.log2(n / leaf_rows))))
    first = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(sample_rows, n)).select("v").toArrow()
    sample = np.array(first.column("v").to_pylist(), np.float64).reshape(-1, width)
    forest = spark.sparkContext.broadcast(Forest(sample, trees if depth else 1, depth, math.sqrt(facts.longest)))
    span = 1 << depth

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, values = b.column("vec_id"), b.column("v").flatten().to_numpy().astype(kind).reshape(-1, width)
            raw = pa.array([x.tobytes() for x in values], pa.binary())
            for t, leaf in enumerate(forest.value.leaves(values)):
                yield pa.RecordBatch.from_arrays([pa.array(t * span + leaf), ids, raw], names=["leaf", "vec_id", "raw"])

    members = write_and_read(rows.mapInArrow(route, "leaf long, vec_id long, raw binary"), "leaf-members")
    held = {r.leaf: r["count"] for r in members.groupBy("leaf").count().collect()}  # a number for each leaf of the forest
    sizes = np.array([held.get(i, 0) for i in range(span * (trees if depth else 1))])
    blocks = np.maximum(1, -(-sizes // leaf_block))
    room = visits if visits is not None else math.ceil(visit_share * n)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                b = whole.slice(a, 256)
                ids, values = b.column("vec_id").to_numpy(), b.column("v").flatten().to_numpy().astype(kind).reshape(-1, width)
                order = forest.value.queue(values)
                taken = np.cumsum(sizes[order], 1) - sizes[order] < room
                row, at = np.nonzero(taken & (sizes[order] > 0))
                leaf = order[row, at]
                times = blocks[leaf]
                row, leaf = np.repeat(row, times), np.repeat(leaf, times)
                block = np.arange(len(leaf)) - np.repeat(np.cumsum(times) - times, times)
                raw = pa.array([x.tobytes() for x in values], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(block), pa.array(ids[row]), raw.take(pa.array(row))], names=["leaf", "block", "vec_id", "raw"])

    probes = rows.where(is_query).mapInArrow(probe, "leaf long, block long, vec_id long, raw binary").withColumn("asks", F.lit(True))
    many = sorted((i, int(x)) for i, x in enumerate(blocks) if x > 1)
    table = F.create_map(*(F.lit(x).cast("long") for p in many for x in p)) if many else F.lit(None).cast("map<bigint,bigint>")
    block = F.pmod(F.xxhash64("vec_id"), F.coalesce(table[F.col("leaf")], F.lit(1).cast("long")))
    units = members.select("leaf", block.alias("block"), "vec_id", "raw", F.lit(False).alias("asks")).unionByName(probes)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        at, parts = None, []
        for b in batches:
            leaf, block = b.column("leaf").to_numpy(), b.column("block").to_numpy()
            asks, ids, values = b.column("asks").to_numpy(zero_copy_only=False), b.column("vec_id").to_numpy(), _matrix(b, "raw", kind, width)
            cut = np.flatnonzero(np.r_[True, (leaf[1:] != leaf[:-1]) | (block[1:] != block[:-1])])
            for i, j in zip(cut, [*cut[1:], len(leaf)], strict=True):
                if (leaf[i], block[i]) != at:
                    best.meet(parts)
                    at, parts = (leaf[i], block[i]), []
                parts.append((asks[i:j], ids[i:j], values[i:j]))
                if sum(len(p[0]) for p in parts) > 4 * leaf_block:  # members come first; queries pass by them in turn
                    inner = np.concatenate([p[0] for p in parts])
                    best.meet(parts)
                    parts = [tuple(np.concatenate([p[c] for p in parts])[~inner] for c in range(3))]
            yield from best.full()
        best.meet(parts)
        yield best.rows()

    met = units.repartition("leaf", "block").sortWithinPartitions("leaf", "block", "asks").mapInArrow(rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


class _Best:
    """The k best rows of each query met so far."""

    def __init__(self, k: int, most: int = 1_000_000):
        self.k, self.most = k, most
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = 0

    def meet(self, parts: list[tuple]) -> None:
        if not parts:
            return
        asks, ids, x = (np.concatenate([p[c] for p in parts]) for c in range(3))
        x = x.astype(np.float64)
        q, m = np.flatnonzero(asks), self.few(ids, x, np.flatnonzero(~asks))
        for a in range(0, len(q) if len(m) else 0, 512):
            s = x[q[a : a + 512]] @ x[m].T
            s[ids[q[a : a + 512], None] == ids[m]] = -np.inf
            if len(m) > self.k:
                least = np.partition(s, -self.k, 1)[:, -self.k]
                least = least - 1e-9 * (1 + np.abs(least))  # products may differ in the last bits with their place
            else:
                least = np.full(len(s), -np.inf)
            i, j = np.nonzero((s >= least[:, None]) & (s > -np.inf))
            score = (x[q[a + i]] * x[m[j]]).cumsum(1)[:, -1]  # one after the other: the same for equal vectors
            self.found.append((ids[q[a + i]], ids[m[j]], score))
            self.n += len(i)
            if self.n > self.most:
                self.squeeze()

    def few(self, ids: np.ndarray, x: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Of equal vectors, the rows of the k + 1 smallest ids: no query can want another."""
        if len(m) <= self.k + 1:
            return m
        kind = np.unique(np.ascontiguousarray(x[m]).view(f"V{8 * x.shape[1]}").ravel(), return_inverse=True)[1].ravel()
        order = np.lexsort((ids[m], kind))
        first = np.flatnonzero(np.r_[True, np.diff(kind[order]) != 0])
        place = np.arange(len(m)) - np.repeat(first, np.diff(np.r_[first, len(m)]))
        return m[order[place <= self.k]]

    def squeeze(self) -> None:
        q, m, s = (np.concatenate(c) for c in zip(*self.found, strict=True))
        order = np.lexsort((m, -s, q))
        q, m, s = q[order], m[order], s[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (m[1:] != m[:-1]) | (s[1:] != s[:-1])
        q, m, s = q[new], m[new], s[new]
        first = np.flatnonzero(np.diff(q, prepend=q[:1] - 1))
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        keep = place < self.k
        self.found = [(q[keep], m[keep], s[keep])]
        self.n = int(keep.sum())

    def full(self) -> Iterator[pa.RecordBatch]:
        """Rows to hand on when the queries met fill the memory set apart."""
        if self.n > self.most // 2:
            self.squeeze()
            if self.n > self.most // 2:
                yield self.rows()
                self.found, self.n = [], 0

    def rows(self) -> pa.RecordBatch:
        if self.found:
            self.squeeze()
        columns = self.found[0] if self.found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])
