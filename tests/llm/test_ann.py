import math

import numpy as np
import pytest

from leadlens.llm import ann
from leadlens.llm import queries as Q
from leadlens.llm.common import table
from tests.conftest import SF_MED, SF_SMALL

ROWS = "vec_id bigint, embedding array<double>, RANK int, leaf string, v int"


def brute_force(rows, asked, k):
    """Exact result for rows (id, vector), equal rows once."""
    width = {}
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    for _, v in good:
        width[len(v)] = width.get(len(v), 0) + 1
    size = max(width, key=lambda w: (width[w], w), default=0)
    good = [(i, v) for i, v in good if len(v) == size]
    out = []
    for q, a in good:
        if asked(q):
            best = sorted(((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in good if i != q))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def run(spark, rows, condition="vec_id % 3 = 0", **options):
    df = spark.createDataFrame([(i, v, 1, "l", 2) for i, v in rows], ROWS)
    return sorted(tuple(r) for r in ann.search(df, condition, **options).collect())


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (6, [-1.0, 1.0]), (7, None), (8, []), (9, [0.0, 0.0]), (10, [1.0, None]),
            (12, [nan, 1.0]), (15, [inf, 1.0]), (18, [1.0]), (None, [1.0, 1.0]), (21, [3.0, 3.0]), (21, [3.0, 3.0]), (24, [1e100, 1.0])]
    for k in (1, 3, 50):
        assert run(spark, rows, k=k) == brute_force(rows, lambda q: q % 3 == 0, k)
    assert run(spark, []) == [] and run(spark, [(1, None), (2, [0.0])]) == [] and run(spark, [(3, [1.0])]) == []


def test_hot_equal_vectors_in_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(-4, 5, 6) if i % 3 == 1 else np.array([1, 2, 3, 0, 0, 1])).astype(float).tolist()) for i in range(900)]
    want = brute_force(rows, lambda q: q % 90 == 0, 20)
    assert run(spark, rows, "vec_id % 90 = 0", leaf_block=64) == want  # one leaf, blocks: exact
    assert run(spark, rows, "vec_id % 90 = 0", leaf_rows=100, visits=10**9, leaf_block=32) == want  # all leaves of all trees


def test_recall_and_scores_with_many_leaves(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 24)) * 3
    rows = [(i, (centres[i % 40] * (1 + i % 3) + rng.normal(size=24)).tolist()) for i in range(4000)]
    want = brute_force([r for r in rows], lambda q: q % 100 == 0, 20)
    got = run(spark, rows, "vec_id % 100 = 0", leaf_rows=64, visit_share=0.5)
    exact = {(q, i): s for q, _, i, s in want}
    assert len(got) == len(want) and all(exact.get((q, i), s) == pytest.approx(s) for q, _, i, s in got)
    assert len({(q, i) for q, _, i, _ in got} & exact.keys()) >= 0.9 * len(want)


def test_query_is_exact_on_a_small_table_and_recalls_on_a_larger(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in table(spark, SF_SMALL, "embeddings").collect()]
    got = sorted(tuple(r) for r in Q.op2_projection_forest(spark, SF_SMALL).collect())
    want = brute_force(rows, lambda q: q % 20 == 0, 20)
    assert [r[:3] for r in got] == [r[:3] for r in want] and np.allclose([r[3] for r in got], [r[3] for r in want], atol=1e-12)
    df = table(spark, SF_MED, "embeddings")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    got = {(r.query_id, r.vec_id) for r in ann.search(df, "vec_id % 20 = 0", leaf_rows=16).collect()}
    want = {(q, i) for q, _, i, _ in brute_force(rows, lambda q: q % 20 == 0, 20)}
    assert len(got & want) >= 0.9 * len(want)
