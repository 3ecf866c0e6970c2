"""Leaps and bounds against full enumeration."""

import itertools

import numpy as np
import pytest

from leadlens.operators import leaps, select


def _table(spark, n=300, p=10, seed=2, extra=()):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p))
    x[:, 1] += 0.9 * x[:, 0]
    x[:, 4] -= 0.8 * x[:, 2]
    y = x[:, :4] @ np.array([1.0, -0.7, 0.5, 0.2]) + 0.3 * x[:, 7] + rng.normal(size=n)
    cols = [x, *[f(x)[:, None] for f in extra]]
    x = np.hstack(cols)
    names = [f"x{i}" for i in range(x.shape[1])]
    rows = [(*map(float, r), float(v), i % 5) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names) + ", y double, fold int"), x, y, names


def _rss(x, y, cols):
    a = np.column_stack([np.ones(len(x)), x[:, cols]])
    r = y - a @ np.linalg.lstsq(a, y, rcond=None)[0]
    return float(r @ r)


def test_every_size_equals_full_enumeration_on_twelve_columns(spark):
    df, x, y, names = _table(spark, p=12)
    mom = select.fold_moments(df, names, "y")
    got = {r.k: r for r in leaps.best_subsets(spark, mom).collect()}
    assert sorted(got) == list(range(1, 13))
    for k in range(1, 13):
        least = min(_rss(x, y, list(c)) for c in itertools.combinations(range(12), k))
        assert got[k].rss == pytest.approx(least, rel=1e-8)
        assert _rss(x, y, [names.index(f) for f in got[k].features]) == pytest.approx(least, rel=1e-8)
        assert got[k].avg_mse == pytest.approx(float(np.mean(select.cv_scores(mom, [names.index(f) for f in got[k].features]))))
    assert [k for k in got if got[k].is_best] == [min(got, key=lambda k: got[k].avg_mse)]


def test_small_rounds_hand_open_nodes_on(spark, monkeypatch):
    df, x, y, names = _table(spark, p=11, seed=5)
    mom = select.fold_moments(df, names, "y")
    want = [(r.k, r.features) for r in leaps.best_subsets(spark, mom).collect()]
    monkeypatch.setattr(leaps, "FIRST", 3)
    monkeypatch.setattr(leaps, "STEPS", 8)
    assert [(r.k, r.features) for r in leaps.best_subsets(spark, mom).collect()] == want
    with pytest.raises(RuntimeError):
        leaps.best_subsets(spark, mom, max_rounds=1)


def test_combined_and_constant_columns_are_left_out(spark):
    df, x, y, names = _table(spark, p=8, extra=(lambda x: x[:, 0] + x[:, 2], lambda x: np.full(len(x), 3.0)))
    got = leaps.best_subsets(spark, select.fold_moments(df, names, "y")).collect()
    assert len(got) == 8 and {f for r in got for f in r.features} == set(names[:8])


def test_monotone_bounds_under_random_problems():
    rng = np.random.default_rng(0)
    for _ in range(30):
        p = int(rng.integers(2, 9))
        x = rng.normal(size=(40, p)) @ rng.normal(size=(p, p))
        y = rng.normal(size=40)
        xc, yc = x - x.mean(0), y - y.mean()
        s = np.sqrt((xc ** 2).sum(0))
        tree = leaps.Tree((xc.T @ xc) / np.outer(s, s), xc.T @ yc / s, float(yc @ yc))
        best, subsets = np.full(p + 1, np.inf), [None] * (p + 1)
        best[0] = tree.yy
        assert tree.walk(([], list(range(p))), best, subsets, 10_000) == []
        for k in range(1, p + 1):
            least = min(_rss(x, y, list(c)) for c in itertools.combinations(range(p), k))
            assert best[k] == pytest.approx(least, rel=1e-6)
