import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.llm import quality
from leadlens.llm import queries as Q
from leadlens.llm.common import table
from tests.conftest import SF_SMALL

SF_LARGE = "/root/testdata/sf0.1"

DOCS = "doc_id bigint, text string, lang string, source string, p_quality int, P_TOXIC string"


def corpus(rng, n):
    """Junk is repeated or full of marks; toxic texts hold one of a few words, some rarely met."""
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(["alpha", "beta", "gamma", "delta"]) + rng.choice(["", "s", "ing"]) + str(rng.randrange(9)) * (rng.random() < 0.1) for _ in range(rng.choice([15, 60, 400]))]
        junk, toxic = rng.random() < 0.2, rng.random() < 0.2
        if junk:
            words = [words[0]] * 40 if rng.random() < 0.5 else [w + "%%%" for w in words]
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), "vileword" + rng.choice(["", "a", "o", "ish", "en"]))
        docs.append((i, " ".join(words), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", None]), 1, "x"))
        labels.append((i, int(not junk), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus(random.Random(7), 1500)
    d = spark.createDataFrame(docs, DOCS)
    known = spark.createDataFrame(labels[:700] + [(99999, 1, 1), (None, 0, 0), (3, None, None)], "doc_id bigint, quality int, toxic int")
    return d, labels, quality.fit(d, known)


def test_held_out_accuracy_and_exchange(fitted):
    d, labels, model = fitted
    truth = {i: (q, t) for i, q, t in labels[700:]}
    new = quality.added_names(d)
    assert new[0] == "_p_quality" and new[3] == "_p_toxic"
    rows = [r for r in quality.score(d, model).collect() if r.doc_id in truth]
    assert len(rows) == 800
    assert sum((r[new[0]] >= 0.5) == truth[r.doc_id][0] for r in rows) >= 0.97 * len(rows)
    assert sum((r[new[3]] >= 0.5) == truth[r.doc_id][1] for r in rows) >= 0.97 * len(rows)
    assert all(sum(p["pseudo"]) > 0 for p in model.parts.values())


def test_scoring_is_the_plain_sum_of_weights(fitted):
    d, _, model = fitted
    new = quality.added_names(d)
    for r in quality.score(d, model).limit(40).collect():
        words, codes, _ = quality.tokens([r.text])
        features = {f for w in words for f in quality.token_features(w)}
        form = model.meta(np.array(quality.layout(r.text, codes)), r.lang, r.source)
        for t, (both, own, other) in zip(("quality", "toxic"), (new[:3], new[3:]), strict=True):
            x, z = (sum(w.get(int(f), 0.0) for f in fs) + c for fs, (w, c) in ((features, model.weights(t, "text")), (form, model.weights(t, "meta"))))
            k = model.parts[t]["both"]
            for value, logit in ((r[own], x), (r[other], z), (r[both], np.clip(x, -20, 20) * k[0] + np.clip(z, -20, 20) * k[1] + k[2])):
                assert value == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, logit)))), abs=1e-9)


def test_edges(spark, fitted):
    _, _, model = fitted
    rows = [(1, None, None, None), (2, "", "en", "s1"), (None, "alpha " * 300_000, "xx", "unseen"), (2, "", "en", "s1"), (4, "\x00\x01 é 漢 %%%", "de", None)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    out = quality.score(d, model).collect()
    assert len(out) == 5 and all(0 <= r[c] <= 1 for r in out for c in quality.added_names(d))
    assert quality.score(d.limit(0), model).count() == 0
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.keep(d, none).count() == 5 and quality.keep(d.drop("lang", "source"), none).columns == ["doc_id", "text"]
    same = spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id bigint, quality int, toxic int")
    assert quality.keep(d, same).count() == 5
    assert quality.keep(d.limit(0), same).count() == 0


def test_query_on_labels_left_out(spark):
    """Fit on half of the labels; the other half, the classifier has never seen, tells."""
    labels = table(spark, SF_LARGE, "labels")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    out = quality.digest(table(spark, SF_LARGE, "documents"), labels.where(half)).join(labels.where(~half), "doc_id").collect()
    right = sum((r.p_quality >= 0.5) == r.quality for r in out) / len(out)
    assert right >= 0.99 and sum((r.p_toxic >= 0.5) == r.toxic for r in out) / len(out) >= 0.97
    rows = Q.op7_co_training(spark, SF_SMALL).collect()
    assert len(rows) == table(spark, SF_SMALL, "documents").count() and {"doc_id", "kept"} <= set(rows[0].asDict())


def test_pool_is_the_least_hashes_whatever_the_partitioning(spark):
    docs, labels = corpus(random.Random(11), 700)
    docs += [(None, *r[1:]) for r in docs[:20]] + [(650, "another text of one id", "en", "s1", 1, "x")]
    known = spark.createDataFrame(labels[:200], "doc_id bigint, quality int, toxic int")
    d = spark.createDataFrame(docs, DOCS)
    parts = [quality.fit(x, known, labelled=150, pool=100).parts for x in (d.repartition(3), d.orderBy(F.desc("doc_id")).coalesce(1))]
    for t in ("quality", "toxic"):
        one, two = (p[t] for p in parts)
        assert one["pseudo"] == two["pseudo"] and (one["both"] == two["both"]).all()
        assert all((x == y).all() if isinstance(x, np.ndarray) else x == y for v in ("text", "meta") for x, y in zip(one[v], two[v], strict=True))


@pytest.mark.parametrize("seed", range(8))
def test_calibration_reaches_the_minimum(seed):
    """Also where two views part the classes nearly always, and agree: the gradient is nil there."""
    rng = np.random.default_rng(seed)
    y = (rng.random(1500) < 0.85).astype(float)
    logits = np.column_stack([np.where(rng.random(1500) < 0.002, -1, 1) * (2 * y - 1) * rng.gamma(4, s, 1500) for s in (2.0, 3.5)])
    w = quality._platt(logits, y)
    x = np.column_stack([np.clip(logits, -20, 20), np.ones(len(y))])
    assert np.abs(x.T @ (1 / (1 + np.exp(-x @ w)) - y) + w - [0.5, 0.5, 0]).max() < 1e-4
    assert ((x @ w > 0) == (y > 0)).mean() > 0.99


def test_keep_takes_any_column_names(spark):
    rows = [(i, " ".join(["fine", "clear", "words"] if i % 2 else ["junk", "spam", "noise"]) + f" {i}", "en", "web", i, i) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, `a.b` int, p_quality int")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    out = quality.keep(docs, labels)
    assert out.columns == docs.columns
    kept = out.collect()
    assert kept and all(tuple(r) == rows[r.doc_id] for r in kept)
