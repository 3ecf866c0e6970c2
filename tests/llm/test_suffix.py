import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from leadlens.llm import queries as Q
from leadlens.llm import suffix
from leadlens.llm.common import table
from tests.conftest import SF_SMALL

DOCS = "doc_id bigint, text string, N_BYTES int, class string"


def covered(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    for r in raws:
        mask = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                mask[i : i + length] = True
        yield r, mask


def brute_force(docs, length):
    out = []
    for (d, _), (r, mask) in zip(docs, covered([t for _, t in docs], length), strict=True):
        kept = bytes(np.frombuffer(r, np.uint8)[~mask])
        out.append((d, len(r), int(mask.sum()), int((np.diff(np.r_[0, mask.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, docs, length, **options):
    df = spark.createDataFrame([(d, t, 1, "c") for d, t in docs], DOCS)
    return sorted((tuple(r) for r in suffix.digest(df, length, **options).collect()), key=repr)


def corpus(rng):
    """Passages around the limit's length in changing surroundings, near copies, loops, copies."""
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(k) for k in (12, 14, 15, 16, 17, 18, 20, 60)]
    out = []
    for _ in range(90):
        t = text(rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            t += rng.choice(["", " ", "x"]) + rng.choice(passages) + rng.choice(["", "y", " "]) + text(rng.randint(0, 30))
        out.append(t)
    near = text(80)
    for _ in range(15):
        k = rng.randrange(len(near))
        out.append(near[:k] + "#" * rng.randint(0, 2) + near[k + 1 :])
    return [*out, "ab" * 200, "ba" * 150 + "c", "z" * 500, "z" * 70, out[0], out[5], out[5], "", None]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_corpus_matches_brute_force(spark, seed):
    docs = list(enumerate(corpus(random.Random(seed))))
    want = brute_force(docs, 70)
    assert run(spark, docs, 70) == want
    assert run(spark, docs, 70, shard_contexts=1, broadcast_rows=1) == want  # counted shards; joins by shuffle


def test_edges(spark):
    a = "".join(f"{i:05d}" for i in range(100))
    docs = [(1, a), (1, a[:499]), (None, a[100:] + "x"), (None, None), (3, ""), (4, a[:99]), (5, "q" * 3_000_000), (6, "Q"), (7, a), (7, a)]
    got = run(spark, docs, 100)
    small = [d for d in docs if d[0] != 5]
    assert [r for r in got if r[0] != 5] == brute_force(small, 100)
    assert [r for r in got if r[0] == 5] == [(5, 3_000_000, 3_000_000, 1, hashlib.sha256(b"").hexdigest())]
    assert run(spark, [], 100) == []


def test_suffix_array_and_segments():
    rng = np.random.default_rng(0)
    for n in [*range(30), 100, 1001]:
        for k in (1, 2, 200):
            s = rng.integers(1, k + 1, n)
            assert suffix.suffix_array(s).tolist() == sorted(range(n), key=lambda i, x=s.tolist(): x[i:])
    raw = rng.integers(97, 100, 70_000).astype(np.uint8).tobytes()
    whole, size = suffix.runs(raw, 64), suffix._SEGMENT
    try:
        suffix._SEGMENT = 1000
        parts = suffix.runs(raw, 64)
    finally:
        suffix._SEGMENT = size
    at = lambda r: np.repeat(r[0] + r[2], r[1]).tolist()  # noqa: E731  every window's anchor
    assert at(whole) == at(parts) and whole[1].sum() == len(raw) - 63


def test_remove_keeps_rows_and_columns(spark):
    a, b = "".join(f"{i:05d}" for i in range(100)), "é" * 30
    docs = [(1, "Start " + a + b), (2, a + b + " end"), (3, "clean"), (4, None)]
    df = spark.createDataFrame([(d, t, 1, "c") for d, t in docs], DOCS)
    out = suffix.remove(df, 100)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, "Start "), (2, " end"), (3, "clean"), (4, None)]


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    assert sorted((tuple(r) for r in Q.op3_suffix_array_dedup(spark, SF_SMALL).collect()), key=repr) == brute_force(docs, 400)


def test_remove_takes_any_column_names(spark):
    a = "".join(f"{i:05d}" for i in range(100))
    df = spark.createDataFrame([(1, "Start " + a, 1, 2, 3, "x"), (2, a + " end", 4, 5, 6, "y"), (None, None, 7, 8, 9, "z")],
                               "doc_id long, text string, _cuts int, _id int, `a.b` int, TEXT string")
    out = suffix.remove(df, 100)
    assert out.columns == df.columns
    assert sorted((tuple(r) for r in out.collect()), key=repr) == [(1, "Start ", 1, 2, 3, "x"), (2, " end", 4, 5, 6, "y"), (None, None, 7, 8, 9, "z")]


def test_runs_of_a_repeated_line_are_one_row_of_a_text(spark, monkeypatch):
    """A line that texts repeat many times meets others as one row a text, not one an occurrence."""
    rng = np.random.default_rng(5)
    line = bytes(rng.integers(97, 123, 90, np.uint8)).decode()
    docs = [(i, line * 40 + f" {i} " + bytes(rng.integers(97, 123, 60, np.uint8)).decode()) for i in range(12)]
    kept, write = {}, suffix.write_and_read
    monkeypatch.setattr(suffix, "write_and_read", lambda df, tag: kept.setdefault(tag, write(df, tag)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    _, spans = suffix.repeats(df, 64)
    got = {r.first_id: [(x.a, x.b) for x in r.spans] for r in spans.collect()}
    want = {}
    for (i, _), (_, mask) in zip(docs, covered([t for _, t in docs], 64), strict=True):
        firsts, lasts = suffix._spans(mask)
        want[i] = [(a, b + 1) for a, b in zip(firsts, lasts, strict=True)]
    assert got == {i: w for i, w in want.items() if w}
    met = kept["met-runs"]
    assert met.count() <= 12 * 8 and met.groupBy("class", "anchor", "ctx", "n", "off").count().where("count > 1").count() == 0
