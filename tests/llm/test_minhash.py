import random

import numpy as np

from leadlens.llm import minhash, suffix
from leadlens.llm.common import lower_words
from leadlens.llm.graph import components

DOCS = "doc_id bigint, text string, N_SHINGLES int, class string"


def brute_force(docs, percent=75):
    sets = []
    for _, t in docs:
        w = lower_words(t)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x in range(len(docs)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if sets[x] and sets[y] and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                up[root(x)] = root(y)
    least = {}
    for x, (d, _) in enumerate(docs):
        if d is not None:
            least[root(x)] = min(d, least.get(root(x), d))
    return sorted(((d, len(sets[x]), least.get(root(x)), d == least.get(root(x))) for x, (d, _) in enumerate(docs)), key=repr)


def run(spark, docs, **options):
    df = spark.createDataFrame([(d, t, 1, "c") for d, t in docs], DOCS)
    return sorted((tuple(r) for r in minhash.link(df, **options).collect()), key=repr)


def family(rng, size, words, changes):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(size - 1):
        t = list(base)
        for _ in range(rng.randint(0, changes)):
            t[rng.randrange(words)] = f"x{rng.randrange(10**9)}"
        out.append(" ".join(t))
    return out


def test_families_at_all_distances_match_brute_force(spark):
    rng = random.Random(8)
    texts = [t for k in range(12) for t in family(rng, rng.randint(2, 25), rng.choice([8, 40, 200]), rng.choice([1, 4, 8, 14]))]
    shared = " ".join(f"p{i}" for i in range(60))  # a passage that many unlike texts hold
    texts += [shared + " " + " ".join(f"u{i}_{j}" for j in range(30)) for i in range(80)]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    want = brute_force(docs)
    assert run(spark, docs) == want
    assert run(spark, docs, block=8, broadcast_rows=1) == want  # hot groups dealt in blocks; joins by shuffle


def test_edges(spark):
    docs = [(5, None), (4, ""), (3, " \n\t"), (10, "One two"), (2, "one\ttwo"), (11, "two one"), (7, "a b c d e"), (6, "A b  c d e"), (8, "a b c d"),
            (20, "É é x y z"), (21, "é é x y z"), (None, "a b c d e"), (None, "alone in here"), (30, "r s t u v w"), (30, "r s t u v w"),
            (40, "k " * 100_000), (41, "k k k k k"), (42, "k k k k"), (50, "a b c d e")]
    assert run(spark, docs) == [(*r[:3], r[0] == r[2]) for r in brute_force(docs)]
    assert run(spark, []) == []


def test_chance_of_missing_a_link_and_estimate():
    rng = np.random.default_rng(3)
    for both, own in [(300, 50), (60, 10)]:  # Jaccard 0.75
        for _ in range(60):
            v = np.unique(rng.integers(0, 2**63, both + 2 * own).astype(np.uint64))
            a, b = minhash.signature(v[: both + own]), minhash.signature(np.concatenate([v[:both], v[both + own :]]))
            same = a == b
            assert same.mean() >= 0.6 and same.reshape(-1, minhash.ROWS).all(1).any()


def test_components_match_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1200)] + [(7, 7), (5000, 5000)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in up}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_deduplicate_keeps_columns(spark):
    docs = [(1, "same words in this text"), (2, "Same words in this text"), (3, "other"), (4, None), (5, "")]
    df = spark.createDataFrame([(d, t, 1, "c") for d, t in docs], DOCS)
    out = minhash.deduplicate(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 3, 4, 5]


def test_deduplicate_keeps_one_of_repeated_rows_and_of_null_ids(spark):
    """The pipeline's second and third stage: a text that stands twice stays once, whole."""
    long = [" ".join(f"{c}{i}" for i in range(120)) for c in "abcdef"]
    near = long[3].replace("d60", "other")
    rows = [(1, long[0]), (1, long[0]), (1, long[0]), (2, long[1]), (None, long[2]), (None, long[2]), (None, long[3]), (None, near), (5, long[4]),
            (None, long[4]), (7, long[5]), (7, long[0]), (8, ""), (8, ""), (9, None), (9, None), (None, "")]
    docs = spark.createDataFrame([(d, t, i, "c") for i, (d, t) in enumerate(rows)], DOCS)
    want = sorted([(1, long[0]), (2, long[1]), (None, long[2]), (5, long[4]), (7, long[5]), (8, ""), (9, None), (None, "")], key=repr)
    out = [[tuple(r) for r in suffix.remove(minhash.deduplicate(docs.repartition(n), **o), 250).collect()] for n, o in ((1, {}), (5, {}), (3, {"broadcast_rows": 1}))]
    for got in out:
        texts = sorted(((d, t) for d, t, *_ in got), key=repr)
        assert [x for x in texts if not str(x[1]).startswith("d")] == want
        assert [x in ((None, long[3]), (None, near)) for x in texts if str(x[1]).startswith("d")] == [True]
        assert sorted(got, key=repr) == sorted(out[0], key=repr)  # the same rows from any partitioning


def test_deduplicate_takes_any_column_names(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, 1, 2, "x"), (2, text + " more", 3, 4, "y"), (3, "other words stand in here", 5, 6, "z"), (3, "other words stand in here", 5, 6, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id int, `a.b` int, TEXT string")
    out = minhash.deduplicate(df)
    assert out.columns == df.columns and sorted(tuple(r) for r in out.collect()) == [rows[0], rows[2]]
