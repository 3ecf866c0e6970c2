import re
import zlib
from collections import Counter

import numpy as np
import pytest

from leadlens.llm import queries as Q
from leadlens.llm import variants
from leadlens.llm.common import table
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck


def counts(docs, least_chars=6, least_count=5, slip=199):
    seen = Counter()
    for d, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % slip == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= least_chars:
                seen[w] += 1
    return {w: n for w, n in seen.items() if n >= least_count}


def deletions(w):
    return {w[:i] + w[i + 1:] for i in range(len(w))}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return a in deletions(b) or b in deletions(a)


def brute_force(words, times=5):
    """Rows from all pairs."""
    by, out = {}, {}
    for w in words:
        found = [x for x in words if near(w, x)]
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= times * words[w] else None
        by[w], out[w] = form, (w, form, words[w], len(found), words.get(form))
    def root(w):
        return w if by[w] is None else root(by[w])
    return [(w, f, root(w), n, k, m) for w, f, n, k, m in out.values()]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def group(spark, words, **kw):
    df = variants.write_and_read(spark.createDataFrame(list(words.items()), "word string, n long"), "t")
    return rows(variants.group_variants(df, **kw))


def by_word(found):
    return sorted(found, key=lambda r: r[0])


def random_words(seed, count, letters="abé", least=6, most=9):
    rng = np.random.default_rng(seed)
    return {"".join(rng.choice(list(letters), rng.integers(least, most + 1))): int(5 * 1.6 ** rng.integers(0, 14)) for _ in range(count)}


@pytest.mark.parametrize("seed", [0, 1])
def test_all_pairs(spark, seed):
    """Dense vocabulary: many near words, ties of n, chains of forms."""
    words = random_words(seed, 500)
    assert group(spark, words) == by_word(brute_force(words))


def test_blocks_of_a_hot_bucket(spark, monkeypatch):
    """A bucket of many blocks, and tiles that go over several batches of rows, give the same."""
    words = random_words(2, 700, "ab", 10, 12)
    want = by_word(brute_force(words))
    monkeypatch.setattr(variants, "BLOCK_WORDS", 20)
    monkeypatch.setattr(variants, "PAIRS", 97)
    assert group(spark, words) == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert group(spark, words) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_one_edit_shapes(spark):
    words = {"colour": 5, "colours": 25, "color": 900, "olours": 5, "coloursx": 125, "xcoloursx": 625, "aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 5,
             "abcabc": 7, "abcabd": 7, "abcdbc": 7, "bcabcc": 7, "élèves": 30, "eleves": 6, "élevés": 6, "éleves": 6, "q" * 5000: 10, "q" * 5001: 50}
    words.pop("color")
    got = group(spark, words)
    assert got == by_word(brute_force(words))
    assert {r[0]: r[2] for r in got}["olours"] == "xcoloursx"


def test_counts(spark):
    texts = [(i, "Straße strasse Größe GRÖSSE größer " * 3 + "x" * i) for i in range(400)]
    texts += [(None, "nulling nulling"), (None, None), (3, ""), (4, "!!"), (5, "a" * 100_000), (6, "word " * 50_000), (6, "Äpfeln×÷äpfeln " * 9), (6, "Äpfeln×÷äpfeln " * 9)]
    df = spark.createDataFrame([(d, t, 1, "w") for d, t in texts], "doc_id bigint, text string, ID int, word string")
    got = {r.word: r.n for r in variants.word_counts(df).collect()}
    assert got == counts(texts) and any(len(w) == 6 and "größer"[:5] in w for w in got)
    named = df.withColumnsRenamed({"doc_id": "my.id", "text": "the.text"})
    assert {r.word: r.n for r in variants.word_counts(named, 4, 2, 7, "my.id", "the.text").collect()} == counts(texts, 4, 2, 7)


def test_counts_in_small_portions(spark, monkeypatch):
    monkeypatch.setattr(variants, "HELD", 10)
    docs = table(spark, SF_SMALL, "documents")
    got = {r.word: r.n for r in variants.word_counts(docs.repartition(3)).collect()}
    assert got == counts([(r.doc_id, r.text) for r in docs.collect()])


def test_joins_are_shuffled(spark):
    """However few bytes their files take: neither the roots, sixteen times exploded, nor the buckets
    go through the driver."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    words = variants.write_and_read(spark.createDataFrame(list(random_words(3, 300).items()), "word string, n long"), "t")
    assert "BroadcastHashJoin LeftSemi" not in (tiles := plan(variants._tiles(words, 6))) and "SortMergeJoin" in tiles
    steps, write = [], variants.write_and_read

    def kept(df, tag):
        steps.append((tag, plan(df)))
        return write(df, tag)

    variants.write_and_read = kept
    try:
        out = variants.group_variants(words)
    finally:
        variants.write_and_read = write
    roots = [p for tag, p in steps if tag == "variant-roots" and "Join" in p]
    assert roots and all("BroadcastHashJoin" not in p and "SortMergeJoin" in p for p in [*roots, plan(out)])


def test_empty(spark):
    assert rows(variants.digest(spark.createDataFrame([], "doc_id bigint, text string"))) == []
    assert group(spark, {"lonely": 9}) == [("lonely", None, "lonely", 9, 0, None)]


def test_query_matches_sql(spark):
    r = compare(spark, "op11", Q.op11_spelling_variants, Q.OP11_SQL, SF_SMALL, duck(SF_SMALL), verbose=True)
    assert r["ok"], r
