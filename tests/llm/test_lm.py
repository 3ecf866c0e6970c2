import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from leadlens.llm import lm
from leadlens.llm.common import coded_words, lower_words, table
from tests.conftest import SF_SMALL

DOCS = "doc_id bigint, text string, lang string, score int, HELD_OUT int"


def base(docs):
    """The contract's counts and base score."""
    tokens = {i: [*lower_words(t), lm.END] for i, (_, t) in enumerate(docs)}
    out = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs]
    seen = {}
    for i, ts in tokens.items():
        if not out[i]:
            for t in ts:
                seen[t] = seen.get(t, 0) + 1
    n, v = sum(seen.values()), len(seen)
    return sorted(((d, out[i], len(ts), sum(t in seen for t in ts), n, round(sum(math.log10((seen.get(t, 0) + 1) / (n + v + 1)) for t in ts), 6))
                   for (d, _), (i, ts) in zip(docs, tokens.items(), strict=True)), key=repr)


def run(spark, docs, **options):
    df = spark.createDataFrame([(d, t, "en" if i % 3 else None, 1, 2) for i, (d, t) in enumerate(docs)], DOCS)
    return lm.score_documents(df, **options).collect()


@pytest.fixture(scope="module")
def scored(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    return docs, lm.score_documents(table(spark, SF_SMALL, "documents"), frequent_words=2000, chunk_words=3000).collect()


def test_counts_and_base_match_brute_force(scored):
    docs, rows = scored
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=repr)
    assert got == base(docs)


def test_model_beats_chance_and_bits_agree(scored):
    docs, rows = scored
    size = {d: sum(map(len, lower_words(t))) + len(lower_words(t)) + 1 for d, t in docs}
    for r in rows:
        assert r.score < 0 and abs(r.bits_per_byte + r.score / math.log10(2) / size[r.doc_id]) < 1e-9
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > -math.log10(64) * sum(size[r.doc_id] for r in held) / 2  # under 3 bits a byte
    known = [r for r in rows if not r.held_out]
    assert sum(r.score for r in known) > sum(r.base_score for r in known)


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, " \n"), (None, "A b a"), (7, "Élan é x \x00\x01 z"), (8, "w" * 50_000), (9, "a " * 30_000), (7, "a"), (7, "a")]
    docs += [(i, "only held out") for i in range(20, 40) if lm.held_out(i)]
    rows = run(spark, docs)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=repr)
    assert got == base(docs) and all(r.score < 0 for r in rows)
    assert run(spark, []) == []
    only = [d for d in range(100) if lm.held_out(d)][:2]
    assert [(r.n_known, r.train_tokens, r.base_score) for r in run(spark, [(d, "x y") for d in only])] == [(0, 0, 0.0)] * 2


def test_rows_beyond_a_slice_without_nulls(spark):
    """Words are counted alike in every slice of an Arrow batch, also of one that has no null."""
    docs = [(i, f"Word{i} b c{i % 7} d") for i in range(1200)]
    df = spark.createDataFrame([(d, t, "en", 1, 2) for d, t in docs], DOCS).coalesce(1)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in lm.score_documents(df).collect()), key=repr)
    assert got == base(docs)
    words, codes, ends = coded_words(pa.array([t for _, t in docs]).slice(700, 3))
    assert [[words[c] for c in codes[a:b]] for a, b in zip([0, *ends], ends)] == [lower_words(t) for _, t in docs[700:703]]


def test_word_probabilities_sum_to_one_and_chunks_agree(spark):
    """Over all continuations of a prefix, bit probabilities multiply to a distribution; the
    counts of the whole prefix don't depend on where chunks end."""
    words = sorted({bytes([0]) + w + b" " for w in [b"a", b"ab", b"abc", b"b", b"ba", b"abd", b"zz"]})
    df = spark.createDataFrame([(bytearray(w), i + 1, 1) for i, w in enumerate(words)], "key binary, learnt bigint, times bigint")
    one = {bytes(r.key): r.score for r in lm.word_scores(df).collect()}
    cells = [lm.Chunk(b"".join(ws), np.array([len(w) for w in ws], "<u4").tobytes(), np.array([words.index(w) + 1.0 for w in ws]).tobytes()) for ws in (words, words[:3], words[3:])]
    ends = {}
    for c in cells[1:]:
        for k, z, o in c.ends():
            ends[k] = tuple(np.add(ends.get(k, (0, 0)), (z, o)))
    parts = np.concatenate([c.trie(ends) for c in cells[1:]])
    assert (cells[0].trie(None) == parts).all()
    assert sum(10**s for s in one.values()) <= 1 + 1e-9
    assert one[b"\x00zz "] > one[b"\x00a "] - 2


def test_correction_and_weights_learn():
    rng = np.random.default_rng(5)
    m = lm.Mixer()
    x = rng.normal(size=(4000, len(lm.ORDERS) + 2)).astype(np.float32)
    one = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 3]))).astype(np.float32)
    row, gate = np.full(4000, 17), np.full(4000, 2)
    loss = lambda: -np.log(np.clip(np.where(one == 1, p := m.probability(m.mixed(x, row), gate), 1 - p), 1e-9, 1)).mean()
    before = loss()
    for _ in range(60):
        m.learn(x, row, gate, one, np.ones(4000), 0.3)
    assert loss() < before - 0.1 and m.weights[17, 3] > 1
