import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.llm import follow, lm
from leadlens.llm.common import lower_words

WORDS = [b"the", b"of", b"dog", b"cat", b"runs", b"walks", b"home", b"green", b"\xc3\xa9t\xc3\xa9"]
KINDS, SCORES = np.array([0, 1, 0, 0]), np.array([-0.3, -0.2, -0.9, -2.5])  # of the first four; the others are rare
RARE_SCORES = {w: -3.0 - i for i, w in enumerate(WORDS[4:])}


def brute_force(docs):
    """Gain of each row, one token at a time."""
    word_id = {w: follow.FIRST + i for i, w in enumerate(WORDS[:4])} | {w: int(follow.rare_ids([w])[0]) for w in WORDS[4:]}
    lines = [[b"", b"", *lower_words(t)] for _, t in docs]
    learnt = [not lm.held_out(d) for d, _ in docs]
    seen = {}
    for line, known in zip(lines, learnt, strict=True):
        for a, b, w in zip(line, line[1:], line[2:], strict=False):
            seen.setdefault((a, b), Counter())[w] += known
    hits, met, coded = np.zeros(follow.CELLS), np.zeros(follow.CELLS), []
    for i, line in enumerate(lines):
        for a, b, w in zip(line, line[1:], line[2:], strict=False):
            counts = Counter(seen[a, b])
            counts[w] -= learnt[i]
            n = sum(counts.values())
            if n <= 0:
                continue
            best = min((x for x in counts if counts[x] > 0), key=lambda x: (-counts[x], word_id[x]))
            k, mine = (WORDS.index(x) if x in WORDS[:4] else None for x in (best, w))
            if k is not None and mine is not None and KINDS[k] != KINDS[mine]:
                continue
            chance = 0 if k is None else int(follow.chances(SCORES[[k]])[0])
            good, bad = (int(follow.level(np.array([x]))[0]) for x in (counts[best], n - counts[best]))
            cell = (good * follow.LEVELS + bad) * follow.CHANCES + chance
            coded.append((i, cell, best == w, w, k, mine))
            met[cell] += learnt[i]
            hits[cell] += learnt[i] and best == w
    p, out = follow.map_of(hits, met), [0.0] * len(docs)
    for i, cell, hit, w, k, mine in coded:
        if hit:
            out[i] += math.log10(p[cell]) - (RARE_SCORES[w] if mine is None else SCORES[mine])
        else:
            out[i] += math.log10(1 - p[cell]) - (0 if k is None or mine is None else math.log10(1 - 10 ** SCORES[k]))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_gains_match_brute_force(spark, monkeypatch, small):
    """Nulls, equal rows, repeats in a text, ties; however many tokens a group and a range hold."""
    if small:
        monkeypatch.setattr(follow, "GROUP", 60)
        monkeypatch.setattr(follow, "RANGE", 20)
    rng = np.random.default_rng(3)
    pick = lambda n: b" ".join(WORDS[i] for i in np.minimum(rng.geometric(0.3, n) - 1, 8)).decode()
    docs = [(i % 50, pick(rng.integers(0, 30))) for i in range(90)] + [(None, "the dog runs The DOG walks " * 40), (7, None), (8, "")]
    docs += docs[:9] + [(None, docs[3][1]), (200, "\n dog  walks home \t")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3).withColumn("id", F.xxhash64("doc_id", "text"))
    rare = spark.createDataFrame([(int(follow.rare_ids([w])[0]), s) for w, s in RARE_SCORES.items()], "word_id bigint, score double")
    got = {r.id: r.gain for r in follow.gains(df, 1500, lambda: (WORDS[:4], KINDS, SCORES), rare, lm.held_out).collect()}
    want = brute_force(docs)
    ids = {(r.doc_id, r.text): r.id for r in df.collect()}
    assert len(got) == len(ids) and max(map(abs, want)) > 1
    for doc, gain in zip(docs, want, strict=True):
        assert abs(got[ids[doc]] - gain) < 1e-9, doc


def test_pack():
    x = np.array([0, 5, 255, 256, 1 << 40])
    y = np.array([1, 2, 3, 4, (1 << 55) + 7])
    assert [c.tolist() for c in follow.unpack(follow.pack((x, 6), (y, 7)), 5, 6, 7)] == [x.tolist(), y.tolist()]


def test_word_order_counts(spark):
    """A text that goes on as others did is likelier than its own words in another order."""
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(60)]
    passages = [list(rng.choice(words, 40)) for _ in range(5)]
    docs = [(i, " ".join(passages[i % 5])) for i in range(60) if not lm.held_out(i)]
    out = [i for i in range(100, 200) if lm.held_out(i)][:2]
    other = list(rng.permutation(passages[2]))
    df = spark.createDataFrame([(d, t, "en") for d, t in [*docs, (out[0], " ".join(passages[2])), (out[1], " ".join(other))]], "doc_id bigint, text string, lang string")
    score = {r.doc_id: r.score for r in lm.score_documents(df).collect()}
    assert score[out[0]] > score[out[1]] + 20
