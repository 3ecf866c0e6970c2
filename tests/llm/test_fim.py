import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leadlens.llm import fim
from leadlens.llm import queries as Q
from leadlens.llm.common import table
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck


def brute_force(d, t, seed=7, fim_percent=100, spm_percent=50):
    t = t or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", t)
    n = len(lines)
    s = hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()
    h = [int(s[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_percent:
        return d, n, "plain", None, None, t
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, x = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm_percent:
        return d, n, "spm", len(p), len(m), f"<S>{x}<P>{p}<M>{m}"
    return d, n, "psm", len(p), len(m), f"<P>{p}<S>{x}<M>{m}"


def texts(seed, count):
    rng = np.random.default_rng(seed)
    pool = ["word", "é", "日本", "\n", "\n\n", "<P", "<", "S>", "\r\n", " ", " ", "😀", "x" * 300, "\n" * 40]
    return ["".join(rng.choice(pool, rng.integers(0, 400))) for _ in range(count)]


EDGES = [(1, None), (2, ""), (3, "\n"), (4, "one line"), (5, "a\nb"), (6, "a\nb\n"), (7, "has <M> inside\n"), (8, "<P"), (9, ">"),
         (None, "null id\nx"), (-4, "minus\n\n\ntext"), (10, "z" * 255 + "<P>" + "z" * 300), (11, "y" * 200_000 + "\nend"), (11, "again\nthe same id"),
         (12, "line\n" * 60_000), (12, "line\n" * 60_000), *[(100 + i, "u" * (250 + i) + "<S>" + "u" * 600) for i in range(12)],
         *[(200 + i, t) for i, t in enumerate(texts(3, 60))]]


def test_edges(spark):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in EDGES], "doc_id bigint, text string, OUTPUT int, `a.b` string")
    got = [tuple(r) for r in fim.transform(df).collect()]
    assert sorted(got, key=repr) == sorted((brute_force(d, t) for d, t in EDGES), key=repr)
    back = fim.transform(df).select("doc_id", fim.restored(fim.F.col("output"), fim.F.col("form")).alias("t")).collect()
    assert sorted(map(repr, [tuple(r) for r in back])) == sorted(repr((d, t or "")) for d, t in EDGES)


def test_parameters_and_names(spark):
    docs = [(str(i), t) for i, t in enumerate(texts(5, 80))]
    df = spark.createDataFrame(docs, "`my.id` string, `the.text` string")
    got = [tuple(r) for r in fim.transform(df, 3, 60, 20, "my.id", "the.text").collect()]
    want = [brute_force(d, t, 3, 60, 20) for d, t in docs]
    assert sorted(got, key=repr) == sorted(want, key=repr) and {"plain", "psm", "spm"} <= {r[2] for r in got}


def test_empty_table(spark):
    assert fim.digest(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="a\n<PSM>é😀", max_size=2000), max_size=4), st.integers(2, 60))
def test_chunks_and_cuts(parts, repeat):
    """Whatever the chunks, counts and cuts are those of the whole text, with an old memo too."""
    memo = fim.Memo(2000)
    for p in parts:
        t = (p * repeat).encode()
        ends = fim.chunk_ends(fim.breaks(np.frombuffer(t, np.uint8)).tolist(), 0, len(t))
        assert ends == sorted(set(ends)) and (ends[-1:] or [0]) == [len(t)]
        assert all(y - x <= fim.MOST for x, y in zip([0, *ends], ends))
        text, lines = fim.Text(t, ends, memo), re.findall(r"[^\n]*\n|[^\n]+", p * repeat)
        assert text.n == len(lines) and text.marked == any(s in t for s in fim.SENTINELS)
        for k in {0, 1, len(lines) // 2, len(lines) - 1, len(lines)} - {-1}:
            if k <= len(lines):
                head = "".join(lines[:k])
                assert text.cut(k) == (len(head.encode()), len(head))


def test_breaks_follow_content(monkeypatch):
    """A passage is cut alike wherever it stands, in slabs of any size; its chunks come from the memo."""
    rng = np.random.default_rng(1)
    shared, other = (bytes(rng.integers(97, 123, n, dtype=np.uint8)) for n in (60_000, 777))
    memo, cut = fim.Memo(), {}
    for lead in (b"", other, other * 3):
        data = lead + shared
        ends = fim.chunk_ends(fim.breaks(np.frombuffer(data, np.uint8)).tolist(), 0, len(data))
        cut[len(lead)] = {e - len(lead) for e in ends if e > len(lead) + 20_000}
        fim.Text(data, ends, memo)
    assert len(set(map(frozenset, cut.values()))) == 1 and memo.hits > 30
    whole = fim.breaks(np.frombuffer(shared, np.uint8))
    monkeypatch.setattr(fim, "SLAB", 1000)
    assert (fim.breaks(np.frombuffer(shared, np.uint8)) == whole).all()


@pytest.mark.parametrize("parts", [1, 7])
def test_partitions(spark, parts):
    docs = table(spark, SF_SMALL, "documents")
    assert sorted(fim.digest(docs.repartition(parts)).collect()) == sorted(fim.digest(docs).collect())


def test_query_matches_sql(spark):
    r = compare(spark, "op12", Q.op12_fill_in_middle, Q.OP12_SQL, SF_SMALL, duck(SF_SMALL), verbose=True)
    assert r["ok"], r
