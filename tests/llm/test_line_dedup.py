import hashlib
from collections import defaultdict

import pytest

from leadlens.llm import line_dedup
from leadlens.llm import queries as Q
from leadlens.llm.common import table
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

SPACE = " \t\n\x0b\f\r"
LOW = str.maketrans(line_dedup.UPPER, line_dedup.LOWER)


def brute_force(docs, min_chars=40, min_docs=5, keep="largest"):
    """Rows (doc_id, n_lines, n_dropped, kept text) by dictionaries."""
    holders = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            holders[line.strip(SPACE).translate(LOW)].add(d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            k = line.strip(SPACE).translate(LOW)
            ids = [i for i in holders[k] if i is not None]
            first = (max(ids) if keep == "largest" else min(ids)) if ids else None
            if not (len(k) >= min_chars and len(holders[k]) >= min_docs and d != first):
                kept.append(line)
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def run(spark, docs):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id bigint, text string, `a.b` string, KEEP_RUNS int")
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.digest(df).collect())


def expected(docs):
    return sorted((d is None, d or 0, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute_force(docs))


LONG = "A line of more than forty code points, É included"
EDGES = [(1, LONG), (2, f"  {LONG.upper().replace('É', 'É')}\t\nother"), (3, f"{LONG}\n{LONG}\n"), (4, f"x\n{LONG}\r\ny"), (5, f"{LONG}\n{LONG}\nend"),
         (5, f"{LONG}\nanother text of the same id"), (None, LONG), (None, None), (6, ""), (7, None), (8, "\n\n"),
         *[(i, "shared but short\n" + "y" * 39) for i in range(10, 20)], *[(i, "z" * 40) for i in range(20, 24)], (24, "z" * 40), (24, "z" * 40),
         (30, "w" * 40 + "\n" + "w" * 41), (40, " " + "é" * 39), *[(50, f"{i} " + "v" * 40) for i in range(8)]]


def test_edges(spark):
    assert run(spark, EDGES) == expected(EDGES)


def test_hot_lines_and_repeated_rows(spark):
    """One line holds most rows, one document is repeated, one has very many lines of one key."""
    docs = [(i, f"{LONG}\nown line of document {i} that nobody else has at all") for i in range(3000)]
    docs += [(7, docs[7][1])] * 400 + [(9000, "\n".join([LONG] * 20_000))] + [(None, LONG)] * 50
    lines = line_dedup.write_and_read(spark.createDataFrame([(i, 0, 0, 0, i % 3 and 5, 5) for i in range(3000)], "doc_id long, a long, b long, pos int, h long, g long"), "t")
    assert [tuple(r) for r in line_dedup._hot(lines, 3000).where("h = 5").collect()] == [(5, 5)]
    assert run(spark, docs) == expected(docs)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_bitmaps_and_drop_lines(spark, keep):
    """Runs rebuild the text; other columns, also of clashing and dotted names, pass through."""
    docs = [(d, t) for d, t in EDGES]
    df = spark.createDataFrame([(d, t, i, "q") for i, (d, t) in enumerate(docs)], "`my.id` bigint, `the.text` string, _a int, n_dropped string")
    bits = line_dedup.keep_bitmaps(df, 20, 3, keep, "my.id", "the.text")
    assert bits.columns == ["doc_id", "a", "b", "n_lines", "n_dropped", "keep_runs"]
    assert bits.count() == len({(d, t or "") for d, t in docs})
    for r in bits.collect():
        assert sum(x.length for x in r.keep_runs) == r.n_lines - r.n_dropped
        assert all(x.start + x.length < y.start for x, y in zip(r.keep_runs, r.keep_runs[1:]))
    out = line_dedup.drop_lines(df, bits, "my.id", "the.text")
    assert out.columns == df.columns
    got = {r["_a"]: (r["my.id"], r["the.text"], r["n_dropped"]) for r in out.collect()}
    want = brute_force(docs, 20, 3, keep)
    assert got == {i: (d, None if docs[i][1] is None else t, "q") for i, (d, _, _, t) in enumerate(want)}


def test_empty_table_and_partitions(spark):
    assert run(spark, []) == []
    docs = table(spark, SF_SMALL, "documents")
    a = line_dedup.digest(docs.repartition(13)).collect()
    assert sorted(a) == sorted(line_dedup.digest(docs.coalesce(1)).collect())
    with pytest.raises(ValueError):
        line_dedup.keep_bitmaps(docs, keep="any")


def test_native_plan_without_a_shuffle_of_windows(spark):
    """No Python in the plan; windows use the range partitions, hot keys never meet in one."""
    plan = line_dedup.digest(table(spark, SF_SMALL, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    below = plan.split("Window [dense_rank")[1].split("rangepartitioning(h#")[0]
    assert plan.count("rangepartitioning(h#") == 1 and "hashpartitioning" not in below and below.count("Sort [") == 1


def test_query_matches_sql(spark):
    r = compare(spark, "op13", Q.op13_line_dedup, Q.OP13_SQL, SF_SMALL, duck(SF_SMALL), verbose=True)
    assert r["ok"], r
