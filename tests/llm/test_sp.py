import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from leadlens.llm import queries as Q
from leadlens.llm import sp
from leadlens.llm.common import slices, table
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  two  spaces ", "Tab\tnew\nline\r\n\x00", "Élan über ñandú 漢字 カナ 🙂🙂 ✓", "x" * 500, "12345 6.7e8", "a_b __init__ '\"!?!?", "▁literal ▁ mark▁", "é combining",
       "don't (stop) [it]{now}; <s>text</s> <0x41>"]


@pytest.fixture(scope="module")
def pieces():
    return sp.Pieces(PATH)


def brute_force(text, pieces):
    """Viterbi over the same units, position by position; ids with bytes for fallbacks."""
    out = []
    for u in sp.units(text):
        best = [(0.0, [])]
        for end in range(1, len(u) + 1):
            options = [(best[end - 1][0] + sp.FALLBACK, end - 1, -1)]
            for start in range(max(0, end - pieces.longest), end):
                if (i := pieces.piece.get(u[start:end])) is not None:
                    options.append((best[start][0] + pieces.cost[i], start, i))
            cost, start, i = min(options, key=lambda o: (o[0], o[1]))
            best.append((cost, best[start][1] + ([i] if i >= 0 else [pieces.byte[c] for c in u[end - 1].encode()])))
        out += best[-1][1]
    return out


def run(spark, texts, **options):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, IDS int, _rare string")
    out = sp.encode(df, PATH, **options)
    assert out.columns == ["doc_id", "text", "_rare", "ids"]
    back = sp.decode(out, PATH, text="back")
    return {r.doc_id: (r.ids, r.back) for r in back.collect()}


@pytest.mark.parametrize("room", [6_000_000, 20, 0])
def test_encoding_matches_viterbi_and_decodes(spark, pieces, room):
    rng = random.Random(6)
    texts = ODD + [" ".join("".join(rng.choice(["th", "e", "ing", "ö", "Ab", "z", "."]) for _ in range(rng.randint(1, 6))) for _ in range(30)) for _ in range(20)]
    texts += [texts[-1], texts[-1]]
    got = run(spark, texts, shared_units=room)  # all units shared; some; none
    for i, t in enumerate(texts):
        assert got[i] == (brute_force(t, pieces), t or "")


def test_costs_are_log_probabilities_and_units_part_the_text(pieces):
    assert math.isclose(sum(math.exp(-c) for c in pieces.cost.values()), 1)
    for t in ODD:
        assert "".join(sp.units(t)) == (" " + t if t else "") and all(len(u) <= sp.MOST + 1 for u in sp.units(t))


def test_empty_table_very_long_text_and_bad_bytes(spark):
    assert run(spark, []) == {}
    long = "word and 漢 " * 100_000
    assert run(spark, [long])[0][1] == long
    df = spark.createDataFrame([(1, [3 + 0xFF, 3 + 0x41]), (2, None), (3, [])], "doc_id bigint, ids array<int>")
    assert [r.text for r in sp.decode(df, PATH).orderBy("doc_id").collect()] == ["�A", None, ""]


def test_query_matches_brute_force(spark, pieces):
    docs = {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").limit(25).collect()}
    got = {r.doc_id: tuple(r)[1:] for r in Q.op6_sentencepiece(spark, SF_SMALL).collect()}
    for d, t in docs.items():
        ids = brute_force(t, pieces)
        assert got[d] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), hashlib.sha256(t.encode()).hexdigest(), True)
    assert len(got) == table(spark, SF_SMALL, "documents").count() and all(x[3] for x in got.values())


def over_whole_text(text, pieces):
    """The cost of the cheapest path over the whole text, cut nowhere, and the decoded ids' cost."""
    t, best = " " + text, [0.0]
    for end in range(1, len(t) + 1):
        options = [best[end - 1] + sp.FALLBACK]
        options += [best[start] + pieces.cost[i] for start in range(max(0, end - pieces.longest), end) if (i := pieces.piece.get(t[start:end])) is not None]
        best.append(min(options))
    return best[-1]


CROSSING = ["a  b", "x" + " " * 40 + "y  ", "   ", "def __init__(self, _x):\n        self.__y = a_b_{1}  # ____", "=" * 3000 + " a", "漢字" * 1200 + "。" + "word" * 700, "a².b ². x²", "$_{i}$ _ "]


def test_paths_are_the_cheapest_over_the_whole_text(spark, pieces):
    """Runs of spaces, marks with underscores and long runs are no place to cut."""
    fallback = set(pieces.byte)
    got = run(spark, CROSSING)
    for i, t in enumerate(CROSSING):
        raw = [x for x in got[i][0] if x in fallback]
        missing = sum(1 for c in bytes(pieces.raw[x][0] for x in raw).decode() if c)
        cost = sum(pieces.cost[x] for x in got[i][0] if x not in fallback) + sp.FALLBACK * missing
        assert got[i][1] == t and math.isclose(cost, over_whole_text(t, pieces))
    assert sum(len(x) > sp.MOST for t in CROSSING for x in sp.units(t, pieces)) >= 2


def test_no_piece_joins_two_units(pieces):
    assert all(len(pieces.cut(p)) == 1 for p in pieces.piece) and pieces.glue.pattern
    assert sp.segments(pa.array(["a  b c  ", None, "", "  ", "x"])) == (["a", " b", "c", " ", "  ", "x"], *(pytest.approx(x) for x in ([0, 1, 2, 3, 4, 5], [4, 4, 4, 5, 6])))


def test_with_check_takes_any_column_names(spark):
    df = spark.createDataFrame([(1, "two words", 3, 4, "x"), (2, None, 5, 6, "y")], "doc_id long, text string, `a.b` int, same int, TEXT string")
    out = sp.with_check(df, PATH)
    assert out.columns == ["doc_id", "a.b", "TEXT", "ids", "n_pieces", "same"]
    assert sorted((r[0], r[1], r[2], r[5]) for r in out.collect()) == [(1, 3, "x", True), (2, 5, "y", True)]


def test_lattices_are_folded_without_grouping_their_edges(spark, pieces, monkeypatch):
    """Many units at a time, also where batches part them; nothing is shuffled or sorted behind the join."""
    rng = random.Random(7)
    words = [*{"".join(rng.choice(["th", "e", "ing", "ö", "漢", "z", "."]) for _ in range(rng.randint(1, 40))) for _ in range(300)}, "a"]
    df = spark.createDataFrame([(i, w, i + 1) for i, w in enumerate(words)], "uid bigint, unit string, times bigint")
    monkeypatch.setattr(sp, "_EDGES", 500)
    known = spark.sparkContext.broadcast(pieces)
    frame = sp.encode_units(df, pieces, known)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortMergeJoin" not in plan
    got = {r.unit: (r.times, r.ids) for r in frame.collect()}
    assert got == {w: (i + 1, sp.cheapest(w, pieces)) for i, w in enumerate(words)}


def test_of_equal_costs_the_earlier_start_wins():
    edges = [(1, 0, 1), (2, 0, 4), (2, 1, 1), (3, 0, 9), (3, 1, 4), (3, 2, 1)]  # aaa: 1+1+1, 2+1 and 1+2 cost the same
    edge = np.array([e << 48 | s << 32 | p for e, s, p in edges] * 2, np.int64)
    size, ids = sp.cheapest_paths(np.repeat([5, 9], len(edges)), edge, np.array([9, 1.0, 0, 0, 2.0, 0, 0, 0, 0, 5.0]))
    assert size.tolist() == [2, 2] and ids.tolist() == [0, 3, 0, 3]


def test_lists_of_strings_equal_those_of_pylist():
    from leadlens.llm.common import values

    for a in (pa.array(["a", "é", ""]), pa.array([b"\xff", b""], pa.large_binary()), pa.array([3, 4]), pa.array([], pa.string())):
        assert values(a) == a.to_pylist()


def test_long_texts_are_encoded_a_bounded_number_of_bytes_at_a_time(spark):
    rows = [(i, f"text {i} " * 12_000) for i in range(12)] + [(90, None), (91, ""), (92, "y " * 400_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)

    def held(b, pieces):
        sizes = [len(t or "") for t in b.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([sum(sizes)] * len(sizes)), pa.array([len(sizes)] * len(sizes))], names=["doc_id", "bytes", "n"])

    out = sp.encode(docs, PATH, finish=held, schema="doc_id bigint, bytes bigint, n bigint").collect()
    assert sorted(r.doc_id for r in out) == sorted(i for i, _ in rows)
    assert all(r.bytes <= 1 << 19 or r.n == 1 for r in out)


def test_slices_keep_rows_in_order():
    rng = random.Random(4)
    texts = [rng.choice([None, "", "é" * rng.randrange(40)]) for _ in range(300)]
    b = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts, pa.string())], names=["i", "text"])
    parts = list(slices(b.slice(7), 1, rows=20, size=100))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(7, 300))
    assert all(p.num_rows <= 20 and (p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column(1).to_pylist()) <= 100) for p in parts)
    assert not list(slices(b.slice(300), 1))
