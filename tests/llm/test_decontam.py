import random

from leadlens.llm import decontam
from leadlens.llm.common import table
from tests.conftest import SF_SMALL

DOCS = "doc_id bigint, text string, N_WORDS int, spans string, lang string"


def run(spark, docs, items):
    d = spark.createDataFrame([(k, v, 1, "s", "en") for k, v in docs], DOCS)
    b = spark.createDataFrame([(k, v, 2) for k, v in items], "item_id bigint, text string, n_words int")
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontam.digest(d, b).collect()}


def test_random_words_match_brute_force(spark):
    rng = random.Random(4)
    text = lambda k: " ".join(rng.choice("abc") for _ in range(k))
    items = [(i, text(rng.choice([0, 1, 4, 7, 9, 10, 11, 25]))) for i in range(2, 30)] + [(99, None), (98, ""), (97, "a b c a")]
    docs = [(i, text(rng.choice([0, 1, 5, 30, 200]))) for i in range(60)] + [(70, None), (71, "")]
    assert run(spark, docs, items) == decontam.brute_force(dict(docs), dict(items))


def test_words_of_all_bytes_and_very_long_text(spark):
    item = "Été 2nd, über-all Ça va. x1 Y2 z3 w4 v5"
    long = "lorem " * 200_000 + item.upper().replace("É", "É") + " ipsum" * 3
    docs = [(1, item.replace(" ", "\n\t")), (2, long), (3, "no match")]
    got = run(spark, docs, [(5, item)])
    assert got == decontam.brute_force({k: v if k != 2 else v for k, v in docs}, {5: item})
    assert decontam.words("AÉé b'c") == ["aÉé b".encode(), b"c"]


def test_empty_tables_and_repeated_rows(spark):
    assert run(spark, [], [(1, "a b")]) == {}
    assert run(spark, [(1, "a b")], [])[1][1:3] == (0, 0)
    twice = decontam.digest(spark.createDataFrame([(1, "a b c"), (1, "a b c")], "doc_id bigint, text string"),
                            spark.createDataFrame([(1, "b"), (1, "b")], "item_id bigint, text string")).collect()
    assert [tuple(r)[1:4] for r in twice] == [(3, 1, 1)] * 2


def test_several_automata_give_the_same(spark):
    docs, items = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    cols = ["doc_id", "n_words", "spans", "items"]
    one = decontam.match(docs, items).select(cols).orderBy("doc_id").collect()
    many = decontam.match(docs, items, max_item_bytes=2000).select(cols).orderBy("doc_id").collect()
    assert one == many and any(r.spans for r in one)


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").limit(60).collect()}
    items = {r.item_id: r.text for r in table(spark, SF_SMALL, "benchmark").collect()}
    got = run(spark, list(docs.items()), list(items.items()))
    assert got == decontam.brute_force(docs, items)


def test_decontaminate_cuts_spans_and_drops_covered_documents(spark):
    item = " ".join(f"w{i}" for i in range(12))
    d = spark.createDataFrame([(1, f"Keep this. {item.upper()}! And that.", 7), (2, item, 8), (3, "clean", 9), (4, None, 1), (5, "", 2)],
                              "doc_id bigint, text string, items int")
    b = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    got = {r.doc_id: (r.text, r["items"]) for r in decontam.decontaminate(d, b, max_coverage=0.9).collect()}
    assert got == {1: ("Keep this. ! And that.", 7), 3: ("clean", 9), 4: (None, 1), 5: ("", 2)}


def test_decontaminate_takes_any_column_names(spark):
    item = " ".join(f"w{i}" for i in range(12))
    df = spark.createDataFrame([(1, "before it " * 20 + item + " after", 1, 2, "x"), (2, "clean", 3, 4, "y"), (3, None, 5, 6, "z")],
                               "doc_id long, text string, spans int, `a.b` int, TEXT string")
    out = decontam.decontaminate(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert out.columns == df.columns
    rows = sorted(tuple(r) for r in out.collect())
    assert [r[2:] for r in rows] == [(1, 2, "x"), (3, 4, "y"), (5, 6, "z")] and "w5" not in rows[0][1] and rows[0][1].startswith("before it")
