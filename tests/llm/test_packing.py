import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leadlens.llm import packing
from leadlens.llm import queries as Q
from leadlens.llm.common import filesystem, table
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_force(docs):
    """The digest from whole texts, encoded at once; rows of one doc_id in any order."""
    tok, out, start = Tokenizer.from_file(PATH), [], 0
    for d, t in docs:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def run(spark, docs):
    df = spark.createDataFrame([(d, t, 5) for d, t in docs], "doc_id bigint, text string, START int")
    rows = packing.round_trip(df, PATH, block=64).orderBy("start").collect()
    return [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows]


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 31, 32])
def test_pack_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001, dtype=np.uint64).astype("<u4")
    data = packing.pack(ids, bits)
    assert len(data) == -(-1001 * bits // 8) and (packing.unpack(data, bits, 1001) == ids).all()
    matrix = (ids[:, None] >> np.arange(bits, dtype="<u4")) & 1
    assert np.packbits(matrix.astype(np.uint8).ravel(), bitorder="little").tobytes() == data
    assert [packing.width(n) for n in (1, 2, 3, 49408, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


def test_random_access(tmp_path):
    ids = np.random.default_rng(1).integers(0, 2**11, 5000).astype("<u4")
    fs, root = filesystem(f"file:{tmp_path}")
    w = packing.Writer(fs.open_output_stream(f"{root}/x"), 11, 128)
    w.add([1, None], [1000, 0], ids[:1000])
    w.add([3], [4000], ids[1000:])
    w.close()
    with fs.open_input_file(f"{root}/x") as f:
        r = packing.Reader(f)
        assert r.starts.tolist() == [0, 1000, 1000, 5000] and r.known.tolist() == [True, False, True]
        for a, b in [(0, 5000), (0, 1), (127, 129), (128, 128), (4999, 5000), (900, 3333)]:
            assert (r.ids(a, b) == ids[a:b]).all()


def test_edges(spark):
    odd = "It's 12 <|endoftext|>x y z\x1c\x0b é ́ ΑΣ Σ\n\n 's '"
    docs = [(None, "null id"), (-3, odd), (1, None), (2, ""), (3, " \n"), (4, "word " * 50_000), (5, "x" * 20_000), (9, odd)]
    assert run(spark, docs) == brute_force(docs)
    twice = run(spark, [(1, "a b"), (1, "c"), (1, "a b"), (2, "d")])
    assert sorted(x[2] for x in twice) == [2, 2, 3, 3] and twice[-1] == (2, 8, 2, twice[-1][3])
    assert run(spark, []) == []


def test_query_matches_whole_text_encoding(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").orderBy("doc_id").collect()]
    got = [tuple(r)[:4] for r in Q.op10_packed_tokens(spark, SF_SMALL).orderBy(F.col("doc_id")).collect()]
    assert got == brute_force(docs)


@pytest.mark.parametrize("seed", range(3))
def test_random_unicode_as_the_library(seed):
    """Words of letters of many alphabets, capitals that lower-case to several code points,
    combining marks and white space of all kinds, each before punctuation, against whole texts."""
    tok, rng = Tokenizer.from_file(PATH), np.random.default_rng(seed)
    words = packing.WordCache(open(PATH, encoding="utf-8").read())
    special = list("İıŞĞÉßẞΣςǅﬁﬀクホ語ไทยक़ाȩ़́́̇क़ẞΩKŉᲉꟋͅ") + ["TARİHİ", "GÜZELLİĞİ", "'s", "’", "12", "½", "Ⅳ"]
    marks = list(",.;:!?") + ["...", "?!", ").", "", "", " ", " ", "\x1c", "\x85", "​", "_"]
    for _ in range(400):
        text = "".join(str(rng.choice([*special, chr(rng.integers(0x21, 0x2FFF)), "ab"])) * int(rng.integers(1, 3)) + str(rng.choice(marks)) + str(rng.choice(["", " ", " ", "\n"]))
                       for _ in range(rng.integers(1, 12)))
        n, ids = words.encode(pa.array([text]), 1)
        assert ids.tolist() == [*tok.encode(text, add_special_tokens=False).ids, 1], text
