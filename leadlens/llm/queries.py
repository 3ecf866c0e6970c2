"""Registered queries of this subpackage: (spark, sf_dir) -> DataFrame, and DuckDB SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontam, fim, html, line_dedup, lm, minhash, packing, quality, sp, suffix, variants, warc
from .common import table


def tokenizer_file(name: str) -> str:
    """A public tokenizer's file: in $TOKENIZERS_DIR, or where the installed package has it."""
    if folder := os.environ.get("TOKENIZERS_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


OP1_SQL = """
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, url, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
h AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS head FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN head IS DISTINCT FROM page_id AND head IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN head IS DISTINCT FROM page_id THEN head END AS refers_to, url
FROM h
"""


def op2_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Words by the contract's class; windows of 10 words, or a shorter item as a whole.
OP4_SQL = r"""
WITH low AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (
          SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (
          SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM low, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, o.n, item_id FROM occ o JOIN win USING (s) WHERE o.n = win.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
met AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ks
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ks, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN pos USING (doc_id) LEFT JOIN met USING (doc_id)
"""


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.digest(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op7_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.link(table(spark, sf_dir, "documents"))


#: Shingles as word lists; links through the shingles that two documents share; components.
OP8_SQL = r"""
WITH RECURSIVE low AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS s FROM (
         SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM low WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ways AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM both_ways JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT l.b, reach.r FROM reach JOIN link l ON l.a = reach.doc_id)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r) AS component_id, d.doc_id = min(r) AS kept
FROM documents d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def op10_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.round_trip(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.digest(table(spark, sf_dir, "documents"))


#: The letters from U+00C0 to U+00FF, and as many code points of one byte that no
#: lower-cased word holds: levenshtein() counts bytes.
_WIDE = "".join(map(chr, range(0xC0, 0x100)))
_NARROW = "".join(c for c in map(chr, range(0x21, 0x61)) if c != "'") + "~"
#: CRC-32 a byte at a time, from the table that its polynomial gives; every pair of words by edit distance.
OP11_SQL = f"""
WITH RECURSIVE bits AS (SELECT i, 0 AS k, i::BIGINT AS v FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (SELECT doc_id, w, count(*) AS c FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS w FROM documents) WHERE length(w) >= 6 GROUP BY ALL),
hashed AS (SELECT w, c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(x) + 1), lambda i: ('0x' || hex(encode(x))[2 * i - 1:2 * i])::BIGINT)),
  lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) AS h FROM (SELECT w, c, doc_id || ':' || w AS x FROM runs), crc),
slipped AS (SELECT CASE WHEN h % 199 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
plain AS (SELECT word, n, length(word) AS len, translate(word, '{_WIDE}', '{_NARROW}') AS p FROM words),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS m FROM plain a JOIN plain b ON b.len BETWEEN a.len - 1 AND a.len + 1
  AND a.word <> b.word AND levenshtein(a.p, b.p) = 1),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root FROM formed UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.root FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN roots USING (word)
"""


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH u AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l, sha256('7:' || doc_id) AS s FROM documents),
h AS (SELECT *, len(l) AS n, ('0x' || s[1:8])::BIGINT % (len(l) + 1) AS h1, ('0x' || s[9:16])::BIGINT % (len(l) + 1) AS h2,
  t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || s[17:24])::BIGINT % 100 >= 100 AS plain,
  ('0x' || s[25:32])::BIGINT % 100 < 50 AS spm FROM u),
p AS (SELECT *, array_to_string(l[1:least(h1, h2)], '') AS pre, array_to_string(l[least(h1, h2) + 1:greatest(h1, h2)], '') AS mid,
  array_to_string(l[greatest(h1, h2) + 1:], '') AS suf FROM h)
SELECT doc_id, n::BIGINT AS n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
  CASE WHEN NOT plain THEN length(pre) END AS prefix_chars, CASE WHEN NOT plain THEN length(mid) END AS middle_chars,
  sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
    ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH l AS (SELECT doc_id, unnest(w) AS line, generate_subscripts(w, 1) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
many AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
d AS (SELECT doc_id, i, line, coalesce(doc_id <> keeper, false) AS gone FROM k LEFT JOIN many USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_warc_index, op2_projection_forest, op3_suffix_array_dedup, op4_decontamination, op5_lm_scoring, op6_sentencepiece, op7_co_training, op8_circulant_minhash, op9_html_extraction, op10_packed_tokens,
        op11_spelling_variants, op12_fill_in_middle, op13_line_dedup)}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc_index": OP1_SQL, "op4_decontamination": OP4_SQL, "op8_circulant_minhash": OP8_SQL,
            "op11_spelling_variants": OP11_SQL, "op12_fill_in_middle": OP12_SQL, "op13_line_dedup": OP13_SQL}
