"""Cleaning pipeline over ``documents``: each stage reads what its predecessor wrote.

1. quality classifier: documents of low quality and toxic ones go;
2. MinHash near-dedup: one document of each group of near copies stays, the one of smallest id;
3. suffix-array dedup: passages of at least PASSAGE_BYTES bytes that stand at two places go at all
   of them (of characters cut in part, the rest goes too);
4. benchmark decontamination: spans that benchmark items share go, and documents that are hardly
   anything else;
5. SentencePiece encoding: the texts that are left, as piece ids, with the decoded text's check.

All stages but the last return the columns of ``documents``, extra ones of any names too. Null and
empty texts pass as they are (the classifier judges them by their other columns), repeated rows come
down to one where near copies go, null doc_ids are kept, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadlens.llm import decontam, minhash, quality, sp, suffix
from leadlens.llm.common import table
from leadlens.llm.queries import tokenizer_file
from leadlens.session import write_and_read

#: Fifty words are seldom shorter; unrelated texts don't share as much by chance.
PASSAGE_BYTES = 250


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicate(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix.remove(docs, PASSAGE_BYTES)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids and n_pieces of each document, and whether they decode to it."""
    kept = [c for c in ("doc_id", "lang", "source", "text") if c in docs.columns]
    return sp.with_check(docs.select(kept), tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeated_passages),
    ("benchmark decontamination", cut_benchmark),
    ("SentencePiece encoding", encode),
]

#: The classifier and the lattice have no SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the others return is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = write_and_read(docs, f"stage-{i + 1}")
    return docs
