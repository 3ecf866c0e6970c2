"""Line deduplication by range-partitioned line hashes; keep bitmaps instead of texts.

Every line of at least ``min_chars`` code points (white space stripped at both ends, A-Z in lower
case) becomes two 64-bit hashes. The hashes are range-partitioned, sorted by hash, document and
position, and read as a stream: the first document of a hash keeps its lines, those of the others
are dropped if at least ``min_docs`` documents hold the line. What comes back per document is a
run-length bitmap of the lines to keep. All of it is DataFrame functions.

Hashes that so many lines share that one range would be too much for a task are found in a hash
sample of the lines (it only steers the partitioning), counted by partial aggregates and joined
back by a broadcast; the result is the same on either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import named
from ..session import write_and_read
from .common import private_names

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The white space of line keys: 0x20 and 0x09-0x0D.
SPACE = " \t\n\x0b\f\r"
#: One line in so many is looked at to find hashes that many lines share.
SAMPLED = 64


def fingerprint(text: Column) -> list[Column]:
    """128 bits of a text as two columns: rows of one document id with different texts are told apart."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _line_hashes(texts: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, a, b, pos, h, g) for every line whose key has ``min_chars`` code points."""
    cut = texts.select("doc_id", "a", "b", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keys = cut.where(F.char_length("line") >= min_chars).withColumn("key", F.btrim("line", F.lit(SPACE)))
    keys = keys.where(F.char_length("key") >= min_chars)
    # lower() folds A-Z alone where all is ASCII, and is far cheaper than translate()
    ascii_only = F.octet_length("key") == F.char_length("key")
    low = F.when(ascii_only, F.lower("key")).otherwise(F.translate("key", UPPER, LOWER))
    h, g = fingerprint(F.col("low"))
    return keys.withColumn("low", low).select("doc_id", "a", "b", "pos", h.alias("h"), g.alias("g"))


def _hot(lines: DataFrame, total: int) -> DataFrame:
    """(h, g) shared by more lines than a task should read, at most about 100,000 of them: a
    quarter of an even share of the partitions (250,000 lines at most), or 1 in 100,000 of all."""
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = max(min(250_000, total / (4 * parts)), total / 100_000)
    sample = lines.where(F.pmod(F.xxhash64("doc_id", "a", "pos", "h"), F.lit(SAMPLED)) == 0)
    found = sample.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= max(4, int(limit / SAMPLED)))
    return write_and_read(found.select("h", "g"), "hot-lines")


def _dropped(lines: DataFrame, min_docs: int, keep: str) -> DataFrame:
    """(doc_id, a, b, pos) of the lines to drop."""
    first = F.col("doc_id").desc_nulls_last() if keep == "largest" else F.col("doc_id").asc_nulls_last()
    hot = F.broadcast(_hot(lines, lines.count()))
    where = ["doc_id", "a", "b", "pos"]

    stream = lines.join(hot, ["h", "g"], "left_anti").repartitionByRange("h", "g").sortWithinPartitions("h", "g", first, "a", "b", "pos")
    one = Window.partitionBy("h", "g")
    ranked = stream.withColumn("nth", F.dense_rank().over(one.orderBy(first)))  # 1: the document that keeps its lines
    ranked = ranked.withColumn("n", F.max("nth").over(one))
    cold = ranked.where((F.col("n") >= min_docs) & (F.col("nth") > 1)).select(*where)

    many = lines.join(hot, ["h", "g"], "left_semi")
    holders = many.select("h", "g", "doc_id").distinct().groupBy("h", "g").agg(
        F.count(F.lit(1)).alias("n"), (F.max if keep == "largest" else F.min)("doc_id").alias("keeper"))
    met = many.join(F.broadcast(holders.where(F.col("n") >= min_docs)), ["h", "g"])
    return cold.unionByName(met.where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select(*where))


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, keep: str = "largest",
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, a, b, n_lines, n_dropped, keep_runs): one row for each different (id, text).

    ``a`` and ``b`` are the text's :func:`fingerprint`; ``keep_runs`` is the keep bitmap compressed
    to its runs of ones, structs (start, length) of line positions from 0. A line goes if its key
    has at least ``min_chars`` code points and at least ``min_docs`` ids hold it, but for the lines
    of the ``keep`` ("largest" or "smallest") id that holds it, which all stay.

    A null or empty text is one empty line. Rows without an id count as one document, which never is
    the one to keep a line that another holds. Rows repeated as a whole are one row here; rows of one id with different texts
    are one document in the counts and have a bitmap each. Other columns are not looked at. An
    empty table gives an empty one.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    texts = docs.select(named(id_col).alias("doc_id"), F.coalesce(named(text_col), F.lit("")).alias("text"))
    a, b = fingerprint(F.col("text"))
    texts = texts.withColumns({"a": a, "b": b})
    lines = write_and_read(_line_hashes(texts, min_chars), "line-hashes")
    gone = _dropped(lines, min_docs, keep).groupBy("doc_id", "a", "b").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    all_docs = texts.select("doc_id", "a", "b", F.size(_lines(F.col("text"))).alias("n_lines")).distinct()
    both = _left_join(all_docs, gone, ("doc_id", "a", "b"), ("gone",))
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    # between two dropped lines, and before the first and after the last, stands a run of kept ones
    edges = F.zip_with(F.concat(F.array(F.lit(-1)), gone), F.concat(gone, F.array(F.col("n_lines"))),
                       lambda x, y: F.struct((x + 1).alias("start"), (y - x - 1).alias("length")))
    return both.select("doc_id", "a", "b", F.col("n_lines").cast("long").alias("n_lines"),
                       F.size(gone).cast("long").alias("n_dropped"),
                       F.filter(edges, lambda r: r["length"] > 0).alias("keep_runs"))


def _left_join(left: DataFrame, right: DataFrame, on: tuple[str, str, str], take: tuple[str, ...]) -> DataFrame:
    """``left`` with the columns ``take`` of ``right`` where ``on`` is equal, nulls included; ``on``
    names the columns of ``left``, in the order of doc_id, a, b."""
    names = private_names(left, "_k0", "_k1", "_k2")
    other = right.select(*[named(c).alias(n) for c, n in zip(("doc_id", "a", "b"), names)], *take)
    same = [named(c).eqNullSafe(named(n)) if c == on[0] else named(c) == named(n) for c, n in zip(on, names)]
    return left.join(other, same, "left").drop(*names)


def drop_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               count_col: str | None = None) -> DataFrame:
    """``docs``, each row once and with all its columns, its text cut to the lines that its bitmap
    keeps, joined by line breaks; with ``count_col`` also the number of dropped lines. Rows without
    a bitmap, or with one that keeps all, stay as they are (a null text too); only bitmaps that
    drop something are joined."""
    a, b, runs, n = private_names(docs, "_a", "_b", "keep_runs", "n_dropped")
    x, y = fingerprint(F.coalesce(named(text_col), F.lit("")))
    some = bitmaps.where("n_dropped > 0").withColumnsRenamed({"keep_runs": runs, "n_dropped": n})
    both = _left_join(docs.withColumns({a: x, b: y}), some, (id_col, a, b), (runs, n))
    lines = _lines(named(text_col))
    kept = F.array_join(F.flatten(F.transform(named(runs), lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n")
    text = F.when(named(runs).isNull(), named(text_col)).otherwise(kept)
    count = [F.coalesce(named(n), F.lit(0)).cast("long").alias(count_col)] if count_col else []
    return both.select(*[text.alias(c) if c == text_col else named(c) for c in docs.columns], *count)


def digest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines before, n_dropped by :func:`keep_bitmaps`, and
    kept_sha256 of the text that :func:`drop_lines` leaves."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("n_lines", F.size(_lines(F.col("text"))).cast("long"))
    kept = drop_lines(base, keep_bitmaps(base), count_col="n_dropped")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
