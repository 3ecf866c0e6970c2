"""JSON record helpers: nested list extraction, key listing, canonical text."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_list(df: DataFrame, col: str, keep: list[str], alias: str = "item") -> DataFrame:
    """One row per element of the array ``col``; records with an empty or missing list
    keep one row with NULL (so they are still counted)."""
    return df.select(*keep, F.size(col).alias(f"{col}_size"), F.explode_outer(col).alias(alias))


def list_profile(df: DataFrame, col: str) -> DataFrame:
    """How many records have a missing, empty or non-empty list, and the element total."""
    s = F.size(col)
    return df.agg(
        F.count_if(F.col(col).isNull()).alias("missing"),
        F.count_if(s == 0).alias("empty"),
        F.count_if(s > 0).alias("non_empty"),
        F.sum(F.when(s > 0, s).otherwise(0)).alias("elements"),
    )


def top_level_keys(json_text: str | Column) -> Column:
    """Keys of the outermost JSON object, in document order."""
    c = F.col(json_text) if isinstance(json_text, str) else json_text
    return F.json_object_keys(c)


#: A token of compact JSON whose escaped quotes are masked; tokens laid out at a time.
_TOKEN, _BLOCK = r'"[^"]*"|\{\}|\[\]|[\[\]{},:]|[^\[\]{},:"]+', 256


def _indented(compact: Column, indents: int) -> Column:
    """Compact JSON laid out with a line for each member and element. The text is cut into tokens,
    the tokens into blocks; the depth at which a block starts is a sum over the blocks before it, so
    the work grows with the text, not with its square."""
    # control characters stand escaped in JSON, so two of them can mask escapes while tokens are cut
    masked = F.replace(F.replace(compact, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    tokens = F.regexp_extract_all(masked, F.lit(_TOKEN), F.lit(0))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(tokens) - 1) / _BLOCK).cast("int")), lambda i: F.slice(tokens, i * _BLOCK + 1, _BLOCK))
    step = lambda t: F.when(t.isin("{", "["), 1).when(t.isin("}", "]"), -1).otherwise(0)
    total = lambda x: F.aggregate(x, F.lit(0), lambda acc, v: acc + v)
    change = F.transform(blocks, lambda block: total(F.transform(block, step)))
    line = lambda depth: F.concat(F.lit("\n"), F.repeat(F.lit(" " * indents), depth))

    def lay(acc: Column, t: Column) -> Column:
        depth = acc["depth"] + step(t)
        text = (F.when(t.isin("{", "["), F.concat(t, line(depth))).when(t.isin("}", "]"), F.concat(line(depth), t))
                .when(t == ",", F.concat(t, line(depth))).when(t == ":", F.lit(": ")).otherwise(t))
        return F.struct(depth.alias("depth"), F.concat(acc["text"], text).alias("text"))

    def block_text(block: Column, i: Column) -> Column:
        start = F.struct(total(F.slice(change, F.lit(1), i)).alias("depth"), F.lit("").alias("text"))
        return F.aggregate(block, start, lay, lambda acc: acc["text"])

    joined = F.array_join(F.transform(blocks, block_text), "")
    return F.replace(F.replace(joined, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))


def canonical_json(json_text: str | Column, pretty: bool = True, sort: bool = True, indents: int = 4) -> Column:
    """Text of any JSON value, on one line or (``pretty``) with every object and array opened on
    lines of their own, ``indents`` spaces a level; keys sorted at all levels. NULL for NULL; text
    that is no JSON, or repeats a key within an object, gives NULL (see :func:`invalid_json`).
    Numbers come out in Spark's form (1.50 as 1.5).

    Built-in expressions: the value is parsed to a variant, whose keys are in order. ``sort=False``
    keeps the keys' own order, which a variant does not; that form is a small Arrow UDF."""
    c = F.col(json_text) if isinstance(json_text, str) else json_text
    if sort:
        compact = F.to_json(F.try_parse_json(c))
        return _indented(compact, indents) if pretty else compact
    layout = {"indent": indents} if pretty else {"separators": (",", ":")}

    @F.pandas_udf("string")
    def text(values: pd.Series) -> pd.Series:
        def one(v: str | None) -> str | None:
            try:
                return None if v is None else json.dumps(json.loads(v), ensure_ascii=False, **layout)
            except ValueError:
                return None

        return values.map(one)

    return text(c)


def invalid_json(json_text: str | Column) -> Column:
    """Whether a text is there but is no JSON value."""
    c = F.col(json_text) if isinstance(json_text, str) else json_text
    return c.isNotNull() & F.try_parse_json(c).isNull()
