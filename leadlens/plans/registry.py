"""Query registry: each entry is a Spark callable (spark, data_dir) -> DataFrame and,
when the result is expressible in SQL, the equivalent DuckDB query over the raw tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.issues import ISSUES_SQL

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}

DIGITS = 6


def register(name: str, sql: str | None = None):
    """Decorator adding a query (and its oracle SQL, if any) to the registry."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return deco


def with_issues(body: str, extra_ctes: str = "") -> str:
    """Prefix ``body`` with the ``issues`` CTE (and optional further CTEs)."""
    ctes = f"issues AS ({ISSUES_SQL})"
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"


def rounded(df: DataFrame, digits: int = DIGITS, significant: Sequence[str] = ()) -> DataFrame:
    """Round every double column so engine-level float noise does not change results: to ``digits``
    places, columns in ``significant`` (p-values, which may be tiny) to as many significant digits."""

    def one(f):
        if not isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.col(f.name)
        if f.name in significant:
            return F.format_string(f"%.{digits - 1}e", F.col(f.name)).try_cast("double").alias(f.name)
        return F.round(F.col(f.name), digits).alias(f.name)

    return df.select(*[one(f) for f in df.schema.fields])


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def _load() -> None:
    # Importing the modules registers their queries.
    from . import q_check, q_model, q_more, q_prep, q_profile, q_sparse, q_wide  # noqa: F401
