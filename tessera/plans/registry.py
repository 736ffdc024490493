"""Registry of named queries and their DuckDB oracle SQL.

Each query is a function ``(spark, sf_dir) -> DataFrame`` that reads the
driver tables (or data Spark derives from them).  ``oracle`` holds, for the
relational ones, an equivalent SQL text runnable by DuckDB over views with
the same table names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
KIND: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``; with ``sql`` the driver checks it against DuckDB."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        KIND[name] = "oracle" if sql is not None else "rows"
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = 4, overrides: dict[str, int] | None = None) -> DataFrame:
    """Round every double column (presentation; both sides of the oracle do the same)."""
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), overrides.get(f.name, digits)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def round_sig(c, digits: int = 10):
    """Round to ``digits`` significant digits (for large sums / squares)."""
    p = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))))
    return F.when(c.isNull() | (c == 0) | F.isnan(c) | (F.abs(c) == float("inf")), c) \
        .otherwise(F.round(c / p, digits - 1) * p)


def round_sig_cols(df: DataFrame, cols: list[str], digits: int = 10) -> DataFrame:
    return df.withColumns({c: round_sig(F.col(c), digits) for c in cols})
