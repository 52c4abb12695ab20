"""Registry of named queries and their independent SQL formulations."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    note: str = ""
    tags: Sequence[str] = field(default_factory=tuple)


REGISTRY: dict[str, Query] = {}

DIGITS = 6


def register(name: str, sql: str | None = None, note: str = "", tags: Sequence[str] = ()):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, note, tuple(tags))
        return fn

    return deco


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column, so that sums in another order compare equal."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def sql_round(body: str, double_columns: Sequence[str], digits: int = DIGITS) -> str:
    """Wrap a DuckDB query so the listed double columns are rounded."""
    if not double_columns:
        return body
    parts = ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in double_columns)
    return f"SELECT * REPLACE ({parts}) FROM (\n{body}\n) q"
