"""Registry of checked queries: each key runs a library operator over the
generated tables (Spark) and, where the result is SQL-expressible, carries
the equivalent DuckDB SQL over the same parquet views.

Doubles are rounded to 6 digits on both sides (summation order differs
between engines); names and types are aligned on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column (engines sum in different orders)."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def with_ctes(*ctes: str, body: str) -> str:
    parts = [c.strip().rstrip(",") for c in ctes if c]
    return "WITH " + ",\n".join(parts) + "\n" + body
