"""Name, Spark query and checking SQL of every registered query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry.views import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        ORACLE[name] = with_views(sql)
        return fn

    return register


def codes_as_text(df: DataFrame) -> DataFrame:
    """Code sets as comma-separated text, which compares alike in every engine."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({c: F.array_join(c, ",") for c in arrays}) if arrays else df
