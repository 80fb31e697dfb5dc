"""Activity rows to a long list of one row per person, date and code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortal.functions.text import strip_code
from cohortal.operators.joins import shuffle_partitions
from cohortal.sources.tables import input_bytes


def code_longlist(
    activity: DataFrame, codes: Column, *, time: str = "attendance_date"
) -> DataFrame:
    """One row per code of an array column, cleaned; blanks and nulls are dropped."""
    exploded = activity.select("*", F.explode(codes).alias("diagnosis"))
    return (
        exploded.withColumn("diagnosis", strip_code(F.col("diagnosis")))
        .where(F.col("diagnosis") != "")
        .withColumnRenamed(time, "date")
    )


def codes_in_text(column: str) -> Column:
    """Comma-separated text as an array."""
    return F.split(F.col(column), ",")


def codes_in_columns(columns: list[str]) -> Column:
    """Several code columns as one array, each code once.

    Repeats within a row carry nothing and are dropped before the explode.
    """
    return F.array_distinct(F.array(*[F.col(c) for c in columns]))


def keep_one(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key set: the smallest of its other columns, read in table order.

    Equal keys collapse map-side, so a hot key does not reach one task in bulk,
    and a retry picks the same row again.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_kept"))
    return kept.select(*[F.col(c) if c in keys else F.col("_kept")[c].alias(c) for c in df.columns])


# Input files of a distinct task, and the most tasks.
DISTINCT_BYTES = 8 * 1024 * 1024
DISTINCT_TASKS = 10_000


def spread_distinct(df: DataFrame) -> DataFrame:
    """``distinct`` of rows that seldom repeat, with as many tasks as the input has use for.

    A plain distinct first hashes all rows of a map task, which rarely drops any, and gets
    at most as many reduce tasks as the session names shuffle partitions, however large the
    input is. Here rows are dealt first, by all their columns, to as many tasks as that, or
    more if the bytes of the input files ask for them; what a task hashes stays the same as
    the input grows.
    """
    by_bytes = min(DISTINCT_TASKS, input_bytes(df) // DISTINCT_BYTES)
    tasks = max(shuffle_partitions(df), by_bytes)
    return df.repartition(tasks, *[F.col(f"`{c}`") for c in df.columns]).distinct()


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_hash(df: DataFrame) -> Column:
    """One number for a whole row: a short tie-break for wide tables."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def top_row(
    df: DataFrame,
    keys: list[str],
    by: list[Column],
    tie_break: list[str | Column] | None = None,
) -> DataFrame:
    """First row per key in the given order.

    Ties fall to ``tie_break``, by default all remaining columns. Spark cuts
    each key to one row before the shuffle (WindowGroupLimit).
    """
    ties = tie_break if tie_break is not None else [c for c in df.columns if c not in keys]
    order = Window.partitionBy(*keys).orderBy(*by, *[_column(c).asc() for c in ties])
    ranked = df.withColumn("_row", F.row_number().over(order))
    return ranked.where("_row = 1").drop("_row")


def latest_row(
    df: DataFrame, key: str, time: str, tie_break: list[str | Column] | None = None
) -> DataFrame:
    """Row with the greatest ``time`` per key."""
    return top_row(df, [key], [F.col(time).desc()], tie_break)


def union_all(tables: list[DataFrame]) -> DataFrame:
    """Union by column name, keeping duplicates."""
    return reduce(DataFrame.unionByName, tables)


def fill_from_fallback(
    codes: DataFrame,
    fallback: DataFrame,
    *,
    key: str,
    value: str,
    fallback_key: str,
    fallback_value: str,
) -> DataFrame:
    """Where ``value`` is null take the fallback's value for the key.

    The fallback must hold one row per key. Rows that already have a value are
    left as they are, so the two halves need no split and no union.
    """
    matches = fallback.select(
        F.col(fallback_key).alias(key), F.col(fallback_value).alias("_fallback")
    )
    joined = codes.join(matches, key, "left")
    filled = joined.withColumn(value, F.coalesce(F.col(value), F.col("_fallback")))
    return filled.select(*codes.columns)
