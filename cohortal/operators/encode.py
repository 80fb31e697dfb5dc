"""One-hot columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortal.functions.text import fill_blank
from cohortal.functions.weeks import flag

def discover_values(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted distinct non-null values of all columns, found in one job.

    The distinct runs on the cluster. The driver receives one entry for each 0/1 column
    of the result, whose schema it has to hold anyway.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]
    )
    found = (
        df.select(F.explode(pairs).alias("p"))
        .select("p.c", "p.v")
        .where("v is not null")
        .distinct()
        .collect()
    )
    values: dict[str, list[str]] = {c: [] for c in columns}
    for c, v in found:
        values[c].append(v)
    return {c: sorted(v) for c, v in values.items()}


def one_hot_columns(column: str, values: list[str]) -> list[Column]:
    """One 0/1 column per value, named ``{column}_{value}`` with spaces underscored."""
    return [
        flag(F.col(column) == v).alias(f"{column}_{v.replace(' ', '_')}") for v in values
    ]


def one_hot(
    df: DataFrame, columns: list[str], values: dict[str, list[str]] | None = None
) -> DataFrame:
    """Append 0/1 columns for the declared values; undeclared columns are discovered."""
    declared = dict(values or {})
    unknown = [c for c in columns if c not in declared]
    if unknown:
        declared.update(discover_values(df, unknown))
    flags = [e for c in columns for e in one_hot_columns(c, declared[c])]
    return df.select("*", *flags)


def clean_one_hot(
    df: DataFrame,
    columns: list[str],
    values: dict[str, list[str]] | None = None,
    fill: str = "unknown",
    suffix: str = "_null_replaced",
) -> DataFrame:
    """Fill blanks into ``{column}{suffix}``, then one-hot the filled columns."""
    cleaned = df.withColumns({c + suffix: fill_blank(F.col(c), fill) for c in columns})
    declared = {c + suffix: v for c, v in (values or {}).items() if c in columns}
    return one_hot(cleaned, [c + suffix for c in columns], declared)
