"""Column helpers shared by the text operators."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EARLIER = (Window.unboundedPreceding, -1)
WORD = r"[^\x20\x09-\x0D]+"


def whole_text(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that shuffles both sides, however small Spark takes them to be.

    Spark sizes a table by its files and the types of the columns read. It takes exploded rows
    for as many as before, a text for 20 bytes and a list for one value, so it may broadcast
    through the driver what is very much larger than its bound.
    """
    return df.hint("merge")


def shielded(
    docs: DataFrame, needed: list[str], run: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``run`` on the documents, with all columns but the needed ones under names that no
    operator uses, and their own names again in the result.

    So columns of the user never meet those an operator works with. Where a result has the
    name of a column, in whatever case, the result stays.
    """
    others = [c for c in docs.columns if c.lower() not in {n.lower() for n in needed}]
    hidden = {f"__user_column_{i}__": c for i, c in enumerate(others)}
    names = {c: h for h, c in hidden.items()}
    out = run(docs.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in docs.columns]))
    made = {c.lower() for c in out.columns if c not in hidden}
    back = [c for c in out.columns if c not in hidden or hidden[c].lower() not in made]
    return out.select(*[F.col(f"`{c}`").alias(hidden.get(c, c)) for c in back])


def hashed_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, those whose ``key`` has the lowest hashes.

    A first cut by the number of rows leaves few more than are wanted, however many
    partitions there are; only these are sorted. The choice depends on the rows alone.
    """
    share = min(1.0, 4 * most / max(1, df.count()))
    drawn = F.xxhash64(key)
    low = F.pmod(drawn, F.lit(2**30)) <= int(share * 2**30)
    return df.where(low).orderBy(F.pmod(drawn, F.lit(2**30)), key).limit(most)


def running_total(
    df: DataFrame, key: str, chunk: str, order: list[str], value: str, out: str
) -> DataFrame:
    """``out``: sum of ``value`` over all rows of ``key`` that come before the row.

    Rows are ordered by chunk, then by ``order``. Each (key, chunk) is summed on its own
    and the sums of earlier chunks are added, so that a key with a third of all rows is
    spread over as many tasks as it has chunks.
    """
    base, k, c = f"{out}_base", f"{out}_key", f"{out}_chunk"
    bases = (
        df.groupBy(F.col(key).alias(k), F.col(chunk).alias(c))
        .agg(F.sum(value).alias(base))
        .withColumn(
            base,
            F.coalesce(
                F.sum(base).over(Window.partitionBy(k).orderBy(c).rowsBetween(*EARLIER)),
                F.lit(0),
            ).cast("bigint"),
        )
    )
    within = Window.partitionBy(key, chunk).orderBy(*order).rowsBetween(*EARLIER)
    return (
        df.withColumn(out, F.coalesce(F.sum(value).over(within), F.lit(0)).cast("bigint"))
        .join(bases, (F.col(key) == F.col(k)) & (F.col(chunk) == F.col(c)))
        .withColumn(out, F.col(out) + F.col(base))
        .drop(base, k, c)
    )
