"""Strata and the train / validate / test split."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortal.functions.person import uniform_draw
from cohortal.operators.joins import lookup_join, shuffle_partitions
from cohortal.sources.tables import stage

FRACTIONS = {"train": 0.6, "validate": 0.2, "test": 0.2}
# Sketches hold a quantile's rank to one part in this many of a stratum's rows.
ACCURACY = 10_000


def stratum_label(columns: list[str], null_label: str | None = None) -> Column:
    """Values joined by dashes. A null value makes the label null, or reads ``null_label``."""
    parts = [F.col(c).cast("string") for c in columns]
    if null_label is not None:
        parts = [F.coalesce(p, F.lit(null_label)) for p in parts]
    return F.concat(*[p for c in parts for p in (F.lit("-"), c)][1:])


def numbered_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """``c``, ``v`` (as text) and ``n``: the distinct values of the columns, numbered from 0
    within each column. A null is a value of its own.

    One scan finds the values of all columns. They are numbered in chunks: each task counts
    on from where the chunks before it end, so that a column with very many values does not
    meet in one task. The order of the numbers is fixed by the values alone.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]
    )
    seen = df.select(F.explode(pairs).alias("p")).select("p.c", "p.v").distinct()
    chunk = F.pmod(F.xxhash64("v"), F.lit(shuffle_partitions(df)))
    seen = stage(seen.withColumn("chunk", chunk), "values")
    earlier = Window.partitionBy("c").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = seen.groupBy("c", "chunk").agg(F.count(F.lit(1)).alias("rows"))
    starts = starts.select(
        "c", "chunk", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("c", "chunk").orderBy("v")
    placed = seen.withColumn("place", F.row_number().over(within) - 1).join(starts, ["c", "chunk"])
    return placed.select("c", "v", (F.col("start") + F.col("place")).alias("n"))


def strata_crosstab(person: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Every combination of the values seen in the columns, with its label.

    The combinations are the numbers below the product of the value counts, read in mixed
    radix: the digit of each column is found by division and looked up among the numbered
    values by an equality join. The table is scanned once and no two lists are multiplied
    in a nested loop; the product is spread over tasks as a range of numbers.
    """
    values = stage(numbered_values(person, columns), "numbered")
    sizes = {r["c"]: r["n"] for r in values.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    types = {f.name: f.dataType for f in person.schema.fields}
    total, places = 1, []
    for c in columns:
        places.append((c, total, sizes.get(c, 0)))
        total *= sizes.get(c, 0)
    out = person.sparkSession.range(total).withColumnRenamed("id", "_combination")
    for c, radix, size in places:
        digit = F.expr(f"_combination div {radix} % {max(size, 1)}")
        digits = values.where(F.col("c") == c).select(
            F.col("n").alias("_digit"), F.col("v").cast(types[c]).alias(c)
        )
        out = out.withColumn("_digit", digit).join(digits, "_digit").drop("_digit")
    return out.select(*columns, stratum_label(columns).alias(name))


def strata_assign(
    person: DataFrame, columns: list[str], name: str, *, null_label: str | None = None
) -> DataFrame:
    """Stratum label per person; people with a null in a column are dropped.

    Equal to an inner join with the crosstab, without the join. With
    ``null_label`` everyone is kept and nulls read as that text in the label.
    """
    if null_label is None:
        person = person.where(reduce(and_, [F.col(c).isNotNull() for c in columns]))
    rest = [c for c in person.columns if c not in columns]
    return person.select(*columns, *rest, stratum_label(columns, null_label).alias(name))


def _draw(person: DataFrame, key: str, seed: int, salt: Column | None = None) -> Column:
    """Number in [0, 1) of each row, by its key; of a row without a key, by its other columns."""
    others = [F.col(f"`{c}`") for c in person.columns if c != key]
    whole = F.xxhash64(*others) if others else F.lit(0)
    drawn = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("row:"), whole.cast("string")))
    if salt is not None:
        drawn = F.concat(salt.cast("string"), F.lit(":"), drawn)
    return uniform_draw(drawn, seed)


def _bounds(fractions: dict[str, float]) -> list[tuple[str, float]]:
    """Name and upper bound of every part but the last, as shares of the whole."""
    total, names = sum(fractions.values()), list(fractions)
    return [(n, sum(fractions[m] for m in names[: i + 1]) / total) for i, n in enumerate(names[:-1])]


def _part(cases: list[tuple[str, Column]], last: str) -> Column:
    """The first name whose condition holds, else ``last``."""
    if not cases:
        return F.lit(last)
    return reduce(lambda acc, case: acc.when(case[1], case[0]), cases, F).otherwise(last)


def split_hash(
    person: DataFrame,
    key: str,
    *,
    fractions: dict[str, float] | None = None,
    seed: int = 0,
    salt: Column | None = None,
    out: str = "dataset",
) -> DataFrame:
    """Assign each row to a part by a seeded hash of its key.

    Membership depends on seed and key alone: not on partitioning, retries or
    which other rows are present. A row without a key is drawn by its other columns, so
    that such rows spread over the parts too; equal ones fall together. Fractions are
    weights and need not sum to 1.
    """
    fractions = fractions or FRACTIONS
    draw = _draw(person, key, seed, salt)
    cases = [(name, draw < bound) for name, bound in _bounds(fractions)]
    return person.withColumn(out, _part(cases, list(fractions)[-1]))


def split_stratified(
    person: DataFrame,
    key: str,
    target: str,
    *,
    fractions: dict[str, float] | None = None,
    seed: int = 0,
    out: str = "dataset",
) -> DataFrame:
    """Draw separately within target 0 and 1; rows with another target are lost.

    Each class has its own independent draw, so both are split in the given
    proportions without a shuffle.
    """
    labelled = person.where(F.col(target).isin(0, 1))
    return split_hash(
        labelled, key, fractions=fractions, seed=seed, salt=F.col(target), out=out
    )


def _stratum_key(stratum: str) -> Column:
    """Key of a stratum, by which null strata find each other too."""
    return F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit(""))


def stratum_thresholds(
    person: DataFrame,
    key: str,
    stratum: str,
    *,
    fractions: dict[str, float] | None = None,
    seed: int = 0,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per stratum: ``stratum_key``, ``rows`` and ``bounds``, the draws up to which
    each part but the last reaches.

    The bounds are quantiles of the stratum's own draws. Every map task keeps one quantile
    sketch per stratum and sends only that, so a stratum with a third of all rows is neither
    sorted nor gathered. A bound's rank is right to ``rows / accuracy``, and exactly right
    in strata of up to ``accuracy`` rows. The table is written, so that one run uses the same
    bounds throughout; kept by the caller, it splits later rows by the same bounds.
    """
    shares = [bound for _, bound in _bounds(fractions or FRACTIONS)]
    drawn = person.select(
        _stratum_key(stratum).alias("stratum_key"), _draw(person, key, seed).alias("_draw")
    )
    found = drawn.groupBy("stratum_key").agg(
        F.count(F.lit(1)).alias("rows"),
        F.percentile_approx("_draw", shares or [1.0], accuracy).alias("bounds"),
    )
    return stage(found, "thresholds")


def split_by_stratum(
    person: DataFrame,
    key: str,
    stratum: str,
    *,
    fractions: dict[str, float] | None = None,
    seed: int = 0,
    accuracy: int = ACCURACY,
    thresholds: DataFrame | None = None,
    out: str = "dataset",
) -> DataFrame:
    """Split every stratum on its own, so that each meets the fractions.

    A weighted draw meets them only on average: of ten people of a stratum it may put all
    in one part. Here part i ends at the draw of rank ``ceil(share * rows)`` of the stratum,
    which is within one row of the wanted share, plus ``rows / accuracy`` in strata of more
    than ``accuracy`` rows. Rows of equal draws (equal keys) stay together. Null is a stratum
    like any other. ``thresholds`` of an earlier call apply its bounds; rows of a stratum it
    does not know are split by the fractions themselves.
    """
    fractions = fractions or FRACTIONS
    if thresholds is None:
        thresholds = stratum_thresholds(
            person, key, stratum, fractions=fractions, seed=seed, accuracy=accuracy
        )
    bounds = thresholds.select(F.col("stratum_key").alias("_known"), F.col("bounds").alias("_bounds"))
    columns = [F.col(f"`{c}`") for c in person.columns if c != out]
    drawn = person.select(
        "*", _stratum_key(stratum).alias("_key"), _draw(person, key, seed).alias("_draw")
    )
    joined = lookup_join(drawn, bounds, "_key", "_known")
    cases = [
        (name, F.col("_draw") <= F.coalesce(F.col("_bounds")[i], F.lit(share)))
        for i, (name, share) in enumerate(_bounds(fractions))
    ]
    return joined.select(*columns, _part(cases, list(fractions)[-1]).alias(out))
