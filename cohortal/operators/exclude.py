"""Cohort exclusions: rules are data, evaluated in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rules = list[tuple[str, Column]]


def reasons(rules: Rules) -> Column:
    """Array of the reasons whose condition is true; null conditions do not count."""
    return F.array_compact(F.array(*[F.when(rule, F.lit(reason)) for reason, rule in rules]))


def exclusion_reasons(person: DataFrame, entity: str, rules: Rules) -> DataFrame:
    """One row per person and reason, from a single scan of the person table."""
    return person.select(entity, F.explode(reasons(rules)).alias("reason"))


def reason_for_all(people: DataFrame, entity: str, reason: str) -> DataFrame:
    """Every listed person with one reason, e.g. those with a prior diagnosis."""
    return people.select(entity, F.lit(reason).alias("reason"))


def exclude(
    person: DataFrame, listed: DataFrame, entity: str, *, reason_column: bool = False
) -> DataFrame:
    """People without any listed reason.

    ``reason_column`` keeps the all-null ``reason`` that a left join with a null
    test leaves behind.
    """
    kept = person.join(listed.select(entity), entity, "left_anti")
    if reason_column:
        kept = kept.withColumn("reason", F.lit(None).cast("string"))
    return kept


def exclude_by_rules(person: DataFrame, rules: Rules) -> DataFrame:
    """People for whom no rule holds, when every rule reads the person's own row.

    Equal to listing the reasons and anti-joining them on a table of one row per
    person, without computing that table twice. Each rule is its own conjunct, so
    rules on person attributes apply before the wide joins below them.
    """
    for _, rule in rules:
        person = person.where(~F.coalesce(rule, F.lit(False)))
    return person


Facts = dict[str, Column]
# Reason, the facts it needs, and the facts that rule it out.
FactRules = list[tuple[str, list[str], list[str]]]


def fact_names(sources: list[tuple[DataFrame, Facts]]) -> list[str]:
    """Names of all facts; the place of a name is its bit."""
    names = list(dict.fromkeys(name for _, facts in sources for name in facts))
    if len(names) > 63:
        raise ValueError(f"{len(names)} facts do not fit one number")
    return names


def fact_bits(facts: Facts, names: list[str]) -> Column:
    """The facts that hold for a row, as one number; a null condition does not hold."""
    bits = [
        F.when(condition, F.lit(1 << names.index(name))).otherwise(F.lit(0)).cast("bigint")
        for name, condition in facts.items()
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def fact_sets(entity: str, sources: list[tuple[DataFrame, Facts]]) -> DataFrame:
    """``entity`` and ``facts``: which facts hold for each entity, as the bits of one number.

    Each source is a table with the facts that can be read off its rows; a fact holds for an
    entity if it does in any of its rows. Sources are cut to the entity and one number, and
    only rows with a fact are kept. One union and one ``bit_or`` gather them: map tasks send
    one number per entity, so a hot entity costs no more than any other, and no source is
    joined with another. Rows without an entity are dropped. Bits follow ``fact_names``.
    """
    names = fact_names(sources)
    parts = [t.select(entity, fact_bits(facts, names).alias("facts")) for t, facts in sources]
    rows = reduce(DataFrame.unionAll, parts).where(F.col(entity).isNotNull() & (F.col("facts") != 0))
    return rows.groupBy(entity).agg(F.bit_or("facts").alias("facts"))


def reasons_of_facts(sets: DataFrame, entity: str, names: list[str], rules: FactRules) -> DataFrame:
    """One row per entity and reason: all needed facts hold and none that rules it out."""

    def mask(wanted: list[str]) -> int:
        return sum(1 << names.index(n) for n in wanted)

    found = [
        F.when(F.col("facts").bitwiseAND(F.lit(mask([*needs, *bars]))) == mask(needs), reason)
        for reason, needs, bars in rules
    ]
    return sets.select(entity, F.explode(F.array_compact(F.array(*found))).alias("reason"))
