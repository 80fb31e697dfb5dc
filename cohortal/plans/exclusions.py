"""Exclusion lists straight from the raw tables.

A person's reasons need a few columns of five sources. Each source gives narrow rows
(person, facts), and the facts of a person meet in one aggregate; the wide person table is
not built for it. The lists equal those read off the wide table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortal import fixed
from cohortal.config import CohortConfig, ConditionRule
from cohortal.functions.text import drop_dots, strip_code
from cohortal.functions.weeks import Timeline
from cohortal.operators.exclude import (
    FactRules,
    Facts,
    fact_bits,
    fact_names,
    fact_sets,
    reasons_of_facts,
)
from cohortal.operators.longlist import codes_in_columns, codes_in_text, top_row
from cohortal.plans import codes

# Facts besides the reasons themselves; the first marks people of the person table.
_PERSON, _PRIOR, _RECORD, _CAUSE = "person", "prior", "record_flag", "cause"


def _exploded(table: DataFrame, keep: list[str], texts: Column) -> DataFrame:
    """``keep`` and one cleaned ``code`` per element of an array of code texts."""
    return table.select(*keep, F.explode(texts).alias("code")).withColumn(
        "code", strip_code(F.col("code"))
    )


def prior_people(
    sources, cfg: CohortConfig, rule: ConditionRule, *, first_year: str = fixed.FIRST_FINANCIAL_YEAR
) -> DataFrame:
    """The entity of every event before the cut-off with a code of the condition, repeats
    included.

    Codes are tested where they lie: outpatient diagnoses and the emergency code map are cut
    to matching rows before the activity meets them, so what is joined is an id, not a row
    of codes.
    """

    def past(activity: DataFrame) -> DataFrame:
        return activity.where(
            Timeline(activity, cfg, "attendance_date").before() & F.col(cfg.entity).isNotNull()
        )

    entity, matches = [cfg.entity], rule.matches(F.col("code"))
    inpatient = _exploded(past(sources.inpatient), entity, codes_in_text("dimention_8"))
    found = [inpatient.where(matches).select(*entity)]

    raw = codes.union_periods(sources.outpatient_periods, first_year)
    diagnosed = _exploded(
        raw,
        [F.col("OPA_Ident").cast("string").alias("opa_ident_min")],
        codes_in_columns(fixed.OUTPATIENT_CODE_COLUMNS),
    )
    attendances = diagnosed.where(matches).select("opa_ident_min")
    outpatient = past(sources.outpatient).select(*entity, "opa_ident_min")
    found.append(outpatient.join(attendances, "opa_ident_min", "left_semi").select(*entity))

    targets = codes.emergency_code_map(sources.code_map, sources.fallback_map).select(
        F.col("SNOMED_Code").alias("_target"), drop_dots(F.col("ICD10_Mapping")).alias("code")
    )
    targets = targets.where(matches & (F.col("code") != fixed.NOT_A_DIAGNOSIS))
    emergency = _exploded(past(sources.emergency), entity, codes_in_text("dimention_8"))
    # A shuffled join that Spark broadcasts if the targets prove small, and whose frequent
    # codes it splits if not.
    mapped = emergency.join(targets.select(F.col("_target").alias("code")), "code", "left_semi")
    found.append(mapped.select(*entity))
    return codes.union_all(found)


def _latest(
    table: DataFrame, cfg: CohortConfig, time: str, keep: list[str], ties: list[str | Column] | None
) -> DataFrame:
    """``keep`` of the latest row per entity, ties broken as in the wide table."""
    order, extra = [], []
    for i, tie in enumerate([c for c in table.columns if c != cfg.entity] if ties is None else ties):
        if isinstance(tie, str):
            order.append(F.col(f"`{tie}`"))
            extra += [tie] if tie not in [time, *keep, *extra] else []
        else:
            order.append(F.col(f"_tie{i}"))
            extra.append(tie.alias(f"_tie{i}"))
    narrow = table.where(F.col(cfg.entity).isNotNull()).select(cfg.entity, time, *keep, *extra)
    return top_row(narrow, [cfg.entity], [F.col(time).desc()], order).select(cfg.entity, *keep)


def _person_facts(person: DataFrame, cfg: CohortConfig) -> Facts:
    age, death = F.col("age"), Timeline(person, cfg, "death_month")
    deducted = F.col("deducted").cast("int") == 1
    return {
        _PERSON: F.lit(True),
        fixed.NO_AGE: age.isNull(),
        fixed.TOO_YOUNG: age < 40,
        fixed.TOO_OLD: age > 120,
        fixed.DIED_BEFORE: death.before(),
        fixed.DEDUCTED: deducted & (F.col("deduction_reason") != "DEA"),
        fixed.DIED_AFTER: death.time >= death.cutoff,
    }


_OWN_FIRST = [fixed.NO_AGE, fixed.TOO_YOUNG, fixed.TOO_OLD]
_OWN_LAST = [fixed.DIED_BEFORE, fixed.DEDUCTED]


def _alone(reasons: list[str]) -> FactRules:
    return [(r, [r], []) for r in reasons]


def _listed(sources, cfg: CohortConfig, found: list, rules: FactRules) -> DataFrame:
    person = sources.person
    names = fact_names(found)
    listed = reasons_of_facts(fact_sets(cfg.entity, found), cfg.entity, names, rules)
    # People without an id match nothing elsewhere; each of their rows speaks for itself.
    unnamed = person.where(F.col(cfg.entity).isNull())
    own = unnamed.select(cfg.entity, fact_bits(_person_facts(person, cfg), names).alias("facts"))
    return listed.unionAll(reasons_of_facts(own, cfg.entity, names, rules))


def cancer_list(
    sources,
    cfg: CohortConfig,
    *,
    first_year: str = fixed.FIRST_FINANCIAL_YEAR,
    tie_break: list[str | Column] | None = None,
) -> DataFrame:
    """(person, reason) pairs of the cancer outcome; a person may have several reasons.

    People of the person table that repeat count once. People with a prior diagnosis are
    listed even if the person table lacks them. ``sources`` are those of a build.
    """
    snapshot = _latest(sources.snapshots, cfg, "date", ["active_cancer", "cancer"], tie_break)
    flagged = (F.col("active_cancer") == 1) | (F.col("cancer") == 1)
    deaths = sources.mortality.select(cfg.entity, "reg_date_of_death", *fixed.CAUSE_COLUMNS, "activity_id")
    died = _latest(deaths, cfg, "activity_id", fixed.CAUSE_COLUMNS, None)
    prior = prior_people(sources, cfg, fixed.CANCER, first_year=first_year)
    found = [
        (sources.person, _person_facts(sources.person, cfg)),
        (snapshot, {_RECORD: flagged}),
        (died, {_CAUSE: fixed.CANCER.any_of(fixed.CAUSE_COLUMNS) == 1}),
        (prior, {_PRIOR: F.lit(True)}),
    ]
    rules = [
        *_alone(_OWN_FIRST),
        (fixed.RECORD_FLAG, [_PERSON, _RECORD], []),
        *_alone(_OWN_LAST),
        (fixed.DIED_AFTER, [fixed.DIED_AFTER], [_CAUSE]),
        (fixed.PRIOR_CANCER, [_PRIOR], []),
    ]
    return _listed(sources, cfg, found, rules)


def stroke_list(
    sources, cfg: CohortConfig, *, first_year: str = fixed.FIRST_FINANCIAL_YEAR
) -> DataFrame:
    """As ``cancer_list``: no record-flag rule, and any later death excludes."""
    prior = prior_people(sources, cfg, fixed.STROKE, first_year=first_year)
    found = [
        (sources.person, _person_facts(sources.person, cfg)),
        (prior, {_PRIOR: F.lit(True)}),
    ]
    rules = [
        *_alone([*_OWN_FIRST, *_OWN_LAST, fixed.DIED_AFTER]),
        (fixed.PRIOR_STROKE, [_PRIOR], []),
    ]
    return _listed(sources, cfg, found, rules)
