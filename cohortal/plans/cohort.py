"""Wide person tables, cohort exclusions and modelling tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortal import fixed
from cohortal.config import CohortConfig
from cohortal.functions.person import age_bucket, clean_age
from cohortal.functions.text import map_values, tristate_text
from cohortal.functions.weeks import Timeline
from cohortal.operators.encode import clean_one_hot, one_hot
from cohortal.operators.exclude import Rules, exclude, exclusion_reasons, reason_for_all
from cohortal.operators.joins import (
    columns_containing,
    left_join_all,
    prefix_columns,
    select_columns,
)
from cohortal.operators.labels import flag_cause_of_death, update_labels_from_death
from cohortal.operators.strata import split_stratified, strata_assign
from cohortal.plans.features import latest_mortality

CLEAN = "_null_removed"
CAUSE_FLAG = "passed_away_with_cancer_cod"


def _others(tables: list[DataFrame], cfg: CohortConfig) -> list[str]:
    return list(dict.fromkeys(c for t in tables for c in t.columns if c != cfg.entity))


def person_features(
    person: DataFrame,
    outcome: DataFrame,
    categories: DataFrame,
    prior: DataFrame,
    cfg: CohortConfig,
) -> DataFrame:
    """Person with outcome, category and prior-condition columns; numbers zero-filled."""
    tables = [outcome, categories, prior]
    wide = left_join_all(person, tables, cfg.entity)
    return wide.na.fill(0, subset=_others(tables, cfg))


def snapshot_columns(snapshot: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Snapshot columns carried to the person table, prefixed with their source."""
    parts = [f"{c}_" for c in fixed.SNAPSHOT_CATEGORIES]
    chosen = [cfg.entity, *fixed.SNAPSHOT_COLUMNS]
    chosen += [c for c in columns_containing(snapshot, parts) if c not in chosen]
    return prefix_columns(snapshot.select(*chosen), "phr_", keep=[cfg.entity])


def person_features_expanded(
    person: DataFrame,
    mortality: DataFrame,
    calls: DataFrame,
    emergency: DataFrame,
    inpatient: DataFrame,
    outpatient: DataFrame,
    snapshot: DataFrame,
    cfg: CohortConfig,
    values: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Person features plus mortality, call, attendance and snapshot columns, the
    cleaned age and one-hot person attributes."""
    health = snapshot_columns(snapshot, cfg)
    counts = [calls, emergency, inpatient, outpatient]
    wide = left_join_all(
        person, [latest_mortality(mortality, cfg), *counts, health], cfg.entity
    )
    wide = wide.withColumns(
        {
            "age_clean": clean_age(F.col("age")),
            **{c + CLEAN: tristate_text(F.col(c)) for c in fixed.PERSON_BOOLEANS},
        }
    )
    booleans = [c + CLEAN for c in fixed.PERSON_BOOLEANS]
    wide = one_hot(wide, booleans, {c: fixed.TRISTATE for c in booleans})
    wide = clean_one_hot(wide, fixed.PERSON_CATEGORIES, values, suffix=CLEAN)
    kept_null = {f"phr_{c}" for c in fixed.SNAPSHOT_NOT_FILLED}
    filled = [c for c in _others([*counts, health], cfg) if c not in kept_null]
    return wide.na.fill(0, subset=filled)


def _common_rules(person: DataFrame, cfg: CohortConfig) -> tuple[Rules, Rules]:
    """Rules both outcomes share, before and after the outcome's own rules."""
    age = F.col("age")
    death = Timeline(person, cfg, "death_month")
    deducted = F.col("deducted").cast("int") == 1
    first = [(fixed.NO_AGE, age.isNull()), (fixed.TOO_YOUNG, age < 40), (fixed.TOO_OLD, age > 120)]
    last = [
        (fixed.DIED_BEFORE, death.before()),
        (fixed.DEDUCTED, deducted & (F.col("deduction_reason") != "DEA")),
    ]
    return first, last


def cancer_rules(person: DataFrame, cfg: CohortConfig) -> Rules:
    """Exclusions read from the person's own row, for the cancer outcome."""
    first, last = _common_rules(person, cfg)
    death = Timeline(person, cfg, "death_month")
    flagged = (F.col("phr_active_cancer") == 1) | (F.col("phr_cancer") == 1)
    no_cause = fixed.CANCER.any_of(fixed.CAUSE_COLUMNS) == 0
    died_otherwise = (death.time >= death.cutoff) & no_cause
    return [
        *first, (fixed.RECORD_FLAG, flagged), *last, (fixed.DIED_AFTER, died_otherwise),
    ]


def stroke_rules(person: DataFrame, cfg: CohortConfig) -> Rules:
    """As ``cancer_rules``: no record-flag rule, and any later death excludes."""
    first, last = _common_rules(person, cfg)
    death = Timeline(person, cfg, "death_month")
    return [*first, *last, (fixed.DIED_AFTER, death.time >= death.cutoff)]


def cancer_exclusions(person: DataFrame, prior: DataFrame, cfg: CohortConfig) -> DataFrame:
    """(person, reason) pairs; a person may have several reasons."""
    own = exclusion_reasons(person, cfg.entity, cancer_rules(person, cfg))
    return own.unionAll(reason_for_all(prior, cfg.entity, fixed.PRIOR_CANCER))


def stroke_exclusions(person: DataFrame, prior: DataFrame, cfg: CohortConfig) -> DataFrame:
    own = exclusion_reasons(person, cfg.entity, stroke_rules(person, cfg))
    return own.unionAll(reason_for_all(prior, cfg.entity, fixed.PRIOR_STROKE))


def cancer_cohort_labels(kept: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Labels of the remaining people, raised where death brought the first diagnosis."""
    flagged = flag_cause_of_death(kept, fixed.CANCER, fixed.CAUSE_COLUMNS, CAUSE_FLAG)
    return update_labels_from_death(flagged, cfg, cause_flag=CAUSE_FLAG)


def cancer_cohort(person: DataFrame, listed: DataFrame, cfg: CohortConfig) -> DataFrame:
    """People without an exclusion, with updated labels."""
    kept = exclude(person, listed, cfg.entity, reason_column=True)
    return cancer_cohort_labels(kept, cfg)


def stroke_cohort(person: DataFrame, listed: DataFrame, cfg: CohortConfig) -> DataFrame:
    """People without an exclusion; labels are left as they are."""
    return exclude(person, listed, cfg.entity)


def model_base(person: DataFrame, cfg: CohortConfig, *, death_label: bool) -> DataFrame:
    """Fixed column list with regrouped categories, their 0/1 columns and the age bucket."""
    area, household = "rural_urban_classification" + CLEAN, "acorn_household_type" + CLEAN
    grouped = person.withColumns(
        {
            area: map_values(F.col(area), fixed.RURAL_URBAN),
            household: map_values(F.col(household), fixed.HOUSEHOLD_TYPE),
        }
    )
    chosen = select_columns(grouped, fixed.model_columns(cfg, death_label=death_label))
    groups = {area: fixed.RURAL_URBAN_GROUPS, household: fixed.HOUSEHOLD_GROUPS}
    encoded = one_hot(chosen, [area, household], groups)
    return encoded.withColumn("age_bucket", age_bucket(F.col("age_clean")))


def _split(person: DataFrame, cfg: CohortConfig, target: str) -> DataFrame:
    labelled = strata_assign(person, ["age_bucket", "gender", target], "category")
    return split_stratified(labelled, cfg.entity, target, seed=cfg.seed)


def cancer_model_table(cohort: DataFrame, site_outcome: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Cancer modelling table: base columns, stratum, split and site labels."""
    base = model_base(cohort, cfg, death_label=True)
    split = _split(base, cfg, f"cancer_diagnosis_in_next_{cfg.label_weeks}_weeks")
    flags = columns_containing(site_outcome, ["cancer_diagnosis_in_next_"])
    joined = split.join(site_outcome.select(cfg.entity, *flags), cfg.entity, "left")
    return joined.na.fill(0, subset=flags)


def stroke_model_table(cohort: DataFrame, outcome: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Stroke modelling table: base columns, label, stratum and split."""
    target = f"{fixed.STROKE.name}_diagnosis_in_next_{cfg.label_weeks}_weeks"
    base = model_base(cohort, cfg, death_label=False)
    labelled = base.join(outcome.select(cfg.entity, target), cfg.entity, "left")
    return _split(labelled.na.fill(0, subset=[target]), cfg, target)
