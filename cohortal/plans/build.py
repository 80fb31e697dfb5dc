"""End-to-end builds: raw tables to the two modelling tables.

The long list of coded events is the largest intermediate, and five consumers
read it. All of them need only the span of each (person, code) on either side of
the cut-off, so the build keeps just that: one pass over the activity tables, one
shuffle, one staged table. Removing same-day duplicates first would be a second
shuffle with the same result, as spans do not change under duplicates.

Spans are staged in buckets of their person, a table with at most one row per code for each
person, and so is the person table. Their readers group and join by person without moving
them again. The activity tables are not: a person can have a third of all events.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortal import fixed
from cohortal.config import CohortConfig, ConditionRule
from cohortal.operators.encode import discover_values
from cohortal.operators.exclude import exclude, exclude_by_rules
from cohortal.operators.joins import lookup_join
from cohortal.operators.labels import label_spans
from cohortal.operators.sites import site_tag
from cohortal.operators.summary import (
    SPAN,
    category_summary,
    group_summary,
    map_categories,
    pivot_categories,
    pivot_sites,
    spans_around,
    spans_on_side,
    spread_values,
    summarise_sites,
)
from cohortal.plans import cohort, codes, features
from cohortal.sources.tables import read_table, stage, stage_bucketed


@dataclass(frozen=True)
class Sources:
    """Input tables of a build."""

    person: DataFrame
    mortality: DataFrame
    calls: DataFrame
    symptoms: DataFrame
    snapshots: DataFrame
    emergency: DataFrame
    inpatient: DataFrame
    outpatient: DataFrame
    outpatient_2008_2020: DataFrame
    outpatient_2021: DataFrame
    outpatient_2022: DataFrame
    outpatient_2023: DataFrame
    code_map: DataFrame
    fallback_map: DataFrame
    code_reference: DataFrame
    boards: DataFrame
    alliances: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> Sources:
        """One Parquet table per field."""
        return cls(**{f.name: read_table(spark, f"{folder}/{f.name}.parquet") for f in fields(cls)})

    @property
    def outpatient_periods(self) -> list[DataFrame]:
        return [
            self.outpatient_2008_2020,
            self.outpatient_2021,
            self.outpatient_2022,
            self.outpatient_2023,
        ]


@dataclass(frozen=True)
class Prepared:
    """Staged intermediates both outcomes read."""

    sources: Sources
    spans: DataFrame
    outpatient: DataFrame


def prepare(
    sources: Sources, cfg: CohortConfig, *, first_year: str = fixed.FIRST_FINANCIAL_YEAR
) -> Prepared:
    """Merge outpatient activity with its codes and reduce all codes to spans."""
    raw = codes.union_periods(sources.outpatient_periods, first_year)
    merged = codes.outpatient_with_codes(sources.outpatient, raw)
    needed = [cfg.entity, "activity_id", "attendance_date", *fixed.OUTPATIENT_CODE_COLUMNS]
    outpatient = stage(merged.select(*needed), "outpatient")
    code_map = codes.emergency_code_map(sources.code_map, sources.fallback_map)
    code_map = stage(code_map, "code_map")
    events = codes.union_sources(
        codes.inpatient_code_rows(sources.inpatient, cfg),
        codes.outpatient_code_rows(outpatient, cfg),
        codes.emergency_code_rows(sources.emergency, code_map, cfg),
        cfg,
    )
    spans = stage_bucketed(spans_around(events, cfg), "spans", cfg.entity)
    return Prepared(sources, spans, outpatient)


def prior_condition(ready: Prepared, cfg: CohortConfig, rule: ConditionRule) -> DataFrame:
    spans = spans_on_side(ready.spans, cfg, "before").where(rule.matches(F.col("code")))
    return group_summary(spans, cfg, f"{rule.name}_before_cut_off", same_code=True, **SPAN)


def condition_outcome(ready: Prepared, cfg: CohortConfig, rule: ConditionRule) -> DataFrame:
    spans = spans_on_side(ready.spans, cfg, "after").where(rule.matches(F.col("code")))
    return label_spans(spans, cfg, rule.name)


def past_categories(ready: Prepared, cfg: CohortConfig) -> list[str]:
    """Categories of the codes before the cut-off."""
    reference = codes.current_reference(ready.sources.code_reference)
    column = features.CATEGORY
    past = spans_on_side(ready.spans, cfg, "before").select("code").distinct()
    found = past.join(reference.select("alt_code", column), F.col("code") == F.col("alt_code"))
    return discover_values(found, [column])[column]


def _category_summary(ready: Prepared, cfg: CohortConfig, categories: list[str]) -> DataFrame:
    reference = codes.current_reference(ready.sources.code_reference)
    column = features.CATEGORY
    wanted = reference.where(F.col(column).isin(categories)).select("alt_code", column)
    spans = lookup_join(spans_on_side(ready.spans, cfg, "before"), wanted, "code", "alt_code")
    known = spans.where(F.col(column).isNotNull())
    return category_summary(known, cfg, column, **SPAN)


def category_features(ready: Prepared, cfg: CohortConfig, categories: list[str]) -> DataFrame:
    summary = _category_summary(ready, cfg, categories)
    return pivot_categories(summary, cfg, features.CATEGORY, categories)


def category_maps(ready: Prepared, cfg: CohortConfig, categories: list[str]) -> DataFrame:
    """As ``category_features``, in one column that ``spread_values`` turns into theirs."""
    summary = _category_summary(ready, cfg, categories)
    return map_categories(summary, cfg, features.CATEGORY, categories)


def site_outcomes(ready: Prepared, cfg: CohortConfig) -> DataFrame:
    tagged = site_tag(spans_on_side(ready.spans, cfg, "after"), code="code", out=features.SITE)
    summary = summarise_sites(tagged, cfg, features.SITE)
    return pivot_sites(summary, cfg, features.SITE, list(fixed.SITE_CODES))


def wide_person(
    ready: Prepared, cfg: CohortConfig, *, categories: list[str], **choices
) -> DataFrame:
    """Every person with all features and cancer labels, nobody excluded."""
    return spread_values(
        compact_person(ready, cfg, categories=categories, **choices), categories
    )


def compact_person(
    ready: Prepared,
    cfg: CohortConfig,
    *,
    categories: list[str],
    symptom_labels: list[str] | None = None,
    values: dict[str, list[str]] | None = None,
    tie_break: list[str | Column] | None = None,
) -> DataFrame:
    """``wide_person`` before its categories become columns: for callers that stage, filter
    or join it first, and spread the categories last."""
    s = ready.sources
    person = cohort.person_features(
        s.person,
        condition_outcome(ready, cfg, fixed.CANCER),
        category_maps(ready, cfg, categories),
        prior_condition(ready, cfg, fixed.CANCER),
        cfg,
    )
    return cohort.person_features_expanded(
        person,
        s.mortality,
        features.call_features(s.calls, s.symptoms, cfg, symptom_labels),
        features.emergency_features(s.emergency, cfg),
        features.inpatient_features(s.inpatient, cfg),
        features.outpatient_features(ready.outpatient, cfg),
        features.snapshot_features(s.snapshots, cfg, values, tie_break),
        cfg,
        values,
    )


def model_values(extra: dict[str, list[str]] | None = None) -> dict[str, list[str]]:
    """Declared category values of the modelling table, so that no job discovers them.

    Categories whose 0/1 columns the table does not carry get none.
    """
    values = {c: [] for c in [*fixed.PERSON_CATEGORIES, *fixed.SNAPSHOT_CATEGORIES]}
    values.update(
        gender=fixed.GENDERS,
        ethnicity_code=fixed.ETHNICITIES,
        imd_decile=fixed.DECILES,
        nhs_region=fixed.REGIONS,
    )
    return values | (extra or {})


RULE_COLUMNS = ["age", "deducted", "deduction_reason", *fixed.CAUSE_COLUMNS]


def stage_people(
    ready: Prepared, cfg: CohortConfig, *, tie_break: list[str | Column] | None = None
) -> DataFrame:
    """Stage one row per person with what both modelling tables start from.

    All joins and all scans of the activity tables end here, once for both
    outcomes and their exclusion lists. A lost executor costs none of it again,
    and the label and encoding expressions are planned over plain columns.
    """
    wide = wide_person(
        ready,
        cfg,
        categories=[fixed.FAMILY_HISTORY_CATEGORY],
        symptom_labels=fixed.SYMPTOM_LABELS,
        values=model_values(),
        tie_break=tie_break,
    )
    needed = [*fixed.model_columns(cfg, death_label=False), *RULE_COLUMNS]
    return stage_bucketed(wide.select(*needed), "people", cfg.entity)


def cancer_exclusions(ready: Prepared, people: DataFrame, cfg: CohortConfig) -> DataFrame:
    """(person, reason) pairs of the cancer outcome."""
    return cohort.cancer_exclusions(people, prior_condition(ready, cfg, fixed.CANCER), cfg)


def stroke_exclusions(ready: Prepared, people: DataFrame, cfg: CohortConfig) -> DataFrame:
    """(person, reason) pairs of the stroke outcome."""
    return cohort.stroke_exclusions(people, prior_condition(ready, cfg, fixed.STROKE), cfg)


def cancer_table(ready: Prepared, people: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Cancer modelling table.

    Every exclusion can be read off the person's own row, so they are filters
    here; the list of reasons is not joined back.
    """
    prior = F.col("cancer_before_cut_off_binary") == 1
    rules = [*cohort.cancer_rules(people, cfg), (fixed.PRIOR_CANCER, prior)]
    labelled = cohort.cancer_cohort_labels(exclude_by_rules(people, rules), cfg)
    return cohort.cancer_model_table(labelled, site_outcomes(ready, cfg), cfg)


def stroke_table(ready: Prepared, people: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Stroke modelling table; prior strokes are a list of their own."""
    kept = exclude_by_rules(people, cohort.stroke_rules(people, cfg))
    kept = exclude(kept, prior_condition(ready, cfg, fixed.STROKE), cfg.entity)
    return cohort.stroke_model_table(kept, condition_outcome(ready, cfg, fixed.STROKE), cfg)
