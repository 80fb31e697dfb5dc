"""Person-level features before the cut-off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortal.config import CohortConfig, ConditionRule
from cohortal.fixed import CAUSE_COLUMNS, GEOGRAPHY_COLUMNS, SITE_CODES, SNAPSHOT_CATEGORIES
from cohortal.functions.text import keep_alphanumeric, like_any, underscore_label
from cohortal.functions.weeks import Timeline
from cohortal.operators.dictionary import CodeDictionary, ShortCodes
from cohortal.operators.encode import clean_one_hot, discover_values
from cohortal.operators.joins import assert_unique, lookup_join
from cohortal.operators.labels import outcome_labels
from cohortal.operators.longlist import latest_row
from cohortal.operators.lookback import lookback_counts, lookback_with_labels
from cohortal.operators.sites import site_tag
from cohortal.operators.summary import (
    category_summary,
    group_summary,
    pivot_categories,
    pivot_sites,
    site_summary,
)

CATEGORY = "category_3_code"
SITE = "cancer_type"


def emergency_features(activity: DataFrame, cfg: CohortConfig) -> DataFrame:
    return lookback_counts(
        activity,
        cfg,
        time="attendance_date",
        total="ae_attend_total",
        prefix="ae_attendances_last_",
        coded="dimention_8",
        coded_total="aea_diagnoses_total",
        coded_pct="ae_diagnosis_pct_of_attendnaces",
    )


def inpatient_features(activity: DataFrame, cfg: CohortConfig) -> DataFrame:
    return lookback_counts(
        activity,
        cfg,
        time="attendance_date",
        total="IP_attend_total",
        prefix="IP_attendances_last_",
        coded="dimention_8",
        coded_total="IP_diagnoses_total",
        coded_pct="IP_diagnosis_pct_of_attendnaces",
    )


def outpatient_features(activity: DataFrame, cfg: CohortConfig) -> DataFrame:
    return lookback_counts(
        activity,
        cfg,
        time="attendance_date",
        total="opa_attend_total",
        prefix="OPA_attendances_last_",
        coded="Primary_Diagnosis_Code",
        coded_total="opa_diagnoses_total",
        coded_pct="opa_diagnosis_pct_of_attendnaces",
    )


# Site type of the calls that count, and the marker of a related symptom.
CALL_SITE_TYPE = 2
RELATED = "Y"


def symptom_labels(symptoms: DataFrame) -> list[str]:
    """Column labels of the related symptoms, read from the symptom reference."""
    label = underscore_label(F.col("symptom_group")).alias("label")
    related = symptoms.where(F.col("cancer_related") == RELATED).select(label)
    return discover_values(related, ["label"])["label"]


def call_features(
    calls: DataFrame,
    symptoms: DataFrame,
    cfg: CohortConfig,
    labels: list[str] | None = None,
) -> DataFrame:
    """Calls in total, in each window, with a related symptom, and per symptom."""
    assert_unique(symptoms, "symptom_group")
    if labels is None:
        labels = symptom_labels(symptoms)
    calls = calls.where(F.col("site_type_id") == CALL_SITE_TYPE)
    reference = symptoms.select(F.col("symptom_group").alias("_symptom"), "cancer_related")
    joined = lookup_join(calls, reference, "symptom_group", "_symptom")
    label = F.when(F.col("cancer_related") == RELATED, underscore_label(F.col("symptom_group")))
    return lookback_with_labels(
        joined.select(cfg.entity, "call_date", label.alias("label")),
        cfg,
        time="call_date",
        label="label",
        values=labels,
        prefix="111_calls_last_",
        total="111_calls_total",
        related_prefix="111_calls_cancer_last_",
    )


def snapshot_features(
    snapshots: DataFrame,
    cfg: CohortConfig,
    values: dict[str, list[str]] | None = None,
    tie_break: list[str | Column] | None = None,
) -> DataFrame:
    """Latest health-record snapshot per person with its two categories one-hot."""
    latest = latest_row(snapshots, cfg.entity, "date", tie_break)
    return clean_one_hot(latest, SNAPSHOT_CATEGORIES, values, suffix="_null_removed")


def geography_features(
    boards: DataFrame,
    alliances: DataFrame,
    person: DataFrame,
    cfg: CohortConfig,
    values: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Care board and alliance of each person's area, sanitised and one-hot."""
    alliance = alliances.select(F.col("LSOA11CD").alias("_area"), "CAL19NM")
    areas = lookup_join(boards, alliance, "LSOA11CD", "_area").select(
        "LSOA11CD",
        keep_alphanumeric(F.col("CAL19NM")).alias("cancer_alliance"),
        keep_alphanumeric(F.col("ICB22NM")).alias("integrated_care_board"),
    )
    located = lookup_join(
        person.select(cfg.entity, "lsoa_2011_code"), areas, "lsoa_2011_code", "LSOA11CD"
    ).drop("lsoa_2011_code")
    suffix = "_null_removed"
    encoded = clean_one_hot(located, GEOGRAPHY_COLUMNS, values, suffix=suffix)
    return encoded.drop(*[c + suffix for c in GEOGRAPHY_COLUMNS])


def category_features(
    events: DataFrame,
    cfg: CohortConfig,
    categories: list[str] | None = None,
    dictionary: CodeDictionary | ShortCodes | None = None,
) -> DataFrame:
    """First diagnosis and recency of every category, one row per person.

    Undeclared categories are those of the events before the cut-off, found in a
    job of its own.
    """
    past = events.where(Timeline(events, cfg, "date").before())
    if categories is None:
        categories = discover_values(past, [CATEGORY])[CATEGORY]
    past = past.where(F.col(CATEGORY).isin(categories))
    summary = category_summary(past, cfg, CATEGORY, dictionary=dictionary)
    return pivot_categories(summary, cfg, CATEGORY, categories)


def prior_condition(
    events: DataFrame,
    cfg: CohortConfig,
    rule: ConditionRule,
    *,
    same_code: bool = True,
    dictionary: CodeDictionary | ShortCodes | None = None,
) -> DataFrame:
    """Diagnoses of the condition before the cut-off, one row per person."""
    past = events.where(Timeline(events, cfg, "date").before() & rule.matches(F.col("diagnosis")))
    name = f"{rule.name}_before_cut_off"
    return group_summary(past, cfg, name, same_code=same_code, dictionary=dictionary)


def named_group(
    events: DataFrame, cfg: CohortConfig, name: str, patterns: list[str]
) -> DataFrame:
    """As ``prior_condition`` for a named group of LIKE patterns."""
    hit = like_any(F.col("diagnosis"), patterns)
    past = events.where(Timeline(events, cfg, "date").before() & hit)
    return group_summary(past, cfg, name)


def condition_outcome(
    events: DataFrame,
    cfg: CohortConfig,
    rule: ConditionRule,
    dictionary: CodeDictionary | None = None,
) -> DataFrame:
    """First and latest diagnosis after the cut-off, and one label per horizon."""
    later = events.where(Timeline(events, cfg, "date").after() & rule.matches(F.col("diagnosis")))
    return outcome_labels(later, cfg, rule.name, dictionary=dictionary)


def site_outcomes(
    events: DataFrame,
    cfg: CohortConfig,
    sites: list[str] | None = None,
    dictionary: CodeDictionary | None = None,
) -> DataFrame:
    """Outcomes per disease site, one row per person."""
    sites = sites or list(SITE_CODES)
    later = events.where(Timeline(events, cfg, "date").after())
    tagged = site_tag(later.select(cfg.entity, "date", "diagnosis"), out=SITE)
    summary = site_summary(tagged, cfg, SITE, values=list(SITE_CODES), dictionary=dictionary)
    return pivot_sites(summary, cfg, SITE, sites)


def latest_mortality(mortality: DataFrame, cfg: CohortConfig) -> DataFrame:
    """One mortality row per person: the one with the greatest activity id."""
    columns = [cfg.entity, "reg_date_of_death", *CAUSE_COLUMNS]
    return latest_row(mortality.select(*columns, "activity_id"), cfg.entity, "activity_id").select(
        *columns
    )


