"""From raw activity to one long list of coded events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortal.config import CohortConfig
from cohortal.fixed import (
    CODE_MAP_COLUMNS,
    FIRST_FINANCIAL_YEAR,
    NOT_A_DIAGNOSIS,
    OUTPATIENT_CODE_COLUMNS,
)
from cohortal.functions.text import drop_dots
from cohortal.operators.joins import lookup_join, salted_left_join
from cohortal.operators.longlist import (
    code_longlist,
    codes_in_columns,
    codes_in_text,
    fill_from_fallback,
    keep_one,
    spread_distinct,
    top_row,
    union_all,
)

SAME_DAY_CODE = ["date", "diagnosis"]
EVENT = ["date", "diagnosis", "source"]


def union_periods(
    periods: list[DataFrame], first_year: str = FIRST_FINANCIAL_YEAR
) -> DataFrame:
    """Raw outpatient tables of all periods, from the first financial year on."""
    return union_all(periods).where(F.col("Der_Financial_Year") >= F.lit(first_year))


def outpatient_with_codes(activity: DataFrame, raw: DataFrame) -> DataFrame:
    """Outpatient activity with its raw diagnosis row, matched on the id as text.

    The id names one attendance, so only nulls can be frequent.
    """
    keyed = raw.withColumn("OPA_Ident_str", F.col("OPA_Ident").cast("string"))
    return salted_left_join(activity, keyed, "opa_ident_min", "OPA_Ident_str", unique_left=True)


def best_mapping(fallback: DataFrame) -> DataFrame:
    """One fallback row per source code: first block, first group, highest priority."""
    order = [F.col("Map_Block").asc(), F.col("Map_Group").asc(), F.col("Map_Priority").desc()]
    return top_row(fallback, ["Referenced_Component_ID"], order)


def emergency_code_map(code_map: DataFrame, fallback: DataFrame) -> DataFrame:
    """Emergency code map with missing target codes taken from the fallback map.

    Only the fallback rows of codes without a target are ranked.
    """
    key = "Referenced_Component_ID"
    unmapped = code_map.where(F.col("ICD10_Mapping").isNull())
    unmapped = unmapped.select(F.col("SNOMED_Code").alias(key))
    filled = fill_from_fallback(
        code_map,
        best_mapping(fallback.join(unmapped, key, "left_semi")),
        key="SNOMED_Code",
        value="ICD10_Mapping",
        fallback_key="Referenced_Component_ID",
        fallback_value="Map_Target",
    )
    return filled.select(*CODE_MAP_COLUMNS)


def _activity(activity: DataFrame, cfg: CohortConfig, *columns: str) -> DataFrame:
    return activity.select(cfg.entity, "activity_id", "attendance_date", *columns)


def emergency_code_rows(activity: DataFrame, code_map: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Emergency codes mapped to the target code system, before duplicates go."""
    rows = code_longlist(_activity(activity, cfg, "dimention_8"), codes_in_text("dimention_8"))
    mapped = lookup_join(rows, code_map, "diagnosis", "SNOMED_Code")
    return mapped.select(
        cfg.entity,
        "activity_id",
        "date",
        F.col("diagnosis").alias("SNOMED_diagnosis"),
        "SNOMED_Code",
        "SNOMED_UK_Preferred_Term",
        "ECDS_Group1",
        "ECDS_Group2",
        "ECDS_Group3",
        "ECDS_Description",
        drop_dots(F.col("ICD10_Mapping")).alias("diagnosis"),
        F.lit("Emergency").alias("source"),
    )


def inpatient_code_rows(activity: DataFrame, cfg: CohortConfig) -> DataFrame:
    rows = code_longlist(_activity(activity, cfg, "dimention_8"), codes_in_text("dimention_8"))
    tagged = rows.withColumn("source", F.lit("Inpatient"))
    return tagged.select(cfg.entity, "activity_id", *EVENT)


def outpatient_code_rows(activity: DataFrame, cfg: CohortConfig) -> DataFrame:
    columns = OUTPATIENT_CODE_COLUMNS
    rows = code_longlist(_activity(activity, cfg, *columns), codes_in_columns(columns))
    return rows.withColumn("source", F.lit("OPA")).select(cfg.entity, "activity_id", *EVENT)


def emergency_codes(activity: DataFrame, code_map: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Emergency diagnoses, each code once per person and day."""
    return keep_one(emergency_code_rows(activity, code_map, cfg), [cfg.entity, *SAME_DAY_CODE])


def inpatient_codes(activity: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Inpatient diagnoses, each code once per person and day."""
    return keep_one(inpatient_code_rows(activity, cfg), [cfg.entity, *SAME_DAY_CODE])


def outpatient_codes(activity: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Outpatient diagnoses, each code once per person and day."""
    return keep_one(outpatient_code_rows(activity, cfg), [cfg.entity, *SAME_DAY_CODE])


def union_sources(
    inpatient: DataFrame,
    outpatient: DataFrame,
    emergency: DataFrame,
    cfg: CohortConfig,
    *,
    once_a_day: bool = False,
) -> DataFrame:
    """The three lists as one, without referrals and without events of no person.

    The referral test also drops emergency codes that found no target code. The lists may
    hold repeats: ``once_a_day`` keeps each code once per person, day and source, by a
    distinct over the four columns that are left.
    """
    emergency = emergency.where(F.col("diagnosis") != NOT_A_DIAGNOSIS)
    events = [t.select(cfg.entity, *EVENT) for t in (inpatient, outpatient, emergency)]
    known = union_all(events).where(F.col(cfg.entity).isNotNull())
    return spread_distinct(known) if once_a_day else known


def current_reference(reference: DataFrame) -> DataFrame:
    """Reference rows still in force that carry a category."""
    return reference.where(
        F.col("effective_to").isNull() & F.col("category_3_code").isNotNull()
    )


def combined_codes(
    inpatient: DataFrame,
    outpatient: DataFrame,
    emergency: DataFrame,
    reference: DataFrame,
    cfg: CohortConfig,
) -> DataFrame:
    """All coded events, each once a day, with their row of the current code reference."""
    events = union_sources(inpatient, outpatient, emergency, cfg, once_a_day=True)
    return lookup_join(events, current_reference(reference), "diagnosis", "alt_code")
