"""Queries for code maps, long lists and reference joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortal.fixed import CODE_MAP_COLUMNS
from cohortal.operators.longlist import code_longlist, codes_in_text, fill_from_fallback
from cohortal.plans import codes
from cohortal.sources.tables import stage
from registry import adapters as a
from registry.catalog import query

ID = "patient_pseudo_id"
EVENT = f"{ID}, activity_id, date, diagnosis, source"


@query("code_longlist", f"SELECT {ID}, activity_id, date, diagnosis FROM inpatient_rows")
def longlist(spark, sf):
    rows = code_longlist(a.inpatient(spark, sf), codes_in_text("dimention_8"))
    return rows.select(ID, "activity_id", "date", "diagnosis")


@query("code_longlist_columns", f"SELECT {EVENT} FROM outpatient_list")
def longlist_columns(spark, sf):
    merged = codes.outpatient_with_codes(
        a.outpatient(spark, sf), codes.union_periods(a.outpatient_raw(spark, sf), a.FIRST_YEAR)
    )
    return codes.outpatient_codes(merged, a.CFG)


@query("dedupe_event_code", f"SELECT {EVENT} FROM inpatient_list")
def dedupe(spark, sf):
    return codes.inpatient_codes(a.inpatient(spark, sf), a.CFG)


def _full_map(spark, sf):
    return codes.emergency_code_map(a.code_map(spark, sf), a.fallback_map(spark, sf))


def _staged_map(spark, sf):
    """The map is a table of its own: written once, then measured and joined."""
    return stage(_full_map(spark, sf), "code_map")


@query("longlist_mapped", "SELECT * FROM emergency_list")
def longlist_mapped(spark, sf):
    return codes.emergency_codes(a.emergency(spark, sf), _staged_map(spark, sf), a.CFG)


@query("best_mapping", "SELECT * FROM best_fallback")
def best_mapping(spark, sf):
    return codes.best_mapping(a.fallback_map(spark, sf))


@query(
    "mapping_fallback",
    """SELECT SNOMED_Code, coalesce(ICD10_Mapping, Map_Target) AS ICD10_Mapping
        FROM code_map LEFT JOIN best_fallback ON SNOMED_Code = Referenced_Component_ID""",
)
def mapping_fallback(spark, sf):
    return fill_from_fallback(
        a.code_map(spark, sf).select("SNOMED_Code", "ICD10_Mapping"),
        codes.best_mapping(a.fallback_map(spark, sf)),
        key="SNOMED_Code",
        value="ICD10_Mapping",
        fallback_key="Referenced_Component_ID",
        fallback_value="Map_Target",
    )


@query("code_map_with_fallback", f"SELECT {', '.join(CODE_MAP_COLUMNS)} FROM full_code_map")
def code_map_with_fallback(spark, sf):
    return _full_map(spark, sf)


@query("union_periods", "SELECT * FROM outpatient_periods")
def union_periods(spark, sf):
    return codes.union_periods(a.outpatient_raw(spark, sf), a.FIRST_YEAR)


@query("join_cast_key", "SELECT * FROM outpatient_merged")
def join_cast_key(spark, sf):
    periods = codes.union_periods(a.outpatient_raw(spark, sf), a.FIRST_YEAR)
    return codes.outpatient_with_codes(a.outpatient(spark, sf), periods)


def _three_lists(spark, sf):
    periods = codes.union_periods(a.outpatient_raw(spark, sf), a.FIRST_YEAR)
    merged = codes.outpatient_with_codes(a.outpatient(spark, sf), periods)
    return (
        codes.inpatient_code_rows(a.inpatient(spark, sf), a.CFG),
        codes.outpatient_code_rows(merged, a.CFG),
        codes.emergency_code_rows(a.emergency(spark, sf), _staged_map(spark, sf), a.CFG),
    )


@query("union_sources", "SELECT * FROM all_codes")
def union_sources(spark, sf):
    return codes.union_sources(*_three_lists(spark, sf), a.CFG, once_a_day=True)


@query(
    "filter_not_code", "SELECT SNOMED_Code, ICD10_Mapping FROM code_map WHERE ICD10_Mapping <> '#NIS'"
)
def filter_not_code(spark, sf):
    """Rows of the marker code go, and so do rows without a code."""
    kept = a.code_map(spark, sf).where(F.col("ICD10_Mapping") != codes.NOT_A_DIAGNOSIS)
    return kept.select("SNOMED_Code", "ICD10_Mapping")


@query("ref_current_only", "SELECT * FROM current_codes")
def ref_current_only(spark, sf):
    return codes.current_reference(a.code_reference(spark, sf))


@query(
    "join_reference",
    "SELECT c.*, r.* FROM all_codes c LEFT JOIN current_codes r ON c.diagnosis = r.alt_code",
)
def join_reference(spark, sf):
    return codes.combined_codes(*_three_lists(spark, sf), a.code_reference(spark, sf), a.CFG)
