"""SQL twins of the adapters, as named views that queries pull in by name."""

from __future__ import annotations

import re

from cohortal.fixed import (
    CODE_MAP_COLUMNS,
    OUTPATIENT_CODE_COLUMNS,
    SITE_CODES,
    SNAPSHOT_FLAGS,
)
from registry.adapters import CALL_SHIFT_DAYS, CUTOFF, FIRST_YEAR

CUT = f"DATE '{CUTOFF}'"


def code(key: str) -> str:
    """DuckDB SQL for a letter and two digits made from an integer key."""
    return f"chr((65 + ({key}) % 26)::INT) || lpad((({key}) // 26 * 29 % 100)::VARCHAR, 2, '0')"


def weeks(n: int) -> str:
    """Day n weeks after the cut-off; before it for a negative n."""
    return f"({CUT} + ({7 * n}))"


def cleaned(col: str) -> str:
    return f"translate({col}, ' |,-', '')"


def sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


_TRI = "CASE {0} % 3 WHEN 1 THEN true WHEN 2 THEN false END"
_RAW_FIRST, _RAW_SECOND, _RAW_THIRD, *_RAW_REST = OUTPATIENT_CODE_COLUMNS
_CODE_MAP = {
    "ECDS_UniqueID": "p_partkey",
    "ECDS_Group1": "p_type",
    "ECDS_Group2": "p_brand",
    "ECDS_Group3": "'size ' || p_size",
    "ECDS_Description": "p_name",
    "SNOMED_Code": "p_partkey::VARCHAR",
    "SNOMED_UK_Preferred_Term": "p_name || ' disorder'",
    "ICD10_Mapping": f"""CASE WHEN p_partkey % 7 = 0 THEN NULL
        WHEN p_partkey % 41 = 1 THEN '#NIS'
        ELSE {code('p_partkey')} || '.' || (p_size % 10) END""",
}


def _coded_activity(setting: str, text: str) -> str:
    return f"""SELECT patient_pseudo_id, activity_id, attendance_date,
        CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN '' ELSE {text} END AS dimention_8
        FROM activity_lines WHERE l_returnflag = '{setting}'"""


VIEWS = {
    "person": f"""SELECT c_custkey::VARCHAR AS patient_pseudo_id,
        CASE WHEN c_custkey % 17 <> 0 THEN 30 + c_custkey % 95 END::INT AS age,
        CASE c_custkey % 7 WHEN 1 THEN '' WHEN 2 THEN 'Female' WHEN 3 THEN 'Male'
            WHEN 4 THEN 'Not specified' WHEN 5 THEN 'Not known' WHEN 6 THEN 'Male' END AS gender,
        CASE WHEN c_custkey % 20 BETWEEN 1 AND 17
                THEN substr('ABCDEFGHJKLMNPRSX', (c_custkey % 20)::INT, 1)
            WHEN c_custkey % 20 = 18 THEN '99' WHEN c_custkey % 20 = 19 THEN 'Z'
            END AS ethnicity_code,
        CASE c_custkey % 12 WHEN 0 THEN NULL WHEN 11 THEN ''
            ELSE (c_custkey % 12)::VARCHAR END AS imd_decile,
        nullif(c_custkey % 70, 0)::VARCHAR AS acorn_household_type,
        'type ' || (c_custkey % 4) AS acorn_wellbeing_type,
        CASE c_custkey % 6 WHEN 1 THEN 'Rural village' WHEN 2 THEN 'Urban major conurbation'
            WHEN 3 THEN 'Rural town and fringe' WHEN 4 THEN 'Urban city and town'
            WHEN 5 THEN 'Elsewhere' END AS rural_urban_classification,
        c_mktsegment AS ccg_of_residence,
        {_TRI.format('c_custkey')} AS living_alone,
        {_TRI.format('(c_custkey // 3)')} AS living_with_young,
        {_TRI.format('(c_custkey // 9)')} AS living_with_elderly,
        {_TRI.format('(c_custkey // 27)')} AS private_outdoor_space,
        CASE WHEN c_custkey % 5 = 0
            THEN DATE '1998-06-30' + (c_custkey % 800)::INT END AS death_month,
        CASE WHEN c_custkey % 4 = 1 THEN 1 ELSE 0 END::INT AS deducted,
        CASE c_custkey % 3 WHEN 1 THEN 'DEA' WHEN 2 THEN 'TRA' END AS deduction_reason,
        CASE WHEN c_custkey % 13 <> 0 THEN 'L' || c_nationkey END AS lsoa_2011_code,
        (c_custkey % 2)::INT AS care_home,
        (c_custkey % 10 // 9)::INT AS registered_with_closed_practice,
        (c_custkey % 8 // 7)::INT AS diabetes,
        (c_custkey % 9 // 8)::INT AS immunocompromised,
        'A' || (c_custkey % 5) AS acorn_type
        FROM customer""",
    "boards": """SELECT 'L' || n_nationkey AS LSOA11CD,
        r_name || ' (Board-' || n_regionkey || ')' AS ICB22NM
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "alliances": """SELECT 'L' || n_nationkey AS LSOA11CD,
        CASE WHEN r_name <> 'ASIA' THEN r_name || ' & Alliance' END AS CAL19NM
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "activity_lines": """SELECT
        CASE WHEN l_quantity <> 13 THEN o_custkey::VARCHAR END AS patient_pseudo_id,
        l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS activity_id,
        l_shipdate::DATE AS attendance_date,
        l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "coded_events": f"""SELECT patient_pseudo_id, activity_id, attendance_date AS date,
        {code('l_partkey')} AS diagnosis
        FROM activity_lines WHERE patient_pseudo_id IS NOT NULL""",
    "emergency": _coded_activity("A", "' ' || (l_partkey + l_linenumber) || ' |,,' || l_suppkey || '-'"),
    "inpatient": _coded_activity(
        "N", f"{code('l_partkey')} || ' ,' || {code('l_suppkey * 3 + l_linenumber')} || '-|'"
    ),
    "outpatient": """SELECT patient_pseudo_id, activity_id, attendance_date,
        CASE WHEN l_quantity <> 7 THEN (l_orderkey * 10 + l_linenumber)::VARCHAR END
            AS opa_ident_min
        FROM activity_lines WHERE l_returnflag = 'R'""",
    "outpatient_raw": f"""SELECT l_orderkey * 10 + l_linenumber AS OPA_Ident,
        year(l_shipdate) || '/' || (year(l_shipdate) + 1) AS Der_Financial_Year,
        CASE l_linenumber WHEN 6 THEN NULL WHEN 5 THEN ''
            ELSE {code('l_partkey')} END AS {_RAW_FIRST},
        ' ' || {code('l_suppkey * 11 + l_linenumber')} || '-' AS {_RAW_SECOND},
        ' ' AS {_RAW_THIRD},
        {', '.join(f'NULL::VARCHAR AS {c}' for c in _RAW_REST)}
        FROM lineitem WHERE l_returnflag = 'R'""",
    "outpatient_periods": f"""SELECT * FROM outpatient_raw
        WHERE Der_Financial_Year >= '{FIRST_YEAR}'""",
    "outpatient_merged": """SELECT a.*, r.*, r.OPA_Ident::VARCHAR AS OPA_Ident_str
        FROM outpatient a LEFT JOIN outpatient_periods r
            ON a.opa_ident_min = r.OPA_Ident::VARCHAR""",
    "code_map": "SELECT "
    + ", ".join(f"{_CODE_MAP.get(c, 'NULL::VARCHAR')} AS {c}" for c in CODE_MAP_COLUMNS)
    + " FROM part",
    "fallback_map": f"""SELECT (l_partkey * 2)::VARCHAR AS Referenced_Component_ID,
        l_linenumber AS Map_Block, l_quantity::INT AS Map_Group, l_suppkey AS Map_Priority,
        {code('l_orderkey')} AS Map_Target
        FROM lineitem""",
    "best_fallback": """SELECT Referenced_Component_ID, Map_Block, Map_Group, Map_Priority, Map_Target
        FROM (SELECT *, row_number() OVER (PARTITION BY Referenced_Component_ID
            ORDER BY Map_Block, Map_Group, Map_Priority DESC, Map_Target) AS rn
            FROM fallback_map) WHERE rn = 1""",
    "full_code_map": f"""SELECT {', '.join(c for c in CODE_MAP_COLUMNS)} FROM code_map
            WHERE ICD10_Mapping IS NOT NULL
        UNION ALL
        SELECT {', '.join('Map_Target' if c == 'ICD10_Mapping' else c for c in CODE_MAP_COLUMNS)}
            FROM code_map LEFT JOIN best_fallback ON SNOMED_Code = Referenced_Component_ID
            WHERE ICD10_Mapping IS NULL""",
    "code_reference": f"""SELECT alt_code,
        CASE WHEN substr(alt_code, 2, 2) = '07' THEN NULL
            WHEN substr(alt_code, 2, 2) < '80'
                THEN substr(alt_code, 1, 1) || '00-' || substr(alt_code, 1, 1) || '79'
            ELSE substr(alt_code, 1, 1) || '80-' || substr(alt_code, 1, 1) || '99'
            END AS category_3_code,
        CASE WHEN substr(alt_code, 2, 2) = '13' THEN DATE '2010-01-01' END AS effective_to,
        'code ' || alt_code AS description
        FROM (SELECT DISTINCT {code('p_partkey')} AS alt_code FROM part)""",
    "current_codes": """SELECT * FROM code_reference
        WHERE effective_to IS NULL AND category_3_code IS NOT NULL""",
    "emergency_rows": f"""SELECT patient_pseudo_id, activity_id, date,
        x.diagnosis AS SNOMED_diagnosis, SNOMED_Code, SNOMED_UK_Preferred_Term,
        ECDS_Group1, ECDS_Group2, ECDS_Group3, ECDS_Description,
        replace(ICD10_Mapping, '.', '') AS diagnosis, 'Emergency' AS source
        FROM (SELECT patient_pseudo_id, activity_id, attendance_date AS date,
                {cleaned('part')} AS diagnosis
            FROM (SELECT *, unnest(string_split(dimention_8, ',')) AS part FROM emergency)
            WHERE {cleaned('part')} <> '') x
        LEFT JOIN full_code_map ON x.diagnosis = SNOMED_Code""",
    "inpatient_rows": f"""SELECT patient_pseudo_id, activity_id, attendance_date AS date,
        {cleaned('part')} AS diagnosis, 'Inpatient' AS source
        FROM (SELECT *, unnest(string_split(dimention_8, ',')) AS part FROM inpatient)
        WHERE {cleaned('part')} <> ''""",
    "outpatient_rows": f"""SELECT patient_pseudo_id, activity_id, attendance_date AS date,
        {cleaned('part')} AS diagnosis, 'OPA' AS source
        FROM (SELECT *, unnest([{', '.join(OUTPATIENT_CODE_COLUMNS)}]) AS part
            FROM outpatient_merged)
        WHERE {cleaned('part')} <> ''""",
    "inpatient_list": """SELECT patient_pseudo_id, min(activity_id) AS activity_id, date,
        diagnosis, source FROM inpatient_rows GROUP BY ALL""",
    "outpatient_list": """SELECT patient_pseudo_id, min(activity_id) AS activity_id, date,
        diagnosis, source FROM outpatient_rows GROUP BY ALL""",
    "emergency_list": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
            PARTITION BY patient_pseudo_id, date, diagnosis
            ORDER BY activity_id, SNOMED_diagnosis, SNOMED_Code, SNOMED_UK_Preferred_Term,
                ECDS_Group1, ECDS_Group2, ECDS_Group3, ECDS_Description) AS rn
            FROM emergency_rows) WHERE rn = 1""",
    "all_codes": """SELECT * FROM (
            SELECT patient_pseudo_id, date, diagnosis, source FROM inpatient_list
            UNION ALL SELECT patient_pseudo_id, date, diagnosis, source FROM outpatient_list
            UNION ALL SELECT patient_pseudo_id, date, diagnosis, source FROM emergency_list
                WHERE diagnosis <> '#NIS')
        WHERE patient_pseudo_id IS NOT NULL""",
    "calls": f"""SELECT CASE WHEN value <> 5 THEN user_id::VARCHAR END AS patient_pseudo_id,
        CASE WHEN json_extract_string(props, '$.k')::INT < 10 THEN 1 ELSE 2 END AS site_type_id,
        ts - INTERVAL {CALL_SHIFT_DAYS} DAY AS call_date,
        CASE event_type WHEN 'click' THEN 'Cough' WHEN 'error' THEN 'Tiredness (Fatigue)'
            WHEN 'purchase' THEN 'Abdominal Pain, Rectal Bleeding, Pregnant Over 20 Weeks'
            WHEN 'signup' THEN 'Pain and/or Frequency Passing Urine'
            ELSE 'Earache' END AS symptom_group
        FROM events""",
    "symptoms": """SELECT DISTINCT symptom_group,
        CASE WHEN symptom_group = 'Earache' THEN 'N' ELSE 'Y' END AS cancer_related FROM calls""",
    "past_calls": f"""SELECT patient_pseudo_id, call_date,
        CASE WHEN cancer_related = 'Y'
            THEN regexp_replace(calls.symptom_group, '[ ,()]', '_', 'g') END AS label
        FROM calls LEFT JOIN symptoms ON calls.symptom_group = symptoms.symptom_group
        WHERE site_type_id = 2 AND patient_pseudo_id IS NOT NULL AND call_date < {CUT}""",
    "mortality": f"""SELECT o_custkey::VARCHAR AS patient_pseudo_id, o_orderkey AS activity_id,
        o_orderdate::DATE AS reg_date_of_death, {code('o_orderkey')} AS s_underlying_cod_icd10,
        """
    + ", ".join(
        f"CASE WHEN o_orderkey % {n + 3} = 0 THEN {code(f'o_orderkey * {n + 1} + {n}')} END"
        f" AS s_cod_code_{n}"
        for n in range(1, 16)
    )
    + " FROM orders",
    "snapshots": """SELECT o_custkey::VARCHAR AS patient_pseudo_id, o_orderkey AS snapshot_id,
        o_orderdate::DATE AS date, DATE '1940-01-01' + (o_custkey % 10000)::INT AS date_of_birth,
        NULL::DATE AS date_of_death,
        'S' || (o_orderkey % 4) AS highest_acuity_segment_code,
        'segment ' || (o_orderkey % 4) AS highest_acuity_segment_name,
        o_orderpriority AS highest_acuity_segment_description,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'London' WHEN '2-HIGH' THEN 'South East'
            WHEN '4-NOT SPECIFIED' THEN '' WHEN '5-LOW' THEN 'North West' END AS nhs_region,
        'Q' || o_orderstatus AS stp_code,
        """
    + ", ".join(
        f"CASE (o_orderkey + {i}) % 7 WHEN 0 THEN 1 WHEN 3 THEN NULL ELSE 0 END::INT AS {c}"
        for i, c in enumerate(SNAPSHOT_FLAGS)
    )
    + " FROM orders",
    "latest_snapshot": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
            PARTITION BY patient_pseudo_id ORDER BY date DESC, snapshot_id) AS rn
            FROM snapshots) WHERE rn = 1""",
    "sites": "SELECT * FROM (VALUES "
    + ", ".join(f"('{s}', '{'|'.join(codes)}')" for s, codes in SITE_CODES.items())
    + ") AS t(cancer_type, pattern)",
    "site_events": """SELECT e.*, cancer_type FROM coded_events e
        JOIN sites ON regexp_matches(e.diagnosis, pattern)""",
}


def with_views(body: str) -> str:
    """Prefix a query with the views it needs, directly or through other views."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", todo.pop()))
        for name in words & set(VIEWS) - needed:
            needed.add(name)
            todo.append(VIEWS[name])
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed)
    return f"WITH {ctes}\n{body}"
