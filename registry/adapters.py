"""The driver tables in the shape of the library's inputs.

Every adapter reads a whole driver table. Nulls, blanks, separators and unlisted
categories are derived from the keys, because the driver tables have none. The SQL
twins of these shapes are in ``views.py``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortal import CohortConfig
from cohortal import fixed
from cohortal.fixed import CODE_MAP_COLUMNS, OUTPATIENT_CODE_COLUMNS, SNAPSHOT_FLAGS
from cohortal.plans.build import Sources
from cohortal.sources.tables import read_table

CUTOFF = "1999-06-30"
CFG = CohortConfig(cutoff=CUTOFF)
# Events cover January 2024; they move so that 22 January falls on the cut-off.
CALL_SHIFT_DAYS = (date(2024, 1, 22) - date(1999, 6, 30)).days
CALLS_CFG = CohortConfig(cutoff=CUTOFF, lookback_weeks=(1, 2, 3))
FIRST_YEAR = "1996/1997"
TIE_BREAK = ["snapshot_id"]


def code(key: str) -> str:
    """Spark SQL for a letter and two digits made from an integer key."""
    digits = f"lpad(cast(({key}) div 26 * 29 % 100 as string), 2, '0')"
    return f"concat(char(65 + ({key}) % 26), {digits})"


# Schemas of the driver tables by path. Several adapters start from one table, and finding
# its schema is a job of its own.
_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = read_table(spark, path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def person(spark: SparkSession, sf: str) -> DataFrame:
    tri = "case {0} % 3 when 1 then true when 2 then false end"
    return table(spark, sf, "customer").selectExpr(
        "cast(c_custkey as string) as patient_pseudo_id",
        "cast(case when c_custkey % 17 <> 0 then 30 + c_custkey % 95 end as int) as age",
        """case c_custkey % 7 when 1 then '' when 2 then 'Female' when 3 then 'Male'
           when 4 then 'Not specified' when 5 then 'Not known' when 6 then 'Male' end as gender""",
        """case when c_custkey % 20 between 1 and 17
                then substr('ABCDEFGHJKLMNPRSX', cast(c_custkey % 20 as int), 1)
                when c_custkey % 20 = 18 then '99' when c_custkey % 20 = 19 then 'Z'
           end as ethnicity_code""",
        """case c_custkey % 12 when 0 then null when 11 then ''
           else cast(c_custkey % 12 as string) end as imd_decile""",
        "cast(nullif(c_custkey % 70, 0) as string) as acorn_household_type",
        "concat('type ', cast(c_custkey % 4 as string)) as acorn_wellbeing_type",
        """case c_custkey % 6 when 1 then 'Rural village' when 2 then 'Urban major conurbation'
           when 3 then 'Rural town and fringe' when 4 then 'Urban city and town'
           when 5 then 'Elsewhere' end as rural_urban_classification""",
        "c_mktsegment as ccg_of_residence",
        tri.format("c_custkey") + " as living_alone",
        tri.format("(c_custkey div 3)") + " as living_with_young",
        tri.format("(c_custkey div 9)") + " as living_with_elderly",
        tri.format("(c_custkey div 27)") + " as private_outdoor_space",
        """case when c_custkey % 5 = 0
           then date_add(date'1998-06-30', cast(c_custkey % 800 as int)) end as death_month""",
        "cast(case when c_custkey % 4 = 1 then 1 else 0 end as int) as deducted",
        "case c_custkey % 3 when 1 then 'DEA' when 2 then 'TRA' end as deduction_reason",
        """case when c_custkey % 13 <> 0
           then concat('L', cast(c_nationkey as string)) end as lsoa_2011_code""",
        "cast(c_custkey % 2 as int) as care_home",
        "cast(c_custkey % 10 div 9 as int) as registered_with_closed_practice",
        "cast(c_custkey % 8 div 7 as int) as diabetes",
        "cast(c_custkey % 9 div 8 as int) as immunocompromised",
        "concat('A', cast(c_custkey % 5 as string)) as acorn_type",
    )


def boards(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return joined.selectExpr(
        "concat('L', cast(n_nationkey as string)) as LSOA11CD",
        "concat(r_name, ' (Board-', cast(n_regionkey as string), ')') as ICB22NM",
    )


def alliances(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.selectExpr(
        "concat('L', cast(n_nationkey as string)) as LSOA11CD",
        "case when r_name <> 'ASIA' then concat(r_name, ' & Alliance') end as CAL19NM",
    )


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with their person: the activity rows of all three settings."""
    lineitem, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    joined = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    return joined.selectExpr(
        "case when l_quantity <> 13 then cast(o_custkey as string) end as patient_pseudo_id",
        """concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string),
           cast(l_partkey as string), cast(l_suppkey as string)) as activity_id""",
        "cast(l_shipdate as date) as attendance_date",
        "l_returnflag",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
    )


def events(spark: SparkSession, sf: str) -> DataFrame:
    """One coded event per order line: the simplest long list."""
    return lines(spark, sf).where("patient_pseudo_id is not null").selectExpr(
        "patient_pseudo_id", "activity_id", "attendance_date as date", f"{code('l_partkey')} as diagnosis"
    )


def _coded_activity(spark: SparkSession, sf: str, setting: str, text: str) -> DataFrame:
    return lines(spark, sf).where(f"l_returnflag = '{setting}'").selectExpr(
        "patient_pseudo_id",
        "activity_id",
        "attendance_date",
        f"case l_linenumber when 7 then null when 6 then '' else {text} end as dimention_8",
    )


def emergency(spark: SparkSession, sf: str) -> DataFrame:
    text = """concat(' ', cast(l_partkey + l_linenumber as string), ' |,,',
        cast(l_suppkey as string), '-')"""
    return _coded_activity(spark, sf, "A", text)


def inpatient(spark: SparkSession, sf: str) -> DataFrame:
    text = f"concat({code('l_partkey')}, ' ,', {code('l_suppkey * 3 + l_linenumber')}, '-|')"
    return _coded_activity(spark, sf, "N", text)


def outpatient(spark: SparkSession, sf: str) -> DataFrame:
    return lines(spark, sf).where("l_returnflag = 'R'").selectExpr(
        "patient_pseudo_id",
        "activity_id",
        "attendance_date",
        """case when l_quantity <> 7
           then cast(l_orderkey * 10 + l_linenumber as string) end as opa_ident_min""",
    )


def outpatient_raw(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Raw outpatient diagnoses in four period tables."""
    first, second, third, *rest = OUTPATIENT_CODE_COLUMNS
    raw = table(spark, sf, "lineitem").where("l_returnflag = 'R'").selectExpr(
        "l_orderkey * 10 + l_linenumber as OPA_Ident",
        """concat(cast(year(l_shipdate) as string), '/', cast(year(l_shipdate) + 1 as string))
           as Der_Financial_Year""",
        f"case l_linenumber when 6 then null when 5 then '' else {code('l_partkey')} end as {first}",
        f"concat(' ', {code('l_suppkey * 11 + l_linenumber')}, '-') as {second}",
        f"' ' as {third}",
        *[f"cast(null as string) as {c}" for c in rest],
    )
    year = "cast(substr(Der_Financial_Year, 1, 4) as int)"
    periods = [f"{year} < 1997", f"{year} = 1997", f"{year} = 1998", f"{year} > 1998"]
    return [raw.where(p) for p in periods]


def code_map(spark: SparkSession, sf: str) -> DataFrame:
    made = {
        "ECDS_UniqueID": "p_partkey",
        "ECDS_Group1": "p_type",
        "ECDS_Group2": "p_brand",
        "ECDS_Group3": "concat('size ', cast(p_size as string))",
        "ECDS_Description": "p_name",
        "SNOMED_Code": "cast(p_partkey as string)",
        "SNOMED_UK_Preferred_Term": "concat(p_name, ' disorder')",
        "ICD10_Mapping": f"""case when p_partkey % 7 = 0 then null
            when p_partkey % 41 = 1 then '#NIS'
            else concat({code('p_partkey')}, '.', cast(p_size % 10 as string)) end""",
    }
    columns = [f"{made.get(c, 'cast(null as string)')} as {c}" for c in CODE_MAP_COLUMNS]
    return table(spark, sf, "part").selectExpr(*columns)


def fallback_map(spark: SparkSession, sf: str) -> DataFrame:
    """Many rows per source code; only even codes have any."""
    return table(spark, sf, "lineitem").selectExpr(
        "cast(l_partkey * 2 as string) as Referenced_Component_ID",
        "l_linenumber as Map_Block",
        "cast(l_quantity as int) as Map_Group",
        "l_suppkey as Map_Priority",
        f"{code('l_orderkey')} as Map_Target",
    )


def code_reference(spark: SparkSession, sf: str) -> DataFrame:
    """Code, its category block, and an end date for superseded rows."""
    codes = table(spark, sf, "part").selectExpr(f"{code('p_partkey')} as alt_code").distinct()
    letter, digits = "substr(alt_code, 1, 1)", "substr(alt_code, 2, 2)"
    return codes.selectExpr(
        "alt_code",
        f"""case when {digits} = '07' then null
            when {digits} < '80' then concat({letter}, '00-', {letter}, '79')
            else concat({letter}, '80-', {letter}, '99') end as category_3_code""",
        f"case when {digits} = '13' then date'2010-01-01' end as effective_to",
        "concat('code ', alt_code) as description",
    )


CATEGORIES = [
    f"{chr(65 + n)}{low}-{chr(65 + n)}{high}"
    for n in range(26)
    for low, high in (("00", "79"), ("80", "99"))
]

# Every value of the categories, blanks included, as the adapters above make them.
CATEGORY_VALUES = {
    "gender": [*fixed.GENDERS, "unknown"],
    "ethnicity_code": [*fixed.ETHNICITIES, "Z", "unknown"],
    "imd_decile": fixed.DECILES,
    "acorn_household_type": [*[str(n) for n in range(1, 70)], "unknown"],
    "acorn_wellbeing_type": [f"type {n}" for n in range(4)],
    "rural_urban_classification": [
        "Rural village", "Urban major conurbation", "Rural town and fringe",
        "Urban city and town", "Elsewhere", "unknown",
    ],
    "ccg_of_residence": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "nhs_region": fixed.REGIONS,
    "stp_code": ["QF", "QO", "QP"],
}

SYMPTOM = """case event_type when 'click' then 'Cough' when 'error' then 'Tiredness (Fatigue)'
    when 'purchase' then 'Abdominal Pain, Rectal Bleeding, Pregnant Over 20 Weeks'
    when 'signup' then 'Pain and/or Frequency Passing Urine' else 'Earache' end"""
UNRELATED_LABEL = "Earache"
CALL_LABELS = [
    "Abdominal_Pain__Rectal_Bleeding__Pregnant_Over_20_Weeks",
    "Cough",
    "Pain_and/or_Frequency_Passing_Urine",
    "Tiredness__Fatigue_",
]


def calls(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "case when value <> 5 then cast(user_id as string) end as patient_pseudo_id",
        "case when get_json_object(props, '$.k') < 10 then 1 else 2 end as site_type_id",
        f"ts - interval {CALL_SHIFT_DAYS} days as call_date",
        f"{SYMPTOM} as symptom_group",
    )


def symptoms(spark: SparkSession, sf: str) -> DataFrame:
    groups = table(spark, sf, "events").selectExpr(f"{SYMPTOM} as symptom_group").distinct()
    return groups.selectExpr(
        "symptom_group", "case when symptom_group = 'Earache' then 'N' else 'Y' end as cancer_related"
    )


def mortality(spark: SparkSession, sf: str) -> DataFrame:
    causes = [
        f"case when o_orderkey % {n + 3} = 0 then {code(f'o_orderkey * {n + 1} + {n}')} end"
        f" as s_cod_code_{n}"
        for n in range(1, 16)
    ]
    return table(spark, sf, "orders").selectExpr(
        "cast(o_custkey as string) as patient_pseudo_id",
        "o_orderkey as activity_id",
        "cast(o_orderdate as date) as reg_date_of_death",
        f"{code('o_orderkey')} as s_underlying_cod_icd10",
        *causes,
    )


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    flags = [
        f"cast(case (o_orderkey + {i}) % 7 when 0 then 1 when 3 then null else 0 end as int) as {c}"
        for i, c in enumerate(SNAPSHOT_FLAGS)
    ]
    return table(spark, sf, "orders").selectExpr(
        "cast(o_custkey as string) as patient_pseudo_id",
        "o_orderkey as snapshot_id",
        "cast(o_orderdate as date) as date",
        "date_add(date'1940-01-01', cast(o_custkey % 10000 as int)) as date_of_birth",
        "cast(null as date) as date_of_death",
        "concat('S', cast(o_orderkey % 4 as string)) as highest_acuity_segment_code",
        "concat('segment ', cast(o_orderkey % 4 as string)) as highest_acuity_segment_name",
        "o_orderpriority as highest_acuity_segment_description",
        """case o_orderpriority when '1-URGENT' then 'London' when '2-HIGH' then 'South East'
           when '4-NOT SPECIFIED' then '' when '5-LOW' then 'North West' end as nhs_region""",
        "concat('Q', o_orderstatus) as stp_code",
        *flags,
    )


def sources(spark: SparkSession, sf: str) -> Sources:
    p1, p2, p3, p4 = outpatient_raw(spark, sf)
    return Sources(
        person=person(spark, sf),
        mortality=mortality(spark, sf),
        calls=calls(spark, sf),
        symptoms=symptoms(spark, sf),
        snapshots=snapshots(spark, sf),
        emergency=emergency(spark, sf),
        inpatient=inpatient(spark, sf),
        outpatient=outpatient(spark, sf),
        outpatient_2008_2020=p1,
        outpatient_2021=p2,
        outpatient_2022=p3,
        outpatient_2023=p4,
        code_map=code_map(spark, sf),
        fallback_map=fallback_map(spark, sf),
        code_reference=code_reference(spark, sf),
        boards=boards(spark, sf),
        alliances=alliances(spark, sf),
    )
