"""Exclusion lists from narrow facts against those read off the wide person table."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan_of, same_rows
from pyspark.sql import functions as F

from cohortal import fixed
from cohortal.operators.exclude import fact_names, fact_sets, reasons_of_facts
from cohortal.operators.longlist import row_hash
from cohortal.plans import build, exclusions
from registry import adapters

ID = "patient_pseudo_id"
CFG = adapters.CFG


@pytest.fixture(scope="module")
def sources(spark):
    return adapters.sources(spark, "/root/testdata/sf0.001")


@pytest.mark.parametrize("ties", ["snapshot_id", "row"])
def test_lists_equal_those_of_the_wide_table(spark, sources, ties):
    order = ["snapshot_id"] if ties == "snapshot_id" else [row_hash(sources.snapshots)]
    ready = build.prepare(sources, CFG, first_year=adapters.FIRST_YEAR)
    people = build.stage_people(ready, CFG, tie_break=order)
    listed = exclusions.cancer_list(sources, CFG, first_year=adapters.FIRST_YEAR, tie_break=order)
    same_rows(listed, build.cancer_exclusions(ready, people, CFG))
    listed = exclusions.stroke_list(sources, CFG, first_year=adapters.FIRST_YEAR)
    same_rows(listed, build.stroke_exclusions(ready, people, CFG))


def test_no_wide_table_is_joined(sources):
    plan = plan_of(exclusions.cancer_list(sources, CFG, first_year=adapters.FIRST_YEAR))
    assert "c_mktsegment" not in plan and "imd_decile" not in plan and "bit_or" in plan
    # The only left join fills the code map; activity meets its codes in semi joins.
    assert plan.count("LeftOuter") <= 1 and plan.count("LeftSemi") >= 2


def made(spark, sources, **tables):
    kept = {k: getattr(sources, k).limit(0) for k in sources.__dataclass_fields__}
    return build.Sources(**(kept | tables))


def person(sources, **values):
    """One row of the person table; what is not named is null."""
    known = {f.name: F.lit(None).cast(f.dataType) for f in sources.person.schema.fields}
    known |= {k: F.lit(v).cast(sources.person.schema[k].dataType) for k, v in values.items()}
    return sources.person.limit(1).select(*[v.alias(k) for k, v in known.items()])


def test_rules_over_nulls_and_over_several_sources(spark, sources):
    later, before = dt.date(1999, 7, 1), dt.date(1999, 6, 29)
    people = (
        person(sources, patient_pseudo_id="old", age=121, deducted=1, deduction_reason="TRA")
        .unionAll(person(sources, patient_pseudo_id="none"))
        .unionAll(person(sources, patient_pseudo_id="died", age=50, death_month=later))
        .unionAll(person(sources, patient_pseudo_id="cause", age=50, death_month=later))
        .unionAll(person(sources, patient_pseudo_id="gone", age=50, death_month=before))
        .unionAll(person(sources, patient_pseudo_id="moved", age=50, deducted=1))
        .unionAll(person(sources, age=30))
        .unionAll(person(sources))
    )
    deaths = spark.createDataFrame(
        [("cause", 1, "A01"), ("cause", 2, "C50"), ("died", 2, "A01"), ("died", 1, "C50"),
         ("cause2", 3, "C50")],
        f"{ID} string, activity_id long, code string",
    )
    mortality = deaths.select(
        ID, "activity_id", F.lit(later).alias("reg_date_of_death"),
        F.col("code").alias(fixed.CAUSE_COLUMNS[0]),
        *[F.lit(None).cast("string").alias(c) for c in fixed.CAUSE_COLUMNS[1:]],
    )
    activity = spark.createDataFrame(
        [("stranger", "1", before, "A01, C50-"), ("old", "2", later, "C50"), (None, "3", before, "C50"),
         ("none", "4", before, "C44")],
        f"{ID} string, activity_id string, attendance_date date, dimention_8 string",
    )
    found = exclusions.cancer_list(
        made(spark, sources, person=people, mortality=mortality, inpatient=activity), CFG
    )
    rows = sorted(map(tuple, found.collect()), key=str)
    assert rows == sorted(
        [
            ("old", fixed.TOO_OLD), ("old", fixed.DEDUCTED), ("none", fixed.NO_AGE),
            ("died", fixed.DIED_AFTER), ("gone", fixed.DIED_BEFORE),
            ("stranger", fixed.PRIOR_CANCER), (None, fixed.TOO_YOUNG), (None, fixed.NO_AGE),
        ],
        key=str,
    )


def test_facts_of_several_rows_and_sources_meet(spark):
    a = spark.createDataFrame([("p", 1), ("p", None), ("q", 0), (None, 1)], "k string, x int")
    b = spark.createDataFrame([("p", 2), ("r", 2)], "k string, x int")
    found = [(a, {"one": F.col("x") == 1, "zero": F.col("x") == 0}), (b, {"two": F.lit(True)})]
    names = fact_names(found)
    sets = fact_sets("k", found)
    assert names == ["one", "zero", "two"]
    assert {r["k"]: r["facts"] for r in sets.collect()} == {"p": 5, "q": 2, "r": 4}
    rules = [("both", ["one", "two"], []), ("only two", ["two"], ["one"])]
    reasons = reasons_of_facts(sets, "k", names, rules).collect()
    assert sorted(map(tuple, reasons)) == [("p", "both"), ("r", "only two")]


def test_a_hot_person_sends_one_number_from_each_task(spark):
    rows = spark.range(0, 30_000, 1, 6).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "id % 5 as x")
    sets = fact_sets("k", [(rows, {f"f{i}": F.col("x") == i for i in range(5)})])
    assert sets.where("k = 'hot'").first()["facts"] == 31
    plan = plan_of(sets)
    assert "partial_bit_or" in plan and "SortAggregate" not in plan


def test_too_many_facts_are_refused(spark):
    table = spark.range(1)
    with pytest.raises(ValueError, match="do not fit"):
        fact_names([(table, {str(i): F.lit(True) for i in range(64)})])
