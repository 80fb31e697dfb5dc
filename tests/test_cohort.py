"""Assembly, exclusions, label updates and the modelling tables."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import by_key, same_rows
from pyspark.sql import functions as F

from cohortal import CohortConfig, fixed
from cohortal.functions.weeks import flag
from cohortal.operators import summary
from cohortal.operators.exclude import exclude, exclude_by_rules, exclusion_reasons
from cohortal.operators.joins import left_join_all
from cohortal.plans import build, cohort
from registry import adapters

ID = "patient_pseudo_id"
CUT = dt.date(2021, 8, 31)
SF = "/root/testdata/sf0.001"


def days(n: int) -> dt.date:
    return CUT + dt.timedelta(days=n)


DEFAULTS = {
    "age": 50, "death_month": None, "deducted": 0, "deduction_reason": None,
    "phr_active_cancer": 0, "phr_cancer": 0, **dict.fromkeys(fixed.CAUSE_COLUMNS),
    "all_cancer_diagnoses_after_cut_off": None,
    **{f"cancer_diagnosis_in_next_{n}_weeks": 0 for n in (12, 26, 52, 78, 104, 260)},
}
SCHEMA = (
    f"{ID} string, age int, death_month date, deducted int, deduction_reason string,"
    " phr_active_cancer int, phr_cancer int, "
    + ", ".join(f"{c} string" for c in fixed.CAUSE_COLUMNS)
    + ", all_cancer_diagnoses_after_cut_off array<string>, "
    + ", ".join(f"cancer_diagnosis_in_next_{n}_weeks int" for n in (12, 26, 52, 78, 104, 260))
)


def people(spark, **rows):
    return spark.createDataFrame(
        [(k, *{**DEFAULTS, **v}.values()) for k, v in rows.items()], SCHEMA
    )


@pytest.fixture(scope="module")
def mixed(spark):
    return people(
        spark,
        ok={}, no_age={"age": None}, a39={"age": 39}, a40={"age": 40}, a114={"age": 114},
        a120={"age": 120}, a121={"age": 121}, flagged={"phr_cancer": 1},
        active={"phr_active_cancer": 1}, null_flags={"phr_cancer": None, "phr_active_cancer": None},
        died_before={"death_month": days(-1)}, died_on={"death_month": CUT},
        died_on_cause={"death_month": CUT, "s_cod_code_15": "C61"},
        died_skin={"death_month": days(9), "s_cod_code_1": "C44"},
        deducted_null={"deducted": 1}, deducted_dea={"deducted": 1, "deduction_reason": "DEA"},
        deducted_other={"deducted": 1, "deduction_reason": "TRA"},
        young_and_deducted={"age": 20, "deducted": 1, "deduction_reason": "TRA"},
    )


def reasons_of(df) -> dict:
    out: dict = {}
    for r in df.collect():
        out.setdefault(r[ID], set()).add(r["reason"])
    return out


def test_cancer_exclusions(spark, cfg, mixed):
    prior = spark.createDataFrame([("ok",), ("elsewhere",)], f"{ID} string")
    got = reasons_of(cohort.cancer_exclusions(mixed, prior, cfg))
    assert got == {
        "no_age": {"no valid age"}, "a39": {"age <40"}, "a121": {"age > 120"},
        "flagged": {"PHR flag of active or previous cancer"},
        "active": {"PHR flag of active or previous cancer"},
        "died_before": {"passed away before cut-off"},
        "died_on": {"passed away after cut-off (without cancer as COD)"},
        "died_skin": {"passed away after cut-off (without cancer as COD)"},
        "deducted_other": {"deduction reason (not death)"},
        "young_and_deducted": {"age <40", "deduction reason (not death)"},
        "ok": {"Previous cancer flag from SUS"}, "elsewhere": {"Previous cancer flag from SUS"},
    }


def test_stroke_exclusions(spark, cfg, mixed):
    prior = spark.createDataFrame([("ok",)], f"{ID} string")
    got = reasons_of(cohort.stroke_exclusions(mixed, prior, cfg))
    assert "flagged" not in got
    assert got["died_on_cause"] == {"passed away after cut-off (without cancer as COD)"}
    assert got["ok"] == {"Previous stroke flag from SUS"}


def test_deducted_may_be_boolean(cfg, mixed):
    as_boolean = mixed.withColumn("deducted", F.col("deducted") == 1)
    same_rows(
        exclusion_reasons(mixed, ID, cohort.stroke_rules(mixed, cfg)),
        exclusion_reasons(as_boolean, ID, cohort.stroke_rules(as_boolean, cfg)),
    )


def test_one_pass_equals_union_of_filters(cfg, mixed):
    rules = cohort.cancer_rules(mixed, cfg)
    union = None
    for reason, rule in rules:
        part = mixed.where(rule).select(ID, F.lit(reason).alias("reason"))
        union = part if union is None else union.unionAll(part)
    same_rows(exclusion_reasons(mixed, ID, rules), union)


def test_excluding_by_rules_equals_anti_join(cfg, mixed):
    rules = cohort.cancer_rules(mixed, cfg)
    listed = exclusion_reasons(mixed, ID, rules)
    by_join = exclude(mixed, listed, ID)
    assert {r[ID] for r in by_join.collect()} == {
        "ok", "a40", "a114", "a120", "null_flags", "died_on_cause", "deducted_null", "deducted_dea",
    }
    same_rows(exclude_by_rules(mixed, rules), by_join)


def test_exclude_with_reason_column(spark, mixed):
    listed = spark.createDataFrame([("ok", "x"), ("ok", "y"), (None, "z")], f"{ID} string, reason string")
    kept = exclude(mixed, listed, ID, reason_column=True)
    long_way = mixed.join(listed.dropDuplicates([ID]), ID, "left").where("reason is null")
    assert kept.dtypes == long_way.dtypes
    assert by_key(kept) == by_key(long_way)


def test_label_update(spark, cfg):
    df = people(
        spark,
        none={},
        on_cut={"death_month": CUT, "s_cod_code_1": "C50"},
        at_12={"death_month": days(84), "s_cod_code_15": "C50"},
        at_13={"death_month": days(85), "s_underlying_cod_icd10": "C50"},
        other={"death_month": days(5), "s_cod_code_1": "I21"},
        seen={"death_month": days(5), "s_cod_code_1": "C50",
              "all_cancer_diagnoses_after_cut_off": ["C50"], "cancer_diagnosis_in_next_52_weeks": 1},
    )
    out = by_key(cohort.cancer_cohort_labels(df, cfg))
    first = {k: r[fixed.DEATH_LABEL] for k, r in out.items()}
    assert first == {"none": 0, "on_cut": 0, "at_12": 1, "at_13": 1, "other": 0, "seen": 0}
    label = "cancer_diagnosis_in_next_{}_weeks"
    assert [out["at_12"][label.format(n)] for n in cfg.horizon_weeks] == [1] * 6
    assert [out["at_13"][label.format(n)] for n in cfg.horizon_weeks] == [0, 1, 1, 1, 1, 1]
    assert out["seen"][label.format(52)] == 1 and out["seen"][label.format(12)] == 0
    assert out["at_13"]["death_with_first_cancer_diagnosis_in_next_12_weeks"] == 0


def test_zero_fill_touches_numbers_only(spark, cfg):
    person = spark.createDataFrame([("a",), ("b",)], f"{ID} string")
    table = spark.createDataFrame(
        [("a", 1, 1.5, "x", CUT, ["c"], True)],
        f"{ID} string, n int, pct double, s string, d date, codes array<string>, t boolean",
    )
    empty = spark.createDataFrame([], f"{ID} string, m bigint")
    empty2 = spark.createDataFrame([], f"{ID} string, k int")
    out = by_key(cohort.person_features(person, table, empty, empty2, cfg))["b"]
    assert (out["n"], out["pct"], out["m"], out["k"]) == (0, 0.0, 0, 0)
    assert out["s"] is out["d"] is out["codes"] is out["t"] is None


def test_assembly_keeps_one_row_per_person(spark):
    person = spark.range(100).select(F.col("id").cast("string").alias(ID))
    tables = [person.where(F.col(ID) < str(n)).withColumn(f"c{n}", F.lit(n)) for n in range(1, 9)]
    assert left_join_all(person, tables, ID).count() == 100


@pytest.fixture(scope="module")
def ready(spark):
    return build.prepare(
        adapters.sources(spark, SF), adapters.CFG, first_year=adapters.FIRST_YEAR
    )


@pytest.fixture(scope="module")
def wide(ready):
    """One row per person, as the build stages it."""
    return build.stage_people(ready, adapters.CFG, tie_break=adapters.TIE_BREAK)


def test_wide_table_has_every_person_once(ready, wide):
    assert wide.count() == ready.sources.person.count() == wide.select(ID).distinct().count()


def test_labels_and_counts_grow_with_the_window(wide):
    cfg = adapters.CFG
    for pattern, steps in (
        ("cancer_diagnosis_in_next_{}_weeks", cfg.horizon_weeks),
        ("cancer_before_cut_off_in_last_{}_weeks", cfg.lookback_weeks),
    ):
        for near, far in zip(steps, steps[1:]):
            worse = F.col(pattern.format(near)) > F.col(pattern.format(far))
            assert wide.where(worse).count() == 0, (pattern, near)


def test_build_equals_the_dataset_by_dataset_way(ready, wide):
    """Staged spans and inline exclusions against the separate lists."""
    cfg = adapters.CFG
    prior = build.prior_condition(ready, cfg, fixed.CANCER)
    listed = cohort.cancer_exclusions(wide, prior, cfg)
    kept = cohort.cancer_cohort(wide, listed, cfg)
    needed = [*fixed.model_columns(cfg)]
    stepwise = kept.select(*needed)
    assert listed.select(ID).distinct().count() + kept.count() == wide.count()
    table = build.cancer_table(ready, wide, cfg)
    keys = {r[ID] for r in table.collect()}
    assert keys == {r[ID] for r in stepwise.where("gender is not null").collect()}


def test_cancer_table(ready, wide):
    cfg = adapters.CFG
    table = build.cancer_table(ready, wide, cfg)
    site_flags = [c for c in table.columns if c.startswith("cancer_diagnosis_in_next_") and c[-1] != "s"]
    assert set(fixed.model_columns(cfg)) <= set(table.columns)
    assert {"age_bucket", "category", "dataset"} <= set(table.columns)
    assert any(c.endswith("_lung") for c in site_flags)
    row = table.first()
    assert row["dataset"] in ("train", "validate", "test")
    assert all(row[c] is not None for c in site_flags)


def test_stroke_table(ready, wide):
    table = build.stroke_table(ready, wide, adapters.CFG)
    assert fixed.DEATH_LABEL not in table.columns
    assert not [c for c in table.columns if c.endswith("_lung")]
    nulls = table.where(F.col("stroke_diagnosis_in_next_52_weeks").isNull())
    assert table.count() > 0 and nulls.count() == 0


def test_missing_contract_columns_are_named(cfg, mixed):
    grouped = [f"{c}_null_removed" for c in ("rural_urban_classification", "acorn_household_type")]
    person = mixed.withColumns({c: F.lit("unknown") for c in grouped})
    with pytest.raises(ValueError, match="missing columns: .*'111_calls_total'"):
        cohort.model_base(person, cfg, death_label=True)


def test_flag_is_zero_for_null(spark):
    got = spark.createDataFrame([(None,), (True,), (False,)], "x boolean").select(flag(F.col("x")))
    assert [r[0] for r in got.collect()] == [0, 1, 0]


def _events(spark):
    rows = [
        ("1", "A01", "2021-01-01", "x"), ("1", "A02", "2020-01-01", "x"), ("1", "B01", "2021-08-20", "y z"),
        ("2", "B01", "2015-01-01", "y z"), ("3", "C01", "2021-01-01", "undeclared"),
    ]
    made = spark.createDataFrame(rows, "patient_pseudo_id string, diagnosis string, day string, category string")
    return made.select("patient_pseudo_id", "diagnosis", F.col("day").cast("date").alias("date"), "category")


def test_spread_maps_equal_the_joined_pivot(spark):
    cfg = CohortConfig()
    values = ["x", "y z", "never"]
    found = summary.category_summary(_events(spark), cfg, "category")
    people = spark.createDataFrame([("1", 5), ("2", None), ("3", 7), (None, 8)], "patient_pseudo_id string, n int")
    wide = summary.pivot_categories(found, cfg, "category", values)
    added = [c for c in wide.columns if c != "patient_pseudo_id"]
    long_way = people.join(wide, "patient_pseudo_id", "left").withColumn("last", F.lit("end"))
    maps = summary.map_categories(found, cfg, "category", values)
    joined = left_join_all(people, [maps], "patient_pseudo_id").withColumn("last", F.lit("end"))
    same_rows(summary.spread_values(joined, values), long_way.na.fill(0, subset=added))


def test_joins_do_not_copy_the_columns_of_joins_before(spark):
    people = spark.range(20).selectExpr("cast(id as string) as k", "id as n")
    tables = [
        people.selectExpr("k", *[f"n + {i} as t{j}_c{i}" for i in range(30)]).where(f"n % {j + 2} = 0")
        for j in range(3)
    ]
    ours = left_join_all(people, tables, "k")
    long_way = people
    for t in tables:
        long_way = long_way.join(t, "k", "left")
    same_rows(ours, long_way)
    root = ours._jdf.queryExecution().optimizedPlan()
    widths, nodes = [], [root]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Join":
            widths.append(node.output().size())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert len(widths) == 3 and max(widths) <= 2 + 2 * len(tables)
