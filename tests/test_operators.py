"""Operators on small tables that hold the edge rows."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import by_key, same_rows
from pyspark.sql import functions as F

from cohortal.fixed import CANCER, SITE_CODES
from cohortal.operators.encode import clean_one_hot, discover_values, one_hot
from cohortal.operators.joins import (
    assert_unique,
    columns_containing,
    drop_all_null,
    prefix_columns,
    select_columns,
)
from cohortal.operators.labels import outcome_labels
from cohortal.operators.longlist import (
    code_longlist,
    codes_in_columns,
    codes_in_text,
    keep_one,
    latest_row,
)
from cohortal.operators.lookback import (
    count_since,
    lookback_counts,
    lookback_pivot,
    pivot_since,
)
from cohortal.operators.sites import site_filter, site_tag
from cohortal.operators.strata import (
    split_hash,
    split_stratified,
    strata_assign,
    strata_crosstab,
)
from cohortal.operators.summary import (
    category_summary,
    distinct_codes,
    first_per_group,
    latest_per_group,
    site_summary,
)
from cohortal.plans import codes, features

ID = "patient_pseudo_id"
CUT = dt.date(2021, 8, 31)


def weeks(n: int, days: int = 0) -> dt.date:
    return CUT + dt.timedelta(weeks=n, days=days)


EVENT = f"{ID} string, date date, diagnosis string"


def events(spark, *rows):
    return spark.createDataFrame(list(rows), EVENT)


# Encoding


def test_one_hot_names_and_nulls(spark):
    df = spark.createDataFrame([("a", "Not known"), ("b", None), ("c", "x")], f"{ID} string, g string")
    out = by_key(one_hot(df, ["g"]))
    assert list(out["a"]) == [ID, "g", "g_Not_known", "g_x"]
    assert [out[k]["g_Not_known"] for k in "abc"] == [1, 0, 0]


def test_declared_values_need_no_job(spark):
    df = spark.createDataFrame([("a", "x")], f"{ID} string, g string")
    out = one_hot(df, ["g"], {"g": ["y"]})
    assert out.columns == [ID, "g", "g_y"]
    assert one_hot(df, ["g"], {"g": []}).columns == [ID, "g"]


def test_clean_one_hot(spark):
    df = spark.createDataFrame([("a", ""), ("b", None), ("c", "x")], f"{ID} string, g string")
    out = by_key(clean_one_hot(df, ["g"]))
    assert [out[k]["g_null_replaced_unknown"] for k in "abc"] == [1, 1, 0]


def test_discover_finds_all_values_however_many(spark):
    df = spark.range(10_001).withColumn("c", F.when(F.col("id") > 0, "one"))
    found = discover_values(df, ["c", "id"])
    assert found["c"] == ["one"] and len(found["id"]) == 10_001
    assert discover_values(df.limit(0), ["c", "id"]) == {"c": [], "id": []}


# Long lists


def test_longlist_from_text(spark):
    df = spark.createDataFrame(
        [("a", CUT, " A1-2 |"), ("b", CUT, "A,,B"), ("c", CUT, None), ("d", CUT, ""), ("e", CUT, " ")],
        f"{ID} string, attendance_date date, dimention_8 string",
    )
    out = code_longlist(df, codes_in_text("dimention_8"))
    got = sorted((r[ID], r["diagnosis"]) for r in out.collect())
    assert got == [("a", "A12"), ("b", "A"), ("b", "B")]
    assert "date" in out.columns and "attendance_date" not in out.columns


def test_longlist_from_columns_and_null_arrays(spark):
    df = spark.createDataFrame(
        [("a", CUT, "C34", None, "C34"), ("b", CUT, None, None, None)],
        f"{ID} string, attendance_date date, d1 string, d2 string, d3 string",
    )
    got = code_longlist(df, codes_in_columns(["d1", "d2", "d3"])).collect()
    assert [(r[ID], r["diagnosis"]) for r in got] == [("a", "C34")]
    arrays = spark.createDataFrame([("a", CUT, None)], f"{ID} string, attendance_date date, x array<string>")
    assert code_longlist(arrays, F.col("x")).count() == 0


def test_keep_one_does_not_depend_on_layout(spark):
    rows = [("a", CUT, "C34", f"act{n:02d}", f"s{99 - n}") for n in range(40)]
    rows += [("a", None, "C34", "z", "z"), ("a", None, "C34", "y", "z")]
    df = spark.createDataFrame(rows, f"{EVENT}, activity_id string, source string")
    results = {
        frozenset(keep_one(df.repartition(n), [ID, "date", "diagnosis"]).collect()) for n in (1, 3, 7)
    }
    (result,) = results
    assert {r["activity_id"] for r in result} == {"act00", "y"}


def test_latest_row_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", CUT, 2, "x"), ("a", CUT, 1, "y"), ("a", weeks(-1), 0, "z"), ("b", None, 5, "n")],
        f"{ID} string, date date, snapshot_id int, v string",
    )
    out = by_key(latest_row(df, ID, "date", ["snapshot_id"]))
    assert (out["a"]["v"], out["b"]["v"]) == ("y", "n")
    assert by_key(latest_row(df, ID, "date"))["a"]["snapshot_id"] == 1


def test_code_map_fallback(spark):
    columns = codes.CODE_MAP_COLUMNS
    rows = [("1", "C34.1"), ("2", None), ("3", None)]
    code_map = spark.createDataFrame(rows, "SNOMED_Code string, ICD10_Mapping string").select(
        *[F.col(c) if c in ("SNOMED_Code", "ICD10_Mapping") else F.lit(None).cast("string").alias(c)
          for c in columns]
    )
    fallback = spark.createDataFrame(
        [
            ("1", 1, 1, 1, "X00"),
            ("2", 2, 1, 9, "late block"),
            ("2", 1, 2, 9, "late group"),
            ("2", 1, 1, 1, "low priority"),
            ("2", 1, 1, 2, "C50.9"),
        ],
        "Referenced_Component_ID string, Map_Block int, Map_Group int, Map_Priority int,"
        " Map_Target string",
    )
    out = codes.emergency_code_map(code_map, fallback)
    assert out.columns == columns
    assert by_key(out, "SNOMED_Code")["2"]["ICD10_Mapping"] == "C50.9"
    assert by_key(out, "SNOMED_Code")["1"]["ICD10_Mapping"] == "C34.1"
    assert by_key(out, "SNOMED_Code")["3"]["ICD10_Mapping"] is None


def test_union_sources_drops_referrals_unmapped_and_unknown_people(spark, cfg):
    def table(source, *rows):
        return spark.createDataFrame([(*r, source) for r in rows], f"{EVENT}, source string")

    out = codes.union_sources(
        table("Inpatient", ("a", CUT, "#NIS"), (None, CUT, "C34")),
        table("OPA", ("b", CUT, "C50")),
        table("Emergency", ("c", CUT, "#NIS"), ("d", CUT, None), ("e", CUT, "I63")),
        cfg,
    )
    # Only the emergency list is tested for referrals and missing codes.
    assert sorted(r[ID] for r in out.collect()) == ["a", "b", "e"]


def test_combined_codes_keep_unmatched(spark, cfg):
    empty = spark.createDataFrame([], f"{EVENT}, source string")
    listed = spark.createDataFrame(
        [("a", CUT, "C34", "OPA"), ("a", CUT, "C07", "OPA"), ("a", CUT, "C13", "OPA")],
        f"{EVENT}, source string",
    )
    reference = spark.createDataFrame(
        [("C34", "C30-C39", None), ("C07", None, None), ("C13", "C00-C14", CUT)],
        "alt_code string, category_3_code string, effective_to date",
    )
    out = codes.combined_codes(empty, listed, empty, reference, cfg).collect()
    assert {r["diagnosis"]: r["category_3_code"] for r in out} == {
        "C34": "C30-C39", "C07": None, "C13": None,
    }


def test_outpatient_join_casts_key(spark):
    activity = spark.createDataFrame([("a", "10"), ("b", None), ("c", "x")], f"{ID} string, opa_ident_min string")
    raw = spark.createDataFrame([(10, "C34"), (10, "C35"), (11, "C36")], "OPA_Ident bigint, code string")
    out = codes.outpatient_with_codes(activity, raw)
    assert out.columns == [ID, "opa_ident_min", "OPA_Ident", "code", "OPA_Ident_str"]
    got = sorted((r[ID], r["code"]) for r in out.collect())
    assert got == [("a", "C34"), ("a", "C35"), ("b", None), ("c", None)]


def test_union_periods_compares_years_as_text(spark):
    years = ["2015/2016", "2016/2017", "2017/2018"]
    tables = [spark.createDataFrame([(y,)], "Der_Financial_Year string") for y in years]
    assert sorted(r[0] for r in codes.union_periods(tables).collect()) == years[1:]


# Lookback counts


def activity(spark, *rows):
    return spark.createDataFrame(
        list(rows), f"{ID} string, attendance_date date, dimention_8 string"
    )


def test_lookback_counts(spark, cfg):
    df = activity(
        spark,
        ("a", weeks(-4), "x"), ("a", weeks(-4, -1), ""), ("a", weeks(0, -1), None),
        ("a", CUT, "x"), ("a", weeks(1), "x"), (None, weeks(-1), "x"),
        ("b", weeks(-300), " "), ("c", weeks(2), "x"), ("a", None, "x"),
    )
    out = by_key(features.emergency_features(df, cfg))
    assert set(out) == {"a", "b"}
    a = out["a"]
    assert a["ae_attend_total"] == 3
    assert [a[f"ae_attendances_last_{n}_weeks"] for n in cfg.lookback_weeks] == [2, 3, 3, 3, 3]
    assert a["aea_diagnoses_total"] == 1
    assert a["ae_diagnosis_pct_of_attendnaces"] == 1 / 3 * 100
    assert out["b"]["ae_attendances_last_260_weeks"] == 0
    assert out["b"]["aea_diagnoses_total"] == 1


def test_count_since_has_no_upper_bound(spark, cfg):
    df = activity(spark, ("a", weeks(-4), ""), ("a", weeks(9), ""), ("b", weeks(-5), ""))
    out = count_since(df, cfg, time="attendance_date", weeks=4, prefix="n_")
    assert by_key(out) == {"a": {ID: "a", "n_4_weeks": 2}}


def test_pivot_since_leaves_nulls(spark, cfg):
    df = activity(spark, ("a", weeks(-1), "Cough"), ("b", weeks(-1), "Itch"))
    out = pivot_since(
        df, cfg, time="attendance_date", weeks=4, label="dimention_8", values=["Cough"], suffix="n_"
    )
    assert by_key(out)["b"]["Cough_n_4_weeks"] is None
    assert [r[ID] for r in drop_all_null(out, [ID]).collect()] == ["a"]


def test_labels_and_categories_may_be_discovered(spark, cfg):
    df = activity(
        spark, ("a", weeks(-1), "Cough"), ("b", weeks(-30), "Itch"), ("b", weeks(1), "Fever"),
        ("b", weeks(-1), None),
    )
    names = {"time": "attendance_date", "label": "dimention_8", "suffix": "n_"}
    wide = lookback_pivot(df, cfg, **names)
    assert wide.columns == [
        ID, *[f"{v}_n_{n}_weeks" for v in ("Cough", "Itch") for n in cfg.lookback_weeks],
    ]
    assert by_key(wide)["b"]["Itch_n_52_weeks"] == 1
    recent = pivot_since(df, cfg, weeks=4, **names)
    assert recent.columns == [ID, "Cough_n_4_weeks", "Fever_n_4_weeks"]
    coded = events(spark, ("a", weeks(-1), "A1"), ("a", weeks(-1), "Z1"), ("a", weeks(1), "B1"))
    coded = coded.withColumn(features.CATEGORY, F.substring("diagnosis", 1, 1))
    found = features.category_features(coded, cfg)
    assert [c for c in found.columns if c.endswith("_binary")] == ["A_binary", "Z_binary"]


def test_call_features(spark, cfg):
    calls = spark.createDataFrame(
        [
            ("a", 2, weeks(-1), "Cough"), ("a", 2, weeks(-30), "Tiredness (Fatigue)"),
            ("a", 2, weeks(-1), "Earache"), ("a", 1, weeks(-1), "Cough"),
            ("a", 2, CUT, "Cough"), ("b", 2, weeks(-9), None), ("b", 2, weeks(-9), "Unlisted"),
        ],
        f"{ID} string, site_type_id int, call_date date, symptom_group string",
    )
    symptoms = spark.createDataFrame(
        [("Cough", "Y"), ("Tiredness (Fatigue)", "Y"), ("Earache", "N")],
        "symptom_group string, cancer_related string",
    )
    out = by_key(features.call_features(calls, symptoms, cfg))
    a, b = out["a"], out["b"]
    assert (a["111_calls_total"], b["111_calls_total"]) == (3, 2)
    assert (a["111_calls_last_4_weeks"], a["111_calls_cancer_last_4_weeks"]) == (2, 1)
    assert a["Tiredness__Fatigue__111_calls_last_26_weeks"] == 0
    assert a["Tiredness__Fatigue__111_calls_last_52_weeks"] == 1
    assert (b["111_calls_last_12_weeks"], b["111_calls_cancer_last_260_weeks"]) == (2, 0)
    assert b["Cough_111_calls_last_260_weeks"] == 0


def test_repeated_symptoms_are_rejected(spark, cfg):
    symptoms = spark.createDataFrame([("x", "Y"), ("x", "N")], "symptom_group string, cancer_related string")
    with pytest.raises(ValueError, match="not unique"):
        assert_unique(symptoms, "symptom_group")


# Summaries


def test_group_summary(spark, cfg):
    df = events(
        spark,
        ("a", weeks(-4), "C50"), ("a", weeks(-4, 1), "C34"),
        ("b", weeks(-26, 1), "C50"), ("b", weeks(-1), "C50"),
        ("c", weeks(-30), "C61"), ("c", weeks(-30), "C34"),
        ("d", CUT, "C50"), ("e", weeks(-1), "C44"),
    )
    exact = by_key(features.prior_condition(df, cfg, CANCER))
    loose = by_key(features.prior_condition(df, cfg, CANCER, same_code=False))
    name = "cancer_before_cut_off"
    assert set(exact) == set(loose) == {"a", "b", "c"}
    # The latest date is kept only where first and latest row carry one code.
    assert exact["a"][f"{name}_date_latest"] is None
    assert loose["a"][f"{name}_date_latest"] == weeks(-4, 1)
    assert exact["b"][f"{name}_date_latest"] == weeks(-1)
    assert [exact["a"][f"{name}_in_last_{n}_weeks"] for n in (4, 12)] == [0, 1]
    assert exact["b"][f"{name}_in_last_26_weeks"] == 1
    # Two codes on one day: the smaller is first, the greater is latest.
    assert exact["c"][name] == "C34" and exact["c"][f"{name}_date_latest"] is None


def test_undated_rows_sort_first(spark, cfg):
    df = events(spark, ("a", None, "X1"), ("a", weeks(-1), "A1")).withColumn("g", F.lit("k"))
    first = first_per_group(df, cfg, "g").first()
    assert (first["g_date_earliest"], first["diagnosis"]) == (None, "X1")
    assert latest_per_group(df, cfg, "g").first()["g_date_latest"] == weeks(-1)


def test_null_category_has_no_latest_date(spark, cfg):
    df = events(spark, ("a", weeks(-2), "A1"), ("a", weeks(-1), "A2"), ("a", weeks(-3), "B1"))
    df = df.withColumn("cat", F.when(F.col("diagnosis") != "B1", "A"))
    out = {r["cat"]: r for r in category_summary(df, cfg, "cat").collect()}
    assert out["A"]["cat_date_latest"] == weeks(-1)
    assert out[None]["cat_date_latest"] is None and out[None]["cat_date_earliest"] == weeks(-3)


def test_category_features_keep_declared_only(spark, cfg):
    df = events(spark, ("a", weeks(-2), "A1"), ("b", weeks(-1), "B1"), ("c", weeks(1), "A1"))
    df = df.withColumn(features.CATEGORY, F.substring("diagnosis", 1, 1))
    out = features.category_features(df, cfg, ["A", "Z"])
    assert out.columns[:4] == [ID, "A_binary", "A_earliest_date", "A_diagnosis"]
    rows = by_key(out)
    assert set(rows) == {"a"}
    assert rows["a"]["A_last_4_weeks"] == 1 and rows["a"]["Z_binary"] is None


def test_distinct_codes(spark):
    df = events(spark, ("a", CUT, "C2"), ("a", CUT, "C1"), ("a", CUT, "C2"), ("a", CUT, None))
    assert distinct_codes(df, ID, name="codes").first()["codes"] == ["C1", "C2"]


# Sites and outcomes


def test_sites(spark):
    df = events(
        spark, ("a", CUT, "C56"), ("a", CUT, "C900"), ("a", CUT, "C44"), ("a", CUT, "D05"),
        ("a", CUT, None), ("a", CUT, "XC15"), ("a", CUT, "C15C16"),
    )
    tagged = sorted((r["diagnosis"], r["cancer_type"]) for r in site_tag(df).collect())
    assert tagged == [
        ("C15C16", "gi_upper_and_lower"), ("C15C16", "oesophageal"), ("C15C16", "stomach"),
        ("C56", "gynae"), ("C56", "ovarian"),
        ("C900", "haematological"), ("C900", "myeloma"),
        ("XC15", "gi_upper_and_lower"), ("XC15", "oesophageal"),
    ]
    for name in SITE_CODES:
        same_rows(site_filter(df, name), site_tag(df).where(F.col("cancer_type") == name).drop("cancer_type"))
    with pytest.raises(ValueError, match="unknown site"):
        site_filter(df, "toe")


def test_outcome_labels(spark, cfg):
    df = events(
        spark, ("a", weeks(12), "C50"), ("a", weeks(12), "C34"), ("a", weeks(30), "C61"),
        ("b", weeks(12, 1), "C50"), ("c", CUT, "C50"), ("d", weeks(1), "C44"),
    )
    out = by_key(features.condition_outcome(df, cfg, CANCER))
    assert set(out) == {"a", "b"}
    a, b = out["a"], out["b"]
    assert a["diagnosis_earliest_after_cut_off_date"] == "C34"
    assert a["diagnosis_latest_after_cut_off_date"] == "C61"
    assert a["all_cancer_diagnoses_after_cut_off"] == ["C34", "C50", "C61"]
    flags = [f"cancer_diagnosis_in_next_{n}_weeks" for n in cfg.horizon_weeks]
    assert [a[f] for f in flags] == [1, 1, 1, 1, 1, 1]
    assert [b[f] for f in flags] == [0, 1, 1, 1, 1, 1]
    latest = by_key(outcome_labels(df.where("patient_pseudo_id = 'a'"), cfg, "cancer",
                                   prefix="lung_", anchor="latest"))
    assert latest["a"]["lung_cancer_diagnosis_in_next_26_weeks"] == 0
    assert latest["a"]["lung_cancer_diagnosis_in_next_52_weeks"] == 1


def test_site_outcomes(spark, cfg):
    df = events(spark, ("a", weeks(1), "C56"), ("a", weeks(20), "C34"), ("b", weeks(1), "C44"))
    tagged = site_summary(site_tag(df), cfg, "cancer_type")
    assert {tuple(r["all_cancer_diagnoses_after_cut_off"]) for r in tagged.collect()} == {("C34", "C56")}
    out = by_key(features.site_outcomes(df, cfg))
    assert set(out) == {"a"}
    a = out["a"]
    assert a["cancer_diagnosis_in_next_12_weeks_ovarian"] == 1
    assert a["cancer_diagnosis_in_next_12_weeks_lung"] == 0
    assert a["cancer_diagnosis_in_next_12_weeks_breast"] is None
    assert a["all_cancer_diagnoses_after_cut_off_lung"] == ["C34", "C56"]
    assert a["cancer_earliest_date_gynae"] == weeks(1)
    assert len(out["a"]) == 1 + 20 * 10


# Strata and splits


def test_strata(spark):
    rows = [("a", "40-50", "F", 1), ("b", "50-60", None, 0), ("c", "50-60", "M", 0)]
    df = spark.createDataFrame(rows, f"{ID} string, age_bucket string, gender string, y int")
    columns = ["age_bucket", "gender", "y"]
    table = strata_crosstab(df, columns, "category").collect()
    assert len(table) == 2 * 3 * 2
    assert {r["category"] for r in table if r["gender"] is None} == {None}
    assigned = strata_assign(df, columns, "category")
    assert {r[ID]: r["category"] for r in assigned.collect()} == {"a": "40-50-F-1", "c": "50-60-M-0"}
    # Equal to the inner join with the crosstab.
    same_rows(df.join(strata_crosstab(df, columns, "category"), columns), assigned)
    kept = strata_assign(df, columns, "category", null_label="none")
    assert by_key(kept)["b"]["category"] == "50-60-none-0" and kept.count() == 3


def test_crosstab_has_no_limit_on_values(spark):
    df = spark.range(10_001).select("id", F.lit("x").alias("c"))
    table = strata_crosstab(df, ["id", "c"], "label")
    assert table.count() == 10_001 and table.where("label = concat(id, '-x')").count() == 10_001


def test_null_reference_keys_may_repeat(spark):
    table = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert_unique(table, "k")
    with pytest.raises(ValueError, match="not unique"):
        assert_unique(table.union(table.where("v = 3")), "k")


def test_rows_without_a_key_spread_over_the_parts(spark):
    df = spark.range(6_000).select(F.lit(None).cast("string").alias(ID), "id")
    parts = {r["dataset"]: r["count"] for r in split_hash(df, ID).groupBy("dataset").count().collect()}
    assert abs(parts["train"] - 3_600) < 200 and abs(parts["test"] - 1_200) < 200
    same_rows(split_hash(df, ID), split_hash(df.repartition(5), ID))


def test_split_is_fixed_by_seed_and_key(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias(ID))
    splits = [
        {r[ID]: r["dataset"] for r in split_hash(df.repartition(n), ID, seed=0).collect()}
        for n in (1, 5, 16)
    ]
    assert splits[0] == splits[1] == splits[2]
    subset = split_hash(df.where(F.col(ID) < "3"), ID, seed=0).collect()
    assert all(splits[0][r[ID]] == r["dataset"] for r in subset)
    assert splits[0] != {r[ID]: r["dataset"] for r in split_hash(df, ID, seed=1).collect()}
    share = {d: sum(v == d for v in splits[0].values()) / 20_000 for d in ("train", "validate", "test")}
    assert abs(share["train"] - 0.6) < 0.02 and abs(share["test"] - 0.2) < 0.02


def test_split_fractions_are_named(spark):
    df = spark.range(5_000).select(F.col("id").cast("string").alias(ID))
    parts = split_hash(df, ID, fractions={"train": 3, "test": 1, "validate": 0}, seed=0)
    counts = {r["dataset"]: r["count"] for r in parts.groupBy("dataset").count().collect()}
    assert set(counts) == {"train", "test"} and abs(counts["test"] / 5_000 - 0.25) < 0.03
    assert split_hash(df, ID, fractions={"all": 1}).select("dataset").distinct().count() == 1


def test_stratified_split_loses_other_targets(spark):
    df = spark.range(30_000).selectExpr("cast(id as string) as k", "cast(nullif(id % 4, 3) as int) as y")
    out = split_stratified(df, "k", "y")
    rows = out.groupBy("y").pivot("dataset", ["train", "validate", "test"]).count().collect()
    assert {r["y"] for r in rows} == {0, 1}
    for r in rows:
        assert abs(r["train"] / 7_500 - 0.6) < 0.03 and abs(r["test"] / 7_500 - 0.2) < 0.03


# Column helpers


def test_column_helpers(spark):
    df = spark.createDataFrame([("a", 1, 2)], f"{ID} string, region_x int, other int")
    assert prefix_columns(df, "p_", keep=[ID]).columns == [ID, "p_region_x", "p_other"]
    assert columns_containing(df, ["region_"]) == ["region_x"]
    with pytest.raises(ValueError, match=r"\['absent', 'gone'\]"):
        select_columns(df, [ID, "gone", "absent"])


def test_lookback_without_codes(spark, cfg):
    df = activity(spark, ("a", weeks(-1), None))
    out = lookback_counts(df, cfg, time="attendance_date", total="n", prefix="n_")
    assert out.columns == [ID, "n", *[f"n_{n}_weeks" for n in cfg.lookback_weeks]]
