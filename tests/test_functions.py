"""Column expressions on the edge values."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from cohortal.config import CohortConfig
from cohortal.fixed import (
    CANCER,
    CAUSE_COLUMNS,
    RURAL_URBAN,
    SITE_CODES,
    SNAPSHOT_COLUMNS,
    STROKE,
    model_columns,
)
from cohortal.functions.person import age_bucket, clean_age, uniform_draw
from cohortal.functions.text import (
    drop_dots,
    fill_blank,
    keep_alphanumeric,
    like_any,
    map_values,
    strip_code,
    tristate_text,
    underscore_label,
)
from cohortal.functions.weeks import Timeline, weeks_after, weeks_before


def apply(spark, values, type_, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {type_}")
    return [r[1] for r in df.select("i", expression(F.col("x"))).orderBy("i").collect()]


def test_fill_blank(spark):
    got = apply(spark, [None, "", " ", "a"], "string", fill_blank)
    assert got == ["unknown", "unknown", " ", "a"]
    assert apply(spark, [None, 3], "int", fill_blank) == ["unknown", "3"]


def test_tristate(spark):
    got = apply(spark, [True, False, None], "boolean", tristate_text)
    assert got == ["True", "False", "Unknown"]


def test_codes_are_stripped(spark):
    got = apply(spark, [" A1-2 |", "A,B", " ", None], "string", strip_code)
    assert got == ["A12", "AB", "", None]
    assert apply(spark, ["C34.1"], "string", drop_dots) == ["C341"]


@pytest.mark.parametrize(
    "name, label",
    [
        ("Tiredness (Fatigue)", "Tiredness__Fatigue_"),
        ("Abdominal, Flank, Groin or Back Pain or Swelling",
         "Abdominal__Flank__Groin_or_Back_Pain_or_Swelling"),
        ("Pain and/or Frequency Passing Urine", "Pain_and/or_Frequency_Passing_Urine"),
    ],
)
def test_labels(spark, name, label):
    assert apply(spark, [name], "string", underscore_label) == [label]


def test_keep_alphanumeric(spark):
    assert apply(spark, ["A & B (c-1)é"], "string", keep_alphanumeric) == ["A  B c1"]


def test_map_values(spark):
    got = apply(
        spark, ["Rural village", "unknown", "elsewhere", None], "string",
        lambda c: map_values(c, RURAL_URBAN),
    )
    assert got == ["rural", "unknown", None, None]


def test_named_patterns(spark):
    got = apply(spark, ["K10", "Z800", "Z79", None], "string", lambda c: like_any(c, ["K%", "Z80%"]))
    assert got == [True, True, False, None]


def test_ages(spark):
    ages = [None, 39, 40, 49, 50, 90, 113, 114, 120]
    assert apply(spark, ages, "int", clean_age) == [None, 39, 40, 49, 50, 90, 113, None, None]
    got = apply(spark, ages, "int", lambda c: age_bucket(clean_age(c)))
    assert got == ["other", "other", "40-50", "40-50", "50-60", "90+", "90+", "other", "other"]


def test_condition_rules(spark):
    codes = ["C34", "C44", "C440", "D05", "I63", "i63", "", None]
    assert apply(spark, codes, "string", CANCER.matches) == [
        True, False, False, False, False, False, False, None,
    ]
    assert apply(spark, codes, "string", STROKE.matches)[4:6] == [True, False]


@pytest.mark.parametrize(
    "causes, expected",
    [
        ({}, 0),
        ({"s_cod_code_15": "C61"}, 1),
        ({"s_cod_code_3": "C44"}, 0),
        ({"s_cod_code_3": "C449", "s_underlying_cod_icd10": "C50"}, 1),
        ({"s_underlying_cod_icd10": "I21"}, 0),
    ],
)
def test_any_cause(spark, causes, expected):
    schema = ", ".join(f"{c} string" for c in CAUSE_COLUMNS)
    df = spark.createDataFrame([tuple(causes.get(c) for c in CAUSE_COLUMNS)], schema)
    assert df.select(CANCER.any_of(CAUSE_COLUMNS)).first()[0] == expected


def test_week_bounds(spark):
    row = spark.range(1).select(weeks_before("2021-08-31", 52), weeks_after("2021-08-31", 12)).first()
    assert list(row) == [dt.date(2020, 9, 1), dt.date(2021, 11, 23)]


CUT = dt.datetime(2021, 8, 31)
MOMENTS = [
    CUT - dt.timedelta(days=28), CUT - dt.timedelta(days=27), CUT,
    CUT.replace(hour=9), CUT + dt.timedelta(days=84), CUT + dt.timedelta(days=85), None,
]


def line_table(spark, moments, type_, cfg):
    rows = [(i, v) for i, v in enumerate(moments)]
    df = spark.createDataFrame(rows, f"i int, t {type_}")
    line = Timeline(df, cfg, "t")
    tests = [line.before(), line.after(), line.since(4), line.new_within(4), line.by(12)]
    out = df.select("i", *[t.alias(f"c{n}") for n, t in enumerate(tests)]).orderBy("i")
    return [tuple(r)[1:] for r in out.collect()]


def test_timeline_on_dates(spark, cfg):
    dates = [m.date() if m else None for m in MOMENTS if m != CUT.replace(hour=9)]
    got = line_table(spark, dates, "date", cfg)
    # before, after, counted in the last 4 weeks, new in the last 4 weeks, by week 12
    assert got == [
        (True, False, True, False, True),
        (True, False, True, True, True),
        (False, False, True, False, True),
        (False, True, True, False, True),
        (False, True, True, False, False),
        (None, None, None, None, None),
    ]


def test_timeline_on_timestamps(spark, cfg):
    got = line_table(spark, MOMENTS, "timestamp_ntz", cfg)
    assert got[2][:2] == (False, False)
    assert got[3][:2] == (False, True)
    daily = CohortConfig(day_grain=True)
    assert line_table(spark, MOMENTS, "timestamp_ntz", daily)[3][:2] == (False, False)


def test_timeline_on_iso_text(spark, cfg):
    text = ["2021-08-03", "2021-08-31", "2021-09-01"]
    got = line_table(spark, text, "string", cfg)
    assert [r[:2] for r in got] == [(True, False), (False, False), (False, True)]
    assert [r[2] for r in got] == [True, True, True]
    assert [r[3] for r in got] == [False, False, False]


def test_uniform_draw(spark):
    df = spark.range(20_000).select(uniform_draw(F.col("id"), 0).alias("u"))
    row = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= row[0] and row[1] < 1 and abs(row[2] - 0.5) < 0.01


def test_fixed_tables():
    columns = model_columns(CohortConfig())
    assert len(columns) == len(set(columns)) == 209
    assert "phr_maternal_and_infant_health" not in columns
    assert {"Z80-Z99_last_52_weeks", "ethnicity_code_null_removed_99"} <= set(columns)
    # The order is part of the contract.
    at = columns.index
    assert columns[0] == "patient_pseudo_id" and columns[-1].startswith("first_cancer_diagnosis")
    assert at("ethnicity_code_null_removed_K") + 1 == at("ethnicity_code_null_removed_F")
    assert at("imd_decile_null_removed_7") < at("imd_decile_null_removed_1")
    assert at("phr_date_of_birth") + 1 == at("phr_healthy_well")
    assert at("phr_nhs_region_null_removed_Midlands") + 1 == at("phr_hypertension")
    assert at("phr_cancer") + 1 == at("phr_date_of_death")
    digest = hashlib.sha256(",".join(columns).encode()).hexdigest()
    assert digest[:16] == "3dcf3fa677f36f66"
    assert len(SNAPSHOT_COLUMNS) == 70 and SNAPSHOT_COLUMNS[9] == "highest_acuity_segment_code"
    digest = hashlib.sha256(",".join(SNAPSHOT_COLUMNS).encode()).hexdigest()
    assert digest[:16] == "d5bd429beff38fed"
    assert len(SITE_CODES) == 20
    assert SITE_CODES["head_and_neck"][-1] == "C32"
