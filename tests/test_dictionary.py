"""Packed first and last codes and code sets against the plain forms."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan_of, same_rows
from pyspark.sql import functions as F

from cohortal.operators import dictionary as d
from cohortal.operators.sites import site_tag
from cohortal.operators.summary import (
    distinct_codes,
    first_and_last,
    site_summary,
)
from cohortal.plans import features
from registry import adapters

ID = "patient_pseudo_id"
SF = "/root/testdata/sf0.001"
CFG = adapters.CFG


@pytest.fixture(scope="module")
def events(spark):
    """Driver events, some without a date or a code, one person with a third of them."""
    n = F.xxhash64("activity_id")
    hot = F.when(n % 3 == 0, "hot").otherwise(F.col(ID))
    return adapters.events(spark, SF).select(
        hot.alias(ID), "activity_id",
        F.when(n % 50 != 0, F.col("date")).alias("date"),
        F.when(n % 41 != 0, F.col("diagnosis")).alias("diagnosis"),
    )


@pytest.fixture(params=["short", "literal", "mapped", "table"])
def numbering(request, spark, events, monkeypatch):
    if request.param == "short":
        return d.ShortCodes()
    monkeypatch.setattr(d, "MAPPED_CODES", 5000 if request.param == "mapped" else 10)
    monkeypatch.setattr(d, "LITERAL_CODES", 10 if request.param == "table" else 4096)
    return d.code_dictionary(events, "diagnosis")


def test_ends_equal_the_plain_aggregate(events, numbering):
    keys = [ID]
    got = first_and_last(events, keys, dictionary=numbering)
    same_rows(got, first_and_last(events, keys))
    plan = plan_of(got)
    assert "SortAggregate" not in plan and "partial_min" in plan


def test_sets_equal_the_plain_aggregate_in_one_shuffle(spark, events, monkeypatch):
    expected = distinct_codes(events, ID, name="codes")
    known = d.code_dictionary(events, "diagnosis")
    for most in (4, 1000):
        monkeypatch.setattr(d, "SET_WORDS", most)
        got = distinct_codes(events, ID, name="codes", dictionary=known)
        same_rows(got, expected)
        assert plan_of(got).count("Exchange hashpartitioning") == 1
    ends = first_and_last(events, [ID], with_codes=True, dictionary=known)
    plain = first_and_last(events, [ID], with_codes=True)
    same_rows(ends.select(ID, "codes"), plain.select(ID, "codes"))


def test_numbers_sort_like_codes(spark, monkeypatch):
    codes = ["C50", "C5", "C500", "Z", "A00", "a", "C50.1", "0", "~~~~~"]
    df = spark.createDataFrame([(c,) for c in [*codes, None, "C50"]], "c string")
    ordered = sorted(codes)
    for most in (4096, 3):
        monkeypatch.setattr(d, "LITERAL_CODES", most)
        table = d.code_dictionary(df, "c").table.orderBy("_number").collect()
        assert [(r["_code"], r["_number"]) for r in table] == list(zip(ordered, range(1, 99)))
    short = d.ShortCodes()
    rows = short.number(df, "c").select("c", "_number", short.decode(F.col("_number")).alias("back"))
    found = {r["c"]: r["_number"] for r in rows.collect()}
    assert sorted(codes, key=lambda c: found[c]) == ordered and found[None] == 0
    assert rows.where("not (c <=> back)").count() == 0


@pytest.mark.parametrize("code", ["C50.10", "é", ""])
def test_a_code_that_has_no_number_is_an_error(spark, code):
    df = spark.createDataFrame([("p", dt.date(2020, 1, 1), code)], f"{ID} string, date date, diagnosis string")
    with pytest.raises(Exception, match="not a short code"):
        first_and_last(df, [ID], dictionary=d.ShortCodes()).collect()
    known = d.code_dictionary(df.withColumn("diagnosis", F.lit("A00")), "diagnosis")
    with pytest.raises(Exception, match="not in the code dictionary"):
        first_and_last(df, [ID], dictionary=known).collect()


def test_empty_tables_and_timestamps(spark, events):
    none = events.limit(0)
    known = d.code_dictionary(none, "diagnosis")
    assert known.codes == [] and first_and_last(none, [ID], dictionary=known).count() == 0
    assert distinct_codes(none, ID, name="codes", dictionary=known).count() == 0
    # Timestamps do not fit beside a number; the plain form is used.
    timed = events.withColumn("date", F.col("date").cast("timestamp"))
    same_rows(first_and_last(timed, [ID], dictionary=d.ShortCodes()), first_and_last(timed, [ID]))


def test_declared_sites_equal_spans_in_one_shuffle(spark, events):
    tagged = site_tag(events.where(f"date > date'{CFG.cutoff}'"))
    known = d.code_dictionary(tagged, "diagnosis")
    values = [r[0] for r in tagged.select("cancer_type").distinct().collect()]
    got = site_summary(tagged, CFG, "cancer_type", values=values, dictionary=known)
    same_rows(got, site_summary(tagged, CFG, "cancer_type"))
    plan = plan_of(got)
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan
    some = site_summary(tagged, CFG, "cancer_type", values=values[:1], dictionary=known)
    assert {r[0] for r in some.select("cancer_type").collect()} == set(values[:1])


@pytest.mark.parametrize(
    "name", ["group_summary", "category_summary", "first_per_group", "category_pivot", "site_summary"]
)
def test_no_query_sorts_raw_events(spark, name):
    import __spark_entry__ as contract

    plan = plan_of(contract.queries()[name](spark, SF))
    assert "SortAggregate" not in plan


def test_outcomes_take_one_shuffle(spark):
    import __spark_entry__ as contract

    for name in ("outcome_labels", "distinct_codes"):
        plan = plan_of(contract.queries()[name](spark, SF))
        assert plan.count("Exchange hashpartitioning") == 1, name


def test_the_builds_and_the_features_agree(spark, events):
    same_rows(
        features.condition_outcome(events, CFG, adapters.fixed.CANCER),
        features.condition_outcome(
            events, CFG, adapters.fixed.CANCER,
            d.code_dictionary(events.where("diagnosis like 'C%'"), "diagnosis"),
        ),
    )
