"""Substring search by an n-gram index against plain substring tests."""

from __future__ import annotations

import naive
import pytest
from conftest import plan_of, same_rows
from pyspark.sql import functions as F

from cohortal.operators import joins
from cohortal.operators.contains import contains_tag, ngram_index, tags_of_codes
from cohortal.operators.sites import site_tag
from registry import adapters, history

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def long_codes(spark):
    return history._long_codes(spark, SF)


def tags(df) -> dict:
    out: dict = {}
    for r in df.collect():
        out.setdefault(r["id"], []).append(r["cancer_type"])
    return {k: sorted(v) for k, v in out.items()}


def test_equal_to_one_filter_per_site(long_codes):
    found = contains_tag(long_codes)
    same_rows(found, naive.sites(long_codes))
    same_rows(found, site_tag(long_codes))
    assert found.count() > 0


def test_places_repeats_and_missing_codes(spark):
    rows = [
        (1, "C50"), (2, "xC50"), (3, "aC50b"), (4, "C50C50"), (5, "C15/C25"), (6, "c50"),
        (7, "C5"), (8, ""), (9, None), (10, "CC500"),
    ]
    df = spark.createDataFrame(rows, "id int, diagnosis string")
    found = tags(contains_tag(df))
    breast = {i: ["breast"] for i in (1, 2, 3, 4, 10)}
    upper = ["gi_upper_and_lower", "oesophageal", "pancreatic"]
    assert found == breast | {5: upper}


def test_patterns_of_any_length_and_as_a_table(spark):
    df = spark.createDataFrame([(1, "abcdef"), (2, "bc"), (3, "é bc ü")], "id int, diagnosis string")
    sets = {"one": ["a", "ü"], "two": ["bc"], "long": ["bcdef", "abcdefg"], "none": [""]}
    assert tags(contains_tag(df, sites=sets)) == {
        1: ["long", "one", "two"], 2: ["two"], 3: ["one", "two"],
    }
    table = spark.range(3_000).selectExpr(
        "concat('t', id) as tag", "case when id % 2 = 0 then lpad(id, 4, '0') end as pattern"
    )
    df = spark.createDataFrame([(1, "x0014-0999y"), (2, "0013")], "id int, diagnosis string")
    assert tags(contains_tag(df, sites=table)) == {1: ["t14"]}
    assert contains_tag(df, sites={}).count() == 0
    assert contains_tag(df.limit(0)).count() == 0


def test_the_events_columns_stay(spark):
    df = spark.createDataFrame(
        [("C50", "old", 1, 2, 3)], "diagnosis string, cancer_type string, code int, gram int, tag int"
    )
    found = contains_tag(df)
    assert found.columns == ["diagnosis", "code", "gram", "tag", "cancer_type"]
    assert tuple(found.first()) == ("C50", 1, 2, 3, "breast")


def test_the_index_holds_each_code_and_gram_once(spark):
    codes = spark.createDataFrame([("ababab",), ("ababab",), ("a",), (None,)], "c string")
    lengths = spark.createDataFrame([(2,), (6,), (2,)], "n int")
    found = sorted(map(tuple, ngram_index(codes, "c", lengths).collect()))
    assert found == [("ababab", "ab"), ("ababab", "ababab"), ("ababab", "ba")]


def test_no_pattern_is_tested_against_the_events(spark, long_codes):
    """The plan over the events holds a look-up by equality and no regular expression."""
    plan = plan_of(contains_tag(long_codes))
    assert "RLIKE" not in plan and "Contains" not in plan and "NestedLoop" not in plan


def test_a_hot_code_above_the_broadcast_bound(spark, monkeypatch):
    df = spark.range(9_000).selectExpr(
        "id", "case when id % 3 = 0 then 'xC50' else concat('D', id % 500, 'C34') end as diagnosis"
    )
    expected = contains_tag(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 10)
    try:
        found = contains_tag(df)
        assert "BroadcastHashJoin" not in plan_of(found)
        same_rows(found, expected)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found.where("cancer_type = 'breast'").count() == 3_000


def test_each_distinct_code_is_cut_once(spark, long_codes):
    index = tags_of_codes(
        long_codes, "diagnosis", spark.createDataFrame([("t", "C50")], "tag string, pattern string")
    )
    assert index.count() == long_codes.where(F.col("diagnosis").contains("C50")).select(
        "diagnosis"
    ).distinct().count()
    assert adapters.table(spark, SF, "lineitem").count() > index.count()
