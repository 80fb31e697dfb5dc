"""Crosstabs by mixed-radix numbers and splits that meet their fractions in every stratum."""

from __future__ import annotations

from collections import Counter
from math import ceil

import pytest
from conftest import plan_of, same_rows
from pyspark.sql import functions as F

from cohortal.operators.strata import (
    numbered_values,
    split_by_stratum,
    strata_crosstab,
    stratum_thresholds,
)

ID = "patient_pseudo_id"


@pytest.fixture(scope="module")
def people(spark):
    """Half of the rows in one stratum, two small ones, and one without a label."""
    stratum = (
        F.when(F.col("id") < 30_000, "hot")
        .when(F.col("id") < 30_010, "ten")
        .when(F.col("id") < 30_011, "one")
        .when(F.col("id") >= 32_000, F.concat(F.lit("s"), (F.col("id") % 400).cast("string")))
    )
    return spark.range(0, 60_000, 1, 24).select(
        F.col("id").cast("string").alias(ID), stratum.alias("stratum")
    )


def shares(split) -> dict:
    counted = split.groupBy("stratum", "dataset").count().collect()
    out: dict = {}
    for r in counted:
        out.setdefault(r["stratum"], Counter())[r["dataset"]] = r["count"]
    return out


def test_every_stratum_meets_its_fractions(people):
    found = shares(split_by_stratum(people, ID, "stratum", seed=3))
    assert len(found) == 404
    for stratum, parts in found.items():
        n = sum(parts.values())
        error = 1 + n / 10_000
        assert abs(parts["train"] - ceil(0.6 * n)) <= error, stratum
        assert abs(parts["train"] + parts["validate"] - ceil(0.8 * n)) <= 2 * error, stratum
    assert found["ten"] == {"train": 6, "validate": 2, "test": 2}
    assert found["one"] == {"train": 1} and sum(found[None].values()) == 1_989


def test_a_hot_stratum_is_neither_sorted_nor_gathered(spark, people):
    """What reaches the tasks of the second stage is one sketch per stratum and map task."""
    plan = plan_of(split_by_stratum(people, ID, "stratum"))
    assert "Window" not in plan and "Sort" not in plan
    thresholds = stratum_thresholds(people, ID, "stratum")
    assert thresholds.count() == 404
    assert thresholds.where("stratum_key = '=hot'").first()["rows"] == 30_000


def test_coarser_sketches_stay_within_their_error(people):
    found = shares(split_by_stratum(people, ID, "stratum", accuracy=100))["hot"]
    assert abs(found["train"] - 18_000) <= 301


def test_other_fractions_and_kept_thresholds(people):
    fractions = {"a": 1.0, "b": 3.0}
    bounds = stratum_thresholds(people, ID, "stratum", fractions=fractions)
    split = split_by_stratum(people, ID, "stratum", fractions=fractions, thresholds=bounds)
    assert shares(split)["ten"] == {"a": 3, "b": 7}
    # Later rows: known strata by the same bounds, an unknown one by the fractions.
    some = people.where("stratum = 'ten'").unionAll(
        people.where("stratum = 'hot'").withColumn("stratum", F.lit("new"))
    )
    later = split_by_stratum(some, ID, "stratum", fractions=fractions, thresholds=bounds)
    same_rows(later.where("stratum = 'ten'"), split.where("stratum = 'ten'"))
    new = shares(later)["new"]
    assert abs(new["a"] / sum(new.values()) - 0.25) < 0.02
    assert split_by_stratum(people, ID, "stratum", fractions={"all": 1}).select(
        "dataset"
    ).distinct().collect()[0][0] == "all"


def test_splits_do_not_depend_on_partitioning(people):
    few = people.where("stratum <> 'hot'")
    same_rows(
        split_by_stratum(few.coalesce(1), ID, "stratum"),
        split_by_stratum(few.repartition(13), ID, "stratum"),
    )


def test_equal_and_missing_keys(spark):
    rows = [("a", "x"), ("a", "x"), (None, "x"), (None, None)]
    df = spark.createDataFrame(rows, f"{ID} string, stratum string")
    split = split_by_stratum(df, ID, "stratum")
    assert split.count() == 4
    assert split.where(f"{ID} = 'a'").select("dataset").distinct().count() == 1
    assert split_by_stratum(df.limit(0), ID, "stratum").count() == 0


def test_an_older_split_column_is_replaced(spark):
    df = spark.createDataFrame([("a", "x", "old")], f"{ID} string, stratum string, dataset string")
    split = split_by_stratum(df, ID, "stratum")
    assert split.columns == [ID, "stratum", "dataset"] and split.first()["dataset"] == "train"


def test_crosstab_reads_the_table_once_and_multiplies_nothing(spark):
    person = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    table = strata_crosstab(person, ["c_mktsegment", "c_nationkey"], "label")
    plan = plan_of(table)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "customer" not in plan
    segments, nations = (person.select(c).distinct().count() for c in ("c_mktsegment", "c_nationkey"))
    assert table.count() == table.distinct().count() == segments * nations


def test_crosstab_of_one_column_and_of_no_rows(spark):
    df = spark.createDataFrame([(1.5, None), (None, None), (1.5, None)], "a double, b date")
    table = strata_crosstab(df, ["a", "b"], "label")
    assert sorted(table.select("a").collect(), key=str) == [(1.5,), (None,)]
    assert dict(table.dtypes)["a"] == "double" and dict(table.dtypes)["b"] == "date"
    assert strata_crosstab(df, ["a"], "label").count() == 2
    assert strata_crosstab(df.limit(0), ["a", "b"], "label").count() == 0


def test_values_are_numbered_without_gaps_in_every_column(spark):
    df = spark.range(5_000).selectExpr("id % 700 as a", "id % 3 as b", "cast(null as int) as c")
    found = numbered_values(df, ["a", "b", "c"]).collect()
    by_column: dict = {}
    for r in found:
        by_column.setdefault(r["c"], []).append(r["n"])
    assert {c: sorted(n) for c, n in by_column.items()} == {
        "a": list(range(700)), "b": [0, 1, 2], "c": [0],
    }
