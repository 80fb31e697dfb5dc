"""Staged tables in buckets: same rows, read by the key without another shuffle."""

from __future__ import annotations

import os
import re
from dataclasses import fields

import pytest
from conftest import plan_of, same_rows
from pyspark.sql import functions as F

from cohortal import fixed
from cohortal.plans import build
from cohortal.sources.tables import discard, stage, stage_bucketed
from registry import adapters

CFG = adapters.CFG
ID = CFG.entity


def shuffles(df) -> int:
    return len(re.findall(r"\bExchange ", plan_of(df)))


@pytest.fixture(autouse=True)
def no_automatic_broadcast(spark):
    """As with tables that are too large for it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def ready(spark, tmp_path_factory):
    made = adapters.sources(spark, "/root/testdata/sf0.001")
    folder = str(tmp_path_factory.mktemp("sources"))
    for f in fields(build.Sources):
        getattr(made, f.name).write.parquet(f"{folder}/{f.name}.parquet")
    return build.prepare(build.Sources.read(spark, folder), CFG, first_year=adapters.FIRST_YEAR)


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows with one key, a third without a key."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    return spark.range(3000).select(key.alias("k"), "id", F.lit(None).cast("date").alias("d"))


def test_rows_and_types_come_back(spark, rows):
    staged = stage_bucketed(rows, "rows", "k")
    assert staged.dtypes == rows.dtypes
    same_rows(staged, rows)
    same_rows(stage_bucketed(rows.limit(0), "none", "k"), rows.limit(0))


def test_each_key_lies_in_one_file_and_no_name_stays(spark, rows):
    before = {t.name for t in spark.catalog.listTables()}
    staged = stage_bucketed(rows, "rows", "k")
    files = staged.select("k", F.input_file_name().alias("file")).distinct()
    assert files.groupBy("k").count().where("count > 1").isEmpty()
    assert {t.name for t in spark.catalog.listTables()} == before
    assert spark.conf.get("spark.checkpoint.dir") in staged.inputFiles()[0]


def test_discard_removes_the_files(spark, rows):
    staged = stage_bucketed(rows, "rows", "k")
    file = staged.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(file)
    discard(staged)
    assert not os.path.exists(file)


def test_groups_and_joins_read_the_table_where_it_lies(spark, rows):
    staged, plain = stage_bucketed(rows, "rows", "k"), stage(rows, "rows")
    counts = [t.groupBy("k").count() for t in (staged, plain)]
    assert [shuffles(c) for c in counts] == [0, 1]
    same_rows(*counts)
    by_key = plain.groupBy("k").agg(F.max("id").alias("most"))
    joined = [t.join(by_key, "k", "left") for t in (staged, plain)]
    assert [shuffles(j) for j in joined] == [1, 2]
    same_rows(*joined)


def test_filters_and_columns_reach_the_scan(spark, rows):
    plan = plan_of(stage_bucketed(rows, "rows", "k").where("id > 7").select("k"))
    assert "GreaterThan(id,7)" in plan and "d:date" not in plan


def test_readers_of_the_spans_do_not_shuffle(spark, ready):
    """The long list is the largest intermediate; all that is read of it stays in place."""
    for name, table in {
        "prior": build.prior_condition(ready, CFG, fixed.CANCER),
        "outcome": build.condition_outcome(ready, CFG, fixed.STROKE),
        "sites": build.site_outcomes(ready, CFG),
        "categories": build.category_features(ready, CFG, [fixed.FAMILY_HISTORY_CATEGORY]),
    }.items():
        assert shuffles(table) == 0, name


def test_modelling_tables_do_not_shuffle(spark, ready):
    people = build.stage_people(ready, CFG, tie_break=adapters.TIE_BREAK)
    for table in (build.cancer_table(ready, people, CFG), build.stroke_table(ready, people, CFG)):
        assert shuffles(table) == 0


def test_bucketed_and_plain_spans_give_the_same(spark, ready):
    plain = build.Prepared(ready.sources, stage(ready.spans, "plain"), ready.outpatient)
    for make in (
        lambda r: build.prior_condition(r, CFG, fixed.CANCER),
        lambda r: build.condition_outcome(r, CFG, fixed.CANCER),
        lambda r: build.site_outcomes(r, CFG),
        lambda r: build.category_features(r, CFG, adapters.CATEGORIES),
    ):
        same_rows(make(ready), make(plain))
