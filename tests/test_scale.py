"""Single-pass forms against the long way, hot keys, broadcasts and plan shapes."""

from __future__ import annotations

from datetime import date

import naive
import pytest
from conftest import plan_of, same_rows
from pyspark.sql import functions as F

from cohortal import fixed
from cohortal.operators import joins, longlist
from cohortal.operators.longlist import top_row
from cohortal.operators.lookback import lookback_counts
from cohortal.operators.sites import site_tag
from cohortal.operators.summary import (
    SPAN,
    code_spans,
    first_and_last,
    spans_around,
    spans_on_side,
)
from cohortal.plans import codes, features
from cohortal.sources.tables import input_bytes, read_table, stage, write_table
from registry import adapters

ID = "patient_pseudo_id"
CFG = adapters.CFG
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def events(spark):
    return adapters.events(spark, SF)


@pytest.fixture(scope="module")
def skewed(events):
    """A third of all events belongs to one person."""
    hot = F.when(F.xxhash64("activity_id", "diagnosis") % 3 == 0, "hot").otherwise(F.col(ID))
    return events.withColumn(ID, hot)


def exchanges(df) -> int:
    return plan_of(df).count("Exchange ")


@pytest.mark.parametrize("source", ["events", "skewed"])
def test_counts_equal_the_long_way(source, request):
    df = request.getfixturevalue(source)
    ours = lookback_counts(df, CFG, time="date", total="n", prefix="n_")
    same_rows(ours, naive.counts(df, CFG, "date", "n", "n_"))


def test_counts_take_one_scan_and_one_shuffle(spark):
    orders = adapters.table(spark, SF, "orders").withColumnRenamed("o_custkey", ID)
    plan = plan_of(lookback_counts(orders, CFG, time="o_orderdate", total="n", prefix="n_"))
    assert plan.count("FileScan") == 1 and plan.count("Exchange ") == 1
    assert "LessThan(o_orderdate" in plan and "IsNotNull(o_custkey)" in plan
    assert "o_totalprice" not in plan
    long_way = plan_of(naive.counts(orders, CFG, "o_orderdate", "n", "n_"))
    assert long_way.count("FileScan") == 6


@pytest.mark.parametrize("source", ["events", "skewed"])
def test_first_and_last_equal_the_long_way(source, request):
    df = request.getfixturevalue(source)
    got = first_and_last(df, [ID])
    flat = got.select(
        ID, F.col("first.date").alias("first_date"), F.col("first.code").alias("first_code"),
        F.col("last.date").alias("last_date"), F.col("last.code").alias("last_code"),
    )
    same_rows(flat, naive.ends(df, [ID]))


def test_spans_give_the_same_ends(skewed):
    spans = code_spans(skewed, [ID])
    same_rows(first_and_last(spans, [ID], **SPAN), first_and_last(skewed, [ID]))


def test_a_hot_person_is_small_before_it_is_gathered(skewed):
    """After the first shuffle the hot person holds one row per code, not per event."""
    raw = skewed.where(f"{ID} = 'hot'").count()
    reduced = code_spans(skewed, [ID]).where(f"{ID} = 'hot'").count()
    assert reduced == skewed.where(f"{ID} = 'hot'").select("diagnosis").distinct().count()
    assert reduced < raw / 5


@pytest.mark.parametrize("side, test", [("before", "<"), ("after", ">")])
def test_spans_around_equal_spans_of_each_side(events, side, test):
    filtered = events.where(f"date {test} date'{CFG.cutoff}'")
    got = spans_on_side(spans_around(events, CFG), CFG, side)
    same_rows(got, code_spans(filtered, [ID]))


def test_duplicates_do_not_change_spans(events):
    same_rows(spans_around(events.unionAll(events), CFG), spans_around(events, CFG))


def test_sites_equal_the_long_way_in_one_scan(events):
    same_rows(site_tag(events), naive.sites(events))
    assert plan_of(site_tag(events)).count("FileScan") == 2  # lines and their orders


def test_results_do_not_depend_on_partitioning(events):
    one = features.condition_outcome(events.coalesce(1), CFG, fixed.CANCER)
    many = features.condition_outcome(events.repartition(13), CFG, fixed.CANCER)
    same_rows(one, many)


# Joins


def test_hot_keys_finds_the_heavy_ones(spark):
    df = spark.range(30_000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else cast(id as string) end as k"
    )
    found = joins.hot_keys(df, "k")
    assert "hot" in found and len(found) <= joins.shuffle_partitions(df)
    assert joins.hot_keys(df.limit(0), "k") == []


@pytest.fixture
def hot_left(spark):
    return spark.range(30_000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null"
        " else cast(id % 500 as string) end as k"
    )


@pytest.fixture
def right(spark):
    rows = [("hot", 1), ("hot", 2), (None, 3), *[(str(n), n) for n in range(0, 500, 2)]]
    return spark.createDataFrame(rows, "key string, v int")


def test_salted_join_equals_the_plain_join(hot_left, right):
    plain = hot_left.join(right, hot_left.k == right.key, "left")
    salted = joins.salted_left_join(hot_left, right, "k", "key")
    assert salted.columns == plain.columns
    same_rows(salted, plain)


def test_salting_spreads_the_hot_key(spark, hot_left, right):
    """No join task holds more than a small share of the rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def heaviest(df):
            sizes = df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
            return sizes / df.count()

        assert heaviest(hot_left.join(right, hot_left.k == right.key, "left")) > 0.4
        assert heaviest(joins.salted_left_join(hot_left, right, "k", "key")) < 0.25
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_null_keys_take_an_even_share(spark):
    """Nine of ten rows have no key; each task gets as much as the input partitions give."""
    left = spark.range(0, 40_000, 1, 32).selectExpr(
        "id", "case when id % 10 = 0 then cast(id as string) end as k"
    )
    right = spark.range(0, 40_000, 20).selectExpr("cast(id as string) as key", "id as v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.salted_left_join(left, right, "k", "key", unique_left=True)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) <= 3 * 40_000 / len(sizes)
        assert joined.count() == 40_000 and joined.where("v is not null").count() == 2_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_combined_codes_use_a_hash_distinct(spark):
    """No column beyond the four is carried, so nothing is sorted to remove repeats."""
    events = spark.createDataFrame(
        [("a", "1", date(2020, 1, 1), "C50", "Inpatient")],
        f"{ID} string, activity_id string, date date, diagnosis string, source string",
    )
    reference = spark.createDataFrame(
        [("C50", "C00-C79", None)], "alt_code string, category_3_code string, effective_to date"
    )
    plan = plan_of(codes.combined_codes(events, events, events, reference, CFG))
    assert "SortAggregate" not in plan


def test_lookup_broadcasts_only_what_it_measured(spark, hot_left, right):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = joins.lookup_join(hot_left, right, "k", "key")
        large = joins.lookup_join(hot_left, right, "k", "key", max_rows=10)
        assert "BroadcastHashJoin" in plan_of(small)
        assert "BroadcastHashJoin" not in plan_of(large)
        same_rows(small, large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_bound_counts_bytes_too(spark, monkeypatch):
    wide = spark.range(100).select(
        "id", F.repeat(F.lit("x"), 1000).alias("t"), F.array(F.lit("y"), F.lit(None)).alias("a")
    )
    assert joins.fits_broadcast(wide)
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 50_000)
    assert not joins.fits_broadcast(wide)
    assert joins.fits_broadcast(wide.limit(0))


# Plans


def test_top_row_is_cut_before_the_shuffle(events):
    plan = plan_of(top_row(events, [ID], [F.col("date").desc()]))
    assert plan.count("WindowGroupLimit") == 2


def test_site_table_needs_no_third_shuffle(events):
    later = features.site_outcomes(events, CFG)
    # Spans by (person, site, code), then one move to the person.
    assert exchanges(later) - plan_of(later).count("BroadcastExchange") == 2


def test_no_python_in_the_plans(spark):
    import __spark_entry__ as contract

    for name in ("calls_features", "category_pivot", "site_pivot", "strata_crosstab", "split_stratified"):
        plan = plan_of(contract.queries()[name](spark, "/root/testdata/sf0.001"))
        assert "Python" not in plan and "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


# Tables


def test_staged_table_is_read_back_with_pushdown(spark, events):
    staged = stage(spans_around(events, CFG), "spans")
    same_rows(staged, spans_around(events, CFG))
    plan = plan_of(spans_on_side(staged, CFG, "after").where(fixed.CANCER.matches(F.col("code"))))
    assert "IsNotNull(first_after)" in plan and "StringStartsWith(code,C)" in plan
    assert "first_before" not in plan


def test_write_and_read(spark, tmp_path, events):
    path = str(tmp_path / "events")
    write_table(events, path)
    same_rows(read_table(spark, path), events)
    write_table(events.limit(10), path)
    assert read_table(spark, path).count() == 10
    write_table(events.withColumn("year", F.year("date")), path, partition_by=["year"])
    assert read_table(spark, path).where("year = 1998").inputFiles()[0].count("year=") == 1


def test_staging_uses_the_folder_the_session_names(spark, events):
    folder = spark.conf.get("spark.checkpoint.dir")
    files = stage(events, "events").inputFiles()
    assert files and all(folder in f for f in files)


def test_distinct_tasks_follow_the_input(spark, tmp_path, monkeypatch):
    rows = spark.range(600).selectExpr("cast(id % 50 as string) as a", "nullif(id % 7, 0) as b")
    path = f"{tmp_path}/a folder/rows.parquet"
    write_table(rows, path)
    read = read_table(spark, path)
    assert input_bytes(read.unionAll(read)) == input_bytes(read) > 0
    monkeypatch.setattr(longlist, "DISTINCT_BYTES", max(1, input_bytes(read) // 40))
    got = longlist.spread_distinct(read)
    same_rows(got, rows.distinct())
    assert got.rdd.getNumPartitions() >= 40 > joins.shuffle_partitions(read)
    # Rows without files take the partitions of the session.
    assert longlist.spread_distinct(rows).rdd.getNumPartitions() == joins.shuffle_partitions(rows)
    monkeypatch.setattr(longlist, "DISTINCT_TASKS", 20)
    assert longlist.spread_distinct(read).rdd.getNumPartitions() == 20


def test_union_hashes_no_rows_before_they_are_dealt(spark):
    made = spark.createDataFrame(
        [("1", "2020-01-01", "A", "s"), ("1", "2020-01-01", "A", "s"), (None, "2020-01-01", "A", "s")],
        f"{ID} string, date string, diagnosis string, source string",
    )
    got = codes.union_sources(made, made, made, CFG, once_a_day=True)
    assert [tuple(r) for r in got.collect()] == [("1", "2020-01-01", "A", "s")]
    below = plan_of(got).split("Exchange ")[-1]
    assert "HashAggregate" not in below
