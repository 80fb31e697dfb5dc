"""The sink: replaced as a whole or by partition, and never left half-written."""

from __future__ import annotations

import os

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from cohortal.sources import tables
from cohortal.sources.tables import (
    SchemaChanged,
    overwrite_partitions,
    read_table,
    recover_table,
    write_table,
)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def rows(spark, n, **columns):
    df = spark.range(n).withColumn("part", F.expr("cast(id % 3 as int)"))
    return df.withColumns({k: F.lit(v) for k, v in columns.items()})


def stopping(df):
    """Rows of which one makes the writer fail, after others have been written."""
    stop = F.when(F.col("id") == 7, F.raise_error(F.lit("stop")).cast("string"))
    return df.repartition(4, "id").withColumn("v", F.coalesce(stop, F.lit("late")))


def test_a_stopped_writer_leaves_the_old_table(spark, path):
    old = rows(spark, 20, v="old")
    write_table(old, path)
    with pytest.raises(Exception, match="stop"):
        write_table(stopping(rows(spark, 20)), path)
    same_rows(read_table(spark, path), old)
    assert os.listdir(os.path.dirname(path)) == ["table"]


def test_a_stopped_partition_writer_leaves_the_old_table(spark, path):
    old = rows(spark, 20, v="old")
    write_table(old, path, partition_by=["part"])
    with pytest.raises(Exception, match="stop"):
        overwrite_partitions(stopping(rows(spark, 20)), path, ["part"])
    same_rows(read_table(spark, path), old)


def test_a_table_may_be_replaced_by_rows_read_from_it(spark, path):
    write_table(rows(spark, 20), path)
    write_table(read_table(spark, path).where("id < 5"), path, same_schema=True)
    assert read_table(spark, path).count() == 5


def test_one_partition_is_replaced_and_the_others_stay(spark, path):
    old = rows(spark, 30, v="old")
    write_table(old, path, partition_by=["part"])
    overwrite_partitions(rows(spark, 100, v="new").where("part = 1"), path, ["part"])
    got = read_table(spark, path)
    same_rows(got.where("part <> 1"), old.where("part <> 1"))
    same_rows(got.where("part = 1"), rows(spark, 100, v="new").where("part = 1"))
    overwrite_partitions(rows(spark, 0, v="new"), path, ["part"])
    assert read_table(spark, path).count() == got.count()


def test_a_changed_schema_is_refused(spark, path):
    write_table(rows(spark, 9, v="old"), path, partition_by=["part"])
    for other in (rows(spark, 9), rows(spark, 9, v=1), rows(spark, 9, v="x", w="y")):
        with pytest.raises(SchemaChanged):
            overwrite_partitions(other, path, ["part"])
        with pytest.raises(SchemaChanged):
            write_table(other, path, partition_by=["part"], same_schema=True)
    assert read_table(spark, path).where("v = 'old'").count() == 9
    assert os.listdir(os.path.dirname(path)) == ["table"]
    write_table(rows(spark, 4), path)
    assert read_table(spark, path).columns == ["id", "part"]


def test_a_writer_lost_between_the_renamings(spark, path):
    write_table(rows(spark, 9), path)
    os.rename(path, path + "__old-1")
    assert recover_table(spark, path) and read_table(spark, path).count() == 9
    assert not recover_table(spark, path)
    os.rename(path, path + "__old-2")
    write_table(rows(spark, 3), path)
    assert read_table(spark, path).count() == 3
    assert not recover_table(spark, path + "_none") and not recover_table(spark, path + "/a/b")


def test_staged_alone(spark):
    """Tables staged on the way are removed, others stay; the session's setting too."""
    before = spark.conf.get(tables.SHUFFLE_CLEANUP, None)
    first = tables.stage(spark.range(10), "first")
    inner = []

    def build():
        inner.append(tables.stage(first.where("id > 3"), "inner"))
        return inner[0].groupBy((inner[0].id % 2).alias("odd")).count()

    out = tables.stage_alone(build, "out")
    assert {tuple(r) for r in out.collect()} == {(0, 3), (1, 3)}
    assert first.count() == 10
    assert not tables.table_exists(spark, inner[0].inputFiles()[0])
    tables.discard(first)
    assert not tables.table_exists(spark, first.inputFiles()[0].rsplit("/", 1)[0])
    assert spark.conf.get(tables.SHUFFLE_CLEANUP, None) == before
