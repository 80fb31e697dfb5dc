"""Parquet tables and intermediate tables that cut a plan in two."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"
MAX_BUCKETS = "spark.sql.sources.bucketing.maxBuckets"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)
_RUN_FOLDER: ContextVar[str | None] = ContextVar("run_folder", default=None)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


class SchemaChanged(ValueError):
    """The rows to be written do not fit the table that is there."""


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and a function that makes its path objects."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that the rows are read from, each file once."""
    sizes = {}
    spark = df.sparkSession
    for path in set(df.inputFiles()):
        file = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(path))
        system = file.getFileSystem(spark._jsc.hadoopConfiguration())
        sizes[path] = system.getFileStatus(file).getLen()
    return sum(sizes.values())


def table_exists(spark: SparkSession, path: str) -> bool:
    system, make = _file_system(spark, path)
    return system.exists(make(path))


def _beside(path: str, kind: str) -> str:
    return f"{path.rstrip('/')}__{kind}-{uuid.uuid4().hex}"


def recover_table(spark: SparkSession, path: str) -> bool:
    """Put back the old table if a writer was lost after it had moved it away and before it
    had put the new one in its place. True if there was something to put back."""
    system, make = _file_system(spark, path)
    target = make(path.rstrip("/"))
    if system.exists(target) or not system.exists(target.getParent()):
        return False
    moved = [
        f.getPath()
        for f in system.listStatus(target.getParent())
        if f.getPath().getName().startswith(f"{target.getName()}__old-")
    ]
    return bool(moved) and system.rename(max(moved, key=lambda p: p.toString()), target)


def _columns(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def check_schema(df: DataFrame, path: str, *, partition_by: list[str] | None = None) -> None:
    """Raise unless the rows have the columns of the table, and of the same types.

    Partition columns are compared by name: their type is read off folder names.
    """
    loose = set(partition_by or [])
    there, here = _columns(df.sparkSession.read.parquet(path).schema), _columns(df.schema)
    differing = {
        c: (there.get(c), here.get(c))
        for c in {*there, *here}
        if c not in there or c not in here or (c not in loose and there[c] != here[c])
    }
    if differing:
        raise SchemaChanged(f"{path}: (table, rows) differ in {differing}")


def write_table(
    df: DataFrame,
    path: str,
    *,
    partition_by: list[str] | None = None,
    same_schema: bool = False,
) -> None:
    """Replace a Parquet table, or make a new one.

    The rows are written beside the table, which stays as it is until they are complete and,
    with ``same_schema``, have been found to have its columns. Then the two change places by
    renaming. So a writer that fails or is lost on the way leaves the old table, readers
    never see half of a new one, and ``df`` may itself read the table. ``recover_table``
    settles the one case between the two renamings; each write begins with it.

    The rebalance hint lets Spark even out file sizes, splitting skewed partitions
    and merging small ones.
    """
    spark = df.sparkSession
    recover_table(spark, path)
    system, make = _file_system(spark, path)
    new, old = make(_beside(path, "new")), make(_beside(path, "old"))
    writer = df.hint("rebalance", *(partition_by or [])).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(new.toString())
        there = table_exists(spark, path)
        if there and same_schema:
            check_schema(spark.read.parquet(new.toString()), path, partition_by=partition_by)
        if there and not system.rename(make(path), old):
            raise OSError(f"{path} cannot be moved")
        if not system.rename(new, make(path)):
            recover_table(spark, path)
            raise OSError(f"{path} cannot be put in place")
    finally:
        if system.exists(new):
            system.delete(new, True)
    if system.exists(old):
        system.delete(old, True)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace those partitions of a table that ``df`` has rows of, and no others.

    The rows must have the table's columns. Spark writes them to a folder of their own and
    moves the partitions at the end, so a writer that fails before leaves the table.
    """
    if table_exists(df.sparkSession, path):
        check_schema(df, path, partition_by=partition_by)
    writer = df.hint("rebalance", *partition_by).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def staging_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints, else the shared warehouse."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get(WAREHOUSE_DIR)}/cohortal_staged").rstrip("/")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of staged tables, wherever the cluster keeps it."""
    system, make = _file_system(spark, folder)
    system.delete(make(folder), True)


@contextmanager
def one_folder(spark: SparkSession) -> Iterator[str]:
    """Keep all tables staged inside the block in one folder. Whoever knows when the last
    of them has been read removes it."""
    folder = f"{staging_folder(spark)}/cohortal-{uuid.uuid4().hex}"
    token = _RUN_FOLDER.set(folder)
    try:
        yield folder
    finally:
        _RUN_FOLDER.reset(token)


@contextmanager
def staged_run(spark: SparkSession) -> Iterator[str]:
    """As ``one_folder``, and remove the folder at the end.

    For callers that write their results within the block; a table read later would miss
    its staged inputs.
    """
    with one_folder(spark) as folder:
        try:
            yield folder
        finally:
            remove_folder(spark, folder)


def stage_path(spark: SparkSession, name: str) -> str:
    """A path of its own for a staged table, in the folder of the run if there is one."""
    run, unique = _RUN_FOLDER.get(), uuid.uuid4().hex
    return f"{run}/{unique}/{name}" if run else f"{staging_folder(spark)}/cohortal-{unique}/{name}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of a query that runs in the block as soon as it ends.

    Else they lie on the executors' disks until the driver's garbage collector finds the
    query. The session's own setting is put back.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def _note_staged(path: str) -> None:
    made = _STAGED.get()
    if made is not None:
        made.append(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several consumers read, and read it back.

    It survives lost executors and, unlike a cached table, filters and column
    lists of the consumers reach its scan. What was shuffled for it is removed.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    with _shuffles_removed(spark):
        df.write.parquet(path)
    _note_staged(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """As ``stage``, with the rows of a key in one bucket, so that consumers which group or
    join by the key read the table where it lies.

    There are as many buckets as shuffle partitions, hashed alike, so that other tables
    shuffled by the key meet it as they are. Rows move to their bucket before they are
    written (not at all if they lie by the key already), one file for each bucket. All rows
    of a key, null too, go through one task: this is for tables whose rows per key are
    bounded, as codes of a person, not for raw events.

    Spark keeps buckets for tables with a name only. The name is dropped at once; as the
    table is external its files stay, and the DataFrame returned goes on reading them.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    buckets = int(spark.conf.get(SHUFFLE_PARTITIONS))
    buckets = max(1, min(buckets, int(spark.conf.get(MAX_BUCKETS, "100000"))))
    table = f"spark_catalog.default.cohortal_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.format("parquet").option("path", path)
    with _shuffles_removed(spark):
        writer.bucketBy(buckets, key).saveAsTable(table)
    try:
        _note_staged(path)
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def stage_alone(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """Stage the table that ``build`` returns, and remove the tables staged on the way to it.

    Nothing that is read later may depend on those.
    """
    made: list[str] = []
    token = _STAGED.set(made)
    try:
        out = stage(build(), name)
    finally:
        _STAGED.reset(token)
    kept, outer = made.pop(), _STAGED.get()
    if outer is not None:
        outer.append(kept)
    for path in made:
        remove_folder(out.sparkSession, path)
    return out


def discard(table: DataFrame) -> None:
    """Remove a staged table, as ``stage`` returned it, that nothing reads any more."""
    for file in table.inputFiles()[:1]:
        remove_folder(table.sparkSession, file.rsplit("/", 1)[0])
