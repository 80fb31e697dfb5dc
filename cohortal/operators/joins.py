"""Left joins that hold up under a hot key, and reference look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A reference table is broadcast only when it is measured below both bounds.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# The frequent-items sketch takes no smaller share than this.
LEAST_SHARE = 1.1e-4
_SALT = "_salt"


def shuffle_partitions(df: DataFrame) -> int:
    """Join tasks of the session: the measure of what one task should hold."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _text_size(df: DataFrame) -> Column:
    """Bytes of a row: text by its length, other simple values as 8, nested ones as JSON."""
    size = F.lit(0)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            size = size + F.octet_length(F.to_json(F.struct(column)))
        else:
            size = size + 8
    return size


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """Count rows and bytes of a table; the count is partial on every task."""
    max_rows = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_text_size(df)).alias("n_bytes")).first()
    return size["n"] <= max_rows and (size["n_bytes"] or 0) <= BROADCAST_MAX_BYTES


def hot_keys(df: DataFrame, key: str, share: float | None = None) -> list:
    """Keys that may hold at least ``share`` of the non-null rows, by default the even
    share of one shuffle partition.

    The frequent-items sketch merges map-side and returns at most ``1 / share``
    keys. It may name a few keys too many; salting those is harmless.
    """
    share = share or max(LEAST_SHARE, 1 / shuffle_partitions(df))
    found = df.select(key).where(F.col(key).isNotNull()).stat.freqItems([key], share).first()
    return list(found[0]) if found and found[0] else []


def _equal(left_key: str, right_key: str) -> Column:
    return F.col(f"l.`{left_key}`") == F.col(f"r.`{right_key}`")


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    *,
    salts: int | None = None,
    unique_left: bool = False,
) -> DataFrame:
    """Left join in which hot and null keys of the left side spread over tasks.

    Left rows with a hot key take one of ``salts`` numbers (by default as many as there
    are shuffle partitions) from the input partition they lie in, and only the matching
    right rows are repeated once per number. No join task gets more of a hot key than its
    share of the input partitions, the salt reads no column, and a retried task gives the
    same salt. Null keys match nothing and need no copies on the right, so they take the
    number of their input partition itself, however many there are. A key that is an
    identifier (``unique_left``) can only be null often; it is not searched for hot values.
    """
    salts = salts or shuffle_partitions(left)
    hot = [] if unique_left else hot_keys(left, left_key)
    key = F.col(left_key)
    salt = F.when(key.isNull(), F.spark_partition_id())
    copies = F.array(F.lit(0))
    if hot:
        salt = salt.when(key.isin(hot), F.spark_partition_id() % salts)
        copies = F.when(
            F.col(right_key).isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))
        ).otherwise(copies)
    left = left.withColumn(_SALT, salt.otherwise(0))
    right = right.where(F.col(right_key).isNotNull()).withColumn(_SALT, F.explode(copies))
    on = _equal(left_key, right_key) & _equal(_SALT, _SALT)
    return left.alias("l").join(right.alias("r"), on, "left").drop(_SALT)


def lookup_join(
    facts: DataFrame,
    reference: DataFrame,
    left_key: str,
    right_key: str,
    max_rows: int | None = None,
) -> DataFrame:
    """Left join of a fact table with a reference table.

    A reference measured below the broadcast bounds never shuffles the facts;
    a larger one goes through the salted join.
    """
    if fits_broadcast(reference, max_rows):
        small = F.broadcast(reference).alias("r")
        return facts.alias("l").join(small, _equal(left_key, right_key), "left")
    return salted_left_join(facts, reference, left_key, right_key)


def assert_unique(reference: DataFrame, key: str) -> None:
    """Reject a reference whose key repeats; it would multiply the facts.

    Null keys match nothing and may repeat.
    """
    known = reference.where(F.col(key).isNotNull())
    repeated = known.groupBy(key).count().where("count > 1").select(key).first()
    if repeated is not None:
        raise ValueError(f"reference key {key} is not unique, e.g. {repeated[0]!r}")


def left_join_all(person: DataFrame, tables: list[DataFrame], key: str) -> DataFrame:
    """Join tables of one row per key to the person table.

    All sides cluster on the key, so the person table is shuffled once and every
    aggregate that is already partitioned by the key is joined where it lies.

    The columns of a table pass the joins as one struct. Else each join would copy, in code
    of its own that every task makes anew, all columns that the joins before it have added.
    """
    mine = [c for c in person.columns if c != key]
    read = [F.col(f"`{c}`") for c in [key, *mine]]
    for i, table in enumerate(tables):
        added = [c for c in table.columns if c != key]
        columns = F.struct(*[F.col(f"`{c}`") for c in added]).alias(f"_joined{i}")
        person = person.join(table.select(key, columns), key, "left")
        read += [F.col(f"_joined{i}")[c].alias(c) for c in added]
    return person.select(*read)


def prefix_columns(df: DataFrame, prefix: str, keep: list[str]) -> DataFrame:
    """Prefix every column name but the ones in ``keep``."""
    return df.toDF(*[c if c in keep else prefix + c for c in df.columns])


def columns_containing(df: DataFrame, parts: list[str]) -> list[str]:
    """Names that contain any of the given parts, in table order."""
    return [c for c in df.columns if any(p in c for p in parts)]


def select_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Select a fixed list, naming every missing column at once."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*names)


def drop_all_null(df: DataFrame, keep: list[str]) -> DataFrame:
    """Drop rows in which every column outside ``keep`` is null."""
    return df.na.drop(how="all", subset=[c for c in df.columns if c not in keep])


