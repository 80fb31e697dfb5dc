"""Exact dedup by content-defined chunk recipes.

Each text is cut at places its own content sets, so that long documents become short
lists of chunk hashes. Distinct chunks are compared as text once, which turns hashes into
verified identifiers; two texts are equal when their ordered lists of identifiers are.
Long texts move once, as chunks, and copies are merged before that shuffle.

Equality ignores the case of A-Z only. Null text counts as empty and all empty texts are
equal. The row with the largest doc_id stays (null is smallest); of rows equal in text
and doc_id any one stays, and the others are dropped. An empty table gives no rows.
Other columns are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortal.llm.columns import ascii_lower, whole_text
from cohortal.sources.tables import stage

# A chunk ends after 512 characters or more, at the first end of a sentence or line, and
# after 4,096 at the latest; what is left at the end of the text is the last chunk.
CHUNK = r"(?s).{512,4095}?(?:[.!?]\s|\n|\z)|.{1,4096}"


def chunks_of(text: Column) -> Column:
    """Consecutive pieces of the text; together they are the text. Empty text has none."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def hash_of(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def recipes(docs: DataFrame, chunk_hash: Callable[[Column], Column] = hash_of) -> DataFrame:
    """One row per document: its columns but the text, ``row``, ``text_sha256``, ``chunks``
    and ``recipe``, the ordered list of verified chunk identifiers.

    The chunks are of the text as written: where they end does not depend on case.
    """
    chunked = stage(
        docs.drop("row", "text_sha256", "chunks", "recipe")
        .withColumns(
            {
                "row": F.monotonically_increasing_id(),
                "text_sha256": F.sha2(ascii_lower(whole_text()), 256),
                "chunks": chunks_of(F.col("text")),
            }
        )
        .withColumn(
            "recipe",
            F.transform(
                F.coalesce("chunks", F.array().cast("array<string>")),
                lambda c: chunk_hash(ascii_lower(c)),
            ),
        )
        .drop("text"),
        "chunks",
    )
    distinct = (
        chunked.select(F.explode("chunks").alias("chunk"))
        .select(ascii_lower(F.col("chunk")).alias("chunk"))
        .select(chunk_hash(F.col("chunk")).alias("hash"), "chunk")
        .distinct()
    )
    # Hashes that stand for more than one chunk text; as a rule there are none.
    shared = stage(distinct.groupBy("hash").count().where("count > 1").select("hash"), "shared")
    if not shared.isEmpty():
        return _told_apart(chunked, distinct, shared, chunk_hash)
    return chunked


def _told_apart(chunked, distinct, shared, chunk_hash) -> DataFrame:
    """Recipes in which chunks of one hash but different text have different identifiers."""
    names = stage(
        distinct.join(shared, "hash", "left_semi").select(
            "hash", "chunk", F.monotonically_increasing_id().alias("name")
        ),
        "names",
    )
    places = (
        chunked.select("row", F.posexplode("chunks").alias("pos", "chunk"))
        .withColumn("chunk", ascii_lower(F.col("chunk")))
        .withColumn("hash", chunk_hash(F.col("chunk")))
        .join(names, ["hash", "chunk"], "left")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "hash", "name"))).alias("places"))
    )
    listed = F.coalesce(F.col("places"), F.array().cast(places.schema["places"].dataType))
    return (
        chunked.drop("recipe")
        .join(places, "row", "left")
        .withColumn("recipe", F.transform(listed, lambda x: F.struct(x["hash"], x["name"])))
        .drop("places")
    )


def _judged(marked: DataFrame) -> DataFrame:
    """The rows of ``recipes`` without chunks, with ``keep_id``, ``group_size``, ``kept``."""
    # A written table: the join below then shuffles both sides, so that adaptive
    # execution can split the recipe of a large group.
    groups = stage(
        marked.groupBy("recipe")
        .agg(F.max(F.struct("doc_id", "row")).alias("last"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select(
            "recipe",
            F.col("last.doc_id").alias("keep_id"),
            F.col("last.row").alias("keep_row"),
            "group_size",
        ),
        "groups",
    )
    alone = F.col("keep_row").isNull()
    return (
        marked.drop("chunks")
        .join(groups, "recipe", "left")
        .withColumns(
            {
                "keep_id": F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")),
                "group_size": F.coalesce("group_size", F.lit(1)).cast("bigint"),
                "kept": alone | (F.col("keep_row") == F.col("row")),
            }
        )
    )


def exact_groups(
    docs: DataFrame, chunk_hash: Callable[[Column], Column] = hash_of
) -> DataFrame:
    """Every document with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    The other columns of ``docs`` but the text come along; those that have one of these
    names, or row, chunks, recipe or keep_row, are replaced or left out.
    """
    named = docs.drop("keep_id", "group_size", "kept", "keep_row")
    return _judged(recipes(named, chunk_hash)).drop("recipe", "row", "keep_row")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their columns and texts unchanged.

    Decisions are made on recipes. Texts are put together from their chunks and meet only
    the list of rows that go, which Spark broadcasts where its written size is small.
    """
    others = [c for c in docs.columns if c.lower() not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.lit(0)
    marked = recipes(docs.select("doc_id", "text", rest.alias("rest")))
    gone = _judged(marked.select("doc_id", "row", "recipe")).where("not kept").select("row")
    kept = marked.withColumn("text", F.array_join("chunks", "")).join(
        stage(gone, "gone"), "row", "left_anti"
    )
    columns = [F.col(f"rest.`{c}`") if c in others else F.col(c) for c in docs.columns]
    return kept.select(*columns)
