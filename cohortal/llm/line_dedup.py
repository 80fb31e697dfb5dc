"""Lines that many documents share.

Texts are split at line feeds. A line's key is the line without blanks at both ends, with
A-Z lower-cased. A key of at least ``MIN_CHARS`` code points that occurs in at least
``MIN_DOCS`` documents loses all its lines, except in the largest doc_id that holds it.

1. Keys are hashed to 128 bits in Arrow batches. Each text gives one row for each distinct
   key, with the places of its lines; the lines themselves do not move.
2. (key, document) pairs are made distinct, then counted for each key. Both steps combine
   before they shuffle, so a line of a third of all documents is one row of each map task.
3. Pairs meet the keys that go in a join by key, which Spark splits where one is frequent.
   What is left of them are places, gathered for each text and joined to it.
4. Each text is put together from the lines that stay, in their order.

Null and empty texts are one empty line. Documents are told apart by doc_id: rows of one
doc_id count once, and a null doc_id is one document, larger than any other. Repeated rows
get the same result each. The id may be of any type that can be ordered. An empty table
gives no rows. Columns ``n_lines``, ``n_dropped`` and ``kept_text`` of the input are
replaced; all others stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest

from cohortal.llm.columns import free_name, whole_text
from cohortal.sources.tables import stage

MIN_CHARS = 20
MIN_DOCS = 3
BLANKS = b" \t\n\x0b\x0c\r"
SLICE = 256
ADDED = [
    T.StructField("n_lines", T.LongType()),
    T.StructField("n_dropped", T.LongType()),
    T.StructField("kept_text", T.StringType()),
]


def key_places(text: str, min_chars: int = MIN_CHARS) -> dict[bytes, list[int]]:
    """Hash of each key that is long enough, with the numbers of its lines."""
    found: dict[bytes, list[int]] = {}
    for place, line in enumerate(text.encode("utf-8", "surrogatepass").lower().split(b"\n")):
        key = line.strip(BLANKS)
        # A code point takes one to four bytes.
        if len(key) < min_chars:
            continue
        if len(key) < 4 * min_chars and not key.isascii():
            if len(key.decode("utf-8", "surrogatepass")) < min_chars:
                continue
        found.setdefault(xxh3_128_digest(key), []).append(place)
    return found


def _line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """``id``, ``text_key``, the key's hash ``h1``, ``h2`` and ``places``."""
    fields = [
        docs.schema["id"],
        T.StructField("text_key", T.LongType()),
        T.StructField("h1", T.LongType()),
        T.StructField("h2", T.LongType()),
        T.StructField("places", T.ArrayType(T.IntegerType())),
    ]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = [key_places(t.as_py(), min_chars) for t in part.column("text")]
                owners = np.repeat(np.arange(len(found)), [len(f) for f in found])
                hashes = np.frombuffer(b"".join(h for f in found for h in f), "<i8").reshape(-1, 2)
                places = pa.array(
                    [p for f in found for p in f.values()], type=pa.list_(pa.int32())
                )
                kept = part.select(["id", "text_key"]).take(pa.array(owners))
                columns = [
                    *kept.columns,
                    pa.array(np.ascontiguousarray(hashes[:, 0])),
                    pa.array(np.ascontiguousarray(hashes[:, 1])),
                    places,
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return docs.select("id", "text_key", "text").mapInArrow(keys, T.StructType(fields))


def _places_to_drop(pairs: DataFrame, min_docs: int) -> DataFrame:
    """For each ``id`` and ``text_key`` the places of all lines that go."""
    unnamed = F.max(F.col("id").isNull())
    shared = (
        pairs.select("h1", "h2", "id")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"), unnamed.alias("unnamed"))
        .where(F.col("n") >= min_docs)
        .drop("n")
    )
    # As a written table it is shuffled anew, and Spark can split a key of very many pairs.
    shared = stage(shared, "shared_keys")
    stays = F.when(F.col("unnamed"), F.col("id").isNull()).otherwise(F.col("id") == F.col("last"))
    gone = pairs.join(shared, ["h1", "h2"]).where(~stays)
    # Repeated rows give the same places again.
    places = F.array_sort(F.array_distinct(F.flatten(F.collect_list("places"))))
    return gone.groupBy("id", "text_key").agg(places.alias("places"))


def drop_repeated_lines(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """The documents with ``n_lines`` before dropping, ``n_dropped`` and ``kept_text``."""
    docs = docs.drop(*[f.name for f in ADDED])
    text_key = F.xxhash64(whole_text())
    own = docs.select(
        F.col(id_column).alias("id"), text_key.alias("text_key"), whole_text().alias("text")
    )
    pairs = stage(_line_keys(own, min_chars), "line_keys")
    key, drop_id, drop_key, places = (
        free_name(docs, name) for name in ("_text_key", "_drop_id", "_drop_key", "_places")
    )
    dropped = _places_to_drop(pairs, min_docs).toDF(drop_id, drop_key, places)
    same = F.col(id_column).eqNullSafe(F.col(drop_id)) & (F.col(key) == F.col(drop_key))
    joined = docs.withColumn(key, text_key).join(dropped, same, "left")
    chosen = joined.select(*[F.col(f"`{c}`") for c in docs.columns], places)
    schema = T.StructType(docs.schema.fields + ADDED)
    at_text = docs.columns.index("text")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                counts, texts = [], []
                for text, gone in zip(part.column(at_text), part.column(part.num_columns - 1)):
                    lines = (text.as_py() or "").split("\n")
                    out = set(gone.as_py() or ())
                    counts.append((len(lines), len(out)))
                    texts.append("\n".join(s for i, s in enumerate(lines) if i not in out))
                table = np.array(counts, dtype=np.int64).reshape(-1, 2)
                new = [pa.array(table[:, 0]), pa.array(table[:, 1]), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *new], names=schema.names)

    return chosen.mapInArrow(rebuild, schema)
