"""Ranked lexical search by presence masks.

Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, with
A-Z lower-cased. A term's weight and a document's score are integers, see ``weight`` and
``contributions``; equal scores rank by ascending doc_id.

1. Items are read in blocks of bounded size. One pass over the texts counts each document's
   terms and writes those that some item of the block asks for, as (term, occurrences).
2. Spark sums documents, terms and document frequencies of these short rows.
3. Each partition of them is searched block by block. A term's documents are a bitmap; the
   bitmaps of an item's terms, packed across, give each document the mask of the terms it
   holds. The documents are grouped by mask. The best that a mask's documents can score is
   the sum of its terms' largest contributions in the block. Masks are evaluated from the
   highest such sum down, until it falls below the item's last kept score.
4. The best of each partition, ``most`` rows an item at most, are ranked together.

The result is that of scoring every document, as a mask is left out only if none of its
documents can come into the result. Rows are sorted by doc_id within their partition, so
of equal scores the first found stays.

Null and empty texts have no terms: such documents count for nothing and are found by no
item, and such items find nothing. Repeated rows of documents are documents of their own;
repeated rows of items are one item, rows of one item_id with different texts are items of
their own. A null doc_id ranks last among equal scores. Ids may be of any type that can be
ordered. Only the id and the text columns are read, whatever others there are. An empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortal.sources.tables import stage

MOST = 10
# Terms of the items that are searched together.
ITEM_TERMS = 200_000
BLOCK = 8192
SLICE = 256
FIRST_LOOK = 64
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_SPLIT = bytes(
    b + 32 if 65 <= b <= 90 else b if b in _KEPT else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_SPLIT).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 10 + (90 * n * n_docs) // n_terms


def contributions(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _item_terms(items: DataFrame, id_column: str) -> DataFrame:
    """``item_id`` and its distinct ``terms``."""
    rows = items.select(F.col(id_column).alias("item_id"), "text").distinct()
    schema = T.StructType(
        [rows.schema["item_id"], T.StructField("terms", T.ArrayType(T.StringType()))]
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                sorted(t.decode("utf-8", "surrogatepass") for t in set(terms_of(x.as_py())))
                for x in batch.column("text")
            ]
            terms = pa.array(found, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), terms], names=schema.names)

    return rows.mapInArrow(split, schema).where(F.size("terms") > 0)


def _postings(docs: DataFrame, id_column: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id``, number of terms ``n``, and the known ``terms`` with their ``tf``."""
    known = docs.select(F.col(id_column).alias("doc_id"), "text")
    numbers = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [
            known.schema["doc_id"],
            T.StructField("n", T.LongType()),
            T.StructField("terms", numbers),
            T.StructField("tf", numbers),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                n, terms, tf = [], [], []
                for text in part.column("text"):
                    words = terms_of(text.as_py())
                    hits = [(vocabulary[w], c) for w, c in Counter(words).items() if w in vocabulary]
                    n.append(len(words))
                    terms.append([h[0] for h in hits])
                    tf.append([h[1] for h in hits])
                ints = pa.list_(pa.int32())
                columns = [pa.array(n, pa.int64()), pa.array(terms, ints), pa.array(tf, ints)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *columns], names=schema.names
                )

    return known.mapInArrow(count, schema).where("n > 0")


class Items(NamedTuple):
    """Terms of the items, end to end; item i has those from ``starts[i]`` to the next."""

    terms: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, lists: list[list[int]]) -> Items:
        terms = np.array([t for row in lists for t in row], dtype=np.int64)
        return cls(terms, np.cumsum([0, *map(len, lists)]))

    def __len__(self) -> int:
        return len(self.starts) - 1


class Block:
    """Postings of some documents, ordered by term."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, value: np.ndarray, n_docs: int, v: int):
        order = np.argsort(terms, kind="stable")
        self.docs, self.value, self.n_docs = docs[order], value[order], n_docs
        self.starts = np.searchsorted(terms[order], np.arange(v + 1))
        filled = np.flatnonzero(self.starts[1:] > self.starts[:-1])
        self.highest = np.zeros(v, dtype=np.int64)
        if len(filled):
            self.highest[filled] = np.maximum.reduceat(self.value, self.starts[filled])

    def of_terms(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all postings of the terms, and the number of the term of each."""
        lengths = self.starts[terms + 1] - self.starts[terms]
        ends = np.cumsum(lengths)
        row = np.repeat(np.arange(len(terms)), lengths)
        return np.arange(ends[-1]) - (ends - lengths)[row] + self.starts[terms][row], row


def masks_of(row: np.ndarray, docs: np.ndarray, n_terms: int, n_docs: int) -> np.ndarray:
    """For each document the mask of the terms it holds, as words of 64 bits.

    One bitmap for each term is set from its documents; packing the bitmaps across gives
    the masks.
    """
    bitmaps = np.zeros((-(-n_terms // 64) * 64, n_docs), dtype=bool)
    bitmaps[row, docs] = True
    packed = np.packbits(bitmaps, axis=0, bitorder="little")
    return np.ascontiguousarray(packed.T).view("<u8")


def distinct_masks(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different masks, and for each document the number of its mask."""
    if masks.shape[1] == 1:
        found, number = np.unique(masks[:, 0], return_inverse=True)
        return found.reshape(-1, 1), number
    found, number = np.unique(masks, axis=0, return_inverse=True)
    return found, number.reshape(-1)


def mask_bounds(masks: np.ndarray, highest: np.ndarray) -> np.ndarray:
    """The largest score that a document of each mask can have."""
    bits = np.unpackbits(np.ascontiguousarray(masks).view(np.uint8), axis=1, bitorder="little")
    return bits[:, : len(highest)].astype(np.int64) @ highest


def best_of_block(
    block: Block, terms: np.ndarray, most: int, before: int | None
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scores of the block's best documents, best first, ties by number.

    ``before`` is the lowest score of ``most`` earlier documents, if there are so many:
    only higher ones matter then.
    """
    at, row = block.of_terms(terms)
    docs = block.docs[at]
    masks, number = distinct_masks(masks_of(row, docs, len(terms), block.n_docs))
    bounds = mask_bounds(masks, block.highest[terms])
    order = np.argsort(-bounds, kind="stable")
    turn = np.empty(len(order), dtype=np.int64)
    turn[order] = np.arange(len(order))
    queue = np.argsort(turn[number], kind="stable")
    limit = bounds[number[queue]]
    floor = 0 if before is None else before
    end = int(np.searchsorted(-limit, -floor))  # limits above the floor
    place = np.full(block.n_docs, -1, dtype=np.int64)
    found, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    begin, look = 0, FIRST_LOOK
    while begin < end:
        # All documents of a mask are evaluated together.
        stop = min(end, begin + look)
        stop = int(np.searchsorted(-limit, -limit[stop - 1], side="right"))
        chosen = queue[begin:stop]
        place[chosen] = np.arange(len(chosen))
        hit = place[docs] >= 0
        exact = np.bincount(
            place[docs[hit]], block.value[at[hit]].astype(np.float64), minlength=len(chosen)
        ).astype(np.int64)
        place[chosen] = -1
        good = exact > floor
        found = np.concatenate([found, chosen[good]])
        scores = np.concatenate([scores, exact[good]])
        keep = np.lexsort((found, -scores))[:most]
        found, scores = found[keep], scores[keep]
        begin, look = stop, 2 * look
        if len(found) == most and begin < end and limit[begin] < scores[-1]:
            break
    return found, scores


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def _search(
    postings: DataFrame, items: Items, weights: np.ndarray, n_docs: int, n_terms: int, most: int
) -> DataFrame:
    """``item``, ``doc_id`` and ``score`` of the best documents of each partition."""
    schema = T.StructType(
        [
            T.StructField("item", T.IntegerType()),
            postings.schema["doc_id"],
            T.StructField("score", T.LongType()),
        ]
    )

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[tuple[int, object]]] = [[] for _ in range(len(items))]
        id_type = None
        for part in _blocks(batches):
            id_type = part.column("doc_id").type
            n = part.column("n").to_numpy(zero_copy_only=False)
            lists = part.column("terms")
            terms = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            tf = part.column("tf").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            lengths = np.diff(lists.offsets.to_numpy(zero_copy_only=False))
            docs = np.repeat(np.arange(len(n)), lengths)
            m = length_factor(n, n_docs, n_terms)
            value = contributions(weights[terms], tf, m[docs])
            block = Block(terms, docs, value, len(n), len(weights))
            # The highest score that each item could have in this block.
            sums = np.concatenate([[0], np.cumsum(block.highest[items.terms])])
            reach = sums[items.starts[1:]] - sums[items.starts[:-1]]
            for i in np.flatnonzero(reach > 0).tolist():
                top = kept[i]
                before = top[-1][0] if len(top) == most else None
                if before is not None and reach[i] <= before:
                    continue
                asked = items.terms[items.starts[i] : items.starts[i + 1]]
                asked = asked[block.highest[asked] > 0]
                found, scores = best_of_block(block, asked, most, before)
                if len(found):
                    ids = part.column("doc_id").take(pa.array(found)).to_pylist()
                    # Sorting is stable, and earlier blocks have smaller ids.
                    top = sorted([*top, *zip(scores.tolist(), ids)], key=lambda x: -x[0])
                    kept[i] = top[:most]
        rows = [(i, d, s) for i, top in enumerate(kept) for s, d in top]
        if rows:
            columns = [
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array([r[1] for r in rows], id_type),
                pa.array([r[2] for r in rows], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    ordered = postings.sortWithinPartitions(F.col("doc_id").asc_nulls_last())
    return ordered.mapInArrow(best, schema)


def _search_items(docs: DataFrame, rows: list, id_column: str, item_type, most: int) -> DataFrame | None:
    """The ranked documents of the items of one block."""
    spark = docs.sparkSession
    words = sorted({t for r in rows for t in r["terms"]})
    numbers = {w: i for i, w in enumerate(words)}
    vocabulary = {w.encode("utf-8", "surrogatepass"): i for w, i in numbers.items()}
    items = Items.of([[numbers[t] for t in r["terms"]] for r in rows])
    postings = stage(_postings(docs, id_column, vocabulary), "postings")
    n_docs, n_terms = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    # One row for each term of the block's items.
    held = postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect()
    weights = np.zeros(len(words), dtype=np.int64)
    for r in held:
        weights[r["t"]] = weight(n_docs, r["count"])
    found = _search(postings, items, weights, n_docs, n_terms, most)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    ids = spark.createDataFrame(
        [(i, r["item_id"]) for i, r in enumerate(rows)],
        T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type)]),
    )
    # As many rows as the block has items.
    return ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    most: int = MOST,
    id_column: str = "doc_id",
    item_column: str = "item_id",
    item_terms: int = ITEM_TERMS,
) -> DataFrame:
    """``item_id``, ``rank`` from 1, ``doc_id`` and ``score`` of each item's best documents.

    Only documents with a score above 0 are given. Items are searched in blocks of about
    ``item_terms`` terms, which is what the driver and each task hold of them at a time.
    """
    queries = stage(_item_terms(items, item_column), "items")
    total = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = -(-total // item_terms)
    item_type = queries.schema["item_id"].dataType
    dealt = F.pmod(F.xxhash64("item_id", "terms"), F.lit(max(1, n_blocks)))
    parts = []
    for b in range(n_blocks):
        rows = queries.where(dealt == b).collect()
        found = _search_items(docs, rows, id_column, item_type, most) if rows else None
        if found is not None:
            parts.append(found)
    if parts:
        return reduce(DataFrame.unionAll, parts)
    schema = T.StructType(
        [
            T.StructField("item_id", item_type),
            T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", docs.schema[id_column].dataType),
            T.StructField("score", T.LongType()),
        ]
    )
    return docs.sparkSession.createDataFrame([], schema)
