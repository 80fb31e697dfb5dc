"""Mixing sources to target weights with a low-discrepancy schedule.

The mix is a row of slots, each one block of ``block`` words. Slot i takes the point
frac(i / golden ratio), which falls into one source's interval of the cumulative shares
of slots; its rank among that source's slots names the source's block. A source's blocks
are cut from its documents in hashed order, laid end to end. The points spread so evenly
that each source gets its share of any stretch of the mix to within a few slots.

Each source has the slots that its target needs by its blocks as they are, of which the
last in its line may be short, and its last slot is cut to the words still wanted: it gives
its target to the word. Points beyond a source's slots go to the sources left short.

Sources weigh 3, 1, 2, repeating, in code-point order with null last, unless weights are
given. A source's target stops at ``most`` times its own size, and the excess is shared
out by weight among the rest until no source is above. Null and blank texts have size 0
and are not taken. Repeated rows count as documents of their own. An empty table gives
no rows. The per-source totals are collected: one row for each source, not for each
document. Everything is a function of the rows, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortal.llm.columns import free_name, running_total, shielded, whole_text, word_count
from cohortal.sources.tables import stage

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
MOST = 2
BLOCK_WORDS = 64
CHUNK_ROWS = 4096
GOLDEN = (math.sqrt(5) - 1) / 2


class Mix(NamedTuple):
    documents: DataFrame  # one row per document: its columns, row, size, source_size, target
    schedule: DataFrame  # slot, lap, row, first, words: what each slot takes of a document


def targets(sizes: list[int], weights: list[int], share: Fraction, most: int) -> list[Fraction]:
    """Words to take from each source: by weight, at most ``most`` times its size."""
    out = [Fraction(0)] * len(sizes)
    left, open_ = share * sum(sizes), [i for i, s in enumerate(sizes) if s]
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] > most * sizes[i] * total]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = Fraction(most * sizes[i])
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def needed(target: Fraction, size: int, block: int) -> tuple[int, int]:
    """Slots that give a source of ``size`` words its target, and the words of the last."""
    if not size:
        return 0, 0
    laps, rest = divmod(round(target), size)
    blocks = -(-size // block)
    if not rest:
        return laps * blocks, block
    part = -(-rest // block)
    return laps * blocks + part, rest - (part - 1) * block


def _points(slots: DataFrame, shares: list[int]) -> DataFrame:
    """The source number of each slot: its golden-ratio point in the cumulative shares."""
    edges = np.cumsum(shares)

    @F.pandas_udf("int")
    def source_at(slot: pd.Series) -> pd.Series:
        i = slot.to_numpy()
        step = (GOLDEN * 2**20) % 1  # in two parts: exact enough for any number of slots
        point = ((i >> 20) * step + (i & (2**20 - 1)) * GOLDEN + 0.5) % 1
        found = np.searchsorted(edges, point * edges[-1], side="right")
        return pd.Series(np.minimum(found, len(edges) - 1).astype("int32"))

    return slots.withColumn("sid", source_at("slot"))


def _exact(ranked: DataFrame, counts: list[int]) -> DataFrame:
    """The slots with each source's ranks as its count: ranks beyond go to sources that are
    short, in order. Golden-ratio points leave few of them for each source."""
    found = {
        r["sid"]: (r["points"], r["beyond"])
        for r in ranked.join(
            F.broadcast(
                ranked.sparkSession.createDataFrame(
                    list(enumerate(counts)), "_sid int, wanted bigint"
                )
            ),
            F.col("sid") == F.col("_sid"),
        )
        .groupBy("sid")
        .agg(
            F.count("*").alias("points"),
            F.collect_list(F.when(F.col("rank") >= F.col("wanted"), F.col("slot"))).alias("beyond"),
        )
        .collect()
    }
    short = [
        (sid, rank)
        for sid, wanted in enumerate(counts)
        for rank in range(found.get(sid, (0, []))[0], wanted)
    ]
    beyond = sorted(slot for _, slots in found.values() for slot in slots)
    moved = ranked.sparkSession.createDataFrame(
        [(slot, sid, rank) for slot, (sid, rank) in zip(beyond, short)],
        "slot bigint, sid int, rank bigint",
    )
    return ranked.select("slot", "sid", "rank").union(moved)


def mix(
    docs: DataFrame,
    *,
    weights: dict[str | None, int] | None = None,
    share: Fraction = SHARE,
    most: int = MOST,
    block: int = BLOCK_WORDS,
    size: Callable[[Column], Column] = word_count,
) -> Mix:
    """The documents with their numbers, and the schedule of the mix.

    Columns ``row``, ``size``, ``source_size`` and ``target`` are replaced; others stay.
    """
    schedules = []

    def run(own: DataFrame) -> DataFrame:
        made = _mix(own, weights, share, most, block, size)
        schedules.append(made.schedule)
        return made.documents

    documents = shielded(docs, ["doc_id", "text", "source"], run)
    return Mix(documents, schedules[0])


def _mix(
    docs: DataFrame,
    weights: dict[str | None, int] | None,
    share: Fraction,
    most: int,
    block: int,
    size: Callable[[Column], Column],
) -> Mix:
    spark = docs.sparkSession
    named = docs
    sized = stage(
        named.withColumns(
            {"row": F.monotonically_increasing_id(), "size": size(whole_text())}
        ).drop("text"),
        "sized",
    )
    totals = {
        r["source"]: (r["words"], r["rows"])
        for r in sized.groupBy("source")
        .agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
        .collect()
    }
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weigh = [
        weights[s] if weights is not None else WEIGHTS[i % len(WEIGHTS)]
        for i, s in enumerate(order)
    ]
    words = [totals[s][0] for s in order]
    wanted = targets(words, weigh, share, most)
    slots_of = [needed(wanted[i], words[i], block) for i in range(len(order))]
    sources = spark.createDataFrame(
        [
            (i, s, words[i], float(wanted[i]), -(-words[i] // block), *slots_of[i])
            for i, s in enumerate(order)
        ],
        "sid int, source string, source_size bigint, target double, blocks bigint, "
        "slots bigint, last bigint",
    )
    documents = sized.join(
        sources.withColumnRenamed("source", "_source"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("_source", "blocks", "slots", "last")

    # Documents on their source's line of words, in hashed order.
    chunks = max(1, sum(t[1] for t in totals.values()) // CHUNK_ROWS)
    key = F.xxhash64("doc_id", "size", F.lit("mix"))
    lines = running_total(
        documents.where("size > 0")
        .select("sid", "row", "size", key.alias("key"))
        .withColumn("chunk", F.pmod(F.shiftright("key", 20), F.lit(chunks))),
        "sid", "chunk", ["key", "row"], "size", "start",
    )
    end = F.col("start") + F.col("size")
    first, last = F.floor(F.col("start") / block), F.floor((end - 1) / block)
    pieces = (
        lines.withColumn("at", F.explode(F.sequence(first, last)))
        .withColumn("begin", F.greatest("start", F.col("at") * block))
        .select(
            "sid", "at", "row",
            (F.col("begin") - F.col("at") * block).alias("inside"),
            (F.col("begin") - F.col("start")).alias("first"),
            (F.least(end, (F.col("at") + 1) * block) - F.col("begin")).alias("words"),
        )
    )

    counts = [n for n, _ in slots_of]
    slots = spark.range(sum(counts)).withColumnRenamed("id", "slot")
    slots = _points(slots, counts or [1])
    ranked = running_total(
        slots.withColumns({"chunk": F.floor(F.col("slot") / CHUNK_ROWS), "one": F.lit(1)}),
        "sid", "chunk", ["slot"], "one", "rank",
    )
    laps = (
        _exact(ranked, counts)
        .join(sources.select("sid", "blocks", "slots", "last"), "sid")
        .where(F.col("rank") < F.col("slots"))
        .select(
            "sid", "slot",
            F.floor(F.col("rank") / F.col("blocks")).alias("lap"),
            (F.col("rank") % F.col("blocks")).alias("at"),
            F.when(F.col("rank") == F.col("slots") - 1, F.col("last"))
            .otherwise(block)
            .alias("room"),
        )
    )
    schedule = (
        pieces.join(laps, ["sid", "at"])
        .where("inside < room")
        .withColumn("words", F.least("words", F.col("room") - F.col("inside")))
        .select("slot", "lap", "row", "first", "words")
    )
    return Mix(documents.drop("sid"), schedule)


def taken_words(mixed: Mix) -> DataFrame:
    """Every document with ``taken``, the words the mix takes of it, repeats counted."""
    at = free_name(mixed.documents, "_row")
    documents = mixed.documents.drop("taken")
    taken = mixed.schedule.groupBy(F.col("row").alias(at)).agg(F.sum("words").alias("taken"))
    return (
        documents.join(taken, F.col("row") == F.col(at), "left")
        .withColumn("taken", F.coalesce("taken", F.lit(0)).cast("bigint"))
        .drop(at)
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: a row for each lap in which a document is taken.

    Blocks are taken in line order, so in each lap all documents of a source are whole
    but the one where the source's share ends; that one is cut to the words taken.
    All columns stay, whatever their names.
    """
    return shielded(docs, ["doc_id", "text", "source"], lambda own: _mixed(own, options))


def _mixed(docs: DataFrame, options: dict) -> DataFrame:
    tagged = stage(docs.withColumn("_doc", F.monotonically_increasing_id()), "documents")
    mixed = mix(tagged, **options)
    laps = (
        mixed.schedule.groupBy("row", "lap")
        .agg(F.min("first").alias("_first"), F.sum("words").alias("_words"))
        .join(mixed.documents.select("row", "_doc", F.col("size").alias("_size")), "row")
        .select("_doc", "_first", "_words", "_size")
    )
    part = F.array_join(
        F.slice(
            F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0)),
            F.col("_first").cast("int") + 1,
            F.col("_words").cast("int"),
        ),
        "",
    )
    text = F.when(F.col("_words") == F.col("_size"), F.col("text")).otherwise(part)
    return tagged.join(laps, "_doc").withColumn("text", text).select(*docs.columns)
