"""Near-duplicate documents by HyperMinHash.

1. Each document becomes a sketch: in each bucket of shingle hashes the leading zeros and
   a mantissa of the smallest one. Documents with equal shingle sets merge into classes.
2. Bands of four registers deal classes into buckets. Every class of a bucket is compared
   with the bucket's first class, which links a large group of copies in linear work. A
   pair is first estimated from the sketches, corrected for chance collisions, then
   compared on its full sets.
3. Buckets whose classes are not yet in one component are settled exactly: two sets with
   the wanted similarity must share one of the rarest quarter of their shingles, so only
   classes of different components that share one are compared. Where these are common
   shingles, as of a passage that very many documents have, whole sets of common shingles
   are compared, by what tells them from the most central set of their group.

At a similarity of exactly 0.75, a pair shares no bucket with probability 3e-7.

Null, empty and blank texts have no shingles and are linked with nothing. Texts of fewer
than five words are one shingle. Repeated rows are one class; each keeps its row. A null
doc_id is larger than any other: a component's id is null only if all of its ids are. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortal.llm import shingles as S
from cohortal.llm.columns import shielded, shuffled
from cohortal.llm.components import components
from cohortal.llm.workers import per_task
from cohortal.sources.tables import stage

# 100 * intersection >= 75 * union
NUMERATOR, DENOMINATOR = 75, 100
# The same: BOTH * intersection >= NUMERATOR * (sum of the sizes)
BOTH = NUMERATOR + DENOMINATOR
# Pairs of larger sets whose estimate is below this are not compared in full. At a true
# similarity of 0.75 the estimate falls there with a probability under 1e-9.
ESTIMATE_FROM = 0.5
ESTIMATE_SIZE = 2 * S.REGISTERS
# A shingle of more classes than this is common; see _settling_pairs.
COMMON = 32
TEXT_KEY = "xxhash64(text)"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = S.WordHashes()
    for batch in batches:
        sizes, prints, sketches = [], [], []
        for text in batch.column("text"):
            found = S.shingle_set(S.words_of(text.as_py() or ""), known)
            sizes.append(len(found))
            prints.append(S.fingerprint(found) if len(found) else None)
            sketches.append(S.sketch(found).astype("<u2").tobytes() if len(found) else None)
        new = [pa.array(sizes, pa.int64()), pa.array(prints, pa.binary())]
        new.append(pa.array(sketches, pa.binary()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), *new],
            names=["doc_id", "text_key", "n_shingles", "print", "sketch"],
        )


def sketched(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, a key of its text, size and fingerprint of its set, sketch."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("text_key", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("print", T.BinaryType()),
            T.StructField("sketch", T.BinaryType()),
        ]
    )
    rows = docs.select("doc_id", F.expr(TEXT_KEY).alias("text_key"), "text")
    return rows.mapInArrow(per_task(_sketches), schema)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_a, n_b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
        sk_a, sk_b = batch.column("sk_a"), batch.column("sk_b")
        keep = np.ones(batch.num_rows, dtype=bool)
        for i in np.flatnonzero(np.minimum(n_a, n_b) >= ESTIMATE_SIZE):
            a, b = (np.frombuffer(x[int(i)].as_py(), "<u2") for x in (sk_a, sk_b))
            keep[i] = S.estimate(a, b, n_a[i], n_b[i]) >= ESTIMATE_FROM
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = S.WordHashes()
    last, set_a = None, None
    for batch in batches:
        keep = []
        columns = [batch.column(c) for c in ("a", "text_a", "text_b")]
        for a, text_a, text_b in zip(*columns):
            if a.as_py() != last:
                last, set_a = a.as_py(), S.shingle_set(S.words_of(text_a.as_py()), known)
            set_b = S.shingle_set(S.words_of(text_b.as_py()), known)
            common, union = S.similarity(set_a, set_b)
            keep.append(DENOMINATOR * common >= NUMERATOR * union)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def confirmed(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that are similar enough, compared on their full sets.

    The texts of all ``b`` are joined first, so that the text of a class with very many
    partners is not copied through a shuffle.
    """

    def side(name: str, *columns: str) -> DataFrame:
        renamed = [F.col(c).alias(f"{s}_{name}") for c, s in zip(columns, ("n", "sk"))]
        return classes.select(F.col("node").alias(name), *renamed)

    sized = (
        pairs.join(side("b", "n_shingles", "sketch"), "b")
        .join(side("a", "n_shingles", "sketch"), "a")
        .where(
            F.least("n_a", "n_b") * DENOMINATOR >= F.greatest("n_a", "n_b") * NUMERATOR
        )
    )
    likely = stage(sized.mapInArrow(per_task(_likely), "a bigint, b bigint"), "likely")
    texts = shuffled(classes.select("node", "text"))
    full = (
        likely.join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b")
        .join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
        .select("a", "b", "text_a", "text_b")
    )
    return stage(full.mapInArrow(per_task(_confirmed), "a bigint, b bigint"), "links")


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = S.WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            sets = [S.shingle_set(S.words_of(t.as_py()), known) for t in part.column("text")]
            sizes = [len(s) for s in sets]
            take = pa.array(np.repeat(np.arange(len(sets)), sizes))
            kept = part.select(["node", "label"]).take(take)
            hashes = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
            n = np.repeat(np.array(sizes, dtype=np.int64), sizes)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(n), pa.array(hashes)],
                names=["node", "label", "n", "shingle"],
            )


def _prefix(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """The rarest of each class's ``n`` shingles, all but ceil(0.75 n) - 1 of them.

    Two classes of the wanted similarity share one of these. Ties of the counts go by the
    hash, the same way for all.
    """
    order = Window.partitionBy("node").orderBy("sets", "shingle")
    least = F.floor((F.col("n") * NUMERATOR + DENOMINATOR - 1) / DENOMINATOR)
    ranked = shuffled(rows).join(counts, "shingle").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= F.col("n") - least + 1)


def _sharing(rare: DataFrame, owner: str, wanted: Column) -> DataFrame:
    """Pairs (a, b) of sets of similar size that share a shingle of ``rare``, if ``wanted``."""
    x, y = rare.alias("x"), rare.alias("y")
    similar_size = F.least("x.n", "y.n") * DENOMINATOR >= F.greatest("x.n", "y.n") * NUMERATOR
    once = F.col(f"x.{owner}") < F.col(f"y.{owner}")
    on = (F.col("x.shingle") == F.col("y.shingle")) & once & similar_size & wanted
    return (
        shuffled(x)
        .join(y, on)
        .select(F.col(f"x.{owner}").alias("a"), F.col(f"y.{owner}").alias("b"))
        .distinct()
    )


def _alike(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets of common shingles, among them enough similar ones to join all
    that can be joined.

    Sets that share a shingle of their prefixes lie in one group. In a large group of near
    copies all do, and nearly all of them share more than the prefixes tell. So each set is
    described by what tells it from the group's most central one, its ``away``: two sets
    differ by as much as their ``away`` do, and each has only the edits of its copy. With
    ``excess`` = (BOTH * (size of away - size) + 2 * NUMERATOR * n), two sets are similar if
    2 * BOTH * (number of shared ``away``) >= the sum of both ``excess``.

    Where that sum is at most 0, both sets are similar to that of the least ``excess`` too;
    they are paired with it alone. All other pairs share one of the rarest of their ``away``.
    """
    least = F.ceil(F.col("n") * NUMERATOR / DENOMINATOR)
    prefix = F.slice("common", F.lit(1), (F.col("size") - least + 1).cast("int"))
    prefixes = stage(sets.select("set", F.explode(prefix).alias("shingle")), "prefixes")
    firsts = prefixes.groupBy("shingle").agg(F.min("set").alias("first"))
    groups = components(shuffled(prefixes).join(firsts, "shingle").select("first", "set"))
    groups = groups.withColumnsRenamed({"node": "set", "root": "group"})
    grouped = stage(sets.join(groups, "set"), "grouped")
    # The most central set differs least from all classes of its group, in sum.
    in_group = grouped.groupBy("group").agg(F.sum("classes").alias("in_group"))
    nearness = 2 * F.col("weight") - F.col("in_group") * F.col("size")
    # Written, so that a large group's sets are combined before they move.
    counted = stage(grouped.join(stage(in_group, "in_group"), "group"), "counted")
    centres = (
        counted.groupBy("group")
        .agg(F.max_by("common", F.struct(nearness, "set")).alias("centre"))
    )
    grouped = grouped.join(stage(centres, "centres"), "group")
    away = F.concat(F.array_except("common", "centre"), F.array_except("centre", "common"))
    grouped = grouped.withColumn("away", away).withColumn("size_away", F.size("away"))
    excess = (F.col("size_away") - F.col("size")) * BOTH + 2 * F.col("n") * NUMERATOR
    kept = ["set", "group", "n", "loose", "least.label", "size_away", "away"]
    grouped = stage(grouped.select(*kept, excess.alias("excess")), "away")

    lowest = grouped.groupBy("group").agg(F.min(F.struct("excess", "set")).alias("low"))
    grouped = grouped.join(stage(lowest, "lowest_excess"), "group")
    star = grouped.where("set <> low.set AND excess + low.excess <= 0")
    rows = stage(
        grouped.select(
            "set", "group", "n", "loose", "label", "excess", "size_away",
            F.col("low.excess").alias("low"), F.explode("away").alias("shingle"),
        ),
        "away_rows",
    )
    counts = rows.groupBy("group", "shingle").agg(F.count("*").alias("sets"))
    order = Window.partitionBy("set").orderBy("sets", "shingle")
    ranked = shuffled(rows).join(counts, ["group", "shingle"])
    ranked = ranked.withColumn("left", F.col("size_away") - F.row_number().over(order) + 1)
    rare = stage(ranked.where(F.col("left") * 2 * BOTH >= F.col("excess") + F.col("low")), "rare_away")
    both = F.col("x.excess") + F.col("y.excess")
    wanted = (
        (F.col("x.group") == F.col("y.group"))
        & (F.col("x.loose") | F.col("y.loose") | (F.col("x.label") != F.col("y.label")))
        & (both > 0)
        & (F.least("x.left", "y.left") * 2 * BOTH >= both)
    )
    return _sharing(rare, "set", wanted).union(
        star.select(F.col("low.set").alias("a"), F.col("set").alias("b"))
    )


def _settling_pairs(open_classes: DataFrame) -> DataFrame:
    """Pairs of classes that join all components which the given classes can join.

    A pair that is similar enough shares a shingle of both prefixes. If it shares one that
    at most ``COMMON`` classes have, it is found there. If not, all it shares is common
    shingles. Then only the two sets of common shingles and the two sizes decide: classes of
    one size and one set of common shingles are linked with the same others in this way. So
    such sets are compared, see ``_alike``, and a class meets the smallest class of its own
    set or of a similar one, not all that share a passage.
    """
    schema = "node bigint, label bigint, n bigint, shingle bigint"
    rows = stage(
        open_classes.select("node", "label", "text").mapInArrow(per_task(_shingles), schema), "shingles"
    )
    mixed = (F.min("label") != F.max("label")).alias("mixed")
    counts = stage(rows.groupBy("shingle").agg(F.count("*").alias("sets"), mixed), "counts")
    rare = stage(_prefix(rows, counts), "rare")
    different = F.col("x.label") != F.col("y.label")
    few = rare.where((F.col("sets") <= COMMON) & F.col("mixed"))
    found = _sharing(few.select("shingle", "node", "label", "n"), "node", different)

    common = counts.where(F.col("sets") > COMMON).select("shingle", "sets")
    mostly_common = rare.where(F.col("sets") > COMMON).select("node").distinct()
    listed = F.sort_array(F.collect_list(F.struct("sets", "shingle")))
    members = (
        rows.join(mostly_common, "node", "left_semi")
        .join(common, "shingle")
        .groupBy("node", "label", "n")
        .agg(
            F.transform(listed, lambda s: s["shingle"]).alias("common"),
            F.sum("sets").alias("weight"),
        )
    )
    members = stage(members, "members")
    # Classes of one set are similar to each other if their common shingles are enough.
    size = F.size("common")
    close = size * BOTH >= 2 * F.col("n") * NUMERATOR
    sets = stage(
        members.where(size * DENOMINATOR >= F.col("n") * NUMERATOR)
        .groupBy("common", "n", "weight")
        .agg(F.min(F.struct("node", "label")).alias("least"), F.count("*").alias("classes"), mixed)
        .select(
            F.monotonically_increasing_id().alias("set"), "common", "n", "weight", "least",
            "classes", size.alias("size"), close.alias("close"), (F.col("mixed") & ~close).alias("loose"),
        ),
        "sets",
    )
    # What two sets share, counted once for each pair of them, decides: a pair that is not
    # similar by its common shingles alone shares a rare one, and was found by that.
    x, y = shuffled(sets).alias("x"), shuffled(sets).alias("y")
    shared = F.size(F.array_intersect("x.common", "y.common"))
    alike = stage(
        _alike(sets)
        .join(x, F.col("a") == F.col("x.set"))
        .join(y, F.col("b") == F.col("y.set"))
        .where(shared * BOTH >= (F.col("x.n") + F.col("y.n")) * NUMERATOR)
        .select("a", "b", F.col("x.least").alias("least_a"), F.col("y.least").alias("least_b")),
        "alike",
    )
    # The smallest classes of both sets are linked. The others of a set are linked with
    # their smallest class or, if they are not similar to each other, with one other set's.
    met = alike.select(F.col("a").alias("set"), F.col("least_b").alias("to")).union(
        alike.select("b", "least_a")
    )
    met = met.groupBy("set").agg(F.min("to").alias("to"))
    towards = sets.join(met, "set", "left").select(
        "common", "n", F.when(F.col("close"), F.col("least")).otherwise(F.col("to")).alias("to")
    )
    to_least = (
        members.join(towards, ["common", "n"])
        .select(F.struct("node", "label").alias("from"), "to")
        .union(alike.select("least_a", "least_b"))
        .where((F.col("from.node") != F.col("to.node")) & (F.col("from.label") != F.col("to.label")))
        .select(
            F.least("from.node", "to.node").alias("a"), F.greatest("from.node", "to.node").alias("b")
        )
    )
    return found.union(to_least).distinct()


def near_components(docs: DataFrame) -> DataFrame:
    """Every document: doc_id, text_key, n_shingles, component_id and kept."""
    docs = docs.select("doc_id", "text")
    found = stage(sketched(docs), "sketched")
    classes = stage(
        found.where("n_shingles > 0")
        .groupBy("print", "n_shingles", "sketch")
        .agg(
            # Null ids last: the other ids name the component.
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("low")
        )
        .select(
            F.monotonically_increasing_id().alias("node"),
            "print", "n_shingles", "sketch", "low.doc_id", "low.text_key",
        ),
        "classes",
    )

    width = 2 * S.ROWS
    cut = F.substring("sketch", F.col("band") * width + 1, F.lit(width))
    band = F.explode(F.sequence(F.lit(0), F.lit(S.BANDS - 1))).alias("band")
    bands = classes.select("node", "sketch", band)
    bands = bands.select(F.xxhash64("band", cut).alias("bucket"), "node")
    firsts = (
        bands.groupBy("bucket")
        .agg(F.min("node").alias("first"), F.count("*").alias("size"))
        .where("size > 1")
        .drop("size")
    )
    members = stage(shuffled(bands).join(firsts, "bucket"), "members")

    wanted = members.select("node").distinct().join(classes, "node")
    same_text = F.expr(TEXT_KEY) == F.col("text_key")
    fetched = stage(
        shuffled(docs.withColumnRenamed("doc_id", "_id"))
        .join(wanted, F.col("_id").eqNullSafe(F.col("doc_id")) & same_text)
        .select("node", "n_shingles", "sketch", "text")
        .dropDuplicates(["node"]),
        "fetched",
    )
    a, b = F.col("first").alias("a"), F.col("node").alias("b")
    links = confirmed(members.where("first <> node").select(a, b).distinct(), fetched)

    roots = stage(components(links), "roots")
    labelled = members.join(roots, "node", "left").withColumn(
        "label", F.coalesce("root", "node")
    )
    mixed = (
        labelled.groupBy("bucket")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low <> high")
        .select("bucket")
    )
    still_open = labelled.join(mixed, "bucket", "left_semi").select("node", "label").distinct()
    more = confirmed(_settling_pairs(fetched.join(still_open, "node")), fetched)

    # What the first links joined goes in as stars, which are nearly components already.
    roots = components(roots.union(more))
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    # Written, so that the join below shuffles both sides and a large class can be split.
    named = stage(rooted.join(ids, "root").select("print", "component_id"), "named")
    empty = F.col("print").isNull()
    return (
        found.drop("sketch")
        .join(named, "print", "left")
        .withColumn("component_id", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .drop("print")
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """Of each component the documents whose id names it; all columns unchanged.

    One document stays of each component unless several of its rows have that same id.
    Columns beside doc_id and text stay, whatever their names.
    """
    return shielded(docs, ["doc_id", "text"], _drop_near_copies)


def _drop_near_copies(docs: DataFrame) -> DataFrame:
    dropped = near_components(docs).where("not kept").select("doc_id", "text_key").distinct()
    dropped = stage(dropped.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"}), "dropped")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.expr(TEXT_KEY) == F.col("_key"))
    return docs.join(dropped, same, "left_anti")
