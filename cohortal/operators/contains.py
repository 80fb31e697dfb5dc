"""Substring search of many patterns by an index of the codes' n-grams.

Testing every event for every pattern costs events times patterns. Here each distinct code
is cut once into the substrings that are as long as some pattern, and these are matched to
the patterns by an equality join, so the cost is that of the distinct codes and does not
grow with the number of patterns. The patterns may be a table of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortal.fixed import SITE_CODES
from cohortal.operators.joins import lookup_join
from cohortal.sources.tables import stage


def pattern_table(spark: SparkSession, sets: dict[str, list[str]]) -> DataFrame:
    """(tag, pattern) rows of named pattern lists."""
    pairs = [
        F.struct(F.lit(tag).alias("tag"), F.lit(p).alias("pattern"))
        for tag, patterns in sets.items()
        for p in patterns
    ]
    if not pairs:
        return spark.createDataFrame([], "tag string, pattern string")
    return spark.range(1).select(F.inline(F.array(*pairs)))


def substrings(text: Column, length: Column) -> Column:
    """Distinct substrings of a length; none for a shorter text."""
    starts = F.sequence(F.lit(1), F.length(text) - length + 1)
    cut = F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, length)))
    return F.when(F.length(text) >= length, cut)


def ngram_index(codes: DataFrame, code: str, lengths: DataFrame) -> DataFrame:
    """``code`` and ``gram``: each distinct code with its substrings of the given lengths.

    ``lengths`` has one column. It is as small as the number of different pattern lengths
    and goes along with every code as one array, so nothing is joined to build the index.
    """
    distinct = codes.select(F.col(code).alias("code")).where(F.col(code).isNotNull()).distinct()
    wanted = sorted(r[0] for r in lengths.distinct().collect())
    cuts = [F.coalesce(substrings(F.col("code"), F.lit(n)), F.array()) for n in wanted]
    grams = F.flatten(F.array(*cuts)) if cuts else F.array().cast("array<string>")
    return distinct.select("code", F.explode(grams).alias("gram"))


def tags_of_codes(codes: DataFrame, code: str, patterns: DataFrame) -> DataFrame:
    """``code`` and ``tags``: for each distinct code that contains a pattern, the sorted tags
    of all patterns that it contains, each once however often they occur in it."""
    patterns = patterns.where("pattern <> ''").select("tag", "pattern").distinct()
    index = ngram_index(codes, code, patterns.select(F.length("pattern")))
    found = lookup_join(index, patterns, "gram", "pattern").where(F.col("tag").isNotNull())
    return found.groupBy("code").agg(F.array_sort(F.collect_set("tag")).alias("tags"))


def contains_tag(
    events: DataFrame,
    *,
    code: str = "diagnosis",
    out: str = "cancer_type",
    sites: dict[str, list[str]] | DataFrame | None = None,
) -> DataFrame:
    """One row per event and site whose codes its own code contains, at any place.

    Events of no site are dropped, and so are events without a code. A site is given once,
    however many of its codes are found or how often. ``sites`` maps names to code lists,
    or is a table (tag, pattern) of any size; a null tag or an empty pattern matches
    nothing. A column ``out`` of the events is replaced.

    The tags of the distinct codes are a written table, one row per code. The events meet
    it in a look-up that is broadcast below a measured size and salted above, so that a
    code of a third of all events is spread.
    """
    if not isinstance(sites, DataFrame):
        sites = pattern_table(events.sparkSession, SITE_CODES if sites is None else sites)
    tagged = stage(tags_of_codes(events, code, sites), "code_tags")
    tagged = tagged.select(F.col("code").alias("_tagged_code"), F.col("tags").alias("_tags"))
    columns = [F.col(f"`{c}`") for c in events.columns if c != out]
    known = events.where(F.col(code).isNotNull())
    joined = lookup_join(known, tagged, code, "_tagged_code")
    return joined.select(*columns, F.explode("_tags").alias(out))
