"""The features written the long way, one aggregate or filter per output."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortal.fixed import SITE_CODES


def day(cfg, weeks: int):
    return F.date_add(F.lit(cfg.cutoff).cast("date"), 7 * weeks)


def counts(df: DataFrame, cfg, time: str, total: str, prefix: str) -> DataFrame:
    """One aggregate and one join per window."""
    past = df.where(F.col(cfg.entity).isNotNull() & (F.col(time) < day(cfg, 0)))
    out = past.groupBy(cfg.entity).agg(F.count("*").alias(total))
    for n in cfg.lookback_weeks:
        part = past.where(F.col(time) >= day(cfg, -n)).groupBy(cfg.entity)
        out = out.join(part.agg(F.count("*").alias(f"{prefix}{n}_weeks")), cfg.entity, "left")
    return out.na.fill(0)


def _end(df: DataFrame, keys: list[str], *order) -> DataFrame:
    ranked = df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("rn = 1").drop("rn")


def ends(df: DataFrame, keys: list[str], *, code: str = "diagnosis") -> DataFrame:
    """First and last by two windows and a join."""
    first = _end(df, keys, F.asc("date"), F.asc(code))
    last = _end(df, keys, F.desc("date"), F.desc(code))
    first = first.select(*keys, F.col("date").alias("first_date"), F.col(code).alias("first_code"))
    last = last.select(*keys, F.col("date").alias("last_date"), F.col(code).alias("last_code"))
    return first.join(last, keys)


def sites(df: DataFrame) -> DataFrame:
    """One filter per site, unioned."""
    parts = [
        df.where(reduce(lambda a, b: a | b, [F.col("diagnosis").contains(c) for c in codes]))
        .withColumn("cancer_type", F.lit(site))
        for site, codes in SITE_CODES.items()
    ]
    return reduce(DataFrame.unionByName, parts)
