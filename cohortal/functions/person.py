"""Person attributes: age and the deterministic split draw."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Highest plausible age, and the half-open decades of the buckets.
OLDEST_AGE = 113
BUCKET_DECADES = [40, 50, 60, 70, 80]
LAST_BUCKET_FROM = 90


def clean_age(age: Column) -> Column:
    """Ages above the plausible limit become null."""
    return F.when(age <= OLDEST_AGE, age)


def age_bucket(age: Column) -> Column:
    """40-50 ... 80-90 (lower end included), 90+, and ``other`` for the rest."""
    bucket = F.when(age >= LAST_BUCKET_FROM, f"{LAST_BUCKET_FROM}+")
    for low in reversed(BUCKET_DECADES):
        bucket = bucket.when(age >= low, f"{low}-{low + 10}")
    return bucket.otherwise("other")


def uniform_draw(key: Column, seed: int) -> Column:
    """Number in [0, 1) fixed by the seed and the key alone.

    Unlike ``rand`` it does not depend on partitioning, task retries or order.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
