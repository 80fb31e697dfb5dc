"""Disease sites of diagnosis codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortal.fixed import SITE_CODES


def _contains_any(code: Column, codes: list[str]) -> Column:
    return code.rlike("|".join(codes))


def site_filter(
    events: DataFrame, site: str, *, code: str = "diagnosis", sites: dict | None = None
) -> DataFrame:
    """Rows whose code contains a code of the site."""
    sites = SITE_CODES if sites is None else sites
    if site not in sites:
        raise ValueError(f"unknown site {site!r}; known: {sorted(sites)}")
    return events.where(_contains_any(F.col(code), sites[site]))


def site_tag(
    events: DataFrame, *, code: str = "diagnosis", out: str = "cancer_type", sites: dict | None = None
) -> DataFrame:
    """One row per event and site it belongs to; events of no site are dropped.

    All sites are tested in one pass, with no union of filters and no join.
    """
    sites = SITE_CODES if sites is None else sites
    text = F.col(code)
    every = sorted({c for codes in sites.values() for c in codes})
    found = F.array(*[F.when(_contains_any(text, c), F.lit(s)) for s, c in sites.items()])
    relevant = events.where(_contains_any(text, every))
    return relevant.select("*", F.explode(F.array_compact(found)).alias(out))
