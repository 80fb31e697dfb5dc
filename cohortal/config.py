"""Parameters of a cohort build."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CohortConfig:
    """The point in time and the horizons every feature and label hangs on.

    ``day_grain`` turns event timestamps into dates before they are compared
    with the cut-off; without it an event at 09:00 on the cut-off day counts as
    after the cut-off, while a plain date on that day is on neither side.
    """

    entity: str = "patient_pseudo_id"
    cutoff: str = "2021-08-31"
    lookback_weeks: tuple[int, ...] = (4, 12, 26, 52, 260)
    horizon_weeks: tuple[int, ...] = (12, 26, 52, 78, 104, 260)
    label_weeks: int = 52
    day_grain: bool = False
    seed: int = 0


@dataclass(frozen=True)
class ConditionRule:
    """A diagnosis family: codes with one of the prefixes, minus some prefixes."""

    name: str
    include: tuple[str, ...]
    exclude: tuple[str, ...] = ()

    def matches(self, code: Column) -> Column:
        """Prefix tests that the Parquet scan can evaluate; null for a null code."""
        hit = reduce(or_, [code.startswith(p) for p in self.include])
        for prefix in self.exclude:
            hit = hit & ~code.startswith(prefix)
        return hit

    def any_of(self, columns: list[str]) -> Column:
        """1 if any of the columns holds a matching code, else 0 (nulls give 0)."""
        hit = reduce(or_, [self.matches(F.col(c)) for c in columns])
        return F.when(hit, 1).otherwise(0)
