"""Week bounds around the cut-off and comparisons with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortal.config import CohortConfig


def weeks_before(day: str, weeks: int) -> Column:
    return F.date_sub(F.lit(day).cast("date"), 7 * weeks)


def weeks_after(day: str, weeks: int) -> Column:
    return F.date_add(F.lit(day).cast("date"), 7 * weeks)


class Timeline:
    """One event-time column set against the cut-off.

    Bounds are constants of the column's own type (a string column is compared
    with ISO text), so they fold at planning time and the test reaches the scan.
    """

    def __init__(self, df: DataFrame, cfg: CohortConfig, column: str):
        self._cfg = cfg
        self._type = df.schema[column].dataType
        self.time = F.col(column)
        if cfg.day_grain:
            self.time, self._type = F.to_date(self.time), T.DateType()

    def _bound(self, day: Column) -> Column:
        return day.cast(self._type)

    @property
    def cutoff(self) -> Column:
        return self._bound(weeks_after(self._cfg.cutoff, 0))

    def before(self) -> Column:
        """Strictly before the cut-off."""
        return self.time < self.cutoff

    def after(self) -> Column:
        """Strictly after the cut-off."""
        return self.time > self.cutoff

    def since(self, weeks: int) -> Column:
        """On or after the day ``weeks`` before the cut-off; no upper bound."""
        return self.time >= self._bound(weeks_before(self._cfg.cutoff, weeks))

    def new_within(self, weeks: int) -> Column:
        """Strictly inside the ``weeks`` before the cut-off, both ends excluded."""
        return (self.time > self._bound(weeks_before(self._cfg.cutoff, weeks))) & self.before()

    def by(self, weeks: int) -> Column:
        """No later than ``weeks`` after the cut-off."""
        return self.time <= self._bound(weeks_after(self._cfg.cutoff, weeks))


def flag(condition: Column) -> Column:
    """1 where the condition holds; 0 where it is false or null."""
    return F.when(condition, 1).otherwise(0)
