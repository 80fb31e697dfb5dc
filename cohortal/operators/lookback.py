"""Counts of events in windows that end at the cut-off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortal.config import CohortConfig
from cohortal.functions.text import is_present
from cohortal.functions.weeks import Timeline
from cohortal.operators.encode import discover_values


def events_before(events: DataFrame, cfg: CohortConfig, time: str) -> DataFrame:
    """Events of known people strictly before the cut-off."""
    past = F.col(cfg.entity).isNotNull() & Timeline(events, cfg, time).before()
    return events.where(past)


def count_since(
    events: DataFrame,
    cfg: CohortConfig,
    *,
    time: str,
    weeks: int,
    prefix: str,
    keys: list[str] | None = None,
) -> DataFrame:
    """Events per key on or after the day ``weeks`` before the cut-off, open-ended."""
    recent = events.where(Timeline(events, cfg, time).since(weeks))
    counted = recent.groupBy(*(keys or [cfg.entity]))
    return counted.agg(F.count(F.lit(1)).alias(f"{prefix}{weeks}_weeks"))


def pivot_since(
    events: DataFrame,
    cfg: CohortConfig,
    *,
    time: str,
    weeks: int,
    label: str,
    suffix: str,
    values: list[str] | None = None,
) -> DataFrame:
    """``count_since`` with one column per label, null where there is no event.

    Undeclared labels are those of the window, found in a job of its own.
    """
    recent = events.where(Timeline(events, cfg, time).since(weeks))
    if values is None:
        values = discover_values(recent, [label])[label]
    counts = recent.groupBy(cfg.entity).pivot(label, values).count()
    return counts.toDF(cfg.entity, *[f"{v}_{suffix}{weeks}_weeks" for v in values])


def lookback_counts(
    events: DataFrame,
    cfg: CohortConfig,
    *,
    time: str,
    total: str,
    prefix: str,
    coded: str | None = None,
    coded_total: str | None = None,
    coded_pct: str | None = None,
) -> DataFrame:
    """All events before the cut-off and all windows, in one pass and one shuffle.

    ``coded`` names a code column: its non-empty rows are counted and given as a
    percentage of all events.
    """
    past = events_before(events, cfg, time)
    line = Timeline(past, cfg, time)
    counts = [F.count(F.lit(1)).alias(total)]
    counts += [
        F.count_if(line.since(n)).alias(f"{prefix}{n}_weeks") for n in cfg.lookback_weeks
    ]
    if coded:
        counts.append(F.count_if(is_present(F.col(coded))).alias(coded_total))
    out = past.groupBy(cfg.entity).agg(*counts)
    if coded_pct:
        out = out.withColumn(coded_pct, F.try_divide(F.col(coded_total), F.col(total)) * 100)
    return out


def _window_counts(events: DataFrame, cfg: CohortConfig, time: str, label: str) -> DataFrame:
    """Per person and label: all events and events per window, as ``n_*`` columns."""
    line = Timeline(events, cfg, time)
    return events.groupBy(cfg.entity, label).agg(
        F.count(F.lit(1)).alias("n_all"),
        *[F.count_if(line.since(n)).alias(f"n_{n}") for n in cfg.lookback_weeks],
    )


def _by_label(cfg: CohortConfig, label: str, values: list[str]) -> Column:
    """A person's window counts as a map from declared label to counts."""
    counts = F.struct(*[f"n_{n}" for n in cfg.lookback_weeks])
    entry = F.when(F.col(label).isin(values), F.struct(label, counts))
    return F.map_from_entries(F.collect_list(entry)).alias("by_label")


def _spread_labels(
    people: DataFrame, cfg: CohortConfig, kept: list[str], values: list[str], suffix: str
) -> DataFrame:
    """Read ``{label}_{suffix}{n}_weeks`` out of the map, 0 where there is no event."""
    found = people.select(*kept, *[F.col("by_label")[v].alias(v) for v in values])
    wide = found.select(*kept, *[f"`{v}`.*" for v in values])
    names = [f"{v}_{suffix}{n}_weeks" for v in values for n in cfg.lookback_weeks]
    return wide.toDF(*kept, *names).na.fill(0, subset=names)


def lookback_pivot(
    events: DataFrame,
    cfg: CohortConfig,
    *,
    time: str,
    label: str,
    suffix: str,
    values: list[str] | None = None,
) -> DataFrame:
    """One column per label and window, 0 where there is no event.

    Undeclared labels are those before the cut-off, found in a job of its own.
    Events shrink to one row per person and label before they are gathered per
    person, so neither a busy person nor the many columns weigh on a shuffle.
    """
    past = events_before(events, cfg, time)
    if values is None:
        values = discover_values(past, [label])[label]
    narrow = _window_counts(past, cfg, time, label)
    people = narrow.groupBy(cfg.entity).agg(_by_label(cfg, label, values))
    return _spread_labels(people, cfg, [cfg.entity], values, suffix)


def lookback_with_labels(
    events: DataFrame,
    cfg: CohortConfig,
    *,
    time: str,
    label: str,
    values: list[str],
    prefix: str,
    total: str,
    related_prefix: str,
) -> DataFrame:
    """Totals, labelled totals and per-label counts for every window, in one scan.

    A null label means the event counts in the totals only.
    """
    narrow = _window_counts(events_before(events, cfg, time), cfg, time, label)
    related = F.col(label).isNotNull()
    sums = [F.sum("n_all").alias(total)]
    for n in cfg.lookback_weeks:
        sums.append(F.sum(f"n_{n}").alias(f"{prefix}{n}_weeks"))
        sums.append(
            F.coalesce(F.sum(F.when(related, F.col(f"n_{n}"))), F.lit(0)).alias(
                f"{related_prefix}{n}_weeks"
            )
        )
    kept = [total, *[f"{p}{n}_weeks" for n in cfg.lookback_weeks for p in (prefix, related_prefix)]]
    people = narrow.groupBy(cfg.entity).agg(*sums, _by_label(cfg, label, values))
    return _spread_labels(people, cfg, [cfg.entity, *kept], values, prefix)
