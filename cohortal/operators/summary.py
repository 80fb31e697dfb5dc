"""First, latest and distinct codes per person or per person and group.

Two ways to stay clear of a person with a third of all events:

* First and latest are minima and maxima. Each map task sends one row per person,
  so raw events are aggregated straight away, in one shuffle.
* A set of codes grows with every map task that sends a part of it. Raw events
  therefore first shrink to one span per (keys, code), the earliest and latest
  date of the code, with a hash aggregate spread over all tasks by code.

With a dictionary of the codes both are fixed numbers of longs per person, and events are
aggregated in one hash aggregate and one shuffle (``dictionary.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortal.config import CohortConfig
from cohortal.functions.weeks import Timeline, flag
from cohortal.operators.dictionary import (
    CodeDictionary,
    ShortCodes,
    code_sets,
    packable,
    packed,
    packed_ends,
    unpacked,
)

DATE = "date"
CODE = "diagnosis"
# Column names of spans, for the summaries that also read raw events.
SPAN = {"first": "first_seen", "last": "last_seen", "code": "code"}
# Column of a person's values, before they become columns.
BY_VALUE = "_by_value"


def code_spans(
    events: DataFrame, keys: list[str], *, time: str = DATE, code: str = CODE
) -> DataFrame:
    """Per keys and code: ``first_seen`` and ``last_seen``.

    A code with any undated row counts as first seen at an unknown (null) time,
    which sorts before every date, as in an ascending sort of the raw rows.
    """
    undated = F.count_if(F.col(time).isNull()) > 0
    return events.groupBy(*keys, F.col(code).alias("code")).agg(
        F.when(~undated, F.min(time)).alias("first_seen"),
        F.max(time).alias("last_seen"),
    )


def spans_around(
    events: DataFrame, cfg: CohortConfig, *, time: str = DATE, code: str = CODE
) -> DataFrame:
    """Per person and code the span before and the span after the cut-off.

    One scan and one shuffle feed every feature and label that looks at codes.
    """
    line = Timeline(events, cfg, time)
    before, after = F.when(line.before(), F.col(time)), F.when(line.after(), F.col(time))
    return events.groupBy(cfg.entity, F.col(code).alias("code")).agg(
        F.min(before).alias("first_before"),
        F.max(before).alias("last_before"),
        F.min(after).alias("first_after"),
        F.max(after).alias("last_after"),
    )


def spans_on_side(spans: DataFrame, cfg: CohortConfig, side: str) -> DataFrame:
    """Spans ``before`` or ``after`` the cut-off, in the shape of ``code_spans``."""
    seen = spans.where(F.col(f"first_{side}").isNotNull())
    return seen.select(
        cfg.entity,
        "code",
        F.col(f"first_{side}").alias("first_seen"),
        F.col(f"last_{side}").alias("last_seen"),
    )


def first_and_last(
    df: DataFrame,
    keys: list[str],
    *,
    first: str = DATE,
    last: str = DATE,
    code: str = CODE,
    with_codes: bool = False,
    dictionary: CodeDictionary | ShortCodes | None = None,
) -> DataFrame:
    """Per keys: ``first`` and ``last`` as (date, code), optionally the sorted code set.

    Reads events, or spans with ``**SPAN``. Codes break ties on one day: the
    smallest is first, the greatest is last. ``with_codes`` is meant for spans, or for a
    ``dictionary`` that is a literal.
    """
    if dictionary is not None and packable(df, first, last):
        if not with_codes or dictionary.codes is not None:
            return packed_ends(
                df, keys, dictionary, first=first, last=last, code=code, with_codes=with_codes
            )

    def dated(time: str) -> Column:
        return F.struct(F.col(time).alias("date"), F.col(code).alias("code"))

    parts = [F.min(dated(first)).alias("first"), F.max(dated(last)).alias("last")]
    if with_codes:
        parts.append(F.array_sort(F.collect_set(code)).alias("codes"))
    return df.groupBy(*keys).agg(*parts)


def distinct_codes(
    events: DataFrame,
    key: str,
    *,
    code: str = CODE,
    name: str,
    dictionary: CodeDictionary | None = None,
) -> DataFrame:
    """Sorted set of codes per key: as bits of a literal dictionary, else from pairs that are
    made distinct before they are gathered."""
    if dictionary is not None and dictionary.codes is not None:
        return code_sets(events, [key], dictionary, code, name)
    pairs = events.select(key, code).distinct()
    return pairs.groupBy(key).agg(F.array_sort(F.collect_set(code)).alias(name))


def _recent_flags(df: DataFrame, cfg: CohortConfig, time: str, name: str) -> list[Column]:
    line = Timeline(df, cfg, time)
    return [
        flag(line.new_within(n)).alias(f"{name}_in_last_{n}_weeks") for n in cfg.lookback_weeks
    ]


def group_summary(
    events: DataFrame, cfg: CohortConfig, name: str, *, same_code: bool = False, **columns
) -> DataFrame:
    """Per person: first code, earliest and latest date, a flag, and recency flags.

    With ``same_code`` the latest date is given only where the latest row carries
    the first row's code. ``columns`` are those of ``first_and_last``.
    """
    ends = first_and_last(events, [cfg.entity], **columns)
    latest = F.col("last.date")
    if same_code:
        latest = F.when(F.col("first.code") == F.col("last.code"), latest)
    earliest = f"{name}_date_earliest"
    out = ends.select(
        cfg.entity,
        F.col("first.code").alias(name),
        F.col("first.date").alias(earliest),
        latest.alias(f"{name}_date_latest"),
        F.lit(1).alias(f"{name}_binary"),
    )
    return out.select("*", *_recent_flags(out, cfg, earliest, name))


def first_per_group(
    events: DataFrame, cfg: CohortConfig, group: str, dictionary: CodeDictionary | ShortCodes | None = None
) -> DataFrame:
    """Earliest date and its code per person and group."""
    keys = [cfg.entity, group]
    ends = first_and_last(events, keys, dictionary=dictionary)
    return ends.select(
        *keys, F.col("first.date").alias(f"{group}_date_earliest"), F.col("first.code").alias(CODE)
    )


def latest_per_group(events: DataFrame, cfg: CohortConfig, group: str) -> DataFrame:
    """Latest date per person and group."""
    return events.groupBy(cfg.entity, group).agg(F.max(DATE).alias(f"{group}_date_latest"))


def category_summary(
    events: DataFrame, cfg: CohortConfig, category: str, **columns
) -> DataFrame:
    """As ``group_summary``, per person and category."""
    keys = [cfg.entity, category]
    earliest = f"{category}_date_earliest"
    # People without a category form one group, which has no latest date.
    out = first_and_last(events, keys, **columns).select(
        *keys,
        F.col("first.date").alias(earliest),
        F.col("first.code").alias(CODE),
        F.when(F.col(category).isNotNull(), F.col("last.date")).alias(f"{category}_date_latest"),
        F.lit(1).alias(f"{category}_binary"),
    )
    return out.select("*", *_recent_flags(out, cfg, earliest, category))


def _site_columns(ends: DataFrame, cfg: CohortConfig, site: str, all_codes: Column) -> DataFrame:
    earliest = f"{site}_date_earliest"
    out = ends.select(
        cfg.entity,
        site,
        F.col("first.date").alias(earliest),
        F.col("first.code").alias(CODE),
        F.col("last.date").alias(f"{site}_date_latest"),
        all_codes.alias("all_cancer_diagnoses_after_cut_off"),
    )
    line = Timeline(out, cfg, earliest)
    flags = [
        flag(line.by(n)).alias(f"{site}_diagnosis_in_next_{n}_weeks") for n in cfg.horizon_weeks
    ]
    return out.select("*", *flags)


def summarise_sites(spans: DataFrame, cfg: CohortConfig, site: str) -> DataFrame:
    """``site_summary`` over spans keyed by person and site.

    Spans move to their person once; both the per-site step and the code set of
    the whole person then run without another shuffle.
    """
    placed = spans.repartition(cfg.entity)
    ends = first_and_last(placed, [cfg.entity, site], with_codes=True, **SPAN)
    person = Window.partitionBy(cfg.entity)
    all_codes = F.array_sort(F.array_distinct(F.flatten(F.collect_list("codes").over(person))))
    return _site_columns(ends, cfg, site, all_codes)


def summarise_declared_sites(
    tagged: DataFrame,
    cfg: CohortConfig,
    site: str,
    values: list[str],
    dictionary: CodeDictionary,
    *,
    first: str = DATE,
    last: str = DATE,
    code: str = CODE,
) -> DataFrame:
    """``site_summary`` of declared sites, over events or spans, in one hash aggregate.

    Each person gets two longs for each site and the bits of the code set; the sites that
    occur become rows again afterwards. Rows of other sites count for nothing.
    """
    rows = dictionary.number(tagged, code).where(F.col(site).isin(values))
    rows = rows.withColumns({"_first": packed(first), "_last": packed(last)})
    # As SQL text: so many expressions take the driver longer to build one by one.
    names = [v.replace("'", "\\'") for v in values]
    ends = [
        F.expr(f"{pick}(CASE WHEN `{site}` = '{v}' THEN {end} END) AS {end}{i}")
        for i, v in enumerate(names)
        for pick, end in (("min", "_first"), ("max", "_last"))
    ]
    words = [w.alias(f"_word{k}") for k, w in enumerate(dictionary.set_words(F.col("_number")))]
    person = rows.groupBy(cfg.entity).agg(*ends, *words)
    sites = F.expr(
        "array("
        + ", ".join(
            f"CASE WHEN _first{i} IS NOT NULL THEN named_struct("
            f"'site', '{v}', '_first', _first{i}, '_last', _last{i}) END"
            for i, v in enumerate(names)
        )
        + ")"
    )
    codes = dictionary.decode_set([F.col(f"_word{k}") for k in range(len(words))])
    each = person.select(cfg.entity, codes.alias("codes"), F.explode(F.array_compact(sites)).alias("s"))
    ends = each.select(cfg.entity, F.col("s.site").alias(site), "s._first", "s._last", "codes")
    ends = ends.select(
        cfg.entity,
        site,
        *[unpacked(end, dictionary).alias(end[1:]) for end in ("_first", "_last")],
        "codes",
    )
    return _site_columns(ends, cfg, site, F.col("codes"))


def site_summary(
    tagged: DataFrame,
    cfg: CohortConfig,
    site: str,
    *,
    values: list[str] | None = None,
    dictionary: CodeDictionary | None = None,
) -> DataFrame:
    """Per person and site: first and latest date, first code, horizon flags, and
    the codes of the person across all sites.

    With declared site ``values`` and a literal ``dictionary`` one shuffle does; those
    sites are then all that count.
    """
    if values is not None and dictionary is not None and dictionary.codes is not None:
        if packable(tagged, DATE):
            return summarise_declared_sites(tagged, cfg, site, values, dictionary)
    return summarise_sites(code_spans(tagged, [cfg.entity, site]), cfg, site)


def value_maps(
    summary: DataFrame,
    entity: str,
    column: str,
    values: list[str],
    fields: dict[str, Column],
    out: str = BY_VALUE,
) -> DataFrame:
    """One row per person with a map from each declared value to its fields.

    The summary holds one row per person and value, so nothing is left to add up. It moves
    to its person as it is, and the result lies partitioned for the final join. People
    without a declared value give no row.
    """
    declared = summary.where(F.col(column).isin(values)).repartition(entity)
    entry = F.struct(column, F.struct(*[c.alias(n) for n, c in fields.items()]).alias("fields"))
    return declared.groupBy(entity).agg(F.map_from_entries(F.collect_list(entry)).alias(out))


def wide_pivot(
    summary: DataFrame, entity: str, column: str, values: list[str], fields: dict[str, Column]
) -> DataFrame:
    """One row per person with columns ``{value}_{field}`` for the declared values.

    Each output column is read out of the person's map. A pivot would test every row
    against every output column. The wide rows are never shuffled.

    People without a declared value give no row. Dropping all-null rows
    afterwards would test hundreds of columns at once, and seen through as many
    renamed columns that is more than the optimiser's inference can take.
    """
    maps = value_maps(summary, entity, column, values, fields)
    by_value = maps.select(entity, *[F.col(BY_VALUE)[v].alias(v) for v in values])
    wide = by_value.select(entity, *[f"`{v}`.*" for v in values])
    return wide.toDF(entity, *[f"{v}_{n}" for v in values for n in fields])


def spread_values(df: DataFrame, values: list[str], column: str = BY_VALUE) -> DataFrame:
    """Put the columns of ``wide_pivot`` in the place of a column of ``value_maps``, numbers
    zero-filled as after a left join with them.

    Hundreds of columns that only the last step makes pass through no join, sort or
    staged table on the way.
    """
    fields = df.schema[column].dataType.valueType.fields
    spread = {
        f"{v}_{f.name}": (F.col(f"`{column}`")[v][f.name], isinstance(f.dataType, T.NumericType))
        for v in values
        for f in fields
    }
    read = [
        (F.coalesce(c, F.lit(0).cast("long")) if number else c).alias(name)
        for name, (c, number) in spread.items()
    ]
    at = df.columns.index(column)
    names = [F.col(f"`{c}`") for c in df.columns]
    return df.select(*names[:at], *read, *names[at + 1 :])


def _category_fields(cfg: CohortConfig, category: str) -> dict[str, Column]:
    fields = {
        "binary": F.col(f"{category}_binary").cast("long"),
        "earliest_date": F.col(f"{category}_date_earliest"),
        "diagnosis": F.col(CODE),
    }
    for n in cfg.lookback_weeks:
        fields[f"last_{n}_weeks"] = F.col(f"{category}_in_last_{n}_weeks").cast("long")
    return fields


def pivot_categories(
    summary: DataFrame, cfg: CohortConfig, category: str, values: list[str]
) -> DataFrame:
    """Category summary as one row per person that has a declared category."""
    return wide_pivot(summary, cfg.entity, category, values, _category_fields(cfg, category))


def map_categories(
    summary: DataFrame, cfg: CohortConfig, category: str, values: list[str]
) -> DataFrame:
    """As ``pivot_categories``, with a person's categories in one column for ``spread_values``."""
    return value_maps(summary, cfg.entity, category, values, _category_fields(cfg, category))


def pivot_sites(
    summary: DataFrame, cfg: CohortConfig, site: str, values: list[str]
) -> DataFrame:
    """Site summary as one row per person that has a declared site, the site at the
    end of each name."""
    everyone = "all_cancer_diagnoses_after_cut_off"
    fields = {
        "cancer_earliest_date": F.col(f"{site}_date_earliest"),
        "cancer_latest_date": F.col(f"{site}_date_latest"),
        "cancer_diagnosis": F.col(CODE),
        everyone: F.col(everyone),
    }
    for n in cfg.horizon_weeks:
        flags = F.col(f"{site}_diagnosis_in_next_{n}_weeks")
        fields[f"cancer_diagnosis_in_next_{n}_weeks"] = flags.cast("long")
    wide = wide_pivot(summary, cfg.entity, site, values, fields)
    return wide.toDF(cfg.entity, *[f"{n}_{v}" for v in values for n in fields])
