"""Queries for lookback counts, summaries of coded events, sites and outcomes."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from cohortal import fixed
from cohortal.functions.text import underscore_label
from cohortal.functions.weeks import Timeline
from cohortal.operators.contains import contains_tag
from cohortal.operators.dictionary import CodeDictionary, ShortCodes, code_dictionary
from cohortal.operators.joins import drop_all_null, lookup_join
from cohortal.operators.labels import flag_cause_of_death, outcome_labels, update_labels_from_death
from cohortal.operators.lookback import (
    count_since,
    lookback_counts,
    lookback_pivot,
    pivot_since,
)
from cohortal.operators.sites import site_filter, site_tag
from cohortal.operators.summary import (
    category_summary,
    distinct_codes,
    first_per_group,
    latest_per_group,
    site_summary,
)
from cohortal.plans import codes, features
from registry import adapters as a
from registry import sqlgen as g
from registry.catalog import codes_as_text, query
from registry.views import CUT, weeks

ID = "patient_pseudo_id"
CATEGORY = features.CATEGORY


@query(
    "lookback_counts",
    g.counts("orders", "o_orderdate", "order_total", "orders_last_", entity="o_custkey"),
)
def counts_of_orders(spark, sf):
    return lookback_counts(
        a.table(spark, sf, "orders"),
        replace(a.CFG, entity="o_custkey"),
        time="o_orderdate",
        total="order_total",
        prefix="orders_last_",
    )


@query("pct_with_code", "SELECT * FROM emergency_counts")
def pct_with_code(spark, sf):
    return features.emergency_features(a.emergency(spark, sf), a.CFG)


@query("lookback_counts_inpatient", "SELECT * FROM inpatient_counts")
def counts_inpatient(spark, sf):
    return features.inpatient_features(a.inpatient(spark, sf), a.CFG)


@query("lookback_counts_outpatient", "SELECT * FROM outpatient_counts")
def counts_outpatient(spark, sf):
    merged = codes.outpatient_with_codes(
        a.outpatient(spark, sf), codes.union_periods(a.outpatient_raw(spark, sf), a.FIRST_YEAR)
    )
    return features.outpatient_features(merged, a.CFG)


@query(
    "lookback_counts_events",
    g.counts("calls", "call_date", "calls_total", "calls_last_", a.CALLS_CFG.lookback_weeks),
)
def counts_of_calls(spark, sf):
    return lookback_counts(
        a.calls(spark, sf), a.CALLS_CFG, time="call_date", total="calls_total", prefix="calls_last_"
    )


@query(
    "count_since",
    f"""SELECT {ID}, count(*) AS "111_calls_last_2_weeks" FROM calls
        WHERE call_date >= {weeks(-2)} GROUP BY {ID}""",
)
def count_since_query(spark, sf):
    """One window without an upper bound, people without an id included."""
    return count_since(
        a.calls(spark, sf), a.CALLS_CFG, time="call_date", weeks=2, prefix="111_calls_last_"
    )


def _labelled(spark, sf):
    return a.calls(spark, sf).withColumn("label", underscore_label(F.col("symptom_group")))


@query(
    "pivot_since",
    f"SELECT {ID}, "
    + ", ".join(
        f"nullif(count(*) FILTER (WHERE label = '{v}'), 0) AS \"{v}_111_calls_last_2_weeks\""
        for v in a.CALL_LABELS
    )
    + f""" FROM (SELECT *, regexp_replace(symptom_group, '[ ,()]', '_', 'g') AS label FROM calls)
        WHERE call_date >= {weeks(-2)} GROUP BY {ID}""",
)
def pivot_since_query(spark, sf):
    return pivot_since(
        _labelled(spark, sf), a.CALLS_CFG, time="call_date", weeks=2, label="label",
        values=a.CALL_LABELS, suffix="111_calls_last_",
    )


@query(
    "lookback_pivot",
    f"SELECT {ID}, "
    + ", ".join(
        f"count(*) FILTER (WHERE label = '{v}' AND call_date >= {weeks(-n)})"
        f' AS "{v}_111_calls_last_{n}_weeks"'
        for n in a.CALLS_CFG.lookback_weeks
        for v in a.CALL_LABELS
    )
    + f""" FROM (SELECT *, regexp_replace(symptom_group, '[ ,()]', '_', 'g') AS label FROM calls)
        WHERE {ID} IS NOT NULL AND call_date < {CUT} GROUP BY {ID}""",
)
def lookback_pivot_query(spark, sf):
    return lookback_pivot(
        _labelled(spark, sf), a.CALLS_CFG, time="call_date", label="label",
        values=a.CALL_LABELS, suffix="111_calls_last_",
    )


_ALL_LABELS = sorted([*a.CALL_LABELS, a.UNRELATED_LABEL])


@query(
    "pivot_since_discovered",
    f"SELECT {ID}, "
    + ", ".join(
        f"nullif(count(*) FILTER (WHERE label = '{v}'), 0) AS \"{v}_111_calls_last_2_weeks\""
        for v in _ALL_LABELS
    )
    + f""" FROM (SELECT *, regexp_replace(symptom_group, '[ ,()]', '_', 'g') AS label FROM calls)
        WHERE call_date >= {weeks(-2)} GROUP BY {ID}""",
)
def pivot_since_discovered(spark, sf):
    """All labels that occur, found in the data."""
    return pivot_since(
        _labelled(spark, sf), a.CALLS_CFG, time="call_date", weeks=2, label="label",
        suffix="111_calls_last_",
    )


@query(
    "lookback_pivot_discovered",
    f"SELECT {ID}, "
    + ", ".join(
        f"count(*) FILTER (WHERE label = '{v}' AND call_date >= {weeks(-n)})"
        f' AS "{v}_111_calls_last_{n}_weeks"'
        for n in a.CALLS_CFG.lookback_weeks
        for v in _ALL_LABELS
    )
    + f""" FROM (SELECT *, regexp_replace(symptom_group, '[ ,()]', '_', 'g') AS label FROM calls)
        WHERE {ID} IS NOT NULL AND call_date < {CUT} GROUP BY {ID}""",
)
def lookback_pivot_discovered(spark, sf):
    return lookback_pivot(
        _labelled(spark, sf), a.CALLS_CFG, time="call_date", label="label",
        suffix="111_calls_last_",
    )


@query("calls_features", g.call_counts(a.CALL_LABELS, a.CALLS_CFG.lookback_weeks))
def calls_features(spark, sf):
    """The symptom labels are read from the symptom reference."""
    return features.call_features(a.calls(spark, sf), a.symptoms(spark, sf), a.CALLS_CFG)


@query("latest_row", "SELECT * EXCLUDE (activity_id) FROM last_mortality")
def latest_row_query(spark, sf):
    return features.latest_mortality(a.mortality(spark, sf), a.CFG)


_REGIONS = ["London", "North West", "South East", "unknown"]
_PLANS = ["QF", "QO", "QP"]


@query(
    "latest_snapshot_one_hot",
    f"""SELECT *, {g.blank('nhs_region')} AS nhs_region_null_removed,
        {g.blank('stp_code')} AS stp_code_null_removed,
        {', '.join(g.one_hot(f"({g.blank('nhs_region')})", 'nhs_region_null_removed', _REGIONS))},
        {', '.join(g.one_hot(f"({g.blank('stp_code')})", 'stp_code_null_removed', _PLANS))}
        FROM latest_snapshot""",
)
def latest_snapshot(spark, sf):
    values = {"nhs_region": _REGIONS, "stp_code": _PLANS}
    return features.snapshot_features(a.snapshots(spark, sf), a.CFG, values, a.TIE_BREAK)


# All codes of the driver tables have three characters.
SHORT = ShortCodes()
# Dictionaries of the code reference, made once for each folder and condition.
_DICTIONARIES: dict[tuple, CodeDictionary] = {}


def _codes(spark, sf, kind="all"):
    """Dictionary of the reference's codes: of all, of a condition's, or of any site's."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _DICTIONARIES:
        reference = a.code_reference(spark, sf)
        if kind == "sites":
            reference = site_tag(reference, code="alt_code")
        elif kind != "all":
            reference = reference.where(kind.matches(F.col("alt_code")))
        _DICTIONARIES[key] = code_dictionary(reference, "alt_code")
    return _DICTIONARIES[key]


def _categorised(spark, sf):
    current = codes.current_reference(a.code_reference(spark, sf))
    return lookup_join(
        a.events(spark, sf), current.select("alt_code", CATEGORY), "diagnosis", "alt_code"
    )


_CATEGORISED = g.with_category("coded_events")


@query(
    "first_per_group",
    f"""SELECT {ID}, {CATEGORY}, date AS {CATEGORY}_date_earliest, diagnosis
        FROM {g.ranked(_CATEGORISED, f'{ID}, {CATEGORY}', 'date, diagnosis')}""",
)
def first_per_group_query(spark, sf):
    return first_per_group(_categorised(spark, sf), a.CFG, CATEGORY, SHORT)


@query(
    "latest_per_group",
    f"""SELECT {ID}, {CATEGORY}, date AS {CATEGORY}_date_latest
        FROM {g.ranked(_CATEGORISED, f'{ID}, {CATEGORY}', 'date DESC')}""",
)
def latest_per_group_query(spark, sf):
    return latest_per_group(_categorised(spark, sf), a.CFG, CATEGORY)


@query(
    "code_prefix_filter",
    f"SELECT {ID}, activity_id, date, diagnosis FROM coded_events WHERE {g.CANCER}",
)
def code_prefix_filter(spark, sf):
    return a.events(spark, sf).where(fixed.CANCER.matches(F.col("diagnosis")))


@query(
    "distinct_codes",
    f"SELECT {ID}, {g.codes_text('diagnosis')} AS codes FROM coded_events GROUP BY {ID}",
)
def distinct_codes_query(spark, sf):
    found = distinct_codes(a.events(spark, sf), ID, name="codes", dictionary=_codes(spark, sf))
    return codes_as_text(found)


_PRIOR = "cancer_before_cut_off"


@query("group_summary", g.group("coded_events", _PRIOR, g.CANCER))
def group_summary_query(spark, sf):
    return features.prior_condition(
        a.events(spark, sf), a.CFG, fixed.CANCER, same_code=False, dictionary=SHORT
    )


@query("group_summary_same_code", g.group("coded_events", _PRIOR, g.CANCER, same_code=True))
def group_summary_same_code(spark, sf):
    return features.prior_condition(a.events(spark, sf), a.CFG, fixed.CANCER, dictionary=SHORT)


@query(
    "group_summary_alt",
    g.group("coded_events", "stroke_before_cut_off", g.STROKE, same_code=True),
)
def group_summary_alt(spark, sf):
    return features.prior_condition(a.events(spark, sf), a.CFG, fixed.STROKE)


@query(
    "named_code_groups",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS group_name, {ID}, {name} AS first_code,
            {name}_date_earliest AS date_earliest, {name}_date_latest AS date_latest
            FROM ({g.group('coded_events', name, '(' + ' OR '.join(
                f"diagnosis LIKE '{p}'" for p in patterns) + ')')})"""
        for name, patterns in fixed.NAMED_GROUPS.items()
    ),
)
def named_code_groups(spark, sf):
    events = a.events(spark, sf)
    parts = [
        features.named_group(events, a.CFG, name, patterns).select(
            F.lit(name).alias("group_name"),
            ID,
            F.col(name).alias("first_code"),
            F.col(f"{name}_date_earliest").alias("date_earliest"),
            F.col(f"{name}_date_latest").alias("date_latest"),
        )
        for name, patterns in fixed.NAMED_GROUPS.items()
    ]
    return codes.union_all(parts)


@query("category_summary", g.category(_CATEGORISED))
def category_summary_query(spark, sf):
    events = _categorised(spark, sf)
    past = events.where(Timeline(events, a.CFG, "date").before())
    return category_summary(past, a.CFG, CATEGORY, dictionary=SHORT)


@query("category_pivot", g.category_pivot(_CATEGORISED))
def category_pivot(spark, sf):
    return features.category_features(_categorised(spark, sf), a.CFG, a.CATEGORIES, SHORT)


@query(
    "drop_all_null",
    f"""SELECT {ID}, count(*) AS "Cough_111_calls_last_1_weeks" FROM calls
        WHERE symptom_group = 'Cough' AND call_date >= {weeks(-1)} GROUP BY {ID}""",
)
def drop_all_null_query(spark, sf):
    """One symptom of five: people without it give all-null rows, which go."""
    wide = pivot_since(
        _labelled(spark, sf), a.CALLS_CFG, time="call_date", weeks=1, label="label",
        values=["Cough"], suffix="111_calls_last_",
    )
    return drop_all_null(wide, [ID])


@query(
    "site_filter",
    f"""SELECT {ID}, activity_id, date, diagnosis FROM coded_events
        WHERE regexp_matches(diagnosis, '{'|'.join(fixed.SITE_CODES['lung'])}')""",
)
def site_filter_query(spark, sf):
    return site_filter(a.events(spark, sf), "lung")


@query("site_tag", "SELECT * FROM site_events")
def site_tag_query(spark, sf):
    return site_tag(a.events(spark, sf))


def _long_codes(spark, sf):
    """Codes within longer text: at the start, in the middle, at the end, and twice."""
    events = a.events(spark, sf)
    key = F.length("activity_id") % 4
    other = F.substring("activity_id", 1, 2)
    text = (
        F.when(key == 0, F.concat("diagnosis", F.lit(" "), other))
        .when(key == 1, F.concat(other, F.lit("/"), "diagnosis", F.lit(".9")))
        .when(key == 2, F.concat(F.lit("see "), "diagnosis"))
        .otherwise(F.concat("diagnosis", F.lit(","), "diagnosis"))
    )
    return events.withColumn("diagnosis", text)


_LONG_CODES = f"""(SELECT {ID}, activity_id, date, CASE length(activity_id) % 4
    WHEN 0 THEN diagnosis || ' ' || substr(activity_id, 1, 2)
    WHEN 1 THEN substr(activity_id, 1, 2) || '/' || diagnosis || '.9'
    WHEN 2 THEN 'see ' || diagnosis ELSE diagnosis || ',' || diagnosis END AS diagnosis
    FROM coded_events)"""


@query(
    "site_tag_contains",
    f"""SELECT e.*, cancer_type FROM {_LONG_CODES} e
        JOIN sites ON regexp_matches(e.diagnosis, pattern)""",
)
def site_tag_contains(spark, sf):
    """Sites by the codes that occur anywhere in a longer code text."""
    return contains_tag(_long_codes(spark, sf))


def _tagged_later(spark, sf):
    events = a.events(spark, sf)
    return site_tag(events.where(Timeline(events, a.CFG, "date").after()))


@query("site_summary", g.site("site_events"))
def site_summary_query(spark, sf):
    found = site_summary(
        _tagged_later(spark, sf), a.CFG, features.SITE,
        values=list(fixed.SITE_CODES), dictionary=_codes(spark, sf, "sites"),
    )
    return codes_as_text(found)


@query(
    "site_latest_anchor",
    g.outcome(
        "coded_events", "cancer", f"regexp_matches(diagnosis, '{'|'.join(fixed.SITE_CODES['lung'])}')",
        prefix="lung_", anchor="l",
    ),
)
def site_latest_anchor(spark, sf):
    events = a.events(spark, sf)
    lung = site_filter(events.where(Timeline(events, a.CFG, "date").after()), "lung")
    return codes_as_text(outcome_labels(lung, a.CFG, "cancer", prefix="lung_", anchor="latest"))


@query("site_pivot", g.site_pivot("site_events"))
def site_pivot(spark, sf):
    known = _codes(spark, sf, "sites")
    return codes_as_text(features.site_outcomes(a.events(spark, sf), a.CFG, dictionary=known))


@query("outcome_labels", g.outcome("coded_events", "cancer", g.CANCER))
def outcome_labels_query(spark, sf):
    known = _codes(spark, sf, fixed.CANCER)
    return codes_as_text(features.condition_outcome(a.events(spark, sf), a.CFG, fixed.CANCER, known))


@query("outcome_labels_alt", g.outcome("coded_events", "stroke", g.STROKE))
def outcome_labels_alt(spark, sf):
    return codes_as_text(features.condition_outcome(a.events(spark, sf), a.CFG, fixed.STROKE))


@query(
    "any_column_code_flag",
    f"""SELECT {ID}, activity_id, {g.any_cause(fixed.CAUSE_COLUMNS)} AS passed_away_with_cancer_cod
        FROM mortality""",
)
def any_column_code_flag(spark, sf):
    flagged = flag_cause_of_death(
        a.mortality(spark, sf), fixed.CANCER, fixed.CAUSE_COLUMNS, "passed_away_with_cancer_cod"
    )
    return flagged.select(ID, "activity_id", "passed_away_with_cancer_cod")


_DEATH_INPUT = f"""(SELECT p.{ID}, death_month, {', '.join(fixed.CAUSE_COLUMNS)},
    all_cancer_diagnoses_after_cut_off,
    {', '.join(f'coalesce(cancer_diagnosis_in_next_{n}_weeks, 0) AS cancer_diagnosis_in_next_{n}_weeks'
               for n in a.CFG.horizon_weeks)}
    FROM person p LEFT JOIN last_mortality m ON p.{ID} = m.{ID}
    LEFT JOIN ({g.outcome('coded_events', 'cancer', g.CANCER)}) o ON p.{ID} = o.{ID})"""


@query("label_update_from_death", g.updated_labels(_DEATH_INPUT))
def label_update_from_death(spark, sf):
    outcome = features.condition_outcome(a.events(spark, sf), a.CFG, fixed.CANCER)
    labels = [f"cancer_diagnosis_in_next_{n}_weeks" for n in a.CFG.horizon_weeks]
    codes_column = "all_cancer_diagnoses_after_cut_off"
    person = (
        a.person(spark, sf)
        .select(ID, "death_month")
        .join(features.latest_mortality(a.mortality(spark, sf), a.CFG), ID, "left")
        .join(outcome.select(ID, codes_column, *labels), ID, "left")
        .na.fill(0, subset=labels)
        .drop("reg_date_of_death")
    )
    flagged = flag_cause_of_death(
        person, fixed.CANCER, fixed.CAUSE_COLUMNS, "passed_away_with_cancer_cod"
    )
    return codes_as_text(update_labels_from_death(flagged, a.CFG))
