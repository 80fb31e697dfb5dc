"""Queries for assembled person tables, exclusions and modelling tables."""

from __future__ import annotations

from cohortal import fixed
from cohortal.operators.exclude import exclude
from cohortal.operators.summary import spread_values
from cohortal.plans import build, cohort, exclusions
from cohortal.sources.tables import stage_bucketed
from registry import adapters as a
from registry import sqlgen as g
from registry.catalog import codes_as_text, query

ID = "patient_pseudo_id"


def _ready(spark, sf):
    return build.prepare(a.sources(spark, sf), a.CFG, first_year=a.FIRST_YEAR)


def _ready_people(spark, sf):
    ready = _ready(spark, sf)
    return ready, build.stage_people(ready, a.CFG, tie_break=a.TIE_BREAK)


@query("assemble_wide", "SELECT * FROM person_wide")
def assemble_wide(spark, sf):
    ready = _ready(spark, sf)
    compact = cohort.person_features(
        ready.sources.person,
        build.condition_outcome(ready, a.CFG, fixed.CANCER),
        build.category_maps(ready, a.CFG, a.CATEGORIES),
        build.prior_condition(ready, a.CFG, fixed.CANCER),
        a.CFG,
    )
    return codes_as_text(spread_values(compact, a.CATEGORIES))


def _expanded(ready, make=build.wide_person):
    return make(
        ready,
        a.CFG,
        categories=a.CATEGORIES,
        symptom_labels=fixed.SYMPTOM_LABELS,
        values=a.CATEGORY_VALUES,
        tie_break=a.TIE_BREAK,
    )


def _staged(ready):
    """The expanded table with its categories still in one column."""
    return stage_bucketed(_expanded(ready, build.compact_person), "expanded", ID)


@query("assemble_expanded", "SELECT * FROM person_expanded")
def assemble_expanded(spark, sf):
    return codes_as_text(_expanded(_ready(spark, sf)))


def _cancer_list(spark, sf):
    return exclusions.cancer_list(
        a.sources(spark, sf), a.CFG, first_year=a.FIRST_YEAR, tie_break=a.TIE_BREAK
    )


def _stroke_list(spark, sf):
    return exclusions.stroke_list(a.sources(spark, sf), a.CFG, first_year=a.FIRST_YEAR)


@query("exclusion_reasons", "SELECT * FROM cancer_excluded")
def exclusion_reasons(spark, sf):
    return _cancer_list(spark, sf)


@query("exclusion_reasons_alt", "SELECT * FROM stroke_excluded")
def exclusion_reasons_alt(spark, sf):
    return _stroke_list(spark, sf)


@query("cancer_cohort", "SELECT *, NULL::VARCHAR AS reason FROM cancer_kept")
def cancer_cohort(spark, sf):
    """Whole rows of the people who stay, with the labels raised by deaths."""
    ready = _ready(spark, sf)
    people = _staged(ready)
    listed = build.cancer_exclusions(ready, people, a.CFG)
    kept = cohort.cancer_cohort(people, listed, a.CFG)
    return codes_as_text(spread_values(kept, a.CATEGORIES))


@query("stroke_cohort", "SELECT * FROM stroke_kept")
def stroke_cohort(spark, sf):
    """Whole rows of the people who stay."""
    ready = _ready(spark, sf)
    people = _staged(ready)
    listed = build.stroke_exclusions(ready, people, a.CFG)
    kept = cohort.stroke_cohort(people, listed, a.CFG)
    return codes_as_text(spread_values(kept, a.CATEGORIES))


@query(
    "exclude_anti",
    f"""SELECT * FROM person
        WHERE {ID} NOT IN (SELECT {ID} FROM stroke_excluded)""",
)
def exclude_anti(spark, sf):
    return exclude(a.person(spark, sf), _stroke_list(spark, sf), ID)


@query(
    "exclude_left_isnull",
    f"""SELECT p.*, reason FROM person p
        LEFT JOIN (SELECT {ID}, min(reason) AS reason FROM cancer_excluded GROUP BY {ID}) x
            ON p.{ID} = x.{ID} WHERE reason IS NULL""",
)
def exclude_left_isnull(spark, sf):
    return exclude(a.person(spark, sf), _cancer_list(spark, sf), ID, reason_column=True)


_LABEL = f"cancer_diagnosis_in_next_{a.CFG.label_weeks}_weeks"
_STROKE_LABEL = f"stroke_diagnosis_in_next_{a.CFG.label_weeks}_weeks"
_SITE_FLAGS = ", ".join(f"coalesce(w.{c}, 0) AS {c}" for c in g.SITE_FLAGS)


@query(
    "model_table",
    f"""SELECT m.*, {_SITE_FLAGS}
        FROM ({g.model('cancer_kept', _LABEL, death_label=True)}) m
        LEFT JOIN site_wide w ON m.{ID} = w.{ID}""",
)
def model_table(spark, sf):
    return codes_as_text(build.cancer_table(*_ready_people(spark, sf), a.CFG))


@query(
    "model_table_alt",
    g.model(
        "(SELECT k.*, s.stroke_flag FROM stroke_kept k LEFT JOIN (SELECT "
        f"{ID} AS stroke_id, {_STROKE_LABEL} AS stroke_flag FROM stroke_outcome) s"
        f" ON k.{ID} = s.stroke_id)",
        _STROKE_LABEL,
        death_label=False,
        extra=f", coalesce(stroke_flag, 0) AS {_STROKE_LABEL}",
    ),
)
def model_table_alt(spark, sf):
    return codes_as_text(build.stroke_table(*_ready_people(spark, sf), a.CFG))
