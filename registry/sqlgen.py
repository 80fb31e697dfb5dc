"""SQL for the features and labels, written the long way: one window, filter or
join per output, so that it checks the single-pass forms independently."""

from __future__ import annotations

from cohortal import fixed
from registry.adapters import CATEGORIES, CATEGORY_VALUES, CFG
from registry.views import CUT, VIEWS, sql_list, weeks

ID = "patient_pseudo_id"
CANCER = "starts_with(diagnosis, 'C') AND NOT starts_with(diagnosis, 'C44')"
STROKE = "starts_with(diagnosis, 'I6')"


def flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def ranked(src: str, keys: str, order: str) -> str:
    return f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY {keys} ORDER BY {order}) AS rn FROM ({src})) WHERE rn = 1)"""


def counts(
    view: str, time: str, total: str, prefix: str, lookback=CFG.lookback_weeks,
    coded: tuple[str, str, str] | None = None, entity: str = ID,
) -> str:
    windows = [
        f"count(*) FILTER (WHERE {time} >= {weeks(-n)}) AS \"{prefix}{n}_weeks\"" for n in lookback
    ]
    columns = [entity, f'count(*) AS "{total}"', *windows]
    if coded:
        column, coded_total, pct = coded
        n = f"count(*) FILTER (WHERE {column} <> '')"
        columns += [f'{n} AS "{coded_total}"', f'{n}::DOUBLE / count(*)::DOUBLE * 100 AS "{pct}"']
    return f"""SELECT {', '.join(columns)} FROM {view}
        WHERE {entity} IS NOT NULL AND {time} < {CUT} GROUP BY {entity}"""


def call_counts(labels: list[str], lookback) -> str:
    columns = ['count(*) AS "111_calls_total"']
    for n in lookback:
        since = f"call_date >= {weeks(-n)}"
        columns += [
            f'count(*) FILTER (WHERE {since}) AS "111_calls_last_{n}_weeks"',
            f"count(*) FILTER (WHERE {since} AND label IS NOT NULL)"
            f' AS "111_calls_cancer_last_{n}_weeks"',
        ]
        columns += [
            f"count(*) FILTER (WHERE {since} AND label = '{v}')"
            f' AS "{v}_111_calls_last_{n}_weeks"'
            for v in labels
        ]
    return f"SELECT {ID}, {', '.join(columns)} FROM past_calls GROUP BY {ID}"


def recent_flags(name: str, date: str) -> str:
    return ", ".join(
        f"{flag(f'{date} > {weeks(-n)} AND {date} < {CUT}')} AS \"{name}_in_last_{n}_weeks\""
        for n in CFG.lookback_weeks
    )


def group(src: str, name: str, condition: str, *, same_code: bool = False) -> str:
    rows = f"SELECT {ID}, date, diagnosis FROM {src} WHERE date < {CUT} AND {condition}"
    on = f"f.{ID} = l.{ID}" + (" AND f.diagnosis = l.diagnosis" if same_code else "")
    return f"""SELECT f.{ID}, f.diagnosis AS {name}, f.date AS {name}_date_earliest,
        l.date AS {name}_date_latest, 1 AS {name}_binary, {recent_flags(name, 'f.date')}
        FROM {ranked(rows, ID, 'date, diagnosis')} f
        LEFT JOIN {ranked(rows, ID, 'date DESC, diagnosis DESC')} l ON {on}"""


CATEGORY = "category_3_code"


def category(src: str) -> str:
    """``src`` holds events with a category that may be null."""
    rows = f"SELECT {ID}, {CATEGORY}, date, diagnosis FROM ({src}) WHERE date < {CUT}"
    keys = f"{ID}, {CATEGORY}"
    return f"""SELECT f.{ID}, f.{CATEGORY}, f.date AS {CATEGORY}_date_earliest, f.diagnosis,
        l.date AS {CATEGORY}_date_latest, 1 AS {CATEGORY}_binary,
        {recent_flags(CATEGORY, 'f.date')}
        FROM {ranked(rows, keys, 'date, diagnosis')} f
        LEFT JOIN {ranked(rows, keys, 'date DESC, diagnosis DESC')} l
            ON f.{ID} = l.{ID} AND f.{CATEGORY} = l.{CATEGORY}"""


def category_columns(values: list[str]) -> list[tuple[str, str]]:
    """(output name, aggregate) of the category pivot."""
    out = []
    for v in values:
        pick = f"WHEN {CATEGORY} = '{v}' THEN"
        out += [
            (f"{v}_binary", f"sum(CASE {pick} {CATEGORY}_binary END)::BIGINT"),
            (f"{v}_earliest_date", f"max(CASE {pick} {CATEGORY}_date_earliest END)"),
            (f"{v}_diagnosis", f"max(CASE {pick} diagnosis END)"),
        ]
        out += [
            (f"{v}_last_{n}_weeks", f"sum(CASE {pick} {CATEGORY}_in_last_{n}_weeks END)::BIGINT")
            for n in CFG.lookback_weeks
        ]
    return out


def category_pivot(src: str, values: list[str] = CATEGORIES) -> str:
    columns = ", ".join(f'{agg} AS "{name}"' for name, agg in category_columns(values))
    return f"""SELECT {ID}, {columns} FROM ({category(src)})
        WHERE {CATEGORY} IN ({sql_list(values)}) GROUP BY {ID}"""


def site(src: str) -> str:
    """``src`` holds events tagged by site; only those after the cut-off count."""
    rows = f"SELECT {ID}, cancer_type, date, diagnosis FROM {src} WHERE date > {CUT}"
    keys = f"{ID}, cancer_type"
    flags = ", ".join(
        f"{flag(f'f.date <= {weeks(n)}')} AS cancer_type_diagnosis_in_next_{n}_weeks"
        for n in CFG.horizon_weeks
    )
    return f"""SELECT f.{ID}, f.cancer_type, f.date AS cancer_type_date_earliest, f.diagnosis,
        l.date AS cancer_type_date_latest, c.codes AS all_cancer_diagnoses_after_cut_off, {flags}
        FROM {ranked(rows, keys, 'date, diagnosis')} f
        LEFT JOIN {ranked(rows, keys, 'date DESC, diagnosis DESC')} l
            ON f.{ID} = l.{ID} AND f.cancer_type = l.cancer_type
        LEFT JOIN (SELECT {ID}, {codes_text('diagnosis')} AS codes FROM ({rows}) GROUP BY {ID}) c
            ON f.{ID} = c.{ID}"""


def codes_text(column: str) -> str:
    """Sorted distinct codes as one text."""
    return f"string_agg(DISTINCT {column}, ',' ORDER BY {column})"


def site_columns() -> list[tuple[str, str]]:
    out = []
    for v in fixed.SITE_CODES:
        pick = f"WHEN cancer_type = '{v}' THEN"
        out += [
            (f"cancer_earliest_date_{v}", f"max(CASE {pick} cancer_type_date_earliest END)"),
            (f"cancer_latest_date_{v}", f"max(CASE {pick} cancer_type_date_latest END)"),
            (f"cancer_diagnosis_{v}", f"max(CASE {pick} diagnosis END)"),
            (
                f"all_cancer_diagnoses_after_cut_off_{v}",
                f"max(CASE {pick} all_cancer_diagnoses_after_cut_off END)",
            ),
        ]
        out += [
            (
                f"cancer_diagnosis_in_next_{n}_weeks_{v}",
                f"sum(CASE {pick} cancer_type_diagnosis_in_next_{n}_weeks END)::BIGINT",
            )
            for n in CFG.horizon_weeks
        ]
    return out


def site_pivot(src: str) -> str:
    columns = ", ".join(f"{agg} AS {name}" for name, agg in site_columns())
    return f"SELECT {ID}, {columns} FROM ({site(src)}) GROUP BY {ID}"


def outcome(
    src: str, name: str, condition: str, *, prefix: str = "", anchor: str = "f"
) -> str:
    """Anchor ``f`` puts the flags on the first date, ``l`` on the latest."""
    rows = f"SELECT {ID}, date, diagnosis FROM {src} WHERE date > {CUT} AND {condition}"
    flags = ", ".join(
        f"{flag(f'{anchor}.date <= {weeks(n)}')} AS {prefix}{name}_diagnosis_in_next_{n}_weeks"
        for n in CFG.horizon_weeks
    )
    return f"""SELECT f.{ID}, f.date AS {prefix}{name}_after_cut_off_date_earliest,
        f.diagnosis AS {prefix}diagnosis_earliest_after_cut_off_date,
        l.date AS {prefix}{name}_after_cut_off_date_latest,
        l.diagnosis AS {prefix}diagnosis_latest_after_cut_off_date,
        c.codes AS {prefix}all_{name}_diagnoses_after_cut_off, {flags}
        FROM {ranked(rows, ID, 'date, diagnosis')} f
        JOIN {ranked(rows, ID, 'date DESC, diagnosis DESC')} l ON f.{ID} = l.{ID}
        JOIN (SELECT {ID}, {codes_text('diagnosis')} AS codes FROM ({rows}) GROUP BY {ID}) c
            ON f.{ID} = c.{ID}"""


def with_category(src: str) -> str:
    return f"""SELECT {src}.*, {CATEGORY} FROM {src}
        LEFT JOIN current_codes ON {src}.diagnosis = alt_code"""


def blank(column: str) -> str:
    return f"CASE WHEN {column} IS NULL OR {column} = '' THEN 'unknown' ELSE {column} END"


def tristate(column: str) -> str:
    return f"CASE WHEN {column} THEN 'True' WHEN NOT {column} THEN 'False' ELSE 'Unknown' END"


def one_hot(source: str, name: str, values: list[str]) -> list[str]:
    return [
        f"{flag(f'{source} = {sql_list([v])}')} AS \"{name}_{v.replace(' ', '_')}\""
        for v in values
    ]


def any_cause(columns: list[str]) -> str:
    tests = [f"coalesce(starts_with({c}, 'C') AND NOT starts_with({c}, 'C44'), false)" for c in columns]
    return flag(" OR ".join(tests))


AGE_BUCKET = """CASE WHEN {0} >= 40 AND {0} < 50 THEN '40-50' WHEN {0} >= 50 AND {0} < 60 THEN '50-60'
    WHEN {0} >= 60 AND {0} < 70 THEN '60-70' WHEN {0} >= 70 AND {0} < 80 THEN '70-80'
    WHEN {0} >= 80 AND {0} < 90 THEN '80-90' WHEN {0} >= 90 THEN '90+' ELSE 'other' END"""


def mapped(column: str, mapping: dict[str, str]) -> str:
    cases = " ".join(f"WHEN {sql_list([k])} THEN {sql_list([v])}" for k, v in mapping.items())
    return f"CASE {column} {cases} END"


def draw(key: str) -> str:
    return f"('0x' || substr(md5('{CFG.seed}:' || {key}), 1, 8))::UBIGINT / 4294967296.0"


def split(key: str) -> str:
    return (
        f"CASE WHEN {draw(key)} < 0.6 THEN 'train' WHEN {draw(key)} < 0.8 THEN 'validate'"
        " ELSE 'test' END"
    )


# Assembled tables, as views on top of the adapters.

OUTCOME_COLUMNS = [
    "cancer_after_cut_off_date_earliest", "diagnosis_earliest_after_cut_off_date",
    "cancer_after_cut_off_date_latest", "diagnosis_latest_after_cut_off_date",
    "all_cancer_diagnoses_after_cut_off",
]
PRIOR = "cancer_before_cut_off"
COUNT_TABLES = {
    "emergency_counts": (
        "emergency", "ae_attend_total", "ae_attendances_last_",
        ("dimention_8", "aea_diagnoses_total", "ae_diagnosis_pct_of_attendnaces"),
    ),
    "inpatient_counts": (
        "inpatient", "IP_attend_total", "IP_attendances_last_",
        ("dimention_8", "IP_diagnoses_total", "IP_diagnosis_pct_of_attendnaces"),
    ),
    "outpatient_counts": (
        "outpatient_merged", "opa_attend_total", "OPA_attendances_last_",
        ("Primary_Diagnosis_Code", "opa_diagnoses_total", "opa_diagnosis_pct_of_attendnaces"),
    ),
}
for _name, (_view, _total, _prefix, _coded) in COUNT_TABLES.items():
    VIEWS[_name] = counts(_view, "attendance_date", _total, _prefix, coded=_coded)

VIEWS["call_windows"] = call_counts(fixed.SYMPTOM_LABELS, CFG.lookback_weeks)
VIEWS["cancer_outcome"] = outcome("all_codes", "cancer", CANCER)
VIEWS["stroke_outcome"] = outcome("all_codes", "stroke", STROKE)
VIEWS["prior_cancer"] = group("all_codes", PRIOR, CANCER, same_code=True)
VIEWS["prior_stroke"] = group("all_codes", "stroke_before_cut_off", STROKE, same_code=True)
VIEWS["category_wide"] = category_pivot(with_category("all_codes"))
VIEWS["tagged_codes"] = """SELECT a.*, cancer_type FROM all_codes a
    JOIN sites ON regexp_matches(a.diagnosis, pattern)"""
VIEWS["site_wide"] = site_pivot("tagged_codes")
VIEWS["last_mortality"] = "SELECT * FROM " + ranked(
    "SELECT * FROM mortality", ID, "activity_id DESC"
)


def _zero(columns: list[str]) -> list[str]:
    return [f'coalesce("{c}", 0) AS "{c}"' for c in columns]


def _category_select() -> list[str]:
    names = [name for name, _ in category_columns(CATEGORIES)]
    text = ("_earliest_date", "_diagnosis")
    return [
        f'"{c}"' if c.endswith(text) else f'coalesce("{c}", 0)::BIGINT AS "{c}"' for c in names
    ]


_OUTCOME_FLAGS = [f"cancer_diagnosis_in_next_{n}_weeks" for n in CFG.horizon_weeks]
_PRIOR_FLAGS = [f"{PRIOR}_binary", *[f"{PRIOR}_in_last_{n}_weeks" for n in CFG.lookback_weeks]]
VIEWS["person_wide"] = f"""SELECT person.*, {', '.join(OUTCOME_COLUMNS)},
    {', '.join(_zero(_OUTCOME_FLAGS))}, {', '.join(_category_select())},
    {PRIOR}, {PRIOR}_date_earliest, {PRIOR}_date_latest, {', '.join(_zero(_PRIOR_FLAGS))}
    FROM person LEFT JOIN cancer_outcome USING ({ID}) LEFT JOIN category_wide USING ({ID})
    LEFT JOIN prior_cancer USING ({ID})"""


def _count_columns() -> list[str]:
    out = ["111_calls_total"]
    for n in CFG.lookback_weeks:
        out += [f"111_calls_last_{n}_weeks", f"111_calls_cancer_last_{n}_weeks"]
        out += [f"{v}_111_calls_last_{n}_weeks" for v in fixed.SYMPTOM_LABELS]
    for _, total, prefix, (_, coded_total, pct) in COUNT_TABLES.values():
        out += [total, *[f"{prefix}{n}_weeks" for n in CFG.lookback_weeks], coded_total, pct]
    return out


def _snapshot_select() -> list[str]:
    kept = [*fixed.SNAPSHOT_DATES, *fixed.SNAPSHOT_SEGMENTS]
    out = [f"s.{c} AS phr_{c}" for c in kept]
    out += [f"coalesce(s.{c}, 0) AS phr_{c}" for c in fixed.SNAPSHOT_FLAGS]
    for c in fixed.SNAPSHOT_CATEGORIES:
        # Without a snapshot the cleaned category stays null.
        text = f"CASE WHEN s.{ID} IS NOT NULL THEN {blank(f's.{c}')} END"
        out.append(f"{text} AS phr_{c}_null_removed")
        out += one_hot(f"({text})", f"phr_{c}_null_removed", CATEGORY_VALUES[c])
    return out


def _person_select() -> list[str]:
    out = ["CASE WHEN age <= 113 THEN age END AS age_clean"]
    for c in fixed.PERSON_BOOLEANS:
        out.append(f"{tristate(c)} AS {c}_null_removed")
        out += one_hot(f"({tristate(c)})", f"{c}_null_removed", fixed.TRISTATE)
    for c in fixed.PERSON_CATEGORIES:
        out.append(f"{blank(c)} AS {c}_null_removed")
        out += one_hot(f"({blank(c)})", f"{c}_null_removed", CATEGORY_VALUES[c])
    return out


VIEWS["person_expanded"] = f"""SELECT p.*, {', '.join(_person_select())},
    m.reg_date_of_death, {', '.join('m.' + c for c in fixed.CAUSE_COLUMNS)},
    {', '.join(_zero(_count_columns()))}, {', '.join(_snapshot_select())}
    FROM person_wide p LEFT JOIN last_mortality m ON p.{ID} = m.{ID}
    LEFT JOIN call_windows c ON p.{ID} = c.{ID}
    LEFT JOIN emergency_counts e ON p.{ID} = e.{ID}
    LEFT JOIN inpatient_counts i ON p.{ID} = i.{ID}
    LEFT JOIN outpatient_counts o ON p.{ID} = o.{ID}
    LEFT JOIN latest_snapshot s ON p.{ID} = s.{ID}"""


def _reason(name: str, condition: str) -> str:
    return f"SELECT {ID}, {sql_list([name])} AS reason FROM person_expanded WHERE {condition}"


_COMMON = [
    (fixed.NO_AGE, "age IS NULL"),
    (fixed.TOO_YOUNG, "age < 40"),
    (fixed.TOO_OLD, "age > 120"),
    (fixed.DIED_BEFORE, f"death_month < {CUT}"),
    (fixed.DEDUCTED, "deducted = 1 AND deduction_reason <> 'DEA'"),
]
VIEWS["cancer_excluded"] = " UNION ALL ".join(
    [
        *[_reason(*r) for r in _COMMON],
        _reason(fixed.RECORD_FLAG, "phr_active_cancer = 1 OR phr_cancer = 1"),
        _reason(
            fixed.DIED_AFTER,
            f"death_month >= {CUT} AND ({any_cause(fixed.CAUSE_COLUMNS)}) = 0",
        ),
        f"SELECT {ID}, '{fixed.PRIOR_CANCER}' FROM prior_cancer",
    ]
)
VIEWS["stroke_excluded"] = " UNION ALL ".join(
    [
        *[_reason(*r) for r in _COMMON],
        _reason(fixed.DIED_AFTER, f"death_month >= {CUT}"),
        f"SELECT {ID}, '{fixed.PRIOR_STROKE}' FROM prior_stroke",
    ]
)


def updated_labels(src: str) -> str:
    """``src`` holds the death month, causes, code set and horizon labels."""
    later = {n: f"death_with_first_cancer_diagnosis_in_next_{n}_weeks" for n in CFG.horizon_weeks}
    by_death = [
        f"{flag(f'death_month <= {weeks(n)} AND {fixed.DEATH_LABEL} = 1')} AS {name}"
        for n, name in later.items()
    ]
    raised = [
        f"{flag(f'{name} = 1 OR cancer_diagnosis_in_next_{n}_weeks = 1')}"
        f" AS cancer_diagnosis_in_next_{n}_weeks"
        for n, name in later.items()
    ]
    at_death = flag(
        f"passed_away_with_cancer_cod = 1 AND death_month > {CUT}"
        " AND all_cancer_diagnoses_after_cut_off IS NULL"
    )
    return f"""SELECT * REPLACE ({', '.join(raised)}) FROM (SELECT *, {', '.join(by_death)} FROM (
        SELECT *, {at_death} AS {fixed.DEATH_LABEL} FROM (
        SELECT *, {any_cause(fixed.CAUSE_COLUMNS)} AS passed_away_with_cancer_cod FROM {src})))"""


VIEWS["cancer_kept"] = updated_labels(
    f"(SELECT * FROM person_expanded WHERE {ID} NOT IN (SELECT {ID} FROM cancer_excluded))"
)
VIEWS["stroke_kept"] = f"""SELECT * FROM person_expanded
    WHERE {ID} NOT IN (SELECT {ID} FROM stroke_excluded)"""


def model(src: str, target: str, *, death_label: bool, extra: str = "", join: str = "") -> str:
    area, household = "rural_urban_classification_null_removed", "acorn_household_type_null_removed"
    columns = ", ".join(f'"{c}"' for c in fixed.model_columns(CFG, death_label=death_label))
    hot = one_hot(area, area, fixed.RURAL_URBAN_GROUPS)
    hot += one_hot(household, household, fixed.HOUSEHOLD_GROUPS)
    return f"""SELECT *, age_bucket || '-' || gender || '-' || {target} AS category,
        {split(f"{target} || ':' || {ID}")} AS dataset
        FROM (SELECT {columns}, {', '.join(hot)}, {AGE_BUCKET.format('age_clean')} AS age_bucket{extra}
            FROM (SELECT * REPLACE ({mapped(area, fixed.RURAL_URBAN)} AS {area},
                {mapped(household, fixed.HOUSEHOLD_TYPE)} AS {household}) FROM {src}) {join})
        WHERE gender IS NOT NULL"""


SITE_FLAGS = [name for name, _ in site_columns() if "cancer_diagnosis_in_next_" in name]
