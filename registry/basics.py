"""Queries for filters, cleaning, encoding, geography, strata and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortal import fixed
from cohortal.functions.person import age_bucket, clean_age
from cohortal.functions.text import (
    fill_blank,
    keep_alphanumeric,
    map_values,
    tristate_text,
    underscore_label,
)
from cohortal.functions.weeks import Timeline, flag, weeks_after, weeks_before
from cohortal.operators.encode import clean_one_hot, one_hot
from cohortal.operators.joins import columns_containing, prefix_columns, select_columns
from cohortal.operators.strata import (
    split_by_stratum,
    split_hash,
    split_stratified,
    strata_assign,
    strata_crosstab,
    stratum_label,
)
from cohortal.plans.features import geography_features
from cohortal.sources.tables import overwrite_partitions, read_table, stage_path, write_table
from registry import adapters as a
from registry import sqlgen as g
from registry.catalog import query
from registry.views import CUT, weeks

ID = "patient_pseudo_id"


@query("scan_project", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def scan_project(spark, sf):
    names = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    return select_columns(a.table(spark, sf, "orders"), names)


@query(
    "sink_overwrite",
    f"""SELECT o_orderkey, o_totalprice, year(o_orderdate)::INTEGER AS order_year,
            CASE WHEN year(o_orderdate) = 1998 THEN 'second' ELSE 'first' END AS written
        FROM orders WHERE year(o_orderdate) <> 1998 OR o_orderdate < {CUT} AND o_orderkey % 2 = 0""",
)
def sink_overwrite(spark, sf):
    """Orders written by year, one year replaced, and the table read back."""
    path = stage_path(spark, "orders_by_year")
    orders = a.table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year")
    )
    write_table(orders.withColumn("written", F.lit("first")), path, partition_by=["order_year"])
    again = orders.where("order_year = 1998 AND o_orderkey % 2 = 0")
    overwrite_partitions(again.withColumn("written", F.lit("second")), path, ["order_year"])
    return read_table(spark, path).select("o_orderkey", "o_totalprice", "order_year", "written")


@query("filter_before", f"SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate < {CUT}")
def filter_before(spark, sf):
    orders = a.table(spark, sf, "orders")
    past = orders.where(Timeline(orders, a.CFG, "o_orderdate").before())
    return past.select("o_orderkey", "o_custkey")


@query("filter_after", f"SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate > {CUT}")
def filter_after(spark, sf):
    orders = a.table(spark, sf, "orders")
    later = orders.where(Timeline(orders, a.CFG, "o_orderdate").after())
    return later.select("o_orderkey", "o_custkey")


_BOUNDS = [
    text
    for n in a.CFG.lookback_weeks
    for text in (
        f"{weeks(-n)} AS from_{n}",
        f"{g.flag(f'o_orderdate >= {weeks(-n)}')} AS since_{n}",
        f"{g.flag(f'o_orderdate > {weeks(-n)} AND o_orderdate < {CUT}')} AS new_{n}",
    )
] + [
    text
    for n in a.CFG.horizon_weeks
    for text in (
        f"{weeks(n)} AS until_{n}",
        f"{g.flag(f'o_orderdate <= {weeks(n)}')} AS by_{n}",
    )
]


@query("week_bounds", f"SELECT o_orderkey, {', '.join(_BOUNDS)} FROM orders")
def week_bounds(spark, sf):
    orders = a.table(spark, sf, "orders")
    line = Timeline(orders, a.CFG, "o_orderdate")
    columns = [F.col("o_orderkey")]
    for n in a.CFG.lookback_weeks:
        columns += [
            weeks_before(a.CUTOFF, n).alias(f"from_{n}"),
            flag(line.since(n)).alias(f"since_{n}"),
            flag(line.new_within(n)).alias(f"new_{n}"),
        ]
    for n in a.CFG.horizon_weeks:
        columns += [
            weeks_after(a.CUTOFF, n).alias(f"until_{n}"),
            flag(line.by(n)).alias(f"by_{n}"),
        ]
    return orders.select(*columns)


@query(
    "drop_null_key",
    f"SELECT {ID}, activity_id, attendance_date FROM activity_lines WHERE {ID} IS NOT NULL",
)
def drop_null_key(spark, sf):
    known = a.lines(spark, sf).na.drop(subset=[ID])
    return known.select(ID, "activity_id", "attendance_date")


@query(
    "clean_string",
    f"""SELECT {ID}, {g.blank('gender')} AS gender_null_replaced,
        {g.blank('imd_decile')} AS imd_decile_null_replaced FROM person""",
)
def clean_string(spark, sf):
    columns = [fill_blank(F.col(c)).alias(f"{c}_null_replaced") for c in ("gender", "imd_decile")]
    return a.person(spark, sf).select(ID, *columns)


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "one_hot",
    f"""SELECT {ID}, ccg_of_residence, acorn_wellbeing_type,
        {', '.join(g.one_hot('ccg_of_residence', 'ccg_of_residence', _SEGMENTS))},
        {', '.join(g.one_hot('acorn_wellbeing_type', 'acorn_wellbeing_type',
                             [f'type {n}' for n in range(4)]))} FROM person""",
)
def one_hot_query(spark, sf):
    """The values are discovered, in one job for both columns."""
    columns = ["ccg_of_residence", "acorn_wellbeing_type"]
    return one_hot(a.person(spark, sf).select(ID, *columns), columns)


@query(
    "clean_one_hot",
    f"""SELECT {ID}, gender, {g.blank('gender')} AS gender_null_replaced,
        {', '.join(g.one_hot(f"({g.blank('gender')})", 'gender_null_replaced',
                             [*fixed.GENDERS, 'unknown']))} FROM person""",
)
def clean_one_hot_query(spark, sf):
    return clean_one_hot(a.person(spark, sf).select(ID, "gender"), ["gender"])


@query(
    "tristate_text",
    f"SELECT {ID}, "
    + ", ".join(f"{g.tristate(c)} AS {c}_null_removed" for c in fixed.PERSON_BOOLEANS)
    + " FROM person",
)
def tristate(spark, sf):
    columns = [tristate_text(F.col(c)).alias(f"{c}_null_removed") for c in fixed.PERSON_BOOLEANS]
    return a.person(spark, sf).select(ID, *columns)


@query(
    "prefix_columns",
    f"SELECT {ID}, age AS src_age, gender AS src_gender, death_month AS src_death_month FROM person",
)
def prefix(spark, sf):
    person = a.person(spark, sf).select(ID, "age", "gender", "death_month")
    return prefix_columns(person, "src_", keep=[ID])


@query(
    "select_by_pattern",
    f"""SELECT {ID}, acorn_household_type, acorn_wellbeing_type, living_alone, living_with_young,
        living_with_elderly, acorn_type FROM person""",
)
def select_by_pattern(spark, sf):
    person = a.person(spark, sf)
    return person.select(ID, *columns_containing(person, ["living_", "acorn_"]))


@query("age_clean", f"SELECT {ID}, CASE WHEN age <= 113 THEN age END AS age_clean FROM person")
def age_clean(spark, sf):
    return a.person(spark, sf).select(ID, clean_age(F.col("age")).alias("age_clean"))


@query(
    "age_bucket",
    f"""SELECT {ID}, {g.AGE_BUCKET.format('age_clean')} AS age_bucket
        FROM (SELECT {ID}, CASE WHEN age <= 113 THEN age END AS age_clean FROM person)""",
)
def age_bucket_query(spark, sf):
    bucket = age_bucket(clean_age(F.col("age")))
    return a.person(spark, sf).select(ID, bucket.alias("age_bucket"))


_AREA, _HOUSE = "rural_urban_classification", "acorn_household_type"


@query(
    "map_values",
    f"""SELECT {ID}, {g.mapped(_AREA, fixed.RURAL_URBAN)} AS {_AREA},
        {g.mapped(_HOUSE, fixed.HOUSEHOLD_TYPE)} AS {_HOUSE} FROM person""",
)
def map_values_query(spark, sf):
    return a.person(spark, sf).select(
        ID,
        map_values(F.col(_AREA), fixed.RURAL_URBAN).alias(_AREA),
        map_values(F.col(_HOUSE), fixed.HOUSEHOLD_TYPE).alias(_HOUSE),
    )


@query(
    "sanitize_labels",
    """SELECT LSOA11CD, regexp_replace(ICB22NM, '[^a-zA-Z0-9 ]', '', 'g') AS board,
        regexp_replace(ICB22NM, '[ ,()]', '_', 'g') AS label FROM boards""",
)
def sanitize_labels(spark, sf):
    return a.boards(spark, sf).select(
        "LSOA11CD",
        keep_alphanumeric(F.col("ICB22NM")).alias("board"),
        underscore_label(F.col("ICB22NM")).alias("label"),
    )


_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_ALLIANCES = [f"{r}  Alliance" for r in _REGIONS if r != "ASIA"] + ["unknown"]
_BOARDS = [f"{r} Board{n}" for n, r in enumerate(_REGIONS)] + ["unknown"]


@query(
    "geo_two_hop",
    f"""SELECT *,
        {', '.join(g.one_hot(f"({g.blank('cancer_alliance')})",
                             'cancer_alliance_null_removed', _ALLIANCES))},
        {', '.join(g.one_hot(f"({g.blank('integrated_care_board')})",
                             'integrated_care_board_null_removed', _BOARDS))}
        FROM (SELECT {ID}, b.LSOA11CD,
                regexp_replace(CAL19NM, '[^a-zA-Z0-9 ]', '', 'g') AS cancer_alliance,
                regexp_replace(ICB22NM, '[^a-zA-Z0-9 ]', '', 'g') AS integrated_care_board
            FROM person LEFT JOIN boards b ON lsoa_2011_code = b.LSOA11CD
            LEFT JOIN alliances c ON b.LSOA11CD = c.LSOA11CD)""",
)
def geo_two_hop(spark, sf):
    return geography_features(
        a.boards(spark, sf), a.alliances(spark, sf), a.person(spark, sf), a.CFG
    )


def _strata_person(spark, sf):
    person = a.person(spark, sf)
    return person.select(
        ID, age_bucket(F.col("age")).alias("age_bucket"), "gender", "care_home"
    )


_STRATA = f"""(SELECT {ID}, {g.AGE_BUCKET.format('age')} AS age_bucket, gender, care_home
    FROM person)"""
_LABEL = "age_bucket || '-' || gender || '-' || care_home AS category"


@query(
    "strata_crosstab",
    f"""SELECT *, {_LABEL} FROM (SELECT DISTINCT age_bucket FROM {_STRATA}),
        (SELECT DISTINCT gender FROM {_STRATA}), (SELECT DISTINCT care_home FROM {_STRATA})""",
)
def crosstab(spark, sf):
    columns = ["age_bucket", "gender", "care_home"]
    return strata_crosstab(_strata_person(spark, sf), columns, "category")


@query(
    "strata_assign",
    f"""SELECT p.*, category FROM {_STRATA} p JOIN (SELECT *, {_LABEL}
            FROM (SELECT DISTINCT age_bucket FROM {_STRATA}),
            (SELECT DISTINCT gender FROM {_STRATA}), (SELECT DISTINCT care_home FROM {_STRATA}))
        USING (age_bucket, gender, care_home)""",
)
def assign(spark, sf):
    columns = ["age_bucket", "gender", "care_home"]
    return strata_assign(_strata_person(spark, sf), columns, "category")


@query("split_hash", f"SELECT {ID}, {g.split(ID)} AS dataset FROM person")
def split_hash_query(spark, sf):
    return split_hash(a.person(spark, sf).select(ID), ID, seed=a.CFG.seed)


@query(
    "split_stratified",
    f"""SELECT {ID}, target, {g.split(f"target || ':' || {ID}")} AS dataset
        FROM (SELECT {ID}, nullif(care_home + diabetes, 2) AS target FROM person)
        WHERE target IN (0, 1)""",
)
def split_stratified_query(spark, sf):
    target = F.nullif(F.col("care_home") + F.col("diabetes"), F.lit(2)).alias("target")
    return split_stratified(a.person(spark, sf).select(ID, target), ID, "target", seed=a.CFG.seed)


_DRAWN = f"""SELECT {ID}, age_bucket || '-' || gender AS stratum,
    {g.draw(ID)} AS draw FROM {_STRATA}"""
_RANKED = f"""SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY draw) AS place,
    count(*) OVER (PARTITION BY stratum) AS n FROM ({_DRAWN})"""


@query(
    "split_by_stratum",
    f"""SELECT {ID}, d.stratum, CASE WHEN draw <= train THEN 'train'
            WHEN draw <= validate THEN 'validate' ELSE 'test' END AS dataset
        FROM ({_DRAWN}) d JOIN (
            SELECT stratum, min(draw) FILTER (WHERE place >= 0.6 * n) AS train,
                min(draw) FILTER (WHERE place >= 0.8 * n) AS validate
            FROM ({_RANKED}) GROUP BY stratum) b ON d.stratum IS NOT DISTINCT FROM b.stratum""",
)
def split_by_stratum_query(spark, sf):
    """Each stratum split on its own; people of unknown gender are the null stratum."""
    label = stratum_label(["age_bucket", "gender"])
    person = _strata_person(spark, sf).select(ID, label.alias("stratum"))
    return split_by_stratum(person, ID, "stratum", seed=a.CFG.seed)
