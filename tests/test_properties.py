"""Random small tables: the single-pass forms against the long way or plain Python."""

from __future__ import annotations

import datetime as dt

import naive
from conftest import same_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortal.functions.text import strip_code, underscore_label
from cohortal.operators.joins import salted_left_join
from cohortal.operators.lookback import lookback_counts, lookback_pivot
from cohortal.operators.sites import site_tag
from cohortal.operators.summary import (
    SPAN,
    code_spans,
    first_and_last,
    spans_around,
    spans_on_side,
)

ID = "patient_pseudo_id"
CUT = dt.date(2021, 8, 31)
FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
people = st.sampled_from(["a", "b", "c", None])
days = st.one_of(
    st.none(),
    st.sampled_from([0, -28, -84, 84, -27, 1, -1]).map(lambda n: CUT + dt.timedelta(days=n)),
    st.integers(-2500, 2500).map(lambda n: CUT + dt.timedelta(days=n)),
)
code = st.one_of(
    st.none(), st.sampled_from(["C44", "C440", "C56", "C90", "C15C16", "XC25", "I63", "D05", ""])
)
events = st.lists(st.tuples(people, days, code), min_size=1, max_size=40)


def table(spark, rows):
    return spark.createDataFrame(rows, f"{ID} string, date date, diagnosis string")


@FEW
@given(rows=events)
def test_counts(spark, cfg, rows):
    df = table(spark, rows)
    ours = lookback_counts(df, cfg, time="date", total="n", prefix="n_")
    same_rows(ours, naive.counts(df, cfg, "date", "n", "n_"))


@FEW
@given(rows=events)
def test_label_counts(spark, cfg, rows):
    df = table(spark, rows)
    ours = lookback_pivot(
        df, cfg, time="date", label="diagnosis", values=["C56", "I63"], suffix="n_"
    )
    got = {r[ID]: r.asDict() for r in ours.collect()}
    past = [(p, d, c) for p, d, c in rows if p and d and d < CUT]
    assert set(got) == {p for p, _, _ in past}
    for person, row in got.items():
        for n in cfg.lookback_weeks:
            since = CUT - dt.timedelta(weeks=n)
            for label in ("C56", "I63"):
                expected = sum((p, c) == (person, label) and d >= since for p, d, c in past)
                assert row[f"{label}_n_{n}_weeks"] == expected


@FEW
@given(rows=events)
def test_first_and_last(spark, rows):
    df = table(spark, [r for r in rows if r[0] and r[2] is not None] or [("a", CUT, "C56")])
    got = first_and_last(df, [ID])
    flat = got.select(
        ID, F.col("first.date").alias("first_date"), F.col("first.code").alias("first_code"),
        F.col("last.date").alias("last_date"), F.col("last.code").alias("last_code"),
    )
    same_rows(flat, naive.ends(df, [ID]))
    # The same from spans, undated rows included.
    same_rows(first_and_last(code_spans(df, [ID]), [ID], **SPAN), got)


@FEW
@given(rows=events)
def test_spans_on_each_side(spark, cfg, rows):
    df = table(spark, rows)
    for side, test in (("before", "<"), ("after", ">")):
        one_side = df.where(f"date {test} date'{CUT}'")
        same_rows(spans_on_side(spans_around(df, cfg), cfg, side), code_spans(one_side, [ID]))


@FEW
@given(rows=events)
def test_sites(spark, rows):
    df = table(spark, rows)
    same_rows(site_tag(df), naive.sites(df))


@FEW
@given(
    left=st.lists(st.one_of(st.none(), st.sampled_from("hhhhhxyz")), min_size=1, max_size=60),
    right=st.lists(st.one_of(st.none(), st.sampled_from("hxyw")), max_size=8),
)
def test_salted_join(spark, left, right):
    a = spark.createDataFrame([(i, k) for i, k in enumerate(left)], "i int, k string")
    b = spark.createDataFrame([(k, j) for j, k in enumerate(right)], "key string, j int")
    same_rows(salted_left_join(a, b, "k", "key"), a.join(b, a.k == b.key, "left"))


@FEW
@given(texts=st.lists(st.text(alphabet="A1 |,-.()\t_é", max_size=8), min_size=1, max_size=20))
def test_text_cleaning(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", strip_code(F.col("t")), underscore_label(F.col("t"))).collect()
    for text, stripped, label in got:
        assert stripped == "".join(ch for ch in text if ch not in " |,-")
        assert label == "".join("_" if ch in " ,()" else ch for ch in text)
