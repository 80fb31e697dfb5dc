"""Columns of the user that have the names which operators use within."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from texts import SF, table

from cohortal.llm import (
    exact_dedup,
    line_dedup,
    mixing,
    near_dedup,
    ordinal,
    periodic_runs,
    pipeline,
    quality,
    secrets,
)
from cohortal.llm.columns import shielded

# Every name that some operator works with.
INTERNAL = """_m kind row start end match place skipped ok _free _spans _found0 _id _key node label root
    component_id print sketch band bucket first members _source blocks last slots sid lap at room chunk
    _doc _first _words _size _row key begin inside expected_grade tail_probability kept probability
    base_failed n_words word_chars source_size target size taken id text_key h1 h2 places shared
    n_lines n_dropped kept_text runs collapsed terms tf n item rank score""".split()


@pytest.fixture(scope="module")
def docs(spark):
    named = {c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in INTERNAL}
    return table(spark, "documents").where("doc_id < 60").withColumns(named)


def run_mixed(spark, docs):
    return mixing.mixed_documents(docs)


def run_mix(spark, docs):
    return mixing.taken_words(mixing.mix(docs))


def run_secrets(spark, docs):
    plain = docs.select("doc_id", "text")
    return secrets.scan(docs, secrets.train(secrets.labelled_strings(plain)))


def run_pipeline_stage(spark, docs):
    return pipeline.good_documents(spark, docs, SF)


def run_grade(spark, docs):
    ratings = ordinal.driver_ratings(table(spark, "labels"))
    return ordinal.grade(docs, ordinal.train(docs.select("doc_id", "text"), ratings))


def run_quality(spark, docs):
    return quality.judge(docs, quality.train(docs.select("doc_id", "text"), table(spark, "labels")))


@pytest.mark.parametrize(
    "run, replaced",
    [
        (lambda spark, d: near_dedup.drop_near_copies(d), []),
        (lambda spark, d: exact_dedup.drop_copies(d), []),
        (run_mixed, []),
        (run_mix, ["row", "size", "source_size", "target", "taken"]),
        (run_secrets, []),
        (run_pipeline_stage, []),
        (run_grade, ["expected_grade", "tail_probability", "kept"]),
        (run_quality, ["probability", "base_failed", "kept", "n_words", "word_chars"]),
        (lambda spark, d: line_dedup.drop_repeated_lines(d), ["n_lines", "n_dropped", "kept_text"]),
        (lambda spark, d: periodic_runs.with_runs(d), ["runs", "collapsed"]),
    ],
)
def test_columns_of_the_user_stay(spark, docs, run, replaced):
    out = run(spark, docs)
    kept = [c for c in INTERNAL if c not in replaced]
    assert [c for c in out.columns if c in kept] == kept
    rows = out.select("doc_id", *kept).collect()
    assert rows
    for r in rows:
        assert all(r[c] == f"{c} of {r['doc_id']}" for c in kept)


def test_a_result_replaces_a_column_of_its_name(spark):
    df = spark.createDataFrame([(1, "t", 2, 3)], "doc_id int, text string, Found int, other int")
    out = shielded(df, ["text"], lambda d: d.withColumn("found", F.upper("text")))
    assert out.columns == ["doc_id", "text", "other", "found"]
    assert tuple(out.first()) == (1, "t", 3, "T")


def test_text_ids_can_be_trained_on(spark):
    docs = table(spark, "documents").withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    labels = table(spark, "labels").withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    judged = quality.judge(docs.select("doc_id", "text"), quality.train(docs, labels))
    assert judged.count() == docs.count()
