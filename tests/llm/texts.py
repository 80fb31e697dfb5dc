"""Edge rows shared by the tests of the text operators."""

from __future__ import annotations

import re

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, extra string"


def documents(spark, texts, **columns):
    """A documents table from (doc_id, text) pairs, with a column that is not known."""
    rows = [
        (i, t, columns.get("lang", "en"), columns.get("source", "a"), len(t or ""), "x")
        for i, t in texts
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


EDGES = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "one"),
    (6, "ONE"),
    (7, "naïve Ünïcode ça \U0001f600 text"),
    (None, "no id"),
    (8, "same row again"),
    (8, "same row again"),
    (9, "long " * 3000 + "end"),
]


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")
