from __future__ import annotations

import hashlib
import re

from compare import difference, duck
from pyspark.sql import functions as F
from texts import EDGES, SCHEMA, SF, documents

from cohortal.llm import exact_dedup, registry


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_query_matches_sql(spark):
    con = duck(SF)
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    query, sql = registry.QUERIES["op7_exact_dedup"], registry.ORACLE["op7_exact_dedup"]
    assert difference(query(spark, SF), con, sql) is None


def check(spark, **options):
    docs = documents(spark, EDGES)
    out = exact_dedup.exact_groups(docs, **options).collect()
    assert len(out) == len(EDGES) and "extra" in out[0]
    groups: dict = {}
    for i, t in EDGES:
        groups.setdefault(lower(t), []).append(i)
    texts = {}
    for i, t in EDGES:
        texts[i] = lower(t)
    for r in out:
        members = groups[texts[r["doc_id"]]]
        known = [m for m in members if m is not None]
        assert r["keep_id"] == (max(known) if known else None)
        assert r["group_size"] == len(members)
        assert r["text_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    # One row stays of each group, also where the rows are equal.
    assert sum(r["kept"] for r in out) == len(groups)


def test_edge_rows(spark):
    check(spark)


def test_equal_hashes_of_different_chunks(spark):
    check(spark, chunk_hash=lambda c: (F.xxhash64(c) % 2).cast("bigint"))


def test_chunks_make_up_the_text_whatever_its_case(spark):
    texts = ["", "x" * 20_000, "Ab c. " * 900, "line\n" * 800 + "e", "\U0001f600" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    chunks = exact_dedup.chunks_of(F.col("text"))
    lowered = exact_dedup.chunks_of(F.lower("text"))
    rows = df.select("text", chunks.alias("c"), F.transform(lowered, F.length).alias("l")).collect()
    for r in rows:
        assert "".join(r["c"]) == r["text"]
        assert [len(c) for c in r["c"]] == r["l"]
        assert all(len(c) <= 4100 for c in r["c"])


def test_dropping_copies_keeps_rows_as_they_are(spark):
    docs = documents(spark, EDGES)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert kept.exceptAll(docs).count() == 0
    assert kept.count() == len({lower(t) for _, t in EDGES})


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_groups(docs).count() == 0
    assert exact_dedup.drop_copies(docs).count() == 0
