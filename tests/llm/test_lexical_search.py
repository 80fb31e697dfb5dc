from __future__ import annotations

import math
import random
import re
import string
from collections import Counter

import duckdb
import numpy as np
import pytest
from texts import EDGES, SCHEMA, SF, documents

from cohortal.llm import lexical_search, registry

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, most=10):
    """Ranked (score, id) lists: every document scored for every item."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, total = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for doc, c, n in counted:
            m = 10 + 90 * n * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(terms(text)) & set(c)
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored)[:most], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(12)
    words = ["the", "of", "Zebra", "ünï", "x1", "7", "naïve", *(f"w{i}" for i in range(60))]

    def text(n):
        return "".join(rng.choice(words[: rng.randint(2, len(words))]) + rng.choice(" .,\n-") for _ in range(n))

    docs = [(i, text(rng.choice([1, 5, 40, 300]))) for i in range(150)]
    docs += [(i, docs[7][1]) for i in range(500, 540)] + [(None, docs[7][1]), (3, docs[4][1])]
    items = [(i, text(rng.choice([1, 6, 90]))) for i in range(25)]
    items += [(30, docs[7][1]), (31, " ".join(words * 2)), (32, "THE the tHe")]
    return docs, items


def test_against_brute_force(spark, texts):
    docs, items = texts
    rows = spark.createDataFrame(items, ITEMS)
    assert found(lexical_search.search(documents(spark, docs), rows)) == brute(docs, items)
    assert found(lexical_search.search(documents(spark, docs), rows, most=3)) == brute(docs, items, 3)


def test_items_in_blocks(spark, texts):
    docs, items = texts
    rows = spark.createDataFrame(items, ITEMS)
    split = lexical_search.search(documents(spark, docs), rows, item_terms=100)
    assert found(split) == brute(docs, items)


def test_best_of_a_block():
    """With and without a floor from earlier blocks, which cuts nothing that is wanted."""
    rng = np.random.default_rng(3)
    for _ in range(40):
        v, n_docs = 70, 60
        held = rng.random((n_docs, v)) < rng.choice([0.05, 0.3, 0.9])
        value = rng.integers(0, 4, size=(n_docs, v)) * rng.integers(1, 9, size=v)
        docs, terms = np.nonzero(held)
        asked = np.sort(rng.choice(v, size=rng.integers(1, v), replace=False))
        block = lexical_search.Block(terms, docs, value[docs, terms], n_docs, v)
        wanted = asked[block.highest[asked] > 0]
        if not len(wanted):
            continue
        exact = (held[:, asked] * value[:, asked]).sum(axis=1)
        for before in (None, int(np.median(exact))):
            got, scores = lexical_search.best_of_block(block, wanted, 10, before)
            ranked = sorted((-s, d) for d, s in enumerate(exact) if s > (before or 0))[:10]
            assert list(zip((-scores).tolist(), got.tolist())) == ranked


def test_masks_tell_which_terms_a_document_holds():
    held = np.random.default_rng(1).random((130, 40)) < 0.4
    row, docs = np.nonzero(held)
    masks = lexical_search.masks_of(row, docs, 130, 40)
    assert masks.shape == (40, 3)
    different, number = lexical_search.distinct_masks(masks)
    bounds = lexical_search.mask_bounds(different, np.arange(130))
    assert (bounds[number] == (held * np.arange(130)[:, None]).sum(axis=0)).all()


def test_edge_rows(spark):
    docs = [*EDGES, (70, "long " * 5000), (71, "\x00one\x7ftwo three"), (72, "...")]
    items = [(1, "one long"), (1, "one long"), (1, "row again"), (2, None), (3, ""), (4, "?!"),
             (None, "naïve text"), (5, "absent words"), (6, " three")]
    rows = spark.createDataFrame(items, ITEMS)
    assert found(lexical_search.search(documents(spark, docs), rows)) == brute(docs, items)
    empty = spark.createDataFrame([], SCHEMA)
    assert lexical_search.search(empty, rows).count() == 0
    assert lexical_search.search(documents(spark, [(1, None)]), rows).count() == 0
    none = lexical_search.search(documents(spark, docs), spark.createDataFrame([], ITEMS))
    assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.count() == 0


def test_text_ids_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [("b", "red fox", 1, 2, 3), ("a", "red fox", 1, 2, 3), (None, "red fox", 1, 2, 3), ("c", "blue", 1, 2, 3)],
        "key string, text string, doc_id int, n int, score int",
    )
    items = spark.createDataFrame([("q", "fox", 9)], "name string, text string, rank int")
    out = lexical_search.search(docs, items, id_column="key", item_column="name", most=2)
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in sorted(out.collect())] == [
        ("q", 1, "a"), ("q", 2, "b"),
    ]


def test_query_against_its_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    expected = con.execute(registry.ORACLE["op12_lexical_search"]).fetchall()
    assert found(registry.op12(spark, SF)) == sorted(expected, key=str)
