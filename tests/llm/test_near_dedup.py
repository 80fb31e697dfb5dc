from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import plan_of
from texts import EDGES, SCHEMA, SF, documents, table

from cohortal.llm import near_dedup, registry
from cohortal.llm import shingles as S
from cohortal.llm.components import components


def brute(texts):
    """doc_id to (set size, component) by comparing all pairs."""
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        windows = [tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))] if w else []
        sets[i] = frozenset(windows)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = list(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def check(spark, texts):
    out = near_dedup.near_components(documents(spark, texts)).collect()
    assert len(out) == len(texts)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out}
    assert found == brute(texts)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_query_against_all_pairs(spark):
    texts = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    out = registry.QUERIES["op8_hyperminhash_near_dedup"](spark, SF).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute(texts)


@pytest.mark.parametrize("common", [2, 32])
def test_chains_and_shared_passages(spark, monkeypatch, common):
    """Chains of edits, and passages of about the size that decides, with few common sets."""
    monkeypatch.setattr(near_dedup, "COMMON", common)
    rng = random.Random(common)
    texts = []
    for _ in range(6):
        text = words(rng, 120)
        for _ in range(12):
            text = list(text)
            for _ in range(2):
                text[rng.randrange(len(text))] = "new%d" % rng.randrange(10**6)
            texts.append(" ".join(text))
    for _ in range(3):
        passage = words(rng, 80)
        for _ in range(40):
            ends = words(rng, rng.randint(0, 14)), words(rng, rng.randint(0, 14))
            texts.append(" ".join([*ends[0], *passage[rng.randint(0, 2) :], *ends[1]]))
    for _ in range(30):
        texts.append(" ".join(words(rng, rng.randint(1, 8))))
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_large_group_of_copies_with_edits_gives_few_pairs(spark, monkeypatch):
    """Copies of one text whose edits put most of them just below the wanted similarity."""
    rng = random.Random(5)
    text = words(rng, 150)
    texts = []
    for i in range(300):
        copy = list(text)
        for _ in range(rng.choice([1, 3, 4, 4, 5])):
            copy[rng.randrange(len(copy))] = "new%d" % rng.randrange(10**6)
        texts.append((i, " ".join(copy)))
    compared = []
    sharing = near_dedup._sharing

    def counted(*args):
        out = sharing(*args)
        compared.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "_sharing", counted)
    check(spark, texts)
    assert sum(compared) < 10 * len(texts)


def test_edge_rows(spark):
    single = [(i, t) for i, t in EDGES if i not in (8, None)]
    check(spark, single)
    out = near_dedup.near_components(documents(spark, EDGES)).collect()
    assert len(out) == len(EDGES)
    assert [r["component_id"] for r in out if r["doc_id"] == 8] == [8, 8]
    assert [r["kept"] for r in out if r["doc_id"] is None] == [True]
    empty = spark.createDataFrame([], SCHEMA)
    assert near_dedup.near_components(empty).count() == 0
    docs = documents(spark, EDGES)
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 7, 8, 8, 9]


def test_estimates_are_close_and_corrected():
    rng = np.random.default_rng(0)
    for share in (0.0, 0.5, 0.75, 0.9):
        errors = []
        for _ in range(40):
            both = rng.integers(0, 2**63, 2000, dtype=np.uint64) * np.uint64(2)
            n = int(2 * share / (1 + share) * 1000)
            a, b = np.sort(both[:1000]), np.sort(np.append(both[1000 - n : 1000], both[1000 : 2000 - n]))
            errors.append(S.estimate(S.sketch(a), S.sketch(b), 1000, 1000) - n / (2000 - n))
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)]
    links += [(200, 200), (None, 3), (159, 158), (158, 159)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components(df).collect()}
    expected = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert found == expected


def test_exploded_rows_and_texts_are_never_broadcast(spark, monkeypatch):
    """Spark takes an explode's rows for as many as before, and a text for 20 bytes: in a
    small table both look fit to be broadcast, and may hold many times as much."""
    plans = []
    stage = near_dedup.stage

    def noted(df, name):
        plans.append((name, plan_of(df)))
        return stage(df, name)

    monkeypatch.setattr(near_dedup, "stage", noted)
    words = [f"w{i}" for i in range(40)]
    texts = [(i, " ".join([*words, f"end{i % 4}"])) for i in range(8)]
    assert len({r["component_id"] for r in near_dedup.near_components(documents(spark, texts)).collect()}) == 1
    first = dict(reversed(plans))
    for name in ("members", "links", "rare", "rare_away"):
        assert "SortMergeJoin" in first[name] and "BroadcastHashJoin" not in first[name]
