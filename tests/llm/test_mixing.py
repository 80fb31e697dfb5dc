from __future__ import annotations

from fractions import Fraction

import pytest
from texts import EDGES, SCHEMA, SF, WORD, documents, table

from cohortal.llm import mixing, registry


def test_targets_stop_at_twice_the_size():
    found = mixing.targets([100, 10, 40, 0], [3, 1, 2, 3], Fraction(3, 2), 2)
    assert sum(found) == 225 and found[1] == 20 and found[3] == 0
    assert found[0] <= 200 and found[2] == 80 and found[0] == 125
    assert mixing.targets([], [], Fraction(3, 2), 2) == []


@pytest.fixture(scope="module")
def rows(spark):
    return registry.QUERIES["op9_source_mixing"](spark, SF).collect()


def test_query_takes_each_target(spark, rows):
    docs = {r["doc_id"]: r for r in table(spark, "documents").collect()}
    assert len(rows) == len(docs)
    totals: dict = {}
    for r in docs.values():
        totals[r["source"]] = totals.get(r["source"], 0) + len(WORD.findall(r["text"] or ""))
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weights = [(3, 1, 2)[i % 3] for i in range(len(order))]
    # Fill all sources by weight at once, and stop those that are full, over and over.
    wanted, left, open_ = {}, Fraction(3 * sum(totals.values()), 2), dict(zip(order, weights))
    while open_:
        per = left / sum(open_.values())
        full = [s for s, w in open_.items() if per * w > 2 * totals[s]]
        for s in full or list(open_):
            wanted[s] = Fraction(2 * totals[s]) if full else per * open_[s]
            left -= wanted[s]
            del open_[s]
    taken: dict = {}
    for r in rows:
        doc = docs[r["doc_id"]]
        assert r["size"] == len(WORD.findall(doc["text"] or ""))
        assert r["source_size"] == totals[doc["source"]]
        assert r["target"] == pytest.approx(float(wanted[doc["source"]]))
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[doc["source"]] = taken.get(doc["source"], 0) + r["taken"]
    for source, words in taken.items():
        assert abs(words - wanted[source]) <= 1


def test_reruns_agree(spark, rows):
    again = registry.QUERIES["op9_source_mixing"](spark, SF).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_any_stretch_of_the_mix_has_the_shares(spark):
    docs = documents(spark, [(i, "w " * 640) for i in range(30)], source="a").union(
        documents(spark, [(i + 30, "w " * 640) for i in range(30)], source="b")
    )
    mixed = mixing.mix(docs, weights={"a": 3, "b": 1}, share=Fraction(1))
    sources = {r["row"]: r["source"] for r in mixed.documents.collect()}
    slots = sorted((r["slot"], sources[r["row"]]) for r in mixed.schedule.collect())
    for at in range(0, len(slots) - 100, 50):
        share = sum(s == "a" for _, s in slots[at : at + 100]) / 100
        assert abs(share - 0.75) < 0.05


def test_edge_rows(spark):
    docs = documents(spark, EDGES).union(documents(spark, [(50, "b c " * 300)], source=None))
    out = mixing.taken_words(mixing.mix(docs)).collect()
    assert len(out) == len(EDGES) + 1
    assert {r["taken"] for r in out if r["size"] == 0} == {0}
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.taken_words(mixing.mix(empty)).count() == 0
    assert mixing.mixed_documents(empty).count() == 0


def test_documents_of_the_mix_have_the_words_taken(spark):
    docs = table(spark, "documents")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    got: dict = {}
    partial: dict = {}
    for r in out.collect():
        words = WORD.findall(r["text"])
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(words)
        if r["text"] != whole[r["doc_id"]]:
            partial[r["source"]] = partial.get(r["source"], 0) + 1
            assert " ".join(words) in " ".join(WORD.findall(whole[r["doc_id"]]))
    # In each source only the document where its share ends is cut.
    assert all(n <= 2 for n in partial.values())
    expected = {r["doc_id"]: r["taken"] for r in mixing.taken_words(mixing.mix(docs)).collect()}
    total = sum(expected.values())
    assert abs(sum(got.values()) - total) <= 0.01 * total


def test_small_sources_reach_their_targets(spark):
    sizes = {"a": [9000, 40], "b": [30], "c": [100], "d": [1, 1, 5], "e": [64], "f": [129, 70]}
    sizes |= {f"s{i:03}": [1 + 7 * i % 150] for i in range(60)}
    docs = documents(spark, [])
    for k, (source, lengths) in enumerate(sizes.items()):
        texts = [(100 * k + i, "w " * n) for i, n in enumerate(lengths)]
        docs = docs.union(documents(spark, texts, source=source)).coalesce(2)
    for share in (Fraction(3, 2), Fraction(1, 2)):
        mixed = mixing.mix(docs, share=share)
        taken: dict = {}
        for r in mixing.taken_words(mixed).collect():
            assert r["taken"] <= 2 * r["size"]
            words, target = taken.get(r["source"], (0, r["target"]))
            taken[r["source"]] = (words + r["taken"], target)
        assert len(taken) == len(sizes)
        for words, target in taken.values():
            assert abs(words - target) <= 0.5
    slots = {r["slot"] for r in mixed.schedule.collect()}
    assert slots == set(range(len(slots)))
