from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F
from texts import EDGES, SCHEMA, documents

from cohortal.llm import langid, registry


def small_network(seed=0):
    rng = np.random.default_rng(seed)
    shapes = ((2, 9, 256), (2, 9, 3), (2, 3, 1), (2, 2, 3), (2, 1))
    return langid.Network(("a", "b"), *[rng.normal(0, 0.3, s) for s in shapes])


def test_gradients_match_finite_differences():
    net = small_network()
    rng = np.random.default_rng(1)
    data, labels = rng.integers(97, 103, (7, 4)), np.array([0, 1, 1, 0])
    _, gradients = langid.gradients(net, data, labels)
    for array, gradient in zip(net[1:], gradients):
        at = np.unravel_index(np.abs(gradient).argmax(), array.shape)
        kept, losses = array[at], []
        for step in (1e-3, -1e-3):
            array[at] = kept + step
            losses.append(langid.gradients(net, data, labels)[0])
        array[at] = kept
        assert abs((losses[0] - losses[1]) / 2e-3 - gradient[at]) < 1e-4


def test_reader_agrees_with_the_network():
    net = small_network()
    net = langid.Network(net.langs, *[a.astype(np.float32) for a in net[1:]])
    data = np.random.default_rng(2).integers(0, 256, (langid.STRETCH, 5))
    odds, _ = langid.forward(net, data)
    expected = langid._softmax(odds, axis=1)
    found = langid.Reader(net).probabilities(data.astype(np.uint8))
    assert np.abs(found - expected).max() < 1e-4


def test_query_predicts_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = registry.QUERIES["op2_byte_gru_language"](spark, sf).collect()
    assert len(rows) == len(docs)
    right = []
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if r["held_out"]:
            right.append(r["lang_pred"] == docs[r["doc_id"]]["lang"])
    assert np.mean(right) > 0.97


def test_every_position_has_a_label(spark):
    docs = documents(spark, EDGES)
    net = langid.fit([("the house and the dog", "en"), ("le chat et la maison", "fr")] * 40)
    rows = langid.identify(docs.withColumn("score", F.lit("theirs")), net).collect()
    assert len(rows) == len(EDGES)
    for r in rows:
        text = r["text"] or ""
        if any(c.isalpha() for c in text):
            assert r["lang_pred"] in ("en", "fr") and 0 < r["score"] <= 1
            assert sum(r["positions"].values()) == len(text.encode())
        else:
            assert (r["lang_pred"], r["score"], r["positions"]) == ("und", 0.0, {})
    labels = langid.Reader(net).positions("the dog et la maison" * 20)
    assert len(labels) == 400 and set(labels) == {"en", "fr"}
    assert langid.identify(spark.createDataFrame([], SCHEMA), net).count() == 0


def test_nothing_to_learn_from(spark):
    docs = documents(spark, EDGES)
    net = langid.train(docs, F.lit(False))
    assert {r["lang_pred"] for r in langid.identify(docs, net).collect()} == {"und"}
    net = langid.train(docs, F.lit(True))
    assert net.langs == ("en",)
    assert {r["lang_pred"] for r in langid.identify(docs, net).collect()} == {"und", "en"}


def test_sample_has_each_language_and_no_copies(spark):
    texts = [(i, f"text number {i}") for i in range(300)]
    hashed = documents(spark, texts).select("text", (F.xxhash64("text") % 2**30).alias("low"))
    order = [r["text"] for r in hashed.orderBy(F.pmod("low", F.lit(2**30))).collect()]
    docs = documents(spark, [(i, order[0]) for i in range(600)], lang="en")
    docs = docs.union(documents(spark, list(enumerate(order[1:299])), lang="de"))
    docs = docs.union(documents(spark, [(999, order[299])], lang="fr"))
    assert langid.train(docs, F.lit(True), most=50).langs == ("de", "en", "fr")
    rows = langid.training_pairs(docs, F.lit(True), 50)
    assert sorted(r["lang"] for r in rows) == ["de"] * 48 + ["en", "fr"]
    assert len({tuple(r["parts"]) for r in rows}) == 50
    assert rows == langid.training_pairs(docs.repartition(7), F.lit(True), 50)
    # More languages than rows: one pair of each.
    many = documents(spark, texts).withColumn("lang", F.col("doc_id").cast("string"))
    assert len(langid.training_pairs(many, F.lit(True), 50)) == 300


def test_quotas():
    assert langid.quota([5, 100, 200], 65) == 30
    assert langid.quota([5, 6], 100) == 6 and langid.quota([], 9) == 1
    assert langid.quota([9] * 20, 10) == 1


def test_what_is_no_letter_has_no_language():
    for text in ("½ ² ①", "Ⅷ", "12 _ !", "", "\u0301"):
        assert not langid.has_letter(text), text
    for text in ("½ a", "ª", "中", "ʰ"):
        assert langid.has_letter(text), text
