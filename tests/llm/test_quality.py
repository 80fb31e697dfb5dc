from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from texts import EDGES, SCHEMA, SF, WORD, documents, table

from cohortal.llm import quality, registry


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(words), sum(map(len, words)), symbols, repeated, len(covered))


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        expected = brute(texts[r["doc_id"]])
        assert tuple(r[c] for c in quality.COUNTS) == expected
        failed = expected[0] < 50 or 100 * expected[4] > 50 * expected[0]
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed and r["probability"] >= 0.5)


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    check(registry.QUERIES["op6_quality_rules"](spark, SF).collect(), texts)


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    aside = F.xxhash64("doc_id", F.lit(1)) % 3 == 0
    model = quality.train(docs, labels.where(~aside))
    rows = quality.judge(docs.join(labels.where(aside), "doc_id"), model).collect()
    right = [(r["probability"] >= 0.5) == (r["quality"] == 1) for r in rows]
    assert np.mean(right) > 0.93


def test_edge_rows(spark):
    texts = [(i, t) for i, t in EDGES if i != 8]
    texts += [(20, "a b c a b c"), (21, "x\nx\n \n \ny"), (22, "same " * 60), (23, "#*$%&|<> " * 9)]
    texts += [(24, "a\x0bb\x0cc\x1cd\x85e f"), (25, "é\U0001f600 " * 70 + "\n" * 20)]
    docs = documents(spark, texts).withColumn("kept", F.lit(1))
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    model = quality.train(docs, none)
    check(quality.judge(docs, model).collect(), dict(texts))
    both = quality.judge(documents(spark, [(8, "a b")] * 2), model).collect()
    assert len(both) == 2
    assert quality.judge(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_n_grams_are_of_characters():
    """One bucket for each character, pair and triple, whatever bytes they take."""
    for text in ("abca", "éa中é", "\U0001f600x\U0001f600y"):
        singles, pairs, triples = quality._character_buckets(text)
        assert (len(singles), len(pairs), len(triples)) == (4, 3, 2)
        different = [len(set(text)), len({text[i : i + 2] for i in range(3)}), 2]
        assert [len(set(x.tolist())) for x in (singles, pairs, triples)] == different
    assert list(quality._character_buckets("")) == []


def test_long_texts_are_scored_in_pieces(monkeypatch):
    text = "".join(map(chr, [*range(32, 127), 0xE9, 0x4E2D, 0x1F600])) * 40
    hashes = np.arange(50, dtype=np.uint64)
    model = quality.Model(np.random.default_rng(0).normal(size=quality.BUCKETS), 0.0, 1.0, 0.0)
    whole, at = model.probability(text, hashes), quality.features(text, hashes)
    monkeypatch.setattr(quality, "PIECE", 100)
    assert abs(model.probability(text, hashes) - whole) < 1e-9
    pieces = quality.features(text, hashes)
    assert (pieces[0] == at[0]).all() and np.allclose(pieces[1], at[1])
