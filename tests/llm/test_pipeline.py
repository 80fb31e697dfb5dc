from __future__ import annotations

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from test_near_dedup import brute

from texts import SCHEMA, SF, WORD, table
from tokenizers import Tokenizer

from cohortal.llm import registry
from cohortal.sources.tables import stage


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = table(spark, "documents"), [table(spark, "documents")]
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF), name)
        out.append(docs)
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_stages_are_the_five_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == [
        "quality_classifier", "exact_dedup", "near_dedup", "source_mixing", "best_fit_packing",
    ]


def test_all_but_the_last_keep_the_columns(outputs):
    for df in outputs[1:5]:
        assert df.columns == outputs[0].columns


def test_classifier_decides_who_stays(spark, outputs):
    """How well it does is tested on more labels than this folder has."""
    labels = {r["doc_id"]: r for r in table(spark, "labels").collect()}
    graded = registry.QUERIES["op1_ordinal_quality"](spark, SF).collect()
    kept = {r["doc_id"] for r in rows(outputs[1])}
    assert kept == {r["doc_id"] for r in graded if r["kept"]}
    good = [i in kept for i, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0]
    assert np.mean(good) > 0.97


def test_one_row_of_each_text_stays(outputs):
    before, after = rows(outputs[1]), rows(outputs[2])
    last: dict = {}
    for r in before:
        key = (r["text"] or "").encode().lower()
        last[key] = max(last.get(key, -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(last.values())
    texts = {r["doc_id"]: r["text"] for r in before}
    assert all(texts[r["doc_id"]] == r["text"] for r in after)


def test_one_document_of_each_group_stays(outputs):
    groups = brute([(r["doc_id"], r["text"]) for r in rows(outputs[2])])
    expected = sorted(i for i, (_, root) in groups.items() if i == root)
    assert sorted(r["doc_id"] for r in rows(outputs[3])) == expected


def test_sources_get_their_shares(outputs):
    def words(df):
        total: dict = {}
        for r in rows(df):
            total[r["source"]] = total.get(r["source"], 0) + len(WORD.findall(r["text"] or ""))
        return total

    before, after = words(outputs[3]), words(outputs[4])
    assert set(after) <= set(before)
    assert sum(after.values()) == pytest.approx(1.5 * sum(before.values()), rel=0.02)
    assert all(after[s] <= 2 * before[s] for s in after)


def test_everything_is_packed(outputs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = rows(outputs[5])
    tokens = sum(len(tokenizer.encode(r["text"]).ids) + 1 for r in rows(outputs[4]))
    assert sum(r["length"] for r in packed) == tokens
    once = {r["doc_id"]: r["text"] for r in rows(outputs[3])}
    # Documents that the mix takes once and whole pack as they are.
    taken: dict = {}
    for r in rows(outputs[4]):
        taken.setdefault(r["doc_id"], []).append(r["text"])
    single = {i: t[0] for i, t in taken.items() if len(t) == 1 and t[0] == once[i]}
    by_bin: dict = {}
    for r in packed:
        by_bin.setdefault(r["sequence_id"], 0)
        by_bin[r["sequence_id"]] += r["length"]
    assert max(by_bin.values()) <= 2048 and single


def test_registered_and_runs_on_an_empty_table(spark, tmp_path):
    assert "pipeline" in registry.QUERIES and "pipeline" not in registry.ORACLE
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
