from __future__ import annotations

import hashlib
import random
import string
from collections import defaultdict

import duckdb
from texts import EDGES, SCHEMA, SF, documents

from cohortal.llm import line_dedup, registry

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(texts, least=20, most=3):
    own = [(float("inf") if i is None else i, t or "") for i, t in texts]
    holders = defaultdict(set)
    for i, text in own:
        for line in text.split("\n"):
            holders[key_of(line)].add(i)
    gone = {k: max(d) for k, d in holders.items() if len(k) >= least and len(d) >= most}
    out = []
    for i, text in own:
        lines = text.split("\n")
        kept = [s for s in lines if gone.get(key_of(s), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def found(df):
    return sorted(
        (float("inf") if r["doc_id"] is None else r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"])
        for r in df.collect()
    )


def test_against_brute_force(spark):
    rng = random.Random(11)
    shared = ["The same LINE in many documents", "x" * 19, "x" * 20, "é" * 19, "é" * 20, "", " " * 30,
              "licence: all rights reserved.", " wide blank stays in the key"]
    texts = []
    for i in range(60):
        lines = [f"own line {rng.randrange(10**9)} of document {i}" for _ in range(rng.randint(0, 4))]
        for s in rng.sample(shared, rng.randint(0, 5)):
            s = s.upper() if rng.random() < 0.3 else s
            lines += [rng.choice(["", " ", "\t\r"]) + s + rng.choice(["", " \x0b"])] * rng.randint(1, 2)
        rng.shuffle(lines)
        texts.append((i, "\n".join(lines)))
    texts += [(3, texts[9][1]), (None, texts[8][1]), (None, "x" * 20), (70, texts[8][1] + "\n")]
    out = line_dedup.drop_repeated_lines(documents(spark, texts))
    assert found(out) == brute(texts)
    assert out.agg({"n_dropped": "sum"}).first()[0] > 50


def test_two_documents_are_too_few_and_rows_of_one_id_count_once(spark):
    line = "a line that is long enough"
    texts = [(1, line), (1, line), (1, f"{line}\nmore"), (2, line)]
    assert found(line_dedup.drop_repeated_lines(documents(spark, texts))) == brute(texts)
    texts.append((None, f"{line}\n{line}"))
    got = found(line_dedup.drop_repeated_lines(documents(spark, texts)))
    # The row without an id is the largest document: it alone keeps its lines.
    assert got == brute(texts) and sum(r[2] for r in got) == 4


def test_edge_rows(spark):
    texts = [*EDGES, (60, "long line of words " * 2000), (61, "long line of words " * 2000),
             (62, "LONG line of words " * 2000), (63, "\n" * 500)]
    out = line_dedup.drop_repeated_lines(documents(spark, texts))
    assert found(out) == brute(texts)
    assert line_dedup.drop_repeated_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_columns_of_the_input_stay(spark):
    line = "this line is in three documents"
    rows = [(k, f"{line}\n{k}", 1, 2, 3, 4, 5, "x") for k in ("b", "a", "c", "only")]
    names = "key string, text string, id int, text_key int, h1 int, _places int, _drop_id int, kept_text string"
    out = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, names), id_column="key")
    assert out.columns == ["key", "text", "id", "text_key", "h1", "_places", "_drop_id",
                           "n_lines", "n_dropped", "kept_text"]
    got = {r["key"]: r for r in out.collect()}
    assert got["a"]["kept_text"] == "a" and got["only"]["kept_text"] == f"{line}\nonly"
    assert tuple(got["a"])[2:7] == (1, 2, 3, 4, 5)


def test_thresholds(spark):
    texts = [(i, "short\nlonger than ten") for i in range(2)]
    out = line_dedup.drop_repeated_lines(documents(spark, texts), min_chars=10, min_docs=2)
    assert found(out) == brute(texts, 10, 2)


def test_query_against_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    expected = con.execute(registry.ORACLE["op11_line_dedup"]).fetchall()
    got = registry.op11(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(expected) == [
        (i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute(texts)
    ]
