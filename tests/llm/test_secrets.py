from __future__ import annotations

import hashlib
import random
import re

import pytest
from texts import EDGES, SCHEMA, SF, documents, table

from cohortal.llm import registry, secrets

KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
EITHER = "|".join(re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", k) for k in KEYWORDS)
ASSIGN = re.compile(rf"""({EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    found.sort()
    joined = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in found)
    return [*[sum(s[1] == k for s in found) for k in range(3)],
            hashlib.sha256(joined.encode()).hexdigest(), joined]


def digest(r):
    spans = ",".join(s for s in r["spans"].split(",") if not s.startswith("random"))
    return [r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"], spans]


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    rows = registry.QUERIES["op4_markov_secrets"](spark, SF).collect()
    assert {r["doc_id"]: digest(r) for r in rows} == {i: base(t) for i, t in texts.items()}


TRICKY = [
    "password=token: abcdefgh", "PassWord : 'abc12' secret=\"abcdef\"", "ſecret=abcdefgh",
    "api_key=abcdefg apikey:abcdefg api__key=abcdefg", "token===abcde token=  ab",
    "AKIAAKIA" + "A" * 12, "AKIA" + "A" * 15 + " AKIA" + "B" * 16, "x" + "0123456789abcdef" * 3,
    "\U0001f600\U0001f600 token=abcdef \U0001f600 " + "ab12" * 6, "secret=\nabcdefgh",
    "token=" + "a1" * 30, "tokentoken=abcdef.tokenabc=abcdef", "password = 'a' password = 'abcdef'",
]


def test_edge_rows(spark):
    rng = random.Random(3)
    parts = ["token", "=", " ", '"', "abcdef", "AKIA", "0123abcd" * 4, ":", "secret", "\n", "é", "Z9"]
    texts = [(i, t) for i, t in EDGES if i not in (8, None)]
    texts += [(100 + n, t) for n, t in enumerate(TRICKY)]
    texts += [(1000 + n, "".join(rng.choices(parts, k=14))) for n in range(200)]
    texts.append((5000, ("word token=abcdef1 " + "0a" * 20 + "\n") * 400))
    docs = documents(spark, texts)
    model = secrets.train(secrets.labelled_strings(docs))
    rows = secrets.scan(docs, model).collect()
    assert len(rows) == len(texts) and "extra" in rows[0]
    assert {r["doc_id"]: digest(r) for r in rows} == {i: base(t) for i, t in texts}
    again = documents(spark, [e for e in EDGES if e[0] in (8, None)])
    assert sorted(r["doc_id"] or 0 for r in secrets.scan(again, model).collect()) == [0, 8, 8]
    empty = spark.createDataFrame([], SCHEMA)
    assert secrets.scan(empty, secrets.train(secrets.labelled_strings(empty))).count() == 0


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return secrets.train(secrets.labelled_strings(docs))


def test_random_strings_stand_out(spark, model):
    rng = random.Random(8)
    chars = secrets.ALPHABET[:62]
    keys = ["".join(rng.choices(chars, k=32)) for _ in range(60)]
    plain = ["thereinthingerationed", "nouvellement-dicho", "Einlichlichberverung", "some_function_name"]
    docs = documents(spark, [(n, f"see {k} here") for n, k in enumerate(keys)])
    rows = secrets.scan(docs, model).collect()
    assert all(r["spans"] == "random:4:36" for r in rows if r["n_hex"] == 0)
    docs = documents(spark, [(n, f"see {p} here") for n, p in enumerate(plain)])
    assert {r["spans"] for r in secrets.scan(docs, model).collect()} == {""}


def test_random_spans_do_not_overlap_others(spark, model):
    docs = documents(spark, [(1, "token=Zq9XkLm2RtYv8WpAbC7dEfGh4 Zq9XkLm2RtYv8WpAbC7dEfGh4")])
    row = secrets.scan(docs, model).first()
    assert row["spans"] == "assign:0:31,random:32:57" and row["n_random"] == 1
