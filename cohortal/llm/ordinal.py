"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document's grade is 0, 1 or more; P(grade >= k) = sigmoid(score - threshold_k). All
levels share one weight per hashed token, and the thresholds are ordered. The grade of the
driver tables is quality + (1 - toxic): 2 for good and harmless text, 0 for neither.

Tokens are the distinct lower-cased words, the marks that end a word, and how often a word
repeats the one before. Only tokens whose presence shifts the mean grade clearly get a
weight, so long texts do not gather noise.

Training: at most ``MOST_LABELLED`` labelled documents, collected as hashed tokens. All
documents are scored. Null and empty texts have no tokens but the repetition one; they get
the score of a text of which nothing is known. Repeated rows are scored alike. Without
labels every document gets the highest grade and is kept; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortal.llm.sparse import Adam, Sparse, labelled_sample, sigmoid
from cohortal.llm.workers import per_task

MOST_LABELLED = 20_000
BUCKETS = 1 << 18
CLEAR = 4.0  # standard errors
STEPS = 400
PENALTY = 5e-5
KEEP_FROM = 0.5
WORDS_KEPT = 200_000

WORD = re.compile(r"[^\W\d_]+")
MARKS = re.compile(r"[^\w\s]+(?=\s|$)")


def tokens(text: str) -> set[str]:
    """The distinct tokens of a text."""
    words = text.lower().split()
    same = sum(map(str.__eq__, words, words[1:]))
    found = set(WORD.findall(text.lower()))
    found.update("mark " + m[:3] for m in set(MARKS.findall(text)))
    found.add(f"same {min(5, (10 * same) // max(1, len(words)))}")
    return found


def bucket(token: str) -> int:
    return crc32(token.encode("utf-8", "surrogatepass")) % BUCKETS


class Ordinal(NamedTuple):
    buckets: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray  # of grades 1, 2, ...

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for each k from 1, by row."""
        return sigmoid(np.asarray(score)[:, None] - self.thresholds[None, :])


def fit(rows: Sparse, grades: np.ndarray, levels: int) -> Ordinal:
    """Maximum likelihood with a ridge penalty on the weights."""
    grades = np.asarray(grades, dtype=np.int64)
    if not rows.n or levels < 2:
        return Ordinal(np.empty(0, np.int64), np.empty(0), np.full(max(0, levels - 1), -30.0))
    count = rows.transposed_dot(np.ones(rows.n), BUCKETS)
    centred = grades - grades.mean()
    spread = np.sqrt(np.maximum(count, 1)) * (grades.std() + 1e-9)
    keep = (np.abs(rows.transposed_dot(centred, BUCKETS)) / spread >= CLEAR) & (count >= 4)
    small = rows.only(keep)
    k = int(keep.sum())
    # Thresholds are the first one and the logarithms of the steps to the next.
    share = np.array([(grades >= j).mean() for j in range(1, levels)]).clip(1e-4, 1 - 1e-4)
    first = -np.log(share / (1 - share))
    params = np.concatenate([np.zeros(k), first[:1], np.log(np.maximum(np.diff(first), 0.1))])
    adam = Adam(len(params), 0.1)
    for _ in range(STEPS):
        steps = np.exp(params[k + 1 :])
        theta = params[k] + np.concatenate([[0.0], np.cumsum(steps)])
        score = small.dot(params[:k])
        # P(grade >= j): 1 for grade 0, sigmoid in between, 0 beyond the last.
        upper = np.concatenate([[np.inf], -theta, [-np.inf]])
        at = sigmoid(score + upper[grades])
        above = sigmoid(score + upper[grades + 1])
        p = np.maximum(at - above, 1e-12)
        d_at, d_above = at * (1 - at) / p, above * (1 - above) / p
        g = np.zeros(len(params))
        g[:k] = -small.transposed_dot(d_at - d_above, k) / rows.n + PENALTY * params[:k]
        g_theta = np.zeros(levels + 1)
        np.add.at(g_theta, grades, d_at)
        np.add.at(g_theta, grades + 1, -d_above)
        g_theta = g_theta[1:levels] / rows.n
        g[k] = g_theta.sum()
        g[k + 1 :] = np.cumsum(g_theta[::-1])[::-1][1:] * steps
        params -= adam.step(g)
    theta = params[k] + np.concatenate([[0.0], np.cumsum(np.exp(params[k + 1 :]))])
    return Ordinal(np.flatnonzero(keep), params[:k], theta)


def train(
    docs: DataFrame, ratings: DataFrame, *, grade: str = "grade", most: int = MOST_LABELLED
) -> Ordinal:
    """Fit on ``ratings`` (doc_id and an integer grade from 0)."""
    @F.pandas_udf("binary")
    def hashed(texts):
        return texts.map(
            lambda t: np.unique(
                np.fromiter(map(bucket, tokens(t or "")), dtype="<i4")
            ).tobytes()
        )

    sample = labelled_sample(docs, ratings, grade, most).select(
        "doc_id", F.col(grade).cast("int").alias("grade"), hashed("text").alias("buckets")
    )
    found = sorted(sample.collect(), key=lambda r: (r["doc_id"], r["buckets"]))
    grades = np.array([r["grade"] for r in found], dtype=np.int64)
    rows = Sparse([np.frombuffer(r["buckets"], dtype="<i4") for r in found])
    return fit(rows, grades, int(grades.max(initial=0)) + 1)


class _Weights(dict):
    """Weights of tokens; forgets them all when there are too many."""

    def __init__(self, model: Ordinal):
        self.by_bucket = dict(zip(model.buckets.tolist(), model.weights.tolist()))

    def __missing__(self, token: str) -> float:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[token] = found = self.by_bucket.get(bucket(token), 0.0)
        return found


def grade(docs: DataFrame, model: Ordinal, *, keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents with ``expected_grade``, ``tail_probability`` (of the highest grade)
    and ``kept``. Columns of ``docs`` that have these names are replaced."""
    names = ["expected_grade", "tail_probability"]
    docs = docs.drop(*names, "kept")
    schema = T.StructType(docs.schema.fields + [T.StructField(n, T.DoubleType()) for n in names])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _Weights(model)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            scores = [sum(map(weights.__getitem__, tokens(t.as_py() or ""))) for t in texts]
            tails = model.tails(np.array(scores, dtype=np.float64))
            top = tails[:, -1] if tails.shape[1] else np.ones(len(scores))
            columns = [*batch.columns, pa.array(tails.sum(axis=1)), pa.array(top)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    graded = docs.mapInArrow(per_task(score), schema)
    return graded.withColumn("kept", F.col("tail_probability") >= keep_from)


def driver_ratings(labels: DataFrame) -> DataFrame:
    """Grades from the labels: quality + (1 - toxic), null if either is null."""
    return labels.select("doc_id", (F.col("quality") + 1 - F.col("toxic")).alias("grade"))
