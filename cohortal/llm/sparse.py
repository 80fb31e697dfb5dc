"""Sparse hashed features for models that are fitted on a bounded sample of rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortal.llm.columns import hashed_sample


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, most: int) -> DataFrame:
    """doc_id, text and ``target`` of at most ``most`` labelled documents.

    The ids with the lowest hashes are taken, so the choice depends on the rows alone. The
    sample's ids are at most ``most`` rows of two numbers and are broadcast.
    """
    rows = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull())
    chosen = hashed_sample(rows.groupBy("doc_id").agg(F.max(target).alias(target)), "doc_id", most)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


class Sparse:
    """Rows of (feature, value), stored end to end."""

    def __init__(self, features: list[np.ndarray], values: list[np.ndarray] | None = None):
        sizes = np.array([len(f) for f in features], dtype=np.int64)
        empty = np.empty(0, np.int64)
        self.n = len(features)
        self.feature = np.concatenate([empty, *features]).astype(np.int64)
        self.row = np.repeat(np.arange(self.n), sizes)
        if values is None:
            self.value = np.ones(len(self.feature))
        else:
            self.value = np.concatenate([np.empty(0), *values])

    def only(self, keep: np.ndarray) -> Sparse:
        """The features marked in ``keep``, renumbered in order."""
        number = np.cumsum(keep) - 1
        here = keep[self.feature]
        out = object.__new__(Sparse)
        out.n, out.row, out.value = self.n, self.row[here], self.value[here]
        out.feature = number[self.feature[here]]
        return out

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.feature], minlength=self.n)

    def transposed_dot(self, x: np.ndarray, n_features: int) -> np.ndarray:
        return np.bincount(self.feature, self.value * x[self.row], minlength=n_features)


class Adam:
    def __init__(self, n: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(n), np.zeros(n), 0, rate

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.01 * (gradient**2 - self.v)
        scale = np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8
        return self.rate * self.m / (1 - 0.9**self.t) / scale


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, dtype=np.float64)))
