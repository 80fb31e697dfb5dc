"""Quality rules: hashed n-gram logistic regression beside counting rules.

The rules count words, symbols, repeated lines and repeated word windows of whole texts.
The model averages one weight per hashed word, word pair and n-gram of 1 to 3 characters
(code points) over a text; a repeated word counts as the pair "same". It is trained on labelled rows, at most
``MOST_LABELLED`` of them, four fifths for the weights and one fifth to calibrate the
margin to a probability (Platt). A document is kept if no rule fails it and the
probability reaches ``KEEP_FROM``.

Null counts as empty: no words, so the word-count rule fails it. Repeated rows are judged
alike. Without labels, or with one class only, the probability is 1. An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cohortal.llm.shingles import WordHashes, mixed
from cohortal.llm.sparse import Adam, Sparse, labelled_sample, sigmoid

MOST_LABELLED = 4_000
BITS = 16
BUCKETS = 1 << BITS
KINDS = 5  # words, word pairs, character n-grams of 1, 2 and 3
STEPS = 150
PENALTY = 1e-4
SCALE = 20.0
KEEP_FROM = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
PIECE = 1 << 20  # characters

_SEEDS = np.random.default_rng(6).integers(0, 2**63, size=KINDS, dtype=np.uint64) | np.uint64(1)
_SAME = np.uint64(0x5EED)


def _bucket(x: np.ndarray, kind: int) -> np.ndarray:
    """Bucket of each value, by multiplicative hashing with a seed for each kind."""
    return ((x * _SEEDS[kind]) >> np.uint64(64 - BITS)).astype(np.int64)


def _word_buckets(hashes: np.ndarray) -> Iterator[np.ndarray]:
    yield _bucket(hashes, 0)
    if len(hashes) > 1:
        same = hashes[1:] == hashes[:-1]
        pairs = hashes[:-1] * _SEEDS[0] + hashes[1:]
        yield _bucket(np.where(same, _SAME, mixed(pairs)), 1)


def _character_buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of the character n-grams, piece by piece so that long texts need little
    memory. A code point has 21 bits, so three of them fit one number."""
    for at in range(0, len(text), PIECE):
        points = text[at : at + PIECE + 2].encode("utf-32-le", "surrogatepass")
        x = np.frombuffer(points, dtype="<u4").astype(np.uint64)
        end = min(PIECE, len(text) - at)
        code = x
        for n in (1, 2, 3):
            if n > 1:
                code = (code[:-1] << np.uint64(21)) + x[n - 1 :]
            if len(code):
                yield _bucket(code[:end] + np.uint64(1), n + 1)


def features(text: str, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and the share of the text's n-grams that falls into each."""
    found = [*_word_buckets(hashes), *_character_buckets(text)]
    if not found:
        return np.empty(0, np.int64), np.empty(0)
    counts = np.bincount(np.concatenate(found), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, SCALE * counts[at] / counts.sum()


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, text: str, hashes: np.ndarray) -> float:
        total, n = 0.0, 0
        for at in chain(_word_buckets(hashes), _character_buckets(text)):
            total += float(self.weights[at].sum(dtype=np.float64))
            n += len(at)
        margin = self.bias + SCALE * total / max(1, n)
        return float(sigmoid(self.slope * margin + self.offset))


def _logistic(rows: Sparse, y: np.ndarray) -> tuple[np.ndarray, float]:
    adam = Adam(BUCKETS + 1, 0.3)
    params = np.zeros(BUCKETS + 1)
    for _ in range(STEPS):
        error = sigmoid(rows.dot(params[:-1]) + params[-1]) - y
        slope = rows.transposed_dot(error, BUCKETS) / rows.n + PENALTY * params[:-1]
        params -= adam.step(np.append(slope, error.mean()))
    return params[:-1], float(params[-1])


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the calibration, with smoothed targets."""
    n_pos, n_neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    adam, params = Adam(2, 0.05), np.array([1.0, 0.0])
    for _ in range(400):
        error = sigmoid(params[0] * margin + params[1]) - t
        params -= adam.step(np.array([(error * margin).mean(), error.mean()]))
    return float(max(params[0], 1e-3)), float(params[1])


def fit(found: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    y = np.asarray(labels, dtype=np.float64)
    aside = np.arange(len(y)) % 5 == 4
    parts = [np.flatnonzero(~aside), np.flatnonzero(aside)]
    if any(len(set(y[p])) < 2 for p in parts):
        return Model(np.zeros(BUCKETS, np.float32), 0.0, 1.0, 30.0)
    rows = [Sparse([found[i][0] for i in p], [found[i][1] for i in p]) for p in parts]
    weights, bias = _logistic(rows[0], y[parts[0]])
    slope, offset = _platt(rows[1].dot(weights) + bias, y[parts[1]])
    return Model(weights.astype(np.float32), bias, slope, offset)


def train(
    docs: DataFrame, labels: DataFrame, *, target: str = "quality", most: int = MOST_LABELLED
) -> Model:
    sample = labelled_sample(docs, labels, target, most)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            out = []
            for value in batch.column("text"):
                text = value.as_py() or ""
                words = text.encode("utf-8", "surrogatepass").split()
                at, value = features(text, _hashes(words, known))
                out.append((at.astype("<i4").tobytes(), value.astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column(target).cast(pa.int32()),
                    pa.array([o[0] for o in out], pa.binary()),
                    pa.array([o[1] for o in out], pa.binary()),
                ],
                names=["doc_id", "y", "at", "value"],
            )

    schema = T.StructType(
        [
            sample.schema["doc_id"],
            T.StructField("y", T.IntegerType()),
            T.StructField("at", T.BinaryType()),
            T.StructField("value", T.BinaryType()),
        ]
    )
    rows = sample.mapInArrow(hashed, schema).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["at"]))
    found = [(np.frombuffer(r["at"], "<i4"), np.frombuffer(r["value"], "<f4")) for r in rows]
    return fit(found, np.array([r["y"] for r in rows], dtype=np.float64))


def _hashes(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def repeated_words(hashes: np.ndarray, window: int = 3) -> int:
    """Words that lie in a window of words found twice or more in the text."""
    m = len(hashes) - window + 1
    if m < 2:
        return 0
    codes = hashes[:m].copy()
    for k in range(1, window):
        codes = mixed(codes) + hashes[k : k + m]
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    equal = ordered[1:] == ordered[:-1]
    twice = np.zeros(m, dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    covered = np.zeros(len(hashes), dtype=bool)
    for k in range(window):
        covered[k : k + m] |= twice
    return int(covered.sum())


def counts(text: str, raw: bytes, words: list[bytes], hashes: np.ndarray) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    lines = [line for line in raw.split(b"\n") if line.strip()]
    blanks = len(raw) - sum(map(len, words))
    return (
        len(words),
        len(text) - blanks,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(hashes),
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(docs: DataFrame, model: Model, *, keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents with the counts, ``base_failed``, ``probability`` and ``kept``.

    Columns of ``docs`` that have these names are replaced.
    """
    docs = docs.drop(*COUNTS, "base_failed", "probability", "kept")
    added = [T.StructField(c, T.LongType()) for c in COUNTS]
    added.append(T.StructField("base_failed", T.BooleanType()))
    added.append(T.StructField("probability", T.DoubleType()))
    added.append(T.StructField("kept", T.BooleanType()))
    schema = T.StructType(docs.schema.fields + added)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            rows, odds = [], []
            for value in batch.column(batch.schema.get_field_index("text")):
                text = value.as_py() or ""
                raw = text.encode("utf-8", "surrogatepass")
                words = raw.split()
                hashes = _hashes(words, known)
                rows.append(counts(text, raw, words, hashes))
                odds.append(model.probability(text, hashes))
            table = np.array(rows, dtype=np.int64).reshape(-1, len(COUNTS))
            failed = (table[:, 0] < MIN_WORDS) | (
                100 * table[:, 4] > MAX_REPEAT_PERCENT * table[:, 0]
            )
            probability = np.array(odds, dtype=np.float64)
            new = [pa.array(table[:, i]) for i in range(len(COUNTS))]
            new += [pa.array(failed), pa.array(probability)]
            new.append(pa.array(~failed & (probability >= keep_from)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=schema.names)

    return docs.mapInArrow(score, schema)
