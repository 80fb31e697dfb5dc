"""Runs of repeated words: stretches that repeat with a period.

A run is a stretch of consecutive words with smallest period q whose length is at least
``max(MIN_WORDS, 2 * q)`` and that no neighbouring word extends with the same period.

All runs of a text are found on a harmonic grid: a run of period p holds two neighbouring
multiples of p, so each p asks about the pairs (k * p, (k + 1) * p) only, about n * ln(n)
pairs in all. How far the words behind and before the two places agree (the longest common
extensions) gives the run. Most pairs fall out as their first words differ.

Extensions use a difference cover: of each ``MODULUS`` neighbouring places those of a fixed
cover are sampled, and for any two places some small shift takes both to sampled ones.
Words are compared one by one up to there; beyond it, the answer is the smallest of the common
prefixes between the two suffixes' ranks. Only the sampled suffixes are sorted, by the names
of their ``MODULUS``-word blocks and doubling, and a sparse table answers the minima. Both are
built for a text when the first pair agrees that far, once forward and once backward.

Each text is searched on its own, in Arrow batches; nothing is shuffled. Null and empty
texts have no words. Repeated rows get the same result each. An empty table gives no rows.
Columns ``runs`` and ``collapsed`` of the input are replaced; all others stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MIN_WORDS = 12
# A perfect difference set: every shift modulo 21 is the difference of two of its members.
MODULUS = 21
COVER = (0, 1, 4, 14, 16)
# Places whose grid pairs are looked at together, and kept for all short texts.
GRID = 1 << 15
WORDS_KEPT = 300_000
SLICE = 128

_IN_COVER = np.isin(np.arange(MODULUS), COVER)
# At least so many words are compared before ranks are asked for: most pairs differ by then.
LEAST_SHIFT = 12


def _shift(a: int, b: int) -> int:
    """Smallest allowed shift that takes places of residues a and b into the cover."""
    shifts = range(LEAST_SHIFT, LEAST_SHIFT + MODULUS)
    return next(d for d in shifts if _IN_COVER[(a + d) % MODULUS] & _IN_COVER[(b + d) % MODULUS])


SHIFT = np.array([[_shift(a, b) for b in range(MODULUS)] for a in range(MODULUS)])


class Extensions:
    """Longest common extensions of the suffixes of a word sequence."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        # Ends differ from every word, and from each other at different places.
        ends = -1 - np.arange(2 * MODULUS + 2, dtype=np.int64)
        self.words = np.concatenate([words.astype(np.int64), ends])

    def _matching(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Number of equal words from each pair of places on, ``most`` at most."""
        length = np.zeros(len(a), dtype=np.int64)
        open_ = np.flatnonzero(most > 0)
        step = 0
        while len(open_):
            same = self.words[a[open_] + step] == self.words[b[open_] + step]
            open_ = open_[same]
            step += 1
            length[open_] = step
            open_ = open_[most[open_] > step]
        return length

    @cached_property
    def samples(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Rank of each sampled place (elsewhere -1), and the sparse table of the minima."""
        classes = [np.arange(r, self.n, MODULUS) for r in COVER if r < self.n]
        blocks = np.concatenate(classes)
        # Ends count as one smallest letter here: no two blocks end at the same offset.
        letters = np.maximum(self.words, -1) + 1
        rows = letters[blocks[:, None] + np.arange(MODULUS)].astype(">u4")
        rows = np.ascontiguousarray(rows).view(f"V{4 * MODULUS}")[:, 0]
        names = np.unique(rows, return_inverse=True)[1].reshape(-1) + 1
        # The names of each class in order, closed by a smallest one.
        text, place, at = [], [], 0
        for c in classes:
            text += [names[at : at + len(c)], np.zeros(1, dtype=names.dtype)]
            place += [c, np.full(1, -1)]
            at += len(c)
        rank, place = np.concatenate(text).astype(np.int64), np.concatenate(place)
        total, width, levels = len(rank), 1, [rank]
        longest = max(map(len, classes))
        while width < longest + 1:
            behind = np.concatenate([rank[width:], np.zeros(min(width, total), np.int64)])[:total]
            rank = np.unique(rank * (total + 1) + behind, return_inverse=True)[1].reshape(-1)
            width *= 2
            levels.append(rank)
        order = np.argsort(rank, kind="stable")
        order = order[place[order] >= 0]
        ranks = np.full(self.n + 1, -1, dtype=np.int64)
        ranks[place[order]] = np.arange(len(order))
        # Common prefix of neighbours: equal blocks by halving steps, then single words.
        a, b = order[:-1], order[1:]
        equal = np.zeros(len(a), dtype=np.int64)
        for k in range(len(levels) - 1, -1, -1):
            x, y = a + equal, b + equal
            inside = (x < total) & (y < total)
            same = inside & (levels[k][np.minimum(x, total - 1)] == levels[k][np.minimum(y, total - 1)])
            equal += same << k
        shared = equal * MODULUS
        rest = np.full(len(a), MODULUS, dtype=np.int64)
        shared = shared + self._matching(place[a] + shared, place[b] + shared, rest)
        table = [np.concatenate([[0], shared])]
        while 2 ** len(table) <= len(order):
            half = 2 ** (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        return ranks, table

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``a`` and ``b``, a < b."""
        shift = SHIFT[a % MODULUS, b % MODULUS]
        shift = np.minimum(shift, self.n - b)
        length = self._matching(a, b, shift)
        deep = np.flatnonzero((length == shift) & (b + shift < self.n))
        if len(deep):
            ranks, table = self.samples
            x, y = ranks[a[deep] + shift[deep]], ranks[b[deep] + shift[deep]]
            low, high = np.minimum(x, y) + 1, np.maximum(x, y)
            level = np.frexp(high - low + 1)[1] - 1
            found = np.empty(len(deep), dtype=np.int64)
            for k in np.unique(level).tolist():
                here = np.flatnonzero(level == k)
                found[here] = np.minimum(
                    table[k][low[here]], table[k][high[here] - (1 << k) + 1]
                )
            length[deep] += found
        return length


def _pairs_between(start: int, end: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All (place, period) with ``start`` <= place < ``end``, the place a multiple of the
    period, which is ``most`` at most; ordered by place."""
    period = np.arange(1, min(most, end - 1) + 1, dtype=np.int64)
    first = np.maximum(1, -(-start // period)) * period
    count = np.maximum(0, -(-(end - first) // period))
    p = np.repeat(period, count)
    step = np.arange(len(p)) - np.repeat(np.cumsum(count) - count, count)
    j = np.repeat(first, count) + step * p
    order = np.argsort(j, kind="stable")
    return j[order].astype(np.int32), p[order].astype(np.int32)


@lru_cache(maxsize=1)
def _first_pairs() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    j, p = _pairs_between(1, GRID, GRID)
    return j, p, np.searchsorted(j, np.arange(GRID + 1))


def grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (place, period) of the harmonic grid of n places, in pieces of bounded size.
    The pair's other place lies one period before."""
    j, p, ends = _first_pairs()
    end = ends[min(n, GRID)]
    yield j[:end], p[:end]
    for start in range(GRID, n, GRID):
        yield _pairs_between(start, min(n, start + GRID), n // 2)


def find_runs(words: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    """(start, length, period) of every run, by start, then period."""
    n = len(words)
    if n < min_words:
        return np.empty((0, 3), dtype=np.int64)
    forward, backward = Extensions(words), Extensions(words[::-1])
    parts = [np.empty((0, 3), dtype=np.int64)]
    # What is behind and before both places agrees for a whole period in a run.
    for places, periods in grid(n):
        same = np.flatnonzero(words[places] == words[places - periods])
        if not len(same):
            continue
        j, p = places[same].astype(np.int64), periods[same].astype(np.int64)
        i = j - p
        after = forward.between(i, j)
        before = backward.between(n - j, n - i)
        long = before + p + after >= np.maximum(min_words, 2 * p)
        if long.any():
            found = np.stack([(i - before)[long], (j + after)[long], p[long]], axis=1)
            parts.append(np.unique(found, axis=0))
    rows = np.concatenate(parts)
    if len(rows):
        # A stretch comes once more for each multiple of its smallest period.
        rows = np.unique(rows, axis=0)
        first = np.ones(len(rows), dtype=bool)
        first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        rows = rows[first]
        rows[:, 1] -= rows[:, 0]
        rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return rows


def kept_places(runs: np.ndarray, n: int) -> np.ndarray:
    """True for the words that no run contains behind its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


class WordNumbers(dict):
    """A number for each different word."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def numbered(words: list[bytes], known: WordNumbers) -> np.ndarray:
    if len(known) > WORDS_KEPT:
        known.clear()
    return np.fromiter(map(known.__getitem__, words), dtype=np.int32, count=len(words))


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
ADDED = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]


def with_runs(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    min_words: int = MIN_WORDS,
    prepare: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """The documents with their ``runs``, each (start, length, period) in words, and
    ``collapsed``: the words joined by a space, each run cut to its first period.

    ``prepare`` gets each document's id and words (UTF-8) and returns the words to search.
    """
    docs = docs.drop(*[f.name for f in ADDED])
    schema = T.StructType(docs.schema.fields + ADDED)
    at_text = docs.columns.index("text")
    at_id = docs.columns.index(id_column) if prepare else at_text
    runs_type = pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN.fields]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordNumbers()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found, texts = [], []
                for key, text in zip(part.column(at_id), part.column(at_text)):
                    words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                    if prepare is not None:
                        words = prepare(key.as_py(), words)
                    runs = find_runs(numbered(words, known), min_words)
                    if len(runs):
                        kept = kept_places(runs, len(words))
                        words = [w for w, k in zip(words, kept.tolist()) if k]
                    found.append([dict(zip(RUN.names, r)) for r in runs.tolist()])
                    texts.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                new = [pa.array(found, runs_type), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=schema.names)

    return docs.mapInArrow(search, schema)
