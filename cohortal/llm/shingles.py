"""Word shingles of a text as sorted 64-bit hashes, and their HyperMinHash sketch."""

from __future__ import annotations

import hashlib

import numpy as np
from xxhash import xxh3_64_intdigest

WIDTH = 5
BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
MANTISSA_BITS = 10
WORDS_KEPT = 200_000

_rng = np.random.default_rng(20)
_ODD = _rng.integers(0, 2**63, size=WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# The first 64-bit hash of each bucket; buckets divide the hash range evenly.
BOUNDS = np.array([-(-(j << 64) // REGISTERS) for j in range(REGISTERS)], dtype=np.uint64)
# For each bucket the order in which an empty one asks the others.
_ASK = np.stack([_rng.permutation(REGISTERS) for _ in range(REGISTERS)])


class WordHashes(dict):
    """64-bit hashes of words; forgets them all when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = found = xxh3_64_intdigest(word)
        return found


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Runs of characters other than space, tab, line feed, \\v, \\f and \\r; A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of all 5-word windows; a shorter text is one shingle."""
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=n)
    if n < WIDTH:
        return mixed((h * _ODD[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    m = n - WIDTH + 1
    total = h[:m] * _ODD[0]
    for k in range(1, WIDTH):
        total += h[k : k + m] * _ODD[k]
    return np.unique(mixed(total))


def fingerprint(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketch(shingles: np.ndarray) -> np.ndarray:
    """One 16-bit register per bucket: leading zeros and mantissa of its smallest hash.

    Shingles fall into buckets by their leading bits. Empty buckets take the register of
    the first bucket that has one, in an order of their own (densification), so that two
    sets agree in each register with a probability close to their similarity, however
    small they are. ``shingles`` must be sorted and not empty.
    """
    at = np.searchsorted(shingles, BOUNDS)
    ends = np.append(at[1:], len(shingles))
    filled = at < ends
    lowest = shingles[np.minimum(at, len(shingles) - 1)]
    value = (lowest - BOUNDS) * np.uint64(REGISTERS)
    fraction, exponent = np.frexp(value.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 63).astype(np.uint16)
    mantissa = np.clip((fraction * 2 - 1) * 2**MANTISSA_BITS, 0, 2**MANTISSA_BITS - 1)
    registers = zeros << np.uint16(MANTISSA_BITS) | mantissa.astype(np.uint16)
    if not filled.all():
        donors = _ASK[np.arange(REGISTERS), filled[_ASK].argmax(axis=1)]
        registers = np.where(filled, registers, registers[donors])
    return registers


def collision_rate(n_a: int, n_b: int) -> float:
    """Chance that registers of disjoint sets of these sizes are equal."""
    edges = 0.5 ** np.arange(0, 41)
    loads = np.maximum(np.array([[n_a], [n_b]]) / REGISTERS, 1.0)
    below = 1 - (1 - edges) ** loads  # chance that the smallest hash is under each edge
    share = below[:, :-1] - below[:, 1:]
    return float((share[0] * share[1]).sum() / 2**MANTISSA_BITS)


def estimate(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> float:
    """Jaccard similarity from two sketches, corrected for registers that agree by chance."""
    same = float((a == b).mean())
    chance = collision_rate(n_a, n_b)
    return max(0.0, (same - chance) / (1 - chance))


def similarity(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and of the union of two sets."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common, len(a) + len(b) - common
