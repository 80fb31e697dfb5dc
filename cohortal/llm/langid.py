"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are read in stretches of ``STRETCH`` bytes, forwards and backwards.
At each byte the two states give a probability for each language, so every position has a
label; a document's probabilities are the means over all of its positions. The network is
trained in numpy by backpropagation through time, on stretches spread over whole texts of
at most ``MOST_ROWS`` different (text, language) pairs, so copies count once. Each language
has an equal quota of them, and what small ones leave goes to the others; all languages are
in the sample, with one pair each if there are more of them than ``MOST_ROWS``. Only text
and language are used, only of documents with both, and never of those that are held out.

Null texts and texts without a letter are ``und`` with score 0 and no labelled position, as
is every text if there is nothing to learn from. Repeated rows are labelled alike, ties go
to the first language by name, and an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRETCH = 64
HIDDEN = 8
MOST_ROWS = 4_000
STRETCHES_PER_ROW = 6
STEPS = 300
BATCH = 192
RATE = 0.02
BLOCK = 2048
BYTES_AT_ONCE = 1 << 22
UNKNOWN = "und"
HASHES = 2**30

WORD_CHARACTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether any character is a letter. Fractions, Roman numerals and the like, which
    count as word characters, are none."""
    return any(found.group().isalpha() for found in WORD_CHARACTER.finditer(text))


class Network(NamedTuple):
    langs: tuple[str, ...]
    inputs: np.ndarray  # (2, 3 * hidden, 256): update, reset and candidate, for each byte
    recurrent: np.ndarray  # (2, 3 * hidden, hidden)
    bias: np.ndarray  # (2, hidden, 1): of the candidate's recurrent part
    output: np.ndarray  # (2, languages, hidden)
    output_bias: np.ndarray  # (languages, 1)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _softmax(x: np.ndarray, axis: int) -> np.ndarray:
    e = np.exp(x - x.max(axis=axis, keepdims=True))
    return e / e.sum(axis=axis, keepdims=True)


def forward(net: Network, data: np.ndarray) -> tuple[np.ndarray, list]:
    """Log-odds (time, languages, rows) of stretches (time, rows) and what backward needs."""
    steps, rows = data.shape
    hidden = net.recurrent.shape[2]
    state = np.zeros((2, hidden, rows), dtype=np.float32)
    states = np.empty((2, steps, hidden, rows), dtype=np.float32)
    kept = []
    for t in range(steps):
        x = np.stack([net.inputs[0][:, data[t]], net.inputs[1][:, data[steps - 1 - t]]])
        g = net.recurrent @ state
        gates = _logistic(x[:, : 2 * hidden] + g[:, : 2 * hidden])
        z, r = gates[:, :hidden], gates[:, hidden:]
        inner = g[:, 2 * hidden :] + net.bias
        n = np.tanh(x[:, 2 * hidden :] + r * inner)
        kept.append((state, z, r, inner, n))
        state = n + z * (state - n)
        states[0, t], states[1, steps - 1 - t] = state
    odds = net.output[0] @ states[0] + net.output[1] @ states[1] + net.output_bias
    return odds, [states, kept]


def gradients(net: Network, data: np.ndarray, labels: np.ndarray) -> tuple[float, list]:
    """Mean loss over all positions, and its gradient for each array of the network."""
    steps, rows = data.shape
    hidden = net.recurrent.shape[2]
    odds, (states, kept) = forward(net, data)
    p = _softmax(odds, axis=1)
    loss = -np.log(p[:, labels, np.arange(rows)] + 1e-12).mean()
    d_odds = p
    d_odds[:, labels, np.arange(rows)] -= 1
    d_odds /= steps * rows
    d_output = np.stack([np.einsum("tcb,thb->ch", d_odds, s) for s in states])
    d_output_bias = d_odds.sum(axis=(0, 2))[:, None]
    from_output = [np.swapaxes(w, 0, 1) @ d_odds for w in net.output]
    d_inputs = np.zeros((2, 256, 3 * hidden), dtype=np.float32)
    d_recurrent, d_bias = np.zeros_like(net.recurrent), np.zeros_like(net.bias)
    d_state = np.zeros((2, hidden, rows), dtype=np.float32)
    for t in range(steps - 1, -1, -1):
        before, z, r, inner, n = kept[t]
        d_state = d_state + np.stack([from_output[0][t], from_output[1][steps - 1 - t]])
        d_n = d_state * (1 - z) * (1 - n * n)
        d_z = d_state * (before - n) * z * (1 - z)
        d_r = d_n * inner * r * (1 - r)
        d_inner = d_n * r
        d_g = np.concatenate([d_z, d_r, d_inner], axis=1)
        d_x = np.concatenate([d_z, d_r, d_n], axis=1)
        d_recurrent += d_g @ np.swapaxes(before, 1, 2)
        d_bias += d_inner.sum(axis=2, keepdims=True)
        for way, column in enumerate((data[t], data[steps - 1 - t])):
            np.add.at(d_inputs[way], column, d_x[way].T)
        d_state = d_state * z + np.swapaxes(net.recurrent, 1, 2) @ d_g
    d_inputs = np.swapaxes(d_inputs, 1, 2)
    return float(loss), [d_inputs, d_recurrent, d_bias, d_output, d_output_bias]


def as_stretches(raw: bytes) -> bytes:
    """The bytes, filled up with spaces to whole stretches."""
    return raw + b" " * (-len(raw) % STRETCH)


def fit(samples: list[tuple[str, str]], seed: int = 2) -> Network:
    """A network from (text stretch, language) pairs."""
    langs = tuple(sorted({lang for _, lang in samples}))
    rng = np.random.default_rng(seed)
    k = len(langs)

    def noise(*shape):
        return rng.normal(0, 0.3, shape).astype(np.float32)

    arrays = [
        noise(2, 3 * HIDDEN, 256),
        noise(2, 3 * HIDDEN, HIDDEN),
        np.zeros((2, HIDDEN, 1), np.float32),
        noise(2, k, HIDDEN),
        np.zeros((k, 1), np.float32),
    ]
    if k < 2:
        return Network(langs, *arrays)
    number = {lang: i for i, lang in enumerate(langs)}
    rows = [as_stretches(t.encode("utf-8", "replace")[:STRETCH]) for t, _ in samples if t]
    data = np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(-1, STRETCH)
    labels = np.array([number[lang] for t, lang in samples if t])
    m, v = [np.zeros_like(a) for a in arrays], [np.zeros_like(a) for a in arrays]
    for step in range(1, STEPS + 1):
        pick = rng.integers(0, len(data), BATCH)
        net = Network(langs, *arrays)
        _, grads = gradients(net, np.ascontiguousarray(data[pick].T), labels[pick])
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for i, g in enumerate(grads):
            g = np.clip(g, -1, 1)
            m[i] += 0.1 * (g - m[i])
            v[i] += 0.01 * (g * g - v[i])
            change = m[i] / (1 - 0.9**step) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)
            arrays[i] = (arrays[i] - rate * change).astype(np.float32)
    return Network(langs, *arrays)


class Reader:
    """Fast probabilities: gates pre-scaled for one tanh, buffers used again."""

    def __init__(self, net: Network):
        h = net.recurrent.shape[2]
        half = np.ones((3 * h, 1), dtype=np.float32)
        half[: 2 * h] = 0.5
        self.net, self.h = net, h
        self.inputs = [np.ascontiguousarray(x * half) for x in net.inputs]
        self.recurrent = np.ascontiguousarray(net.recurrent * half)

    def probabilities(self, data: np.ndarray) -> np.ndarray:
        """(time, languages, rows) for stretches (time, rows)."""
        net, h = self.net, self.h
        steps, rows = data.shape
        state = np.zeros((2, h, rows), dtype=np.float32)
        states = np.empty((2, steps, h, rows), dtype=np.float32)
        x = np.empty((2, 3 * h, rows), dtype=np.float32)
        g = np.empty_like(x)
        for t in range(steps):
            np.take(self.inputs[0], data[t], axis=1, out=x[0], mode="clip")
            np.take(self.inputs[1], data[steps - 1 - t], axis=1, out=x[1], mode="clip")
            np.matmul(self.recurrent, state, out=g)
            gates = x[:, : 2 * h]
            gates += g[:, : 2 * h]
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            n, inner = x[:, 2 * h :], g[:, 2 * h :]
            inner += net.bias
            inner *= gates[:, h:]
            n += inner
            np.tanh(n, out=n)
            state -= n
            state *= gates[:, :h]
            state += n
            states[0, t], states[1, steps - 1 - t] = state
        odds = net.output[0] @ states[0]
        odds += net.output[1] @ states[1]
        odds += net.output_bias
        np.exp(odds, out=odds)
        odds /= odds.sum(axis=1, keepdims=True)
        return odds

    def documents(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Summed probabilities and labelled positions, (documents, languages) each."""
        k = len(self.net.langs)
        sums, places = np.zeros((len(texts), k)), np.zeros((len(texts), k), dtype=np.int64)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        counts = -(-sizes // STRETCH)
        whole = np.frombuffer(b"".join(map(as_stretches, texts)), dtype=np.uint8)
        whole = whole.reshape(-1, STRETCH)
        owner = np.repeat(np.arange(len(texts)), counts)
        number = np.arange(len(whole)) - np.repeat(np.cumsum(counts) - counts, counts)
        valid = np.minimum(sizes[owner] - number * STRETCH, STRETCH)
        time = np.arange(STRETCH)[:, None]
        for at in range(0, len(whole), BLOCK):
            part = slice(at, at + BLOCK)
            p = self.probabilities(np.ascontiguousarray(whole[part].T))
            real = time < valid[part][None, :]
            best = p.argmax(axis=1)
            p *= real[:, None, :]
            total = p.sum(axis=0, dtype=np.float64)
            for lang in range(k):
                hits = ((best == lang) & real).sum(axis=0)
                np.add.at(sums[:, lang], owner[part], total[lang])
                np.add.at(places[:, lang], owner[part], hits)
        return sums, places

    def positions(self, text: str) -> list[str]:
        """The language of every byte of a text."""
        raw = text.encode("utf-8", "surrogatepass")
        if not raw or not self.net.langs:
            return [UNKNOWN] * len(raw)
        data = np.frombuffer(as_stretches(raw), dtype=np.uint8).reshape(-1, STRETCH).T
        best = self.probabilities(np.ascontiguousarray(data)).argmax(axis=1).T.reshape(-1)
        return [self.net.langs[i] for i in best[: len(raw)]]


def quota(pairs: list[int], most: int) -> int:
    """The most pairs that each language can give for all to give ``most`` at most; 1 at
    least."""
    left, open_ = most, sorted(pairs)
    while open_ and open_[0] * len(open_) <= left:
        left -= open_.pop(0)
    return max(1, left // len(open_)) if open_ else max(pairs, default=1)


def training_pairs(docs: DataFrame, learn: Column, most: int) -> list[Row]:
    """``lang`` and ``parts`` (stretches) of different pairs of a text and its language.

    Each language gives those of its pairs that have the lowest hashes, as far as its quota.
    A first cut by the estimated number of different pairs leaves few more than are wanted;
    only these are gathered. Copies fall together before they are moved.
    """
    space = F.greatest(F.lit(0), F.length("text") - STRETCH)
    starts = F.sequence(F.lit(0), F.lit(STRETCHES_PER_ROW - 1))
    last = STRETCHES_PER_ROW - 1
    picked = F.transform(
        starts,
        lambda i: F.substring(
            F.col("text"), (i * space / last).cast("int") + 1, F.lit(STRETCH)
        ),
    )
    drawn = F.xxhash64("text", "lang")
    pairs = docs.where(learn & F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        "lang", "text", drawn.alias("drawn"), F.pmod(drawn, F.lit(HASHES)).alias("low")
    )
    counts = (
        pairs.groupBy("lang")
        .agg(F.approx_count_distinct("drawn").alias("pairs"), F.min("low").alias("low"))
        .collect()
    )
    wanted = quota([r["pairs"] for r in counts], most)
    # Enough of them for chance and for an estimate that is a fifth too high.
    drawn_from = 1.2 * (wanted + 4 * wanted**0.5 + 8)
    cuts = docs.sparkSession.createDataFrame(
        [
            (r["lang"], max(r["low"], int(min(1.0, drawn_from / r["pairs"]) * HASHES)))
            for r in counts
        ],
        "_lang string, cut bigint",
    )
    found = (
        pairs.join(F.broadcast(cuts), F.col("lang") == F.col("_lang"))
        .where("low <= cut")
        .select("lang", "low", "drawn", picked.alias("parts"))
        .distinct()
        .collect()
    )
    by_lang: dict[str, list[Row]] = {}
    for row in sorted(found):
        by_lang.setdefault(row["lang"], []).append(row)
    level = quota([len(of_lang) for of_lang in by_lang.values()], most)
    return [row for of_lang in by_lang.values() for row in of_lang[:level]]


def train(docs: DataFrame, learn: Column, *, most: int = MOST_ROWS) -> Network:
    """Fit on different texts of the rows for which ``learn`` holds."""
    rows = training_pairs(docs, learn, most)
    return fit([(part, r["lang"]) for r in rows for part in r["parts"]])


def identify(docs: DataFrame, net: Network) -> DataFrame:
    """The documents with ``lang_pred``, ``score`` and ``positions``, the number of bytes
    labelled with each language. Columns of ``docs`` that have these names are replaced."""
    docs = docs.drop("lang_pred", "score", "positions")
    schema = T.StructType(
        docs.schema.fields
        + [
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("positions", T.MapType(T.StringType(), T.LongType())),
        ]
    )
    positions = pa.map_(pa.string(), pa.int64())

    def groups(texts: pa.Array) -> Iterator[list[str]]:
        group, size = [], 0
        for value in texts:
            group.append(value.as_py() or "")
            size += len(group[-1])
            if size >= BYTES_AT_ONCE:
                yield group
                group, size = [], 0
        if group:
            yield group

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(net)
        for batch in batches:
            langs, scores, maps = [], [], []
            for group in groups(batch.column(batch.schema.get_field_index("text"))):
                lettered = [bool(net.langs) and has_letter(t) for t in group]
                raw = [
                    t.encode("utf-8", "surrogatepass") if ok else b""
                    for t, ok in zip(group, lettered)
                ]
                sums, places = reader.documents(raw) if any(lettered) else (None, None)
                for i, ok in enumerate(lettered):
                    if not ok:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        maps.append([])
                        continue
                    best = int(sums[i].argmax())
                    langs.append(net.langs[best])
                    scores.append(float(min(1.0, sums[i][best] / len(raw[i]))))
                    found = zip(net.langs, places[i].tolist())
                    maps.append([(lang, n) for lang, n in found if n])
            new = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            new.append(pa.array(maps, positions))
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=schema.names)

    return docs.mapInArrow(label, schema)


def held_out() -> Column:
    """crc32 of doc_id as text, modulo 4, is 2; false for a null doc_id."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))
