"""Best-fit packing of token sequences with a fixed number of open bins.

Every partition of documents is tokenized and packed in one pass, without a shuffle: a
worker holds the open bins (a count for each amount of free space and a bitset of the
amounts that occur) and one buffer of pieces. A piece goes to the open bin it fills best;
if it fits none, a new bin opens, and beyond ``OPEN_BINS`` the fullest closes. Pieces
enter longest first within each buffer, which leaves less space unused than arrival order.

Null and empty texts are one end token. Repeated rows are packed as often as they occur.
A document of over ``CAPACITY`` tokens is cut into pieces of that length of which the
first may be shorter. An empty table gives no rows. Sequence numbers follow the
partitions of the input, so a task that runs again gives the same rows.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cohortal.llm.workers import per_task

CAPACITY = 2048
OPEN_BINS = 1024
BUFFER = 2000
END_ID = 0
WORDS_KEPT = 300_000
LATIN = re.compile("[\x00-\u024f]*")


class WordTokenizer:
    """Token ids of texts, by a byte-level BPE tokenizer with a memory of words.

    Its splitting rule always cuts before a single space between two visible characters.
    Parts between such spaces are therefore tokenized one by one, and a part seen before
    is looked up, as the bytes of its ids. Special tokens written in a text are ordinary text, or with ``added`` the
    tokens that the tokenizer's own call makes of them.

    With a file of the same vocabulary as ranks, texts in Latin script, and new parts of
    other texts that are, go to the faster reader of such files, which gives the same ids.
    It takes less time for a whole text than the look-ups do where many words are rare, and
    no memory.
    """

    def __init__(self, path: str, ranks_path: str | None = None, added: bool = False):
        self.tokenizer = _tokenizer(path, added)
        tokens = self.tokenizer.get_added_tokens_decoder().values() if added else ()
        self.added = [t.content for t in tokens]
        self.known: dict[str, bytes] = {}
        self.latin = _rank_encoding(ranks_path) if ranks_path else None

    def _encode(self, parts: list[str]) -> list[bytes]:
        if self.latin:
            quick = self.latin.encode_ordinary
            whole = self.tokenizer.encode
            return [
                _packed(
                    quick(p) if LATIN.fullmatch(p) else whole(p, add_special_tokens=False).ids
                )
                for p in parts
            ]
        found = self.tokenizer.encode_batch(parts, add_special_tokens=False)
        return [_packed(e.ids) for e in found]

    def ids(self, text: str) -> np.ndarray:
        if any(token in text for token in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        if self.latin and LATIN.fullmatch(text):
            return self._whole(text)
        parts = text.split(" ")
        first, rest = parts[0], parts[1:]
        if (not first and rest) or first[-1:].isspace():
            return self._whole(text)
        known = self.known
        new = [p for p in set(rest) if p not in known]
        if new:
            if not all(new) or any(p[0].isspace() or p[-1].isspace() for p in new):
                return self._whole(text)
            if len(known) > WORDS_KEPT:
                known.clear()
                new = list(set(rest))
            known.update(zip(new, self._encode([" " + p for p in new])))
        found = b"".join(chain(self._encode([first]), map(known.__getitem__, rest)))
        return np.frombuffer(found, dtype="<u4")

    def _whole(self, text: str) -> np.ndarray:
        return np.frombuffer(self._encode([text])[0], dtype="<u4")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _tokenizer(path: str, added: bool):
    """Read by each task, as is the one below: Spark keeps workers for later stages, whose
    memory a tokenizer (60 MB of both) must not take."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not added
    return tokenizer


def _rank_encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines]
    ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    pattern = public_tokenizers.PATTERN
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Packer:
    """Places lengths into bins; ``put`` returns the bin's number and the offset in it."""

    def __init__(self, capacity: int, open_bins: int, first: int):
        self.capacity, self.open_bins, self.next = capacity, open_bins, first
        self.by_free: dict[int, list[int]] = {}
        self.bits = 0
        self.n_open = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.n_open -= 1
        return found

    def put(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.next
            self.next += 1
            if self.n_open >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)
        left = free - length
        if left:
            bins = self.by_free.setdefault(left, [])
            if not bins:
                self.bits |= 1 << left
            bins.append(number)
            self.n_open += 1
        return number, self.capacity - free


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece; only the first may be shorter than the capacity."""
    first = length % capacity or capacity
    if length <= capacity:
        return [(0, length)]
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    ranks_path: str | None = None,
    *,
    id_column: str = "doc_id",
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    buffer: int = BUFFER,
) -> DataFrame:
    """Pieces of every document with their place in a sequence.

    Columns: the id, ``piece``, ``start``, ``length``, ``ids`` (little-endian unsigned
    32-bit token ids), ``sequence_id`` and ``offset``.
    """
    schema = T.StructType(
        [
            T.StructField(id_column, docs.schema[id_column].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer(tokenizer_path, ranks_path, added=True)
        packer = Packer(capacity, open_bins, TaskContext.get().partitionId() << 36)
        held: list[tuple[int, int, int, bytes, object]] = []

        def placed() -> pa.RecordBatch:
            held.sort(key=lambda x: -x[2])
            places = [packer.put(x[2]) for x in held]
            columns = [
                [x[4] for x in held],
                [x[0] for x in held],
                [x[1] for x in held],
                [x[2] for x in held],
                [x[3] for x in held],
                [p[0] for p in places],
                [p[1] for p in places],
            ]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, out_types)], names=names
            )

        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            out_types = [
                keys.type, pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(),
            ]
            for at in range(0, batch.num_rows, 256):
                part = zip(keys.slice(at, 256).to_pylist(), texts.slice(at, 256).to_pylist())
                for key, text in part:
                    ids = np.append(words.ids(text or ""), np.uint32(END_ID)).astype("<u4")
                    for i, (start, length) in enumerate(cut(len(ids), capacity)):
                        piece = ids[start : start + length].tobytes()
                        held.append((i, start, length, piece, key))
                        if len(held) >= buffer:
                            yield placed()
        if held:
            yield placed()

    names = schema.names
    return docs.select(id_column, "text").mapInArrow(per_task(pack_partition), schema)
