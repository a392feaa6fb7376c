"""Packing documents into sequences along a space-filling curve.

Every document becomes token ids (its tokens and an end id) and a short vector: the sum of a hashed random
direction per token, scaled to length one, so that its length in words does not count. The vector's coordinates, on a fixed grid,
give a Hilbert key, so documents with similar words get close keys. The keyed documents are written once. The bytes of ids in each
stretch of the curve then cut it into ranges of like size, one a task, and each task pours its documents, sorted along the curve,
into sequences. A document is cut where a sequence is full, so only the last sequence of a task has padding. A stretch with more
bytes than a task takes is split by a hash, so copies of one document do not meet in one task.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacewise.llm.common import by_batch, give_back, hashes, kept, mix, slices, written

#: Ids of a sequence.
LENGTH = 4096
#: Dimensions of the vectors, and bits of the curve for each.
DIMENSIONS, CURVE_BITS = 4, 8
#: Stretches of the curve whose bytes are counted.
STRETCH_BITS = 16
#: Most words that a worker keeps, and the bytes of the longest.
CACHE_WORDS, KEPT_BYTES = 3_000_000, 64
#: Anything but white space and the characters that the tokenizer's normal form leaves as they are, but for lower case.
_ODD = re.compile("[^\t-\r -~À-ÖØ-öø-ÿ]")
_SPACE, _LETTER, _DIGIT, _SIGN = range(4)


def _classes() -> np.ndarray:
    kinds = np.full(256, _SIGN, dtype=np.uint8)
    kinds[[9, 10, 11, 12, 13, 32]] = _SPACE
    kinds[ord("a") : ord("z") + 1] = kinds[128:] = _LETTER
    kinds[ord("0") : ord("9") + 1] = _DIGIT
    return kinds


_KINDS = _classes()


def word_edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the tokenizer's words in lower-case bytes that end with white space: runs of letters, single
    digits, runs of signs; an apostrophe that begins a run of signs takes the ending s, t, m, d, re, ve or ll behind it."""
    kinds = _KINDS[data]
    begins = np.empty(len(kinds), dtype=bool)
    begins[0] = kinds[0] != _SPACE
    begins[1:] = (kinds[1:] != _SPACE) & ((kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT))
    marks = np.flatnonzero(data[:-2] == ord("'"))
    if len(marks):
        marks = marks[begins[marks]]
        one, two = data[marks + 1], data[marks + 2]
        short = np.isin(one, list(b"stmd"))
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for chosen, size in ((marks[short], 2), (marks[long], 3)):
            begins[chosen + 1] = False
            begins[chosen + size] = kinds[chosen + size] != _SPACE
    stops = np.flatnonzero(begins | (kinds == _SPACE))
    starts = np.flatnonzero(begins)
    return starts, stops[np.searchsorted(stops, starts) + 1]


class _Encoder:
    """Token ids by the library, for the tokenizer's words, with a compact cache of words by hash.

    The tokenizer encodes each of its words apart from the others, so a text's ids are those of its words; only words not seen before
    go to the library, many at a time. A text with characters beyond plain Latin ones, or what may be the string of a special
    token, goes to the library as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._clear()

    def _clear(self) -> None:
        self.known = np.full(1, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.start, self.size = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.flat = np.empty(0, dtype=np.uint16)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Adds words, which the tokenizer takes as one each, under sorted keys that are new."""
        ids, sizes = [], []
        for at in range(0, len(words), 5_000):
            some = words[at : at + 5_000]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids.append(_narrow(found.ids))
            sizes.append(np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(some)))
        size = np.concatenate(sizes)
        place = np.searchsorted(self.known, keys)
        self.start = np.insert(self.start, place, len(self.flat) + np.cumsum(size) - size)
        self.size = np.insert(self.size, place, size)
        self.known = np.insert(self.known, place, keys)
        self.flat = np.concatenate([self.flat, *ids])

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, 16 bits each."""
        odd = [bool(_ODD.search(t)) or "<|" in t for t in texts]
        raw = [b"" if o else t.lower().encode() for t, o in zip(texts, odd, strict=True)]
        data = np.frombuffer(b" ".join(raw) + b"   ", dtype=np.uint8)
        starts, ends = word_edges(data)
        keys = hashes(data, starts, ends)
        if len(self.known) > CACHE_WORDS:
            self._clear()
        order = np.argsort(keys)  # sorted look-ups touch the cache in order
        ranked = keys[order]
        found = np.searchsorted(self.known, ranked)
        fresh = self.known[np.minimum(found, len(self.known) - 1)] != ranked
        fresh[1:] &= ranked[1:] != ranked[:-1]
        if fresh.any():
            whole, first = data.tobytes(), order[fresh]
            self._learn(keys[first], [whole[a:b].decode() for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
            found = np.searchsorted(self.known, ranked)
        at = np.empty(len(keys), dtype=np.int64)
        at[order] = found
        size = self.size[at]
        flat = self.flat[np.repeat(self.start[at] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        bounds = np.cumsum([0, *(len(r) + 1 for r in raw)])
        cuts = np.concatenate(([0], np.cumsum(size)))[np.searchsorted(starts, bounds)]
        return [_narrow(self.tokenizer.encode(t, add_special_tokens=False).ids) if o else flat[a:b] for t, o, a, b in zip(texts, odd, cuts, cuts[1:], strict=False)]


def _narrow(ids: list[int]) -> np.ndarray:
    found = np.array(ids, dtype=np.int64)
    if found.max(initial=0) >= 1 << 16:
        raise ValueError("token ids of 65,536 and more do not fit")
    return found.astype(np.uint16)


def directions(ids: np.ndarray, dimensions: int) -> np.ndarray:
    """A hashed direction for each id: each coordinate is -1 or 1."""
    bits = mix(ids.astype(np.uint64) + np.uint64(0x51ED270B))
    return np.stack([((bits >> np.uint64(d)) & np.uint64(1)).astype(np.float32) * 2 - 1 for d in range(dimensions)], axis=1)


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve through a cube of 2**bits cells a side; ``grid`` has a row a point.

    Gray-code form: coordinates are turned plane by plane from the highest bit, then interleaved.
    """
    x = grid.astype(np.int64).T.copy()
    n = len(x)
    for plane in reversed(range(1, bits)):
        q = 1 << plane
        for d in range(n):
            on = (x[d] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[d]) & (q - 1))
            x[0] = np.where(on, x[0] ^ (q - 1), x[0] ^ swap)
            x[d] = x[d] ^ swap
    for d in range(1, n):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for plane in reversed(range(1, bits)):
        turn ^= np.where((x[n - 1] >> plane) & 1 == 1, (1 << plane) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], dtype=np.int64)
    for plane in reversed(range(bits)):
        for d in range(n):
            key = (key << 1) | ((x[d] >> plane) & 1)
    return key


@functools.cache
def _table(dimensions: int) -> np.ndarray:
    return directions(np.arange(1 << 16), dimensions)


def curve_keys(ids: list[np.ndarray], dimensions: int = DIMENSIONS, bits: int = CURVE_BITS) -> np.ndarray:
    """Hilbert key of each document from its ids; no document may be empty."""
    sizes = np.array([len(i) for i in ids], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    table, every = _table(dimensions), np.concatenate(ids)
    sums = np.stack([np.add.reduceat(table[every, d], starts, dtype=np.float64) for d in range(dimensions)], axis=1)
    place = (sums / np.maximum(np.sqrt((sums**2).sum(axis=1)), 1)[:, None] + 1) / 2
    return hilbert_keys(np.minimum((place * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)


def keyed(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, curve key, hash of the ids, and the ids (16 bits each: the vocabulary has fewer than 65,536)."""

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = kept(f"packing {tokenizer}", lambda: _Encoder(tokenizer))
        texts = [t or "" for t in batch.column(1).to_pylist()]
        end = _narrow([end_id])
        ids = [np.concatenate((i, end)) for i in encoder.ids(texts)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(curve_keys(ids)), pa.array([i.astype("<u2").tobytes() for i in ids], pa.binary())], names=["doc_id", "key", "ids"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(by_batch(encode), "doc_id long, key long, ids binary")


def _dealt(table: DataFrame, bytes_a_task: int) -> DataFrame:
    """The keyed documents, a range of the curve with about ``bytes_a_task`` bytes of ids in each partition, with its number ``part``.

    Only the bytes of each stretch are gathered, in 65,536 rows at most. No range has more than twice the bytes, but for a longer document.
    """
    stretch = F.shiftright("key", DIMENSIONS * CURVE_BITS - STRETCH_BITS)
    sums = table.groupBy(stretch.alias("stretch")).agg(F.sum(F.octet_length("ids")).alias("held"))
    before = F.coalesce(F.sum("held").over(Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = written(sums.select("stretch", "held", before.alias("before")), "stretches")
    size = sums.agg(F.sum("held")).first()[0] or 0
    count = max(1, -(-size // bytes_a_task))
    share = F.when(F.col("held") > bytes_a_task, F.col("salt") / F.lit(2.0**64) + 0.5).otherwise(0.5)  # salts are spread evenly
    part = F.least(F.floor((F.col("before") + F.col("held") * share) / bytes_a_task), F.lit(count - 1)).cast("int").alias("part")
    placed = table.withColumn("stretch", stretch).join(F.broadcast(sums), "stretch").select("doc_id", "key", "salt", "ids", part)
    return placed.repartitionById(count, "part").sortWithinPartitions("key", "salt", "doc_id")


def packed(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = 2, bytes_a_task: int = 16 << 20) -> DataFrame:
    """Pieces of all documents in sequences of at most ``length`` ids: doc_id, start (the document's ids before
    the piece), ids (little-endian unsigned 32-bit numbers), doc_tokens, sequence_id and offset (place in the sequence).

    A null text counts as empty: its document is the end id alone. Rows are independent, so null and repeated
    doc_ids get pieces each; other columns of ``docs`` are not read. The number of ranges follows the
    bytes of ids. A sequence is filled before the next begins; its tail is padding only at the end of a partition.
    """
    table = written(keyed(docs, tokenizer, end_id).withColumn("salt", F.xxhash64("ids", "doc_id")), "packing")
    dealt = _dealt(table, bytes_a_task)

    def pour(batches) -> Iterator[pa.RecordBatch]:
        sequence, offset = 0, 0
        for batch in (some for whole in batches for some in slices(whole, 1)):
            pieces: list[list] = [[] for _ in range(6)]
            for doc, raw, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                ids, start = np.frombuffer(raw, "<u2").astype("<u4"), 0
                while start < len(ids):
                    take = min(length - offset, len(ids) - start)
                    for column, value in zip(pieces, (doc, start, ids[start : start + take].tobytes(), len(ids), (part << 33) + sequence, offset), strict=True):
                        column.append(value)
                    start, offset = start + take, offset + take
                    if offset == length:
                        sequence, offset = sequence + 1, 0
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(pieces, kinds, strict=True)], names=_PIECES)
            give_back()

    return dealt.select("doc_id", "ids", "part").mapInArrow(pour, "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long")


_PIECES = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the length and checksum of their ids instead of the ids."""
    length = (F.octet_length("ids") / 4).cast("long").alias("length")
    return pieces.select("doc_id", "start", length, F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
