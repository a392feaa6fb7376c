"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Upper-case letters that operators lower; others keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one the session names, else one in the warehouse, which they share too."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends there, and lost executors cost nothing."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


#: Rows of a batch of documents that a query hands to a Python worker.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Small Arrow batches for the session: documents are long, and batches lie outside the JVM's heap, beside the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


#: Bytes of text that a worker works on at once; one longer text is worked on alone.
SLICE_BYTES = 2 << 20


def slices(batch: pa.RecordBatch, text_at: int) -> Iterator[pa.RecordBatch]:
    """The batch cut so that the texts of a slice have SLICE_BYTES at most."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
    place = np.cumsum(sizes) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def give_back() -> None:
    """Returns memory that this worker has freed to the system; a worker goes on to later stages, beside others and the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, once in a worker; a worker keeps one such thing, so those of earlier stages go."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def by_batch(function: Callable[[pa.RecordBatch], pa.RecordBatch], text_at: int = 1) -> Callable[[Iterator], Iterator]:
    """A function for mapInArrow that turns each slice of a batch into one batch."""

    def run(batches):
        for batch in batches:
            for some in slices(batch, text_at):
                yield function(some)
            give_back()

    return run


def fresh(columns: list[str], wanted: str) -> str:
    """A column name that clashes with none, whatever the letter case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def parts(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A list array: row i gets the next sizes[i] values."""
    offsets = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(values)).cast(pa.list_(pa.array(values).type))


class Words:
    """Words of many texts as 64-bit hashes, found with array operations on their UTF-8 bytes.

    ``is_word`` has 256 flags: which bytes belong to words, after A-Z became a-z. ``of[i]`` is the
    text of word i, ``first[t]`` the first word of text t (one entry more than texts).
    """

    def __init__(self, texts: list[str | None], is_word: np.ndarray):
        lowered = [b"" if t is None else t.encode("utf-8", "surrogatepass").lower() for t in texts]
        data = np.frombuffer(b"\n".join(lowered) + b"\n", dtype=np.uint8)
        inside = is_word[data]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside.size and inside[0]:
            edge = np.concatenate(([0], edge))
        self.starts, self.ends = edge[0::2], edge[1::2]
        sizes = np.fromiter(map(len, lowered), dtype=np.int64, count=len(lowered)) + 1
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        self.text_starts = bounds[:-1]
        self.first = np.searchsorted(self.starts, bounds)
        self.of = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.hashes = hashes(data, self.starts, self.ends)
        self.data = data


_POWERS = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15, dtype=np.uint64))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each stretch of bytes: digits of a number to an odd base, mixed; chunked to bound memory."""
    out = np.empty(len(starts), dtype=np.uint64)
    step = 1 << 16
    for at in range(0, len(out), step):
        begins = starts[at : at + step]
        sizes = ends[at : at + step] - begins
        firsts = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(firsts, sizes)
        letters = data[place + np.repeat(begins, sizes)].astype(np.uint64) + np.uint64(1)
        weights = _POWERS[place & 4095] + (place >> 12).astype(np.uint64)
        out[at : at + step] = np.add.reduceat(mix(letters) * weights, firsts)
    return mix(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting beats numpy's hash table on millions of keys."""
    keys = np.sort(keys)
    keep = np.ones(len(keys), dtype=bool)
    keep[1:] = keys[1:] != keys[:-1]
    return keys[keep]


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each occurs."""
    keys = np.sort(keys)
    starts = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), dtype=bool), keys[1:] != keys[:-1])))
    return keys[starts], np.diff(np.concatenate((starts, [len(keys)])))


def flags(pattern: bytes) -> np.ndarray:
    """256 flags: the single bytes that match a class such as ``[0-9a-z]``; bytes from 128 on always do."""
    rule = re.compile(pattern)
    return np.array([b >= 128 or bool(rule.fullmatch(bytes([b]))) for b in range(256)])


#: Letters and digits in ASCII, everything beyond ASCII; in lower-cased bytes.
ALNUM = flags(rb"[0-9a-z]")
#: Everything but white space of ASCII.
NOT_SPACE = flags(rb"[^\x20\x09-\x0D]")
