"""Spelling variants of words: Bloom-guided neighbourhoods.

Every word of the vocabulary generates its edits as hashes (deletions, and replacements by a later letter; an insertion is the
other word's deletion, a replacement by an earlier letter the other word's replacement). The hashes are probed against broadcast
blocked Bloom filters, sharded by word length. Only positives are spelled out and shuffled, to an exact join with the vocabulary
that removes the false ones. Filters beyond ``filter_blocks`` are probed in rounds, each by the words of the lengths it holds, so
what is broadcast is bounded and no word is left out.

Words: maximal runs of ASCII letters and U+00C0 to U+00FF, A-Z lowered. A run may lose a letter first (``mutated``), as the
contract orders. Null or empty texts have no words, a null doc_id counts as empty text, repeated rows count as often as they
occur, other columns of the input are not read, and an empty table gives an empty result. Of equally frequent near words the
smallest in code-point order is the form.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise.llm.common import by_batch, mix, written

#: Letters of words, in code-point order.
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], dtype=np.uint32)
#: Words from this length on share one shard of the filters.
LONGEST_SHARD = 64
#: 64-bit blocks that one round broadcasts: 32 MB.
FILTER_BLOCKS = 1 << 22
#: Blocks of a part of a filter, which one group of rows builds: 256 KB.
_PART_BLOCKS = 1 << 15
#: A block for so many words, and the bits that a word sets in its block.
_WORDS_A_BLOCK, _BITS = 2, 6
#: Letters that a task looks at together.
_CELLS = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mutated(run: str, h: int, every: int) -> str:
    """The run without one letter where ``every`` divides h."""
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, least: int = 7, every: int = 31) -> DataFrame:
    """``word, n`` of all words of at least ``least`` letters, over all texts."""
    found = re.compile(f"[a-zÀ-ÿ]{{{least},}}").findall

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        total: Counter = Counter()
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            head = zlib.crc32(f"{doc_id or ''}:".encode())
            for run, n in Counter(found((text or "").encode().lower().decode())).items():
                total[mutated(run, zlib.crc32(run.encode(), head), every)] += n
        kept = [w for w in total if len(w) >= least]
        return pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array([total[w] for w in kept], pa.int64())], ["word", "n"])

    rows = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(by_batch(count), "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


class _Cells:
    """Words as flat arrays of letters with the hashes of all their prefixes."""

    def __init__(self, words: list[str]):
        self.lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self.letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        first = np.cumsum(self.lengths) - self.lengths
        self.word = np.repeat(np.arange(len(words)), self.lengths)
        self.place = np.arange(len(self.letters)) - first[self.word]
        powers = np.cumprod(np.full(int(self.lengths.max(initial=1)), _BASE, dtype=np.uint64))
        self.power = powers[self.place]
        self.value = mix(self.letters)
        upto = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(self.value * self.power)))
        self.whole = upto[first + self.lengths] - upto[first]
        self.before = upto[:-1] - upto[first][self.word]

    def deleted(self) -> tuple[np.ndarray, np.ndarray]:
        """Cells whose letter can go, and the hash without it; of equal letters in a row only the first."""
        same = np.zeros(len(self.letters), dtype=bool)
        same[1:] = (self.letters[1:] == self.letters[:-1]) & (self.word[1:] == self.word[:-1])
        at = np.flatnonzero(~same)
        after = self.whole[self.word[at]] - self.before[at] - self.value[at] * self.power[at]
        return at, self.before[at] + after * _BACK

    def replaced(self, letter: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells with an earlier letter, and the hash with this one instead."""
        at = np.flatnonzero(self.letters < letter)
        change = mix(np.array([letter], dtype=np.uint32))[0] - self.value[at]
        return at, self.whole[self.word[at]] + change * self.power[at]


class _Shape:
    """Where the filter of each length lies in one row of blocks."""

    def __init__(self, counts: dict[int, int]):
        self.blocks = np.zeros(LONGEST_SHARD + 1, dtype=np.uint64)
        for length, n in counts.items():
            self.blocks[length] = -(-n // _WORDS_A_BLOCK)
        self.first = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(self.blocks)[:-1]))
        self.total = int(self.blocks.sum())

    def place(self, hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block of each word, -1 where its length has no filter, and the word's bits there."""
        mixed = mix(hashes)
        shard = np.minimum(lengths, LONGEST_SHARD)
        size = self.blocks[shard]
        block = self.first[shard] + (((mixed >> np.uint64(32)) * size) >> np.uint64(32))
        bits = np.zeros(len(mixed), dtype=np.uint64)
        spread = mixed * _BASE
        for i in range(_BITS):
            bits |= np.uint64(1) << ((spread >> np.uint64(6 * i + 20)) & np.uint64(63))
        return np.where(size > 0, block.astype(np.int64), -1), bits


def _groups(words: list[str]):
    """Neighbouring words with _CELLS letters together, or one longer word."""
    some, cells = [], 0
    for at, word in enumerate(words):
        if some and cells + len(word) > _CELLS:
            yield some
            some, cells = [], 0
        some.append(at)
        cells += len(word)
    if some:
        yield some


def _parts_of_filter(words: DataFrame, shape: _Shape) -> DataFrame:
    """``part, bits``: the filter of all words, in parts; a part is built from the few words of its blocks."""

    def placed(batches):
        for batch in batches:
            every = batch.column(0).to_pylist()
            for some in _groups(every):
                cells = _Cells([every[i] for i in some])
                block, bits = shape.place(cells.whole, cells.lengths)
                columns = [pa.array(block // _PART_BLOCKS), pa.array(block % _PART_BLOCKS), pa.array(bits.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["part", "block", "bits"])

    def built(key, rows):
        blocks = np.zeros(_PART_BLOCKS, dtype=np.uint64)
        np.bitwise_or.at(blocks, rows.column("block").to_numpy(), rows.column("bits").to_numpy().view(np.uint64))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([blocks.tobytes()], pa.binary())})

    merged = words.select("word").mapInArrow(placed, "part long, block long, bits long")
    merged = merged.groupBy("part", "block").agg(F.bit_or("bits").alias("bits"))
    return merged.groupBy("part").applyInArrow(built, "part long, bits binary")


def _round(words: DataFrame, parts: DataFrame, shape: _Shape, start: int, stop: int) -> DataFrame:
    """``word, n, other``: edits of words that the filter's blocks from start to stop do not rule out."""
    blocks = np.zeros(stop - start, dtype=np.uint64)
    inside = F.col("part").between(start // _PART_BLOCKS, (stop - 1) // _PART_BLOCKS)
    for row in parts.where(inside).toLocalIterator():  # stop - start blocks of 8 bytes in all
        at = row.part * _PART_BLOCKS - start
        first, last = max(at, 0), min(at + _PART_BLOCKS, len(blocks))
        blocks[first:last] = np.frombuffer(bytes(row.bits), dtype=np.uint64)[first - at : last - at]
    shared = words.sparkSession.sparkContext.broadcast(blocks)
    shards = [i for i in range(LONGEST_SHARD + 1) if shape.blocks[i] and shape.first[i] < stop and shape.first[i] + shape.blocks[i] > start]
    near = sorted({s for i in shards for s in (i, min(i + 1, LONGEST_SHARD))})

    def probed(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        block, bits = shape.place(hashes, lengths)
        inside = (block >= start) & (block < stop)
        held = shared.value[np.where(inside, block - start, 0)]
        return np.flatnonzero(inside & (held & bits == bits))

    def probe(batches):
        for batch in batches:
            every, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for some in _groups(every):
                names = [every[i] for i in some]
                cells = _Cells(names)
                source, others = [], []
                at, hashes = cells.deleted()
                for i in at[probed(hashes, cells.lengths[cells.word[at]] - 1)].tolist():
                    word, place = names[cells.word[i]], int(cells.place[i])
                    source.append(some[cells.word[i]])
                    others.append(word[:place] + word[place + 1 :])
                for letter in LETTERS.tolist():
                    at, hashes = cells.replaced(letter)
                    for i in at[probed(hashes, cells.lengths[cells.word[at]])].tolist():
                        word, place = names[cells.word[i]], int(cells.place[i])
                        source.append(some[cells.word[i]])
                        others.append(word[:place] + chr(letter) + word[place + 1 :])
                words = pa.array([every[i] for i in source], pa.string())
                yield pa.RecordBatch.from_arrays([words, pa.array(counts[source]), pa.array(others, pa.string())], ["word", "n", "other"])

    wanted = words.where(F.least(F.char_length("word"), F.lit(LONGEST_SHARD)).isin(near))
    return wanted.select("word", "n").mapInArrow(probe, "word string, n long, other string")


def near_words(words: DataFrame, filter_blocks: int = FILTER_BLOCKS) -> DataFrame:
    """``word, near, near_n``: both directions of every pair of distinct words one edit apart.

    ``words`` has distinct ``word`` and ``n``, and is read several times: a table.
    """
    shard = F.least(F.char_length("word"), F.lit(LONGEST_SHARD)).alias("shard")
    shape = _Shape({r["shard"]: r["count"] for r in words.groupBy(shard).count().collect()})  # one row a shard
    parts = written(_parts_of_filter(words, shape), "filters")
    candidates = words.select("word", "n", F.lit("").alias("other")).limit(0)
    for start in range(0, shape.total, filter_blocks):
        rest = _round(words, parts, shape, start, min(start + filter_blocks, shape.total))
        candidates = candidates.union(written(rest, "edits"))
    known = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = candidates.join(known, "other")
    ends = F.array(
        F.struct(F.col("word"), F.col("other").alias("near"), F.col("other_n").alias("near_n")),
        F.struct(F.col("other").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    return pairs.select(F.explode(ends).alias("e")).select("e.*")


def _roots(forms: DataFrame, steps: int) -> DataFrame:
    """``word, root`` of words that have a form; paths double in each round, and ``steps`` bounds their length."""
    state = forms.select("word", F.col("form").alias("root"))
    reach = 1
    while reach < steps:
        state = written(state, "roots")
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        state = state.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        reach *= 2
    return state


def variants(
    docs: DataFrame, least: int = 7, occurrences: int = 2, ratio: int = 10, every: int = 31, filter_blocks: int = FILTER_BLOCKS
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word that occurs often enough.

    A form has at least ``ratio`` times its word's count, so a path of forms is no longer than the logarithm of the largest count.
    """
    words = written(word_counts(docs, least, every).where(F.col("n") >= occurrences), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best")
    near = near_words(words, filter_blocks).groupBy("word").agg(F.count("*").alias("n_near"), best)
    fits = -F.col("best.minus") >= F.col("n") * ratio
    found = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"),
        F.when(fits, -F.col("best.minus")).alias("form_n"),
    )
    found = written(found, "forms")
    largest, steps = found.agg(F.max("n")).first()[0] or 1, 0
    while largest >= ratio:
        largest, steps = largest // ratio, steps + 1
    roots = _roots(found.where("form is not null"), steps)
    rooted = found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return rooted.select("word", "form", "root", "n", "n_near", "form_n")
