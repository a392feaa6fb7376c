"""Benchmark decontamination with an FM-index over each training shard.

A shard is a slice of a partition. Its text is the shard's words as symbols of the benchmark's
vocabulary; a stretch of other words, and a run of known words too short to hold any window, becomes one
separator, because no occurrence can touch it. Over that text a task builds the index: the suffix order
by prefix doubling, its Burrows-Wheeler transform in a wavelet matrix for ranks, and every ``SAMPLING``-th
position. All windows of the benchmark are searched backward at once; the positions of their
occurrences are found by walking back to a sampled one. Covered words merge into removal spans.

The benchmark is read in blocks of about ``BLOCK_BYTES``, each broadcast and searched for in a narrow pass of its
own over the documents; documents are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacewise.llm.common import ALNUM, Words, by_batch, distinct, fresh, parts

#: Words of a window.
WINDOW = 10
#: Benchmark text that is broadcast at once.
BLOCK_BYTES = 16 << 20
#: Every so many positions of a shard's text are kept.
SAMPLING = 8


class WaveletMatrix:
    """Ranks over a sequence of small numbers: how often a symbol occurs before a position."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels: list[tuple[np.ndarray, int]] = []
        for shift in reversed(range(max(symbols - 1, 1).bit_length())):
            ones = ((values >> shift) & 1).astype(bool)
            before = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(ones, out=before[1:])
            zeros = len(values) - int(before[-1])
            self.levels.append((before, zeros))
            values = np.concatenate((values[~ones], values[ones]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        start = np.zeros_like(end)
        for level, (before, zeros) in enumerate(self.levels):
            bit = ((symbol >> (len(self.levels) - 1 - level)) & 1).astype(bool)
            left, right = before[start], before[end]
            start = np.where(bit, zeros + left, start - left)
            end = np.where(bit, zeros + right, end - right)
        return end - start


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order; a shorter suffix comes before those it begins."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank, step = rank.astype(np.int64), 1
    while True:
        behind = np.zeros(n, dtype=np.int64)
        behind[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(np.concatenate(([0], key[order][1:] != key[order][:-1])))
        rank, step = new, step * 2
        if rank[order[-1]] == n - 1 or step >= n:
            return order


class FmIndex:
    """Backward search and location over a text of symbols 1 to ``symbols`` - 1; 0 separates."""

    def __init__(self, text: np.ndarray, symbols: int):
        text = np.concatenate((text + 1, [0]))  # one smallest symbol ends the text
        order = suffix_order(text)
        self.last = text[order - 1]
        self.tree = WaveletMatrix(self.last, symbols + 1)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols + 1))))
        self.sampled = order % SAMPLING == 0
        self.kept = order[self.sampled]
        self.place = np.cumsum(self.sampled) - 1
        self.size = len(text)

    def ranges(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end row of each window; windows are filled with -1 in front."""
        low, high = np.zeros(len(windows), dtype=np.int64), np.full(len(windows), self.size, dtype=np.int64)
        for back in range(1, windows.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (high > low))
            symbol = windows[live, -back] + 1
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
        return low, high

    def positions(self, rows: np.ndarray) -> np.ndarray:
        found, steps, rows = np.empty(len(rows), dtype=np.int64), 0, rows.copy()
        open_ = np.arange(len(rows))
        while len(open_):
            at = rows[open_]
            here = self.sampled[at]
            found[open_[here]] = self.kept[self.place[at[here]]] + steps
            open_ = open_[~here]
            at = rows[open_]
            symbol = self.last[at]
            rows[open_] = self.before[symbol] + self.tree.rank(symbol, at)
            steps += 1
        return found


@dataclass(frozen=True)
class Block:
    """A block of the benchmark: word hashes (a word's symbol is its place, from 1), distinct windows of
    symbols, and the items of each window (``items[first[w] : first[w + 1]]`` index ``names``)."""

    vocabulary: np.ndarray
    windows: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    items: np.ndarray
    names: list[str]

    @staticmethod
    def of(rows: list[tuple[str, str | None]]) -> Block:
        words = Words([text for _, text in rows], ALNUM)
        vocabulary = distinct(words.hashes)
        symbols = np.searchsorted(vocabulary, words.hashes) + 1
        found: dict[tuple[int, ...], set[int]] = {}
        for item, (start, end) in enumerate(zip(words.first, words.first[1:], strict=False)):
            mine = symbols[start:end].tolist()
            for at in range(max(len(mine) - WINDOW, 0) + 1 if mine else 0):
                found.setdefault(tuple(mine[at : at + WINDOW]), set()).add(item)
        windows = np.full((len(found), WINDOW), -1, dtype=np.int64)
        for w, window in enumerate(found):
            windows[w, WINDOW - len(window) :] = window
        sizes = [len(s) for s in found.values()]
        items = np.array([i for s in found.values() for i in sorted(s)], dtype=np.int64)
        return Block(vocabulary, windows, (windows > 0).sum(axis=1), np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), items, [n for n, _ in rows])

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are hit; distinct (text, item) pairs in order."""
        hit = np.zeros(len(words.hashes) + 1, dtype=np.int64)
        nothing = hit[:-1] > 0, np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(self.windows) or not len(words.hashes):
            return nothing
        place = np.minimum(np.searchsorted(self.vocabulary, words.hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[place] == words.hashes
        # runs of known words inside a text
        begins = known & np.concatenate(([True], ~known[:-1] | (words.of[1:] != words.of[:-1])))
        run = np.cumsum(begins) - 1
        sizes = np.bincount(run[known], minlength=int(begins.sum()))
        kept = np.flatnonzero(known)[sizes[run[known]] >= self.lengths.min()]
        if not len(kept):
            return nothing
        fresh_run = np.concatenate(([False], run[kept][1:] != run[kept][:-1]))
        spot = np.arange(len(kept)) + np.cumsum(fresh_run)
        text = np.zeros(spot[-1] + 1, dtype=np.int64)
        text[spot] = place[kept] + 1
        word = np.full(len(text), -1, dtype=np.int64)
        word[spot] = kept
        index = FmIndex(text, len(self.vocabulary) + 1)
        low, high = index.ranges(self.windows, self.lengths)
        count = np.maximum(high - low, 0)
        window = np.repeat(np.arange(len(count)), count)
        rows = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(int(count.sum()))
        start = word[index.positions(rows)]
        np.add.at(hit, start, 1)
        np.add.at(hit, start + self.lengths[window], -1)
        each = self.first[window + 1] - self.first[window]
        item = self.items[np.repeat(self.first[window] - np.concatenate(([0], np.cumsum(each)[:-1])), each) + np.arange(int(each.sum()))]
        pairs = distinct(np.repeat(words.of[start], each) * len(self.names) + item)
        return np.cumsum(hit[:-1]) > 0, pairs // len(self.names), pairs % len(self.names)


def _spans(words: Words, hit: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text the merged spans of hit words, flat: first and end word, first and end byte; and their number."""
    edge = hit & np.concatenate(([True], ~hit[:-1] | (words.of[1:] != words.of[:-1])))
    stop = hit & np.concatenate((~hit[1:] | (words.of[1:] != words.of[:-1]), [True]))
    first, last = np.flatnonzero(edge), np.flatnonzero(stop)
    of = words.of[first]
    base, byte = words.first[of], words.text_starts[of]
    flat = np.stack((first - base, last + 1 - base, words.starts[first] - byte, words.ends[last] - byte), axis=1).reshape(-1)
    return flat.astype(np.int64), np.bincount(of, minlength=texts) * 4


def blocks_of(items: DataFrame) -> list[Block]:
    """The benchmark in blocks of about BLOCK_BYTES, by a hash of the item."""
    plain = items.select(F.col("item_id").cast("string").alias("item"), "text").where("item_id is not null and text is not null")
    total = plain.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = max(1, math.ceil(total / BLOCK_BYTES))
    for block in range(count):
        rows = plain.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == block).collect()
        yield Block.of(sorted((r.item, r.text) for r in rows))


def contaminations(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` with three columns more: ``n_words``, ``spans`` (flat, four numbers for each removal span: first and end
    word, first and end byte) and ``item_ids`` (sorted as strings, distinct) - their names get leading underscores
    where ``docs`` has such a column. Null and empty texts have no words. Items without id or text are left out; a
    repeated item_id counts once. Rows are independent, so repeated and null doc_ids give a row each. With
    an empty benchmark nothing is hit."""
    return _searched(docs, items)


def _searched(docs: DataFrame, items: DataFrame, last: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None, last_schema: T.StructType | None = None) -> DataFrame:
    """See ``contaminations``; ``last`` turns each batch of its result into one of ``last_schema``, in the stage of the last block:
    a Python stage more would be a worker more on each core."""
    names = [fresh(docs.columns, n) for n in ("n_words", "spans", "item_ids")]
    frame = docs.withColumns({names[0]: F.lit(0).cast("long"), names[1]: F.array().cast("array<bigint>"), names[2]: F.array().cast("array<string>")})
    text_at = [c.lower() for c in docs.columns].index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
    width, columns = len(docs.columns), frame.columns

    def searcher(shared):
        def search(batch: pa.RecordBatch) -> pa.RecordBatch:
            block: Block = shared.value
            words = Words(batch.column(text_at).to_pylist(), ALNUM)
            hit, of, item = block.search(words)
            flat, sizes = _spans(words, hit, batch.num_rows)
            spans, found = parts(flat, sizes), batch.column(width + 2)
            if len(of) or len(found.values):
                each = found.to_pylist()
                for t, i in zip(of.tolist(), item.tolist(), strict=True):
                    each[t].append(block.names[i])
                found = pa.array([sorted(set(e)) for e in each], pa.list_(pa.string()))
            if len(batch.column(width + 1).values):
                spans = pa.array([_merged(a, b) for a, b in zip(batch.column(width + 1).to_pylist(), spans.to_pylist(), strict=True)], pa.list_(pa.int64()))
            counts = pa.array(np.diff(words.first), pa.int64())
            return pa.RecordBatch.from_arrays([*batch.columns[:width], counts, spans, found], names=columns)

        return search

    context = docs.sparkSession.sparkContext
    searchers = (searcher(context.broadcast(block)) for block in blocks_of(items))
    search = next(searchers)  # an empty benchmark is one empty block
    for following in searchers:
        frame, search = frame.mapInArrow(by_batch(search, text_at), schema), following
    if last is None:
        return frame.mapInArrow(by_batch(search, text_at), schema)
    return frame.mapInArrow(by_batch(lambda batch: last(search(batch)), text_at), last_schema)


def _merged(a: list[int], b: list[int]) -> list[int]:
    """Spans of two passes as one list; spans that overlap or touch become one."""
    out: list[list[int]] = []
    for span in sorted([s[i : i + 4] for s in (a, b) for i in range(0, len(s), 4)]):
        if out and span[0] <= out[-1][1]:
            out[-1][1], out[-1][3] = max(out[-1][1], span[1]), max(out[-1][3], span[3])
        else:
            out.append(list(span))
    return [n for span in out for n in span]


def hit_counts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row."""
    found = contaminations(docs.select("doc_id", "text"), items)
    hits = F.aggregate(F.sequence(F.lit(1), F.size("spans"), F.lit(4)), F.lit(0).cast("long"),
                       lambda total, i: total + F.element_at("spans", i + 1) - F.element_at("spans", i))
    n_hit = F.when(F.size("spans") > 0, hits).otherwise(F.lit(0).cast("long"))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def without_spans(text: str, spans: list[int]) -> str:
    """The text with its removal spans cut out."""
    raw, out, at = text.encode(), [], 0
    for i in range(0, len(spans), 4):
        out.append(raw[at : spans[i + 2]])
        at = spans[i + 3]
    return b"".join([*out, raw[at:]]).decode()


def cleaned(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` with the passages of the benchmark cut out of their texts; all other columns stay, but for ``n_chars``, which follows
    the text. A row whose words all go is left out; rows without any passage stay as they are."""
    names, schema = docs.columns, docs.schema
    lower = [c.lower() for c in names]
    text_at, size_at, width = lower.index("text"), lower.index("n_chars") if "n_chars" in lower else None, len(names)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns, spans = list(batch.columns[:width]), batch.column(width + 1)
        if not len(spans.values):
            return pa.RecordBatch.from_arrays(columns, names=names)
        words, each, texts = batch.column(width).to_pylist(), spans.to_pylist(), columns[text_at].to_pylist()
        hit = [sum(s[i + 1] - s[i] for i in range(0, len(s), 4)) for s in each]
        texts = [without_spans(t, s) if s else t for t, s in zip(texts, each, strict=True)]
        columns[text_at] = pa.array(texts, pa.string())
        if size_at is not None:
            sizes = [len(t) if s else n for t, s, n in zip(texts, each, columns[size_at].to_pylist(), strict=True)]
            columns[size_at] = pa.array(sizes, columns[size_at].type)
        kept = [not h or h < w for h, w in zip(hit, words, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(kept, pa.bool_()))

    return _searched(docs, items, cut, schema)
