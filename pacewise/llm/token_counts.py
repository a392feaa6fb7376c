"""Token counts by a two-tier lookup on the map side; no pre-token is ever shuffled.

A byte-level BPE tokenizer treats every run of white space with the run of other characters behind it
on its own, so a text's count is the sum over such pieces. Tier one is a table of the lengths of
frequent pieces, broadcast: the vocabulary's own entries, which are the pieces that were frequent
when the merges were learned, each counted by the library. Its size is bounded by the vocabulary.
Tier two is a cache in each Python worker: the distinct misses of a batch are encoded by the library
together and kept. The cache has a bound and starts anew when it is full, which costs time only.
"""

from __future__ import annotations

import json
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from pacewise.llm.common import by_batch, kept

#: Most pieces that a worker keeps.
CACHE_PIECES = 1_000_000
#: Longest piece that is kept; longer ones are encoded each time.
KEPT_CHARS = 64
_PIECE = re.compile(r"\s*\S+|\s+")
_OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
_DOUBLE = ("  ", "\n\n", " \n", "\n ")


class _Counter:
    """A worker's second tier over the first."""

    def __init__(self, path: str, frequent: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.frequent, self.seen = frequent, dict(frequent)

    def sizes(self, pieces: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(pieces, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        split = [_pieces(t) for t in texts]
        if len(self.seen) > CACHE_PIECES:
            self.seen = dict(self.frequent)
        seen = self.seen
        new = list(set().union(*split).difference(seen)) if split else []
        extra = {}
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            extra.update(zip(some, self.sizes([_spelled(p) for p in some]), strict=True))
        seen.update((p, n) for p, n in extra.items() if len(p) <= KEPT_CHARS)
        get = (seen | extra).__getitem__ if any(len(p) > KEPT_CHARS for p in extra) else seen.__getitem__
        return [sum(map(get, pieces)) for pieces in split]


def _spelled(piece: str) -> str:
    """Pieces are kept without the blank that most begin with; other beginnings have a mark of their own."""
    return piece[1:] if piece[:1] == "\0" else " " + piece


def _pieces(text: str) -> list[str]:
    if not text:
        return []
    if "\0" in text or any(d in text for d in _DOUBLE) or _OTHER_SPACE.search(text):
        return [p[1:] if p[0] == " " and p[1:2] != "\0" else "\0" + p for p in _PIECE.findall(text)]
    # single blanks and line ends only: cut before each; a cut-off line end stays with what follows it
    first, *rest = text.replace("\n", " \0\n").split(" ")
    head = [] if not first else [first if first[0] == "\0" else "\0" + first]
    return head + rest


def frequent_lengths(path: str) -> dict[str, int]:
    """Lengths of the vocabulary's entries as pieces, by the library itself; at most one per entry."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    counter = _Counter(path, {})
    special = [t["content"] for t in spec.get("added_tokens", [])]
    ids = [i for t, i in spec["model"]["vocab"].items() if t not in special]
    words = [counter.tokenizer.decode([i], skip_special_tokens=False) for i in ids]
    pieces = sorted({w[1:] for w in words if w[:1] == " " and "�" not in w and _PIECE.fullmatch(w)})
    return dict(zip(pieces, counter.sizes([_spelled(p) for p in pieces]), strict=True))


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row of ``docs``.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library, readable on every
    executor. A null text counts as empty: 0 bytes, 0 tokens. Strings of special tokens inside a text
    count as the library takes them by default. Rows are independent: null and repeated doc_ids give
    a row each, and other columns of ``docs``, whatever their names, are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(tokenizer))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = kept(f"token counts {tokenizer}", lambda: _Counter(tokenizer, shared.value))
        texts = [t or "" for t in batch.column(1).to_pylist()]
        tokens = counter.counts(texts)
        sizes = [len(t.encode()) for t in texts]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    return docs.select("doc_id", "text").mapInArrow(by_batch(count), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
