"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent letter n-grams (one to ``LONGEST`` letters, words
bounded by a blank) in order of their count over **all** training texts. A text's own most frequent
n-grams are compared with each profile: an n-gram costs the difference of its two ranks, or the most
possible if the profile lacks it ("out of place"). The language with the smallest distance wins.

N-grams are counted map-side in each task and summed by (language, n-gram) with partial aggregation;
there are at most as many rows as distinct n-grams of a few letters. Profiles have a fixed size.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewise.llm.common import by_batch, counted, distinct, slices
from pacewise.llm.quality import in_fold

#: Longest n-gram in letters.
LONGEST = 3
#: N-grams of a profile, and of a text.
PROFILE, DOCUMENT = 400, 300
#: Bits of a letter's number; letters beyond U+1FFF share numbers.
_BITS = 13


def _letters() -> np.ndarray:
    """A number for each code point of the basic plane and one for all others: 0 for what is no letter, 1
    is kept for blanks, and lower case stands for both cases."""
    table = np.zeros(0x10001, dtype=np.int64)
    for point in range(0x10000):
        char = chr(point)
        if unicodedata.category(char)[0] == "L":
            low = char.lower()
            number = ord(low) if len(low) == 1 else point
            table[point] = number if number < 0x2000 else 0x1000 + number % 0x1000
    table[0x10000] = 0x1FFF
    return table


_TABLE: list[np.ndarray] = []


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, n-gram, count) in order of text and n-gram."""
    if not _TABLE:
        _TABLE.append(_letters())
    raw = [(" " + (t or "") + " ").encode("utf-32-le", "surrogatepass") for t in texts]
    points = np.frombuffer(b"".join(raw), dtype="<u4")
    letters = _TABLE[0][np.minimum(points, 0x10000)]
    beyond = np.flatnonzero(points >= 0x10000)
    if len(beyond):
        letters[beyond] = [0x1FFF if unicodedata.category(chr(p))[0] == "L" else 0 for p in points[beyond].tolist()]
    of = np.repeat(np.arange(len(texts)), [len(r) // 4 for r in raw])
    keep = np.ones(len(letters), dtype=bool)
    keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0) | (of[1:] != of[:-1])  # a run of what is no letter counts as one blank
    letters, of = letters[keep], of[keep]
    letters = np.where(letters == 0, 1, letters)
    found, gram = [], letters
    for n in range(1, LONGEST + 1):
        if n > 1:
            gram = (gram[:-1] << _BITS) | letters[n - 1 :]
        owner = of[: len(gram)]
        use = owner == of[n - 1 :]
        use &= (gram & ((1 << _BITS) - 1)) != 1 if n < 3 else True
        if n == 1:
            use &= letters != 1
        if n >= 3:  # a blank inside would join two words
            use &= ((gram >> _BITS) & ((1 << _BITS) - 1)) != 1
        found.append((owner[use] << (_BITS * LONGEST)) | gram[use])
    keys, counts = counted(np.concatenate(found))
    return keys >> (_BITS * LONGEST), keys & ((1 << (_BITS * LONGEST)) - 1), counts


@dataclass(frozen=True)
class Profiles:
    """``ranks[i, j]``: rank of n-gram i in the profile of language j, or PROFILE."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """A language for each text, and how much farther the next profile is: 0 (a tie) to 1."""
        of, gram, counts = grams(texts)
        # by text, count and n-gram; one packed key sorts faster, where counts, places and texts fit into it
        if counts.max(initial=0) < 1 << 18 and len(of) <= 1 << 26 and len(texts) <= 1 << 19:
            order = np.sort((of << 44) | (((1 << 18) - 1 - counts) << 26) | np.arange(len(of))) & ((1 << 26) - 1)
        else:
            order = np.lexsort((gram, -counts, of))
        gram = gram[order]
        starts = np.searchsorted(of, np.arange(len(texts)))
        rank = np.arange(len(of)) - starts[of]
        use = rank < DOCUMENT
        of, gram, rank = of[use], gram[use], rank[use]
        has = np.zeros(len(texts), dtype=bool)
        has[of] = True
        if not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        at = np.minimum(np.searchsorted(self.grams, gram), max(len(self.grams) - 1, 0))
        known = self.grams[at] == gram
        distance = np.empty((len(texts), len(self.languages)))
        for j in range(len(self.languages)):
            theirs = np.where(known, self.ranks[at, j], PROFILE)
            cost = np.where(theirs < PROFILE, np.abs(theirs - rank), PROFILE)
            distance[:, j] = np.bincount(of, weights=cost, minlength=len(texts))
        best = distance.argmin(axis=1)
        least = distance.min(axis=1)
        others = np.where(np.arange(len(self.languages))[None, :] == best[:, None], np.inf, distance).min(axis=1)
        share = np.where(np.isinf(others), 1.0, (others - least) / np.maximum(others, 1e-9))
        names = [self.languages[j] if ok else "und" for j, ok in zip(best, has, strict=True)]
        return names, [float(s) if ok else 0.0 for s, ok in zip(np.clip(share, 0, 1), has, strict=True)]


def _sums(texts: list[str], langs: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Sorted n-grams and their counts by language; a language's texts are counted as one."""
    found = {}
    for lang in sorted(set(langs)):
        _, gram, n = grams([" \n ".join(t for t, own in zip(texts, langs, strict=True) if own == lang)])
        found[lang] = (gram, n)
    return found


def train(rows: DataFrame) -> Profiles:
    """Profiles of every language of ``rows`` (text, lang); rows without either are left out. Equal
    counts rank by the n-gram's number, so the profiles do not depend on the order of rows."""

    def count(batches):
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in (some for whole in batches for some in slices(whole, 0)):
            for lang, (gram, n) in _sums(batch.column(0).to_pylist(), batch.column(1).to_pylist()).items():
                have = total.get(lang, (np.empty(0, np.int64), np.empty(0, np.int64)))
                total[lang] = _added(np.concatenate((have[0], gram)), np.concatenate((have[1], n)))
        for lang, (gram, n) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)], names=["lang", "gram", "n"])

    rows = rows.select("text", "lang").where("text is not null and lang is not null")
    sums = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = sums.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE).select("lang", "gram", "rank").collect()
    languages = sorted({r.lang for r in top})
    every = distinct(np.array([r.gram for r in top], dtype=np.int64))
    ranks = np.full((max(len(every), 1), len(languages)), PROFILE)
    for r in top:
        ranks[np.searchsorted(every, r.gram), languages.index(r.lang)] = r.rank - 1
    return Profiles(languages, every if len(every) else np.full(1, -1), ranks)


def _added(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(gram, kind="stable")
    gram, n = gram[order], n[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(len(gram), 1), dtype=bool), gram[1:] != gram[:-1])))
    return gram[starts], np.add.reduceat(n, starts) if len(starts) else n


def languages(docs: DataFrame, profiles: Profiles, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, by its text alone: ``und`` and 0 where the text
    is null, has no letter, or nothing was learned. Ties go to the first language by name."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def predict(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores = shared.value.predict(batch.column(2).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return plain.mapInArrow(by_batch(predict, 2), "doc_id long, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """Languages of all rows, learned from the rows outside one fold of crc32(doc_id). Null doc_ids are not
    held out; repeated rows are predicted each; an empty table gives an empty result."""
    out = in_fold(F.col("doc_id"), folds, fold)
    return languages(docs, train(docs.where(~out)), out)
