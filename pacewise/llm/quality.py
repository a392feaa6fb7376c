"""Document quality by naive Bayes support vectors.

Features are indicators of hashed n-grams: words and pairs of words, runs of character kinds ("shape":
lower case, upper case, digit, blank, line end, each other sign), and words or pairs that repeat what
came before, with the rough number of repeats. Training takes three steps:

1. A sample of the labelled training rows, at most ``sample`` (a documented bound; the ids with the smallest hash), is
   turned into feature numbers on the executors.
2. Each feature's log-count ratio of the two classes.
3. A linear hinge-loss model on the indicators scaled by their ratios, by dual coordinate descent.

The fitted model, two vectors of fixed size, is broadcast; scoring is a narrow map over whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.llm.common import NOT_SPACE, Words, by_batch, counted, distinct, give_back, mix

#: Bits of a feature number; every vector of the model has this many entries.
BITS = 18
SIZE = 1 << BITS
_RAW_SPACE = NOT_SPACE


def _kinds() -> np.ndarray:
    kind = np.arange(256, dtype=np.uint8)
    kind[ord("a") : ord("z") + 1] = kind[128:] = ord("a")
    kind[ord("A") : ord("Z") + 1] = ord("A")
    kind[ord("0") : ord("9") + 1] = ord("0")
    kind[[9, 11, 12, 13]] = ord(" ")
    return kind


_KINDS = _kinds()


def _numbered(family: int, values: np.ndarray) -> np.ndarray:
    """Feature numbers of a family's values."""
    return (mix(values + np.uint64(family * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(64 - BITS)).astype(np.int64)


def _shapes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and value of the 2- to 4-grams of character kinds, runs of a kind taken as one."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = _KINDS[np.frombuffer(b"\0".join(raw) + b"\0", dtype=np.uint8)]
    of = np.repeat(np.arange(len(raw)), [len(r) + 1 for r in raw])
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = data[1:] != data[:-1]
    data, of = data[keep].astype(np.uint64), of[keep]
    found = []
    gram = data
    for n in (2, 3, 4):
        gram = gram[:-1] * np.uint64(256) + data[n - 1 :]
        same = of[: len(gram)] == of[n - 1 :]
        found.append((of[: len(gram)][same], gram[same] + np.uint64(n << 40)))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _repeats(of: np.ndarray, values: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and eighths of a text's values that occurred in it before, for texts with a few values."""
    keys = np.sort((of.astype(np.uint64) << np.uint64(40)) | (values >> np.uint64(24)))
    o = (keys >> np.uint64(40)).astype(np.int64)
    again = np.zeros(len(o), dtype=np.int64)
    again[1:] = keys[1:] == keys[:-1]
    total = np.bincount(o, minlength=count)
    some = np.flatnonzero(total >= 2)
    share = np.bincount(o, weights=again, minlength=count)[some] * 8 // total[some]
    return some, share.astype(np.uint64)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs in order: text numbers and feature numbers. Every text, also an
    empty or null one, has at least one feature, which only says how long it is."""
    plain = [t or "" for t in texts]
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    lengths = np.array([len(t).bit_length() for t in plain], dtype=np.uint64)
    pairs.append((np.arange(len(plain)), _numbered(1, lengths)))
    words = Words(plain, _RAW_SPACE)
    of, hashes = words.of, words.hashes
    pairs.append((of, _numbered(2, hashes)))
    if len(of) > 1:
        near = of[1:] == of[:-1]
        twin = near & (hashes[1:] == hashes[:-1])
        with np.errstate(over="ignore"):
            both = hashes[1:] * np.uint64(3) + hashes[:-1]
        pairs.append((of[1:][near], _numbered(3, both[near])))
        for least in (1, 4, 16, 64):
            many = np.flatnonzero(np.bincount(of[1:][twin], minlength=len(plain)) >= least)
            pairs.append((many, _numbered(4, np.full(len(many), least, dtype=np.uint64))))
        some, share = _repeats(of, hashes, len(plain))
        pairs.append((some, _numbered(5, share)))
        some, share = _repeats(of[1:][near], both[near], len(plain))
        pairs.append((some, _numbered(6, share)))
    shape_of, shapes = _shapes(plain)
    if len(shape_of):
        keys = shape_of.astype(np.int64) << BITS | _numbered(7, shapes)
        kinds, counts = counted(keys)
        at, number = kinds >> BITS, (kinds & (SIZE - 1)).astype(np.uint64)
        for least in (1, 4, 16):
            many = counts >= least
            pairs.append((at[many], _numbered(8, number[many] + np.uint64(least << 32))))
    keys = distinct(np.concatenate([a.astype(np.int64) << BITS | b for a, b in pairs]))
    return keys >> BITS, keys & (SIZE - 1)


@dataclass(frozen=True)
class Model:
    """``weights`` already holds the log-count ratios; a text's margin is the sum over its features,
    divided by the length of its scaled vector, plus ``bias``."""

    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        at, number = features(texts)
        sums = np.bincount(at, weights=self.weights[number], minlength=len(texts))
        norm = np.sqrt(np.bincount(at, weights=self.ratios[number] ** 2, minlength=len(texts)))
        margin = sums / np.maximum(norm, 1e-9) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin, -40, 40)))


def log_count_ratios(good: np.ndarray, bad: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    good, bad = good + smoothing, bad + smoothing
    return np.log(good / good.sum()) - np.log(bad / bad.sum())


def fit_hinge(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, cost: float, epochs: int, seed: int = 0) -> Model:
    """Dual coordinate descent for the hinge loss; each row is scaled to unit length, classes weigh alike."""
    rng = np.random.default_rng(seed)
    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.where(signs > 0, max((signs > 0).mean(), 1e-9), max((signs < 0).mean(), 1e-9))
    upper = cost * 0.5 / share
    scaled = []
    for row in rows:
        x = ratios[row]
        scaled.append(x / max(np.sqrt(x @ x), 1e-9))
    w, bias, alpha = np.zeros(len(ratios)), 0.0, np.zeros(len(rows))
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            row, x, y = rows[i], scaled[i], signs[i]
            gradient = y * (w[row] @ x + bias) - 1
            step = min(max(alpha[i] - gradient / 2, 0.0), upper[i]) - alpha[i]  # unit rows and a unit bias feature: 2
            if step:
                alpha[i] += step
                w[row] += step * y * x
                bias += step * y
    margins = np.array([w[row] @ x for row, x in zip(rows, scaled, strict=True)]) + bias
    slope = _slope(margins, signs, 0.5 / share)
    return Model(w * ratios, ratios, float(bias), slope)


def _slope(margins: np.ndarray, signs: np.ndarray, weights: np.ndarray) -> float:
    """The logistic slope of best likelihood among a few; it keeps the decision and only spreads scores."""
    choices = (0.5, 1.0, 2.0, 3.0, 5.0, 8.0)
    return min(choices, key=lambda s: float((weights * np.logaddexp(0, -s * signs * margins)).sum()))


def fit_rows(rows: list[np.ndarray], labels: np.ndarray, cost: float, epochs: int) -> Model:
    """A model from the feature numbers of each row."""
    sums = [np.bincount(np.concatenate([r for r, y in zip(rows, labels, strict=True) if y == label] or [np.empty(0, np.int64)]), minlength=SIZE) for label in (0, 1)]
    return fit_hinge(rows, labels, log_count_ratios(sums[1], sums[0]), cost, epochs)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 0, fold: int = 0, sample: int = 8_000, cost: float = 1.0, epochs: int = 12) -> Model:
    """A model from at most ``sample`` labelled documents, those whose ids have the smallest hash.

    With ``folds``, rows of one fold of crc32(doc_id) are left out. A doc_id with several labels counts with the largest;
    null ids and labels, labels but 0 and 1 and labels without a document are left out. Without rows of a class, scores lean
    to the class that there is. The chosen ids are broadcast (``sample`` bounds them), so no text is shuffled.
    """
    wanted = labels.where("doc_id is not null and quality in (0, 1)")
    if folds:
        wanted = wanted.where(~in_fold(F.col("doc_id"), folds, fold))
    one = wanted.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def numbered(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, number = features(batch.column(1).to_pylist())
        cuts = np.searchsorted(at, np.arange(1, batch.num_rows))
        each = [part.astype("<i4").tobytes() for part in np.split(number, cuts)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(each, pa.binary())], names=["quality", "numbers"])

    training = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", "text")
    got = training.mapInArrow(by_batch(numbered), "quality int, numbers binary").collect()
    got.sort(key=lambda r: (r.quality, r.numbers))
    model = fit_rows([np.frombuffer(r.numbers, "<i4") for r in got], np.array([r.quality for r in got], dtype=np.int64), cost, epochs)
    del got
    give_back()  # the driver goes on to other stages
    return model


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, higher: better) of every row, by its text alone; null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(batch.column(1).to_pylist()))], names=["doc_id", "score"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(by_batch(score), "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, with a score of ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at = [c.lower() for c in docs.columns].index("text")

    def choose(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(shared.value.scores(batch.column(text_at).to_pylist()) >= least))

    return docs.mapInArrow(by_batch(choose, text_at), docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """doc_id, held_out, score and predicted of every row. Null doc_ids are not held out; rows with
    repeated ids are scored each. Empty tables give an empty result."""
    found = scored(docs, fit(docs, labels, folds, fold))
    return found.select(
        "doc_id", in_fold(F.col("doc_id"), folds, fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
