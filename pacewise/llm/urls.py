"""URL filter: rules first, then a naive Bayes model over segmented host and path words.

A name such as ``freebetsonline`` is split by Viterbi search over unigram word frequencies, counted over the visible text of all
pages and over the words that hyphens of hosts and slashes of paths already separate. Multinomial naive Bayes scores the words of
host and path. It learns from all urls, with weak labels: a url one of whose words is a seed word is an example to block, any other
one to allow. The model knows the most frequent words (``words`` at most, and all seeds); pieces that no word explains count as one word.

``verdict`` is that of the longest fitting rule, else ``block`` where the probability ``score`` is above 0.5. A null url, one
without ``://`` and one without words are allowed by the method with score 0. Repeated rows are judged each, other columns are not
read, an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import OrderedDict
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.llm.common import LOWER, UPPER, written

#: Words of hosts and paths that mark unwanted pages.
SEEDS = (
    "adult", "ads", "adserver", "bet", "bets", "betting", "bingo", "blackjack", "cam", "casino", "cialis", "crack", "cracked",
    "escort", "escorts", "gamble", "gambling", "hentai", "jackpot", "keygen", "loan", "loans", "lottery", "nude", "nudes",
    "payday", "pharmacy", "phishing", "pills", "poker", "porn", "porno", "roulette", "serial", "sex", "sexy", "slots", "spam",
    "spammer", "spyware", "torrent", "tracker", "viagra", "warez", "webcam", "xxx",
)
#: Words that the model knows.
WORDS = 1 << 17
#: Added to the count of each word that some url has, in both classes; words that none has tell nothing.
SMOOTHING = 0.1
#: Letters of the longest word, and names that a worker remembers.
LONGEST, REMEMBERED = 24, 1 << 15

_LETTERS = re.compile(r"[^\W\d_]+")
Rule = tuple[str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower-case ASCII and path of a url; empty where there is no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host, path = (F.regexp_extract(rest, r"^([^/?#]*+)([^?#]*+)", part) for part in (1, 2))
    return F.translate(host, UPPER, LOWER), path


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, the first of equally long ones, or nulls.

    ``rules`` is a list of (verdict, host and path) that a person keeps; its tests become part of the plan.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        domain, slash, start = text.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + start)
        name, verdict = F.when(fits, text).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}++"), F.lit(0))


def known_words(pages: DataFrame, words: int = WORDS) -> DataFrame:
    """``word, n`` of the most frequent words of visible texts, of paths and of hosts with hyphens, over all pages.

    Known are all words that occur at least 2^k times, for the smallest k that leaves no more than ``words`` of them.
    """
    html = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1>", " ")
    visible = F.regexp_replace(html, r"<[^>]*+>", " ")
    host, path = host_and_path(F.col("url"))
    parts = F.filter(F.split(host, "[.]"), lambda p: p.contains("-"))
    every = F.concat(_words_of(visible), _words_of(path), _words_of(F.array_join(parts, ".")))
    found = pages.select(F.explode(every).alias("word")).where(F.length("word") <= LONGEST)
    counts = written(found.groupBy("word").agg(F.count("*").alias("n")), "words")
    level = F.length(F.bin("n")).alias("level")
    least, held = 64, 0
    for row in counts.groupBy(level).count().orderBy(F.desc("level")).collect():  # 64 rows at most
        held += row["count"]
        if held > words:
            break
        least = row.level - 1
    return counts.where(F.shiftright("n", least) > 0) if least < 64 else counts.limit(0)


class Segmenter:
    """Viterbi search for the likeliest split of a name, with a bounded memory of names."""

    def __init__(self, counts: dict[str, int]):
        total = sum(counts.values()) + 1
        self.cost = {w: -math.log(n / total) for w, n in counts.items()}
        self.longest = max(map(len, counts), default=1)
        self.unknown = math.log(total) + math.log(10)
        self.seen: OrderedDict[str, list[str]] = OrderedDict()

    def split(self, name: str) -> list[str]:
        """Words of a name of letters; letters that no word explains stay together as one piece.

        An unknown piece costs ten times a word seen once for each of its letters, so known words are preferred.
        """
        if name in self.seen:
            return self.seen[name]
        n = len(name)
        best, back = [0.0] + [math.inf] * n, [0] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                cost = best[start] + self.cost.get(name[start:end], math.inf)
                if cost < best[end]:
                    best[end], back[end] = cost, start
            cost = best[end - 1] + self.unknown
            if cost < best[end]:
                best[end], back[end] = cost, -1
        words: list[str] = []
        end, open_piece = n, ""
        while end:
            if back[end] < 0:
                open_piece = name[end - 1] + open_piece
                end -= 1
                continue
            if open_piece:
                words.append(open_piece)
                open_piece = ""
            words.append(name[back[end] : end])
            end = back[end]
        if open_piece:
            words.append(open_piece)
        words.reverse()
        if n <= 256:
            self.seen[name] = words
            if len(self.seen) > REMEMBERED:
                self.seen.popitem(last=False)
        return words

    def words(self, host: str, path: str) -> list[str]:
        return [w for name in _LETTERS.findall(f"{host} {path}".lower()) for w in self.split(name)]


class Model:
    """Word frequencies and log ratios of the two classes; its size is bounded by the number of known words."""

    def __init__(self, counts: dict[str, int], seeds: Sequence[str]):
        self.seeds = frozenset(seeds)
        self.counts = counts
        self.place = {w: i + 1 for i, w in enumerate(counts)}
        self.ratio = np.zeros(len(counts) + 1)
        self.prior = 0.0
        self._segmenter: Segmenter | None = None

    def __getstate__(self):
        return self.__dict__ | {"_segmenter": None}

    @property
    def segmenter(self) -> Segmenter:
        if self._segmenter is None:
            self._segmenter = Segmenter(self.counts)
        return self._segmenter

    def score(self, words: list[str]) -> float:
        if not words:
            return 0.0
        odds = self.prior + sum(float(self.ratio[self.place.get(w, 0)]) for w in words)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def fit(pages: DataFrame, words: int = WORDS, seeds: Sequence[str] = SEEDS) -> Model:
    """The model, from all pages. At most ``words`` rows with counts, and as many sums, come to the driver."""
    known = {r.word: r.n for r in known_words(pages, words).collect()}
    for seed in seeds:
        known[seed] = known.get(seed, 0) + 1
    model = Model(known, seeds)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def tally(batches):
        sums, urls = np.zeros((2, len(shared.value.ratio)), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for batch in batches:
            for host, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = shared.value.segmenter.words(host, path)
                if found:
                    kind = int(not shared.value.seeds.isdisjoint(found))
                    urls[kind] += 1
                    for w in found:
                        sums[kind, shared.value.place.get(w, 0)] += 1
        kinds, places = np.nonzero(sums)
        columns = [np.append(kinds, [0, 1]), np.append(places, [-1, -1]), np.append(sums[kinds, places], urls)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["kind", "place", "n"])

    host, path = host_and_path(F.col("url"))
    rows = pages.select(host.alias("host"), path.alias("path")).mapInArrow(tally, "kind long, place long, n long")
    sums, urls = np.zeros((2, len(model.ratio))), np.ones(2)
    for row in rows.groupBy("kind", "place").agg(F.sum("n").alias("n")).collect():
        if row.place < 0:
            urls[row.kind] += row.n
        else:
            sums[row.kind, row.place] += row.n
    used = sums.sum(axis=0) > 0
    smooth = sums[:, used] + SMOOTHING
    model.ratio[used] = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    model.prior = float(np.log(urls[1] / urls[0]))
    return model


def judged(pages: DataFrame, model: Model, rules: Sequence[Rule] = ()) -> DataFrame:
    """``page_id, host, path, rule, verdict, score, words`` of every url."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            found = [shared.value.segmenter.words(h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            scores = pa.array([shared.value.score(w) for w in found], pa.float64())
            words = pa.array([" ".join(w) for w in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores, words], [*batch.schema.names, "score", "words"])

    host, path = host_and_path(F.col("url"))
    located = pages.select("page_id", host.alias("host"), path.alias("path"))
    types = ", ".join(f"{n} {t}" for n, t in located.dtypes)
    scored = located.mapInArrow(score, f"{types}, score double, words string")
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "score", "words")
