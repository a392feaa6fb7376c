"""Personal data by a semi-Markov conditional random field over exact base patterns.

Base spans (e-mail, IP address, card, phone) come from four patterns with their checks and always stay. The field
then labels the rest. A window is a stretch of tokens around digits and at signs; every run of up to ``SPAN``
tokens is a candidate segment with features of the *whole* span (its shape, digit count, check sum, address form,
neighbours). Dynamic programming over the window chooses boundaries and kinds together; plain words outside
windows can only be "none", so windows are independent and the result is that of the whole text.

The field is trained here: its windows are a bounded sample (``sample``, rows with the smallest hash) labelled by
the base patterns, with phones also shown without their country prefix, so that it learns forms which the patterns miss.
Its log-likelihood is maximised with the forward-backward recursions. Weights have a fixed size and are broadcast.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise.llm.common import by_batch, give_back, slices

#: Fixed kinds, in the order of the results.
KINDS = ("email", "ip", "card", "phone")
#: Most tokens of a segment.
SPAN = 6
#: Windows that the field learns from; tokens of a window that it learns, and characters that these may have in all.
SAMPLE, LEARNED_TOKENS, LEARNED_CHARS = 1500, 4 * SPAN, 2000
#: Tasks that narrow the windows of all tasks to those with the smallest hashes, and those that narrow theirs for the driver.
_MERGERS, _LAST = 64, 4
_FEATURES = 1 << 13
_NONE = len(KINDS)

_TRIGGER = re.compile("[0-9@]")
_LOCAL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_EMAIL_HERE, _EMAIL = re.compile(_LOCAL), re.compile(r"(?<![A-Za-z0-9._%+-])" + _LOCAL)
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]")
_TOKEN = re.compile(r"\S+")
_EDGE = ".,;:!?\"'"

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost matches that do not overlap. A start inside a run of address signs can only win right behind the match
    before, so all other starts are those of runs; that keeps long runs linear."""
    found, at = [], 0
    while text.find("@", at) >= 0:
        match = _EMAIL_HERE.match(text, at) or _EMAIL.search(text, at)
        if not match:
            break
        found.append(("email", match.start(), match.end()))
        at = match.end()
    return found


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[Span]:
    """The base spans by start, then kind."""
    if not _TRIGGER.search(text):
        return []
    found = _emails(text)
    found += [("ip", *m.span()) for m in _IP.finditer(text) if _is_ip(m[0])]
    found += [("card", *m.span()) for m in _CARD.finditer(text) if _is_card(m[0])]
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


@dataclass
class Window:
    """Consecutive tokens: their text without marks at the edges, and its place."""

    tokens: list[str]
    starts: list[int]
    ends: list[int]


def windows(text: str) -> list[Window]:
    """Stretches of tokens with a digit or at sign, with one plain neighbour at either side."""
    hits = [m.start() for m in _TRIGGER.finditer(text)]
    found: list[Window] = []
    done = 0
    for hit in hits:
        if hit < done:
            continue
        begin = _token_start(text, hit, done)
        before = _token_start(text, begin - 1, done) if begin > done else begin
        window, at = Window([], [], []), max(before, done)
        while match := _TOKEN.search(text, at):
            _append(window, match)
            at = match.end()
            if match.start() >= begin and not _TRIGGER.search(match[0]):
                break
        done = at
        if window.tokens:
            found.append(window)
    return found


def _token_start(text: str, at: int, least: int) -> int:
    """Where the token before or at a place begins; looks back to ``least`` at most, so that all windows of a text cost its length."""
    while at > least and text[at - 1 : at].isspace():
        at -= 1
    while at > least and not text[at - 1].isspace():
        at -= 1
    return max(at, 0)


def _append(window: Window, match: re.Match) -> None:
    token = match[0]
    left = len(token) - len(token.lstrip(_EDGE))
    core = token.strip(_EDGE)
    window.tokens.append(core or token[:1])
    window.starts.append(match.start() + (left if core else 0))
    window.ends.append(match.start() + (left + len(core) if core else 1))


def _shape(text: str) -> str:
    return re.sub("[^\\W\\d_]+", "a", re.sub("[0-9]", "9", text))


def segment_features(tokens: list[str], i: int, j: int) -> list[int]:
    """Numbers of the features of tokens i to j - 1 as one span."""
    span = " ".join(tokens[i:j])
    shape, digits = _shape(span), _digits(span)
    coarse = re.sub("9+", "9", shape)
    names = [f"shape={shape[:40]}", f"coarse={coarse[:24]}", f"size={j - i}", f"first={shape[:1]}", f"last={shape[-1:]}",
             f"digits={min(len(digits), 20)}", f"kinds={''.join(sorted(set(coarse)))[:12]}"]
    if "@" in span:
        names.append(f"address={bool(_EMAIL_HERE.fullmatch(span))}")
    if span.count(".") == 3 and "9" in coarse:
        names.append(f"quad={bool(_IP.fullmatch(span)) and _is_ip(span)}")
    if 14 <= len(digits) <= 19:
        names.append(f"sum={luhn(digits)},{coarse.strip('9 -') == ''}")
    if 10 <= len(digits) <= 15:
        names.append(f"dial={span[:1] in '+('},{'(' in span and ')' in span},{'a' not in coarse}")
    if i:
        names.append(f"before={re.sub('9+', '9', _shape(tokens[i - 1]))[-3:]}")
    if j < len(tokens):
        names.append(f"after={re.sub('9+', '9', _shape(tokens[j]))[:3]}")
    return [zlib.crc32(n.encode()) % _FEATURES for n in names]


def _may_be(tokens: list[str], i: int, j: int) -> bool:
    """Whether a kind other than none is worth scoring: both edge tokens hold a digit or at sign."""
    return bool(_TRIGGER.search(tokens[i]) and _TRIGGER.search(tokens[j - 1]))


def _first_from_none(scores: np.ndarray) -> np.ndarray:
    """Kind of the highest score in each column; of equal ones none, then the last kind."""
    return _NONE - scores[::-1].argmax(axis=0)


@dataclass
class Field:
    """Weights of (feature, kind) and of (kind, kind next to it); the last kind is none."""

    weights: np.ndarray
    moves: np.ndarray

    @staticmethod
    def zero() -> Field:
        return Field(np.zeros((_FEATURES, _NONE + 1)), np.zeros((_NONE + 1, _NONE + 1)))

    def scores(self, tokens: list[str]) -> dict[tuple[int, int], tuple[list[int], np.ndarray]]:
        """Feature numbers and the score of each kind for every candidate segment."""
        found = {}
        for i in range(len(tokens)):
            for j in range(i + 1, min(i + SPAN, len(tokens)) + 1):
                kinds = _may_be(tokens, i, j)
                if kinds or j == i + 1:
                    numbers = segment_features(tokens, i, j)
                    score = self.weights[numbers].sum(axis=0)
                    if not kinds:
                        score[:_NONE] = -np.inf
                    if j > i + 1:
                        score[_NONE] = -np.inf
                    found[i, j] = numbers, score
        return found

    def best(self, tokens: list[str]) -> list[tuple[int, int, int]]:
        """The segmentation of highest score: (first token, end, kind), without none, which wins ties: a field of zeros labels nothing."""
        scores, n = self.scores(tokens), len(tokens)
        value = np.full((n + 1, _NONE + 1), -np.inf)
        value[0, _NONE] = 0.0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for j in range(1, n + 1):
            for i in range(max(0, j - SPAN), j):
                if (i, j) in scores:
                    came = value[i][:, None] + self.moves
                    before = _first_from_none(came)
                    total = came.max(axis=0) + scores[i, j][1]
                    for kind in np.flatnonzero(total > value[j]).tolist():
                        value[j, kind] = total[kind]
                        back[j, kind] = i, int(before[kind])
        out, j, kind = [], n, int(_first_from_none(value[n]))
        while j:
            i, before = back[j, kind]
            if kind != _NONE:
                out.append((i, j, kind))
            j, kind = i, before
        return out[::-1]

    def gradient(self, tokens: list[str], gold: list[tuple[int, int, int]]) -> tuple[list[tuple[list[int], np.ndarray]], np.ndarray]:
        """Observed minus expected counts: (feature numbers, amount by kind) of each segment, and of the moves."""
        scores, n = self.scores(tokens), len(tokens)
        ahead = np.full((n + 1, _NONE + 1), -np.inf)
        ahead[0, _NONE] = 0.0
        with np.errstate(divide="ignore"):
            for j in range(1, n + 1):
                for i in range(max(0, j - SPAN), j):
                    if (i, j) in scores:
                        ahead[j] = np.logaddexp(ahead[j], np.logaddexp.reduce(ahead[i][:, None] + self.moves, axis=0) + scores[i, j][1])
            behind = np.full((n + 1, _NONE + 1), -np.inf)
            behind[n] = 0.0
            for i in range(n - 1, -1, -1):
                for j in range(i + 1, min(i + SPAN, n) + 1):
                    if (i, j) in scores:
                        behind[i] = np.logaddexp(behind[i], np.logaddexp.reduce(self.moves + (scores[i, j][1] + behind[j])[None, :], axis=1))
            whole = np.logaddexp.reduce(ahead[n])
        pieces, moves = [], np.zeros_like(self.moves)
        wanted = {(i, j): kind for i, j, kind in gold}
        covered = {t for i, j, _ in gold for t in range(i, j)}
        wanted |= {(t, t + 1): _NONE for t in range(n) if t not in covered}
        for (i, j), (numbers, score) in scores.items():
            share = np.exp(ahead[i][:, None] + self.moves + (score + behind[j])[None, :] - whole)
            amount = -share.sum(axis=0)
            moves -= share
            if (i, j) in wanted:
                amount[wanted[i, j]] += 1
            pieces.append((numbers, amount))
        last = _NONE
        for _, kind in sorted(wanted.items()):
            moves[last, kind] += 1
            last = kind
        return pieces, moves


def labelled(window: Window, spans: list[Span]) -> list[tuple[int, int, int]]:
    """Base spans that lie on token edges of the window, as segments; of spans that overlap, the first."""
    starts, ends = {s: k for k, s in enumerate(window.starts)}, {e: k for k, e in enumerate(window.ends)}
    found, done = [], 0
    for kind, start, end in spans:
        i, j = starts.get(start), ends.get(end)
        if i is not None and j is not None and i >= done and j - i < SPAN:
            found.append((i, j + 1, KINDS.index(kind)))
            done = j + 1
    return found


def train(examples: list[tuple[list[str], list[tuple[int, int, int]]]], epochs: int = 4, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """A field of high likelihood by adaptive gradient steps, in the given order."""
    field = Field.zero()
    seen, seen_moves = np.full_like(field.weights, 1e-6), np.full_like(field.moves, 1e-6)
    for _ in range(epochs):
        for tokens, gold in examples:
            pieces, moves = field.gradient(tokens, gold)
            step: dict[int, np.ndarray] = {}
            for numbers, amount in pieces:
                if np.abs(amount).max() > 1e-4:
                    for number in numbers:
                        step[number] = step.get(number, 0) + amount
            for number, amount in step.items():
                amount = amount - decay * field.weights[number]
                seen[number] += amount**2
                field.weights[number] += rate * amount / np.sqrt(seen[number])
            moves = moves - decay * field.moves
            seen_moves += moves**2
            field.moves += rate * moves / np.sqrt(seen_moves)
    return field


def _without_prefix(tokens: list[str], gold: list[tuple[int, int, int]]) -> tuple[list[str], list[tuple[int, int, int]]] | None:
    """The same example with the first phone's country prefix left out, if it is a token of its own."""
    for at, (i, j, kind) in enumerate(gold):
        if KINDS[kind] == "phone" and j - i > 1 and re.fullmatch(r"\+[0-9]{1,3}", tokens[i]):
            rest = [(a - 1, b - 1, k) for a, b, k in gold[at + 1 :]]
            return tokens[:i] + tokens[i + 1 :], [*gold[:at], (i, j - 1, kind), *rest]
    return None


class _Smallest:
    """The distinct windows with the smallest hashes among those added, ``sample`` of them at most."""

    def __init__(self, sample: int):
        self.sample, self.found = sample, {}

    def add(self, key: int, tokens: list[str], gold: list[int]) -> None:
        self.found[key] = tokens, gold
        if len(self.found) > 4 * self.sample:
            self.cut()

    def cut(self) -> None:
        self.found = {k: self.found[k] for k in sorted(self.found)[: self.sample]}

    def batch(self) -> pa.RecordBatch:
        self.cut()
        kinds = (pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()))
        columns = list(self.found), [t for t, _ in self.found.values()], [g for _, g in self.found.values()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "tokens", "gold"])


def _key(tokens: list[str], gold: list[int]) -> int:
    text = "\0".join(tokens) + f"\0{gold}"
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """A field from at most ``sample`` windows of all of ``docs``: the distinct ones with the smallest hashes.

    Each task keeps that many windows, and some tasks narrow those of all to as many again, so how often a text is repeated, or how many
    rows there are, does not matter. Of a window only the first LEARNED_TOKENS tokens are learned, and none that
    has more than LEARNED_CHARS characters in them. Without any window the field is zero and labels nothing.
    """

    def cut(batches):
        kept = _Smallest(sample)
        for batch in (some for whole in batches for some in slices(whole, 0)):
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                for window in windows(text):
                    tokens = window.tokens[:LEARNED_TOKENS]
                    if sum(map(len, tokens)) <= LEARNED_CHARS:
                        gold = [n for s in labelled(window, spans) if s[1] <= LEARNED_TOKENS for n in s]
                        kept.add(_key(tokens, gold), tokens, gold)
            give_back()
        yield kept.batch()

    def narrow(batches):
        kept = _Smallest(sample)
        for batch in batches:
            for row in batch.to_pylist():
                kept.add(row["key"], row["tokens"], row["gold"])
        yield kept.batch()

    schema = "key long, tokens array<string>, gold array<int>"
    found = docs.select("text").where(F.col("text").rlike("[0-9@]")).mapInArrow(cut, schema)
    found = found.repartition(_MERGERS, "key").mapInArrow(narrow, schema).repartition(_LAST).mapInArrow(narrow, schema)
    rows = found.orderBy("key").limit(sample).collect()
    examples = []
    for row in rows:
        gold = [tuple(row.gold[i : i + 3]) for i in range(0, len(row.gold), 3)]
        examples.append((row.tokens, gold))
        if other := _without_prefix(row.tokens, gold):
            examples.append(other)
    field = train(examples)
    give_back()  # the driver goes on to other stages
    return field


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and these with the field's spans that overlap none of them."""
    base = base_spans(text)
    if not _TRIGGER.search(text):
        return base, base
    taken = sorted((s[1], s[2]) for s in base)
    more, at = [], 0
    for window in windows(text):
        for i, j, kind in field.best(window.tokens):
            start, end = window.starts[i], window.ends[j - 1]
            while at < len(taken) and taken[at][1] <= window.starts[0]:
                at += 1
            if not _overlaps(taken, at, start, end):
                more.append((KINDS[kind], start, end))
    return base, in_order(base + more)


def _overlaps(taken: list[tuple[int, int]], at: int, start: int, end: int) -> bool:
    while at < len(taken) and taken[at][0] < end:
        if taken[at][1] > start:
            return True
        at += 1
    return False


def written_out(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, counts of the base spans by kind, base_sha256 and spans of every row. Null texts count as empty and have
    no spans. Rows are independent: null and repeated doc_ids give a row each; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [all_spans(t or "", shared.value) for t in batch.column(1).to_pylist()]
        counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
        sums = [hashlib.sha256(written_out(base).encode()).hexdigest() for base, _ in found]
        return pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(sums, pa.string()), pa.array([written_out(s) for _, s in found], pa.string())], names=names)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(by_batch(find), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(text: str, spans: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by its first kind in angle brackets."""
    out, at = [], 0
    merged: list[list] = []
    for kind, start, end in spans:
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[at:start], f"<{kind}>"]
        at = end
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by its kind; all other columns stay, but for ``n_chars``, which follows
    a changed text. Null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    names, schema = docs.columns, docs.schema
    lower = [c.lower() for c in names]
    text_at, size_at = lower.index("text"), lower.index("n_chars") if "n_chars" in lower else None

    def hide(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(batch.columns)
        texts = columns[text_at].to_pylist()
        spans = [all_spans(t or "", shared.value)[1] for t in texts]
        columns[text_at] = pa.array([redact(t, s) if s else t for t, s in zip(texts, spans, strict=True)], pa.string())
        if size_at is not None:
            sizes = [len(t) if s else n for t, s, n in zip(columns[text_at].to_pylist(), spans, columns[size_at].to_pylist(), strict=True)]
            columns[size_at] = pa.array(sizes, columns[size_at].type)
        return pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(by_batch(hide, text_at), schema)
