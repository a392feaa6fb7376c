"""Operators whose result for a row depends on that row alone, against plain re-statements."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pacewise.llm import decontamination, language, licenses, personal_data, quality, token_counts
from tests.llm.helpers import with_clashes, words

ODD = [None, "", " ", "\n\n  x", "a" * 300_000, "1 " * 20_000, "é" * 5_000, "日本語 テキスト", "<|endoftext|> x", "same text", "same text", "\0 \x1c 🙂"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(n if n != 3 else None, t) for n, t in enumerate(ODD)] + [(9, "same text")]
    return with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def by_id(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=repr)


def _mixed(seed, pieces, count, most):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, most))) for _ in range(count)]


# Token counts

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_token_counts_are_the_library_s(spark, odd):
    pieces = ["a", "b's", " ", "  ", "\n", "\n\n", "\t", "<|endoftext|>", "\0", "é", "1", "2.", "!", "'ll", "\xa0", "　", "日本", "word", " the", "\x1c", "\r\n", "\x85"]
    library = Tokenizer.from_file(BYTES)
    counter = token_counts._Counter(BYTES, token_counts.frequent_lengths(BYTES))
    texts = _mixed(1, pieces, 8000, 12)
    assert counter.counts(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    got = token_counts.token_counts(odd, BYTES, limit=100).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect()]
    assert by_id(got, "doc_id", "n_bytes", "n_tokens") == sorted(want, key=repr)
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_PIECES", 3)
    counter, library = token_counts._Counter(BYTES, {}), Tokenizer.from_file(BYTES)
    for text in ("one two three four", "five six", "one two"):
        assert counter.counts([text]) == [len(library.encode(text, add_special_tokens=False).ids)]


# Benchmark passages


def _hits(texts, items):
    windows = {}
    for name, text in items:
        w = words(text)
        for i in range(max(len(w) - 10, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(name)
    lengths, out = {len(k) for k in windows}, []
    for text in texts:
        w, found = words(text), set()
        hit = [False] * len(w)
        for i in range(len(w)):
            for n in lengths:
                if tuple(w[i : i + n]) in windows and i + n <= len(w):
                    found |= windows[tuple(w[i : i + n])]
                    hit[i : i + n] = [True] * n
        out.append((len(w), sum(hit), sorted(found)))
    return out


def test_fm_index_finds_what_a_scan_finds(spark):
    rng = random.Random(2)
    docs, items = [], []
    for _ in range(60):
        letters = ["a", "B", "c1", "é", "dd"][: rng.randint(2, 5)]
        items.append((len(items), " ".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 9, 10, 11, 13])))))
        docs.append((len(docs), None if rng.random() < 0.1 else ", ".join(rng.choice([*letters, "zz"]) for _ in range(rng.randint(0, 60)))))
    items = [i for i in items if len(words(i[1])) != 1] + [(7, None), (None, "a a a"), (8, "zz zz"), (8, "zz zz")]
    want = [(d[0], n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0)
            for d, (n, h, i) in zip(docs, _hits([t for _, t in docs], [(str(n), t) for n, t in items if n is not None and t]), strict=True)]
    got = decontamination.hit_counts(with_clashes(spark.createDataFrame(docs, "doc_id long, text string")), spark.createDataFrame(items, "item_id long, text string"))
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert got.columns == columns and by_id(got.collect(), *columns) == sorted(want, key=repr)


def test_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "x one two three y four five z"), (2, "one two three four five"), (3, "none")], "doc_id long, text string")
    items = spark.createDataFrame([(n, t) for n, t in enumerate(["one two", "two three", "four five", "three four", "one two"])], "item_id long, text string")
    whole = decontamination.contaminations(docs, items).collect()
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 40)
    assert decontamination.contaminations(docs, items).collect() == whole
    assert whole[1]["spans"] == [0, 5, 0, 23] and whole[1]["item_ids"] == ["0", "1", "2", "3", "4"]


def test_passages_are_cut_out(spark):
    passage = "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 p11"
    rows = [(1, f"Before, é {passage.upper()}! after", 5), (2, passage, 1), (3, "clean", 5), (4, None, 0)]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string, n_chars long"))
    got = {r.doc_id: r for r in decontamination.cleaned(docs, spark.createDataFrame([(1, passage)], "item_id long, text string")).collect()}
    assert got[1].text == "Before, é ! after" and got[1].n_chars == 17
    assert got[3].text == "clean" and got[4].text is None and 2 not in got
    assert got[1].asDict().keys() == set(docs.columns)


def test_nothing_to_find(spark, odd, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontamination.hit_counts(odd, none).collect())
    assert decontamination.hit_counts(empty, spark.createDataFrame([(1, "a")], "item_id long, text string")).collect() == []


# Personal data

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def _base(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            luhn = sum((n * 2 - 9 * (n > 4)) if i % 2 else n for i, n in enumerate(digits[::-1])) % 10 == 0
            if {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")), "card": 14 <= len(digits) <= 19 and luhn, "phone": 10 <= len(digits) <= 15}[kind]:
                found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


PII = [*"ab@._-+1 5().%é", "1.2.3.4", "4111 1111 1111 1111", "x@y.z", "+1 (234) 555-6789", "255", "@a.b"]


def test_base_spans():
    for text in _mixed(1, PII, 20_000, 25):
        assert personal_data.base_spans(text) == _base(text), text


@pytest.fixture(scope="module")
def field(spark):
    rng = random.Random(3)
    forms = ["jo.na{}@mail.example.com", "10.2.{}.7", "+1 (212) 555-01{}", "4111111111111111", "{} apples", "version {}", "a @ b"]
    rows = [(n, "word " * rng.randint(0, 4) + rng.choice(forms).format(rng.randint(10, 99)) + " more words." + "\n" * rng.randint(0, 2)) for n in range(600)]
    return personal_data.fit(spark.createDataFrame(rows, "doc_id long, text string"), sample=400)


def test_the_field_keeps_base_spans_and_adds_what_patterns_miss(spark, field, odd):
    for text in _mixed(5, [*PII, " word ", " word "], 800, 20):
        base, every = personal_data.all_spans(text, field)
        assert base == _base(text) and set(base) <= set(every)
        assert every == personal_data.in_order(every)
    tied = "call +1 (212) 555-0134 4111111111111111 now"  # the phone's pattern runs into the card's digits and fails
    assert ("phone", 5, 22) not in _base(tied) and ("phone", 5, 22) in personal_data.all_spans(tied, field)[1]
    assert personal_data.all_spans("chapter 12 has 300 words", field) == ([], [])
    got = personal_data.personal_data(odd, field).collect()
    assert len(got) == odd.count() and all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got if not r.doc_id)


def test_segmentation_is_the_best_of_all(field):
    """The dynamic programme against every segmentation of short windows."""

    def every(n, start=0):
        if start == n:
            yield []
        for end in range(start + 1, min(start + personal_data.SPAN, n) + 1):
            for kind in range(personal_data._NONE + 1):
                for rest in every(n, end):
                    yield [(start, end, kind), *rest]

    def score(path, scores):
        total, last = 0.0, personal_data._NONE
        for i, j, kind in path:
            total += field.moves[last, kind] + (scores[i, j][1][kind] if (i, j) in scores else -np.inf)
            last = kind
        return total

    for tokens in (["+1", "(212)", "555-0134"], ["a", "4111111111111111", "x"], ["10.2.3.7", "b@c.de"]):
        scores = field.scores(tokens)
        best = max(every(len(tokens)), key=lambda path: score(path, scores))
        assert field.best(tokens) == [s for s in best if s[2] != personal_data._NONE]


def test_the_field_learns_from_repeated_texts(spark):
    """Windows count once, however often their text is repeated; without any, the field labels nothing."""
    few = [f"call +49 30 {n:07} 12 or mail a{n}@mail.example.com today" for n in range(50)]
    types = "doc_id long, text string"
    plain = spark.createDataFrame(list(enumerate(few)), types)
    hot = spark.createDataFrame([(n, few[0]) for n in range(5000)] + list(enumerate(few)) * 2, types).repartition(7)
    one, other = personal_data.fit(plain), personal_data.fit(hot)
    assert one.weights.any() and np.array_equal(one.weights, other.weights) and np.array_equal(one.moves, other.moves)
    alone = personal_data.fit(spark.createDataFrame([(n, few[0]) for n in range(1000)], types))
    assert alone.weights.any() and personal_data.all_spans("room 12 now", alone)[0] == []
    for nothing in ([], [(1, None), (2, "no sign of it")]):
        zero = personal_data.fit(spark.createDataFrame(nothing, types))
        assert not zero.weights.any()
        assert personal_data.all_spans("room 12 now, mail a@b.example or ring 555 1234", zero)[1] == [("email", 18, 29)]


def test_long_tokens_are_seen_whole(field):
    address = "y" * 1000 + "@mail.example.com"
    for text in (f"to {address} now", "x" * 1000 + "7 end", "7" + "x" * 100_000):
        found = personal_data.windows(text)
        assert max((t for w in found for t in w.tokens), key=len) == max(text.split(), key=len)
        base, every = personal_data.all_spans(text, field)
        assert base == _base(text) and set(base) <= set(every)


def test_redaction(spark, field):
    docs = with_clashes(spark.createDataFrame([(1, "mail a.b@c.de or 10.0.0.1!", 9), (2, None, 0), (3, "plain", 5)], "doc_id long, text string, n_chars long"))
    got = {r.doc_id: r for r in personal_data.redacted(docs, field).collect()}
    assert got[1].text == "mail <email> or <ip>!" and got[1].n_chars == 21 and got[2].text is None and got[3].text == "plain"


# Licenses


def _license_base(text):
    w, starts, labels = words(text), [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_license_base_and_edges(spark, odd):
    texts = _mixed(4, ["cc", "by", "CC", " ", "-", "general public license ", "All rights reserved", "É", "license ", "Licensed under ", "x ", "mit ", "2.0 "], 300, 14)
    frame = odd.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = licenses.licenses(with_clashes(frame)).collect()
    want = [(r.doc_id, *_license_base(r.text)) for r in frame.collect()]
    assert by_id(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(want, key=repr)
    for r in got:
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and set(filter(None, r.base_labels.split(","))) <= set(labels) and 0 <= r.score <= 1


def test_license_rules(spark):
    cases = {
        "Licensed under CC BY-NC 4.0. x": "cc-by,cc-by-nc-4.0", "under the GNU General Public License, version 3.": "gpl,gpl-3", "Released under the MIT License": "mit",
        "SPDX-License-Identifier: Apache-2.0": "apache-2.0", "the GNU Lesser General Public License v2.1": "gpl,lgpl-2.1", "a Creative Commons Attribution-ShareAlike 3.0 work": "cc-by-sa-3.0",
        "BSD 3-Clause License": "bsd-3-clause", "mit einer license": "", "it was released": "",
    }
    rows = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.licenses(rows).collect()}
    assert [got[n].labels for n in range(len(cases))] == list(cases.values())
    assert [d.label for d in got[4].detections] == ["lgpl-2.1"], "what lies inside another detection is suppressed"
    heads = {h for rule in licenses.rules() for h in licenses._heads(rule.pattern)}
    assert len(licenses.rules()) > 300 and not heads & {"the", "a", "in", "of"}


def _longest(parsed):
    """A match of a parsed pattern with the most words; options are taken."""
    out = ""
    for kind, value in parsed:
        kind = str(kind)
        if kind == "LITERAL":
            out += chr(value)
        elif kind == "IN":
            out += chr(value[0][1] if str(value[0][0]) == "LITERAL" else value[0][1][0])
        elif kind == "MAX_REPEAT":
            out += _longest(value[2]) * value[1]
        elif kind == "SUBPATTERN":
            out += _longest(value[3])
        elif kind == "BRANCH":
            out += max(map(_longest, value[1]), key=lambda t: (t.count(" "), len(t)))
        else:
            raise ValueError(kind)
    return out


def test_every_rule_passes_the_prefilter_whatever_joins_its_words(spark):
    texts = [_longest(re._parser.parse(r.pattern)) for r in licenses.rules()]
    assert all(re.fullmatch(r.pattern, t) for r, t in zip(licenses.rules(), texts, strict=True))
    joined = [t.replace(" ", sign) for t in dict.fromkeys(texts) for sign in (" ", "\n", "-")]
    frame = spark.createDataFrame(list(enumerate(joined)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.licenses(frame).collect()}
    assert [joined[n] for n, r in got.items() if not r.labels] == []
    assert got[joined.index("public-domain")].labels == "public-domain" and got[joined.index("public\ndomain")].score == 0.6


def test_a_detection_reaches_its_real_end(spark):
    texts = [_longest(re._parser.parse(r.pattern)) for r in licenses.rules()]
    assert licenses.VIEW == max(len(t.split(" ")) for t in texts)
    long = [t for t in dict.fromkeys(texts) if len(t.split(" ")) > 14]
    frame = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    got = {r.doc_id: r.detections for r in licenses.licenses(frame).collect()}
    assert len(long) > 10 and all(max(d.end_word for d in got[n]) == len(t.split(" ")) for n, t in enumerate(long))


# Language and quality


def test_rank_order_profiles(spark, odd, empty):
    rng, rows = random.Random(6), []
    for lang, syllables in (("aa", ["ta", "to", "ka", "ti"]), ("bb", ["lu", "le", "mi", "lo"])):
        rows += [(len(rows) + n, " ".join("".join(rng.choice(syllables) for _ in range(3)) for _ in range(30)), lang) for n in range(80)]
    docs = with_clashes(spark.createDataFrame([(n, t, l) for n, (_, t, l) in enumerate(rows)], "doc_id long, text string, lang string"))
    got = language.identified(docs).collect()
    truth = {n: l for n, (_, _, l) in enumerate(rows)}
    assert all(r.lang_pred == truth[r.doc_id] and 0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    profiles = language.train(docs)
    plain = {r.lang: r.n for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert profiles.languages == sorted(plain)
    found = language.languages(odd, profiles, F.lit(False)).collect()
    assert {r.doc_id: r.lang_pred for r in found}[0] == "und" and {r.doc_id: r.lang_pred for r in found}[5] == "und"
    assert language.identified(empty).collect() == []


def test_very_frequent_grams_rank_by_their_count():
    _, gram, n = language.grams(["b " * 300_000 + "a " * 270_000])
    by_code, by_count = np.arange(len(gram)), np.argsort(np.lexsort((gram, -n)))
    assert (by_code != by_count).any()
    profiles = language.Profiles(["code", "count"], gram, np.stack((by_code, by_count), axis=1))
    assert profiles.predict(["x", "b " * 300_000 + "a " * 270_000])[0][1] == "count"


def test_grams_are_those_of_a_plain_count():
    texts = ["Ab, a1b", None, "éß  日", "aa aa"]
    of, gram, counts = language.grams(texts)
    bits, mask = language._BITS, (1 << language._BITS) - 1
    for place, text in enumerate(texts):
        want = {}
        letters = "".join(c.lower() if c.isalpha() else " " for c in text or "")
        for word in letters.split():
            padded = [1, *(ord(c) if ord(c) < 0x2000 else 0x1000 + ord(c) % 0x1000 for c in word), 1]
            for n in (1, 2, 3):
                for i in range(len(padded) - n + 1):
                    part = padded[i : i + n]
                    if (n == 1 and part == [1]) or (n == 2 and part[1] == 1) or (n == 3 and part[1] == 1):
                        continue
                    key = 0
                    for p in part:
                        key = key << bits | (p & mask)
                    want[key] = want.get(key, 0) + 1
        mine = of == place
        assert dict(zip(gram[mine].tolist(), counts[mine].tolist(), strict=True)) == want


def test_quality_on_held_out_rows(spark, odd, empty):
    rng, docs, labels = random.Random(7), [], []
    for n in range(400):
        good = rng.random() < 0.8
        body = [rng.choice(["lorem", "ipsum", "dolor", "sit", "amet", "sed"]) + str(rng.randint(0, 30)) for _ in range(40)]
        docs.append((n, " ".join(body if good else [w.upper() + "!!" for w in body])))
        labels.append((n, int(good)))
    labels += [(1, None), (None, 0), (99_999, 1), (2, labels[2][1])]
    docs, labels = with_clashes(spark.createDataFrame(docs, "doc_id long, text string")), spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.quality_scores(docs, labels).collect()
    truth = {r.doc_id: r.quality for r in labels.where("quality is not null").collect()}
    held = [r for r in got if r.held_out]
    assert len(held) > 50 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(r.predicted == (r.score >= 0.5) for r in got)
    model = quality.fit(docs, labels)
    assert [r.doc_id for r in quality.accepted(docs, model).collect() if truth[r.doc_id] == 0] == []
    assert quality.accepted(docs, model).columns == docs.columns
    assert all(0 <= r.score <= 1 for r in quality.scored(odd, model).collect()) and quality.scored(odd, model).count() == odd.count()
    assert quality.quality_scores(empty, labels).collect() == []
    assert quality.quality_scores(docs, labels.limit(0)).count() == docs.count()
