"""Prefix trie, url filter and spelling variants against plain restatements."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from pacewise.llm import prefix_trie, spelling, urls

_CONVERSATIONS = "conv_id long, turn long, role string, text string"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Prefix trie


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append((turn is not None, turn or 0, key, (role, text)))
    own = {c: [t[3] for t in sorted(found)] for c, found in turns.items()}
    whole = {}
    for c, found in own.items():
        n = zlib.crc32(str(c).encode()) % 9
        head = c - int(math.fmod(c, 5))
        whole[c] = tuple(own.get(head, [])[:n] + found[n:])
    members = defaultdict(list)
    for c, found in whole.items():
        for d in range(len(found) + 1):
            members[found[:d]].append(c)
    out = Counter()
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        kids = lambda n: [m for m in members if len(m) == len(n) + 1 and m[: len(n)] == n]
        saved = sum((len(members[n]) - 1) * (len(n[-1][1].encode()) if n else 0) for n in below)
        ends = ",".join(str(c) for c in sorted(convs) if whole[c] == node)
        parent = min(members[node[:-1]]) if node else None
        leaves = sum(not kids(n) for n in below)
        out[(min(convs), len(node), parent, len(convs), len(kids(node)), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def trie_rows(frame):
    return Counter(
        (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in frame.collect()
    )


def _conversations():
    """Shared starts, copies, one long conversation, nulls, ties, repeated rows, ids below zero and without a first one."""
    rows = []
    for c in list(range(40)) + [-7, -5, 102, 1003]:
        for t in range(c % 7 + 1):
            rows.append((c, t, ("user", "assistant")[t % 2], f"tüte {t} {c % 3 if t > 1 else 0}"))
    rows += [(200, t, "user", "again") for t in range(60)] + [(201, t, "user", "again") for t in range(55)]
    rows += [(300, None, None, None), (300, None, "x", "y"), (300, 0, None, ""), (301, 5, "a", "tie"), (301, 5, "b", "tie"), (301, 5, "b", "tie")]
    rows += [(None, 0, "user", "nobody's"), (13, 0, "user", "one more")]
    return rows


@pytest.mark.parametrize("cells, rows", [(1 << 20, 1 << 16), (30, 3), (1, 1)])
def test_trie_matches_plain_one(spark, cells, rows):
    given = _conversations()
    frame = spark.createDataFrame(given, _CONVERSATIONS).repartition(3).selectExpr("*", "'x' AS ids", "1 AS depth")
    assert trie_rows(prefix_trie.prefix_nodes(frame, cells=cells, rows=rows)) == plain_trie(given)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_nodes(spark.createDataFrame([], _CONVERSATIONS)).count() == 0
    lone = spark.createDataFrame([(3, 0, "user", "taken away")], _CONVERSATIONS)  # crc32("3") % 9 turns of an absent conversation
    assert trie_rows(prefix_trie.prefix_nodes(lone)) == plain_trie([(3, 0, "user", "taken away")])


def test_ends_of_a_node_are_one_stream(spark):
    given = [(5 * c, 0, "user", "same") for c in range(500)]
    frame = spark.createDataFrame(given, _CONVERSATIONS)
    assert trie_rows(prefix_trie.prefix_nodes(frame, cells=50, rows=20)) == plain_trie(given)


# Urls

_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return host.translate(_LOWER), path


def plain_rule(host, path, rules):
    best = None
    for kind, text in rules:
        domain, _, start = text.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start) and (best is None or len(text) > len(best[1])):
            best = (kind, text)
    return best


def plain_split(name, counts):
    """Cheapest split by trying all: known words, or single letters at the price of unknown ones."""
    total = sum(counts.values()) + 1
    unknown = math.log(total) + math.log(10)

    def cheapest(rest):
        if not rest:
            return 0.0
        tries = [unknown + cheapest(rest[1:])]
        for end in range(1, len(rest) + 1):
            if rest[:end] in counts:
                tries.append(-math.log(counts[rest[:end]] / total) + cheapest(rest[end:]))
        return min(tries)

    return cheapest(name), unknown, total


_URLS = [
    "http://www.Example.NET/en/1?x#y", "https://example.net/en/", "https://a.b.example.com/de/x", "http://notexample.com/de/", "ftp://x.org/fr/é",
    "http://ÄÖ.org/fr", "x.org/fr/", "http://", "http://host?q=/en/", "http://net", "http://net/", "a://b://c.net/", "", None, "http://x.net:80/", "http://free-bets.com/",
    "http://freebets.com/slots", "http://cheapfreebets.org/", "http://garden.org/freeflowers",
]


def _pages(spark):
    html = "<p>free cheap garden flowers are free</p><script>var bets = 1</script><style>p{}</style> the garden"
    rows = [(i, u, html if i % 2 else None) for i, u in enumerate(_URLS)] + [(7, _URLS[0], "x" * 200_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "'y' AS words")


def test_hosts_paths_and_rules(spark):
    pages = _pages(spark)
    found = urls.judged(pages, urls.fit(pages), _RULES).collect()
    assert len(found) == len(_URLS) + 1
    for r in found:
        host, path = plain_url(_URLS[r.page_id] if r.page_id != 7 or r.host == "" else _URLS[0])
        assert (r.host, r.path) == (host, path)
        rule = plain_rule(host, path, _RULES)
        assert (r.rule, r.verdict) == ((rule[1], rule[0]) if rule else (None, "block" if r.score > 0.5 else "allow"))
        assert 0 <= r.score <= 1 and (r.words or r.score == 0)


def test_split_is_the_cheapest():
    counts = {"free": 9, "bets": 2, "be": 4, "ts": 1, "free-": 1, "f": 3, "online": 5, "on": 9, "line": 4}
    splitter = urls.Segmenter(counts)
    for name in ("freebets", "freebetsonline", "zzfreezz", "onlineon", "f", "qqqq", "bebets"):
        words = splitter.split(name)
        assert "".join(words) == name
        least, unknown, total = plain_split(name, counts)
        cost = sum(-math.log(counts[w] / total) if w in counts else unknown * len(w) for w in words)
        assert cost == pytest.approx(least)
        assert splitter.split(name) == words
    assert splitter.split("freebetsonline") == ["free", "bets", "online"]
    assert "".join(splitter.split("ab" * 5000)) == "ab" * 5000


def test_bayes_is_the_plain_one(spark):
    """Log ratios from plain counts of the segmented words of each url."""
    pages = _pages(spark)
    model = urls.fit(pages)
    sums, n_urls = (Counter(), Counter()), [1, 1]
    for url in [*_URLS, _URLS[0]]:
        words = model.segmenter.words(*plain_url(url))
        if words:
            kind = int(any(w in urls.SEEDS for w in words))
            n_urls[kind] += 1
            sums[kind].update(w if w in model.place else "" for w in words)
    seen = set(sums[0]) | set(sums[1])
    size = [sum(s.values()) + urls.SMOOTHING * len(seen) for s in sums]
    for word in seen:
        expected = math.log((sums[1][word] + urls.SMOOTHING) / size[1]) - math.log((sums[0][word] + urls.SMOOTHING) / size[0])
        assert model.ratio[model.place.get(word, 0)] == pytest.approx(expected)
    assert model.prior == pytest.approx(math.log(n_urls[1] / n_urls[0]))
    verdict = {r.page_id: r.verdict for r in urls.judged(pages, model).collect()}
    assert verdict[16] == "block" and verdict[17] == "block" and verdict[18] == "allow"


def test_known_words_count_every_page(spark):
    found = {r.word: r.n for r in urls.known_words(_pages(spark)).collect()}
    half = sum(i % 2 for i in range(len(_URLS)))
    assert found["free"] == 2 * half + 1 and found["the"] == half and found["bets"] == 1 and "var" not in found
    assert found["slots"] == 1 and "freebets" not in found


def test_urls_of_nothing(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judged(none, urls.fit(none), _RULES).count() == 0


# Spelling variants


def plain_variants(docs, least=7, occurrences=2, ratio=10, every=31):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").translate(_LOWER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: c for w, c in n.items() if len(w) >= least and c >= occurrences}
    near = defaultdict(set)
    for w in n:
        gaps = [w[:i] + w[i + 1 :] for i in range(len(w))]
        others = set(gaps) | {w[:i] + chr(c) + w[i + 1 :] for i in range(len(w)) for c in spelling.LETTERS.tolist()}
        for o in (others & n.keys()) - {w}:
            near[w].add(o)
            near[o].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def _texts():
    words = {"gardens": 300, "gardenss": 25, "gardenz": 2, "gardenzz": 2, "gxrdens": 30, "gardéns": 5, "aaaaaaaa": 40, "aaaaaaa": 3, "aaaaaaaaa": 3, "ÿÿÿÿÿÿÿ": 2, "ÿÿÿÿÿÿà": 20}
    rows = [(i, " ".join([w.upper() if i % 3 == 0 and w.isascii() else w] * 5)) for w, n in words.items() for i in range(n // 5 + 1)]
    long = "x" * 3000
    rows += [(900, f"{long} {long}y, {long}, {long}y"), (901, long), (None, "gardens,gardens×gardenss"), (902, None), (903, ""), (903, "short words")]
    return rows + rows[:30]


@pytest.mark.parametrize("blocks", [1 << 22, 2])
def test_variants_match_plain_ones(spark, blocks):
    given = _texts()
    frame = spark.createDataFrame(given, "doc_id long, text string").repartition(3).selectExpr("*", "'x' AS word", "1 AS n")
    found = spelling.variants(frame, filter_blocks=blocks)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(plain_variants(given), key=str)


def test_forms_follow_to_the_last(spark):
    given = [(i, "abcdefgh " * 1000) for i in range(20)] + [(i, "abcdefgi " * 60) for i in range(20)] + [(99, "abcdefii abcdefii abcdefgi")]
    found = {r.word: r for r in spelling.variants(spark.createDataFrame(given, "doc_id long, text string"), every=10**9).collect()}
    assert (found["abcdefii"].form, found["abcdefii"].root) == ("abcdefgi", "abcdefgh")


def test_variants_of_nothing(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")).count() == 0
