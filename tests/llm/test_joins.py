"""Joins, packing, quotations and the pipeline, against brute force on small inputs."""

import itertools
import math
import random
import re
import string
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import Row
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from pacewise.llm import packing, personal_data, quality, quotations, shingle_join, vector_join
from pacewise.llm.common import written
from pacewise.llm.components import components
from tests.llm.helpers import Links, spaced_words, with_clashes, words


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5), (None, 3)]
    links = Links({n for e in edges for n in e if n is not None and e[0] != e[1] and e[0] is not None})
    for a, b in edges:
        if a is not None and a != b:
            links.link(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: links.least(n) for n in links.above}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# Shingles


def _shingles(text):
    w = spaced_words(text)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def _classes(rows):
    sets, links = [(i, _shingles(t)) for i, t in rows], Links([i for i, _ in rows if i is not None])
    for (i, a), (j, b) in itertools.combinations(sets, 2):
        common = len(a & b)
        if i is not None and j is not None and common and 100 * common >= 75 * (len(a) + len(b) - common):
            links.link(i, j)
    return sorted(((i, len(a), links.least(i) if i is not None else None) for i, a in sets), key=repr)


def _texts(seed):
    rng = random.Random(seed)
    vocabulary, rows = [f"w{i}" for i in range(300)], []
    for _ in range(14):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 6, 8, 12, 20, 60, 200]))]
        for _ in range(rng.choice([1, 2, 3, 8, 40])):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(own + [rng.choice(vocabulary) for _ in range(len(own) // 6 * (rng.random() < 0.2))])))
    n = len(rows)
    rows += [(n, None), (n + 1, ""), (n + 2, " \t"), (None, "a b c d e f"), (None, None), (5, "w1 w2 w3 w4 w5 w6"), (n + 3, "W1 w2\tw3 w4 w5 w6"), (n + 4, "é " * 3000), (n + 5, "é " * 2000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("light", [0, 20])
def test_heavy_light_join(spark, monkeypatch, light):
    monkeypatch.setattr(shingle_join, "boundary", lambda sets, percent: light)
    rows = _texts(light + 1)
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2))
    got = shingle_join.classes(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == _classes(rows)


def test_one_of_each_and_empty(spark):
    docs = with_clashes(spark.createDataFrame([(2, "a b c d e f g h"), (1, "a b c d e f g h"), (3, "x"), (4, None), (None, "a b c d e f g h")], "doc_id long, text string"))
    kept = shingle_join.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4]
    assert shingle_join.classes(docs.limit(0)).collect() == []


def _link_counts(rows):
    sets, counts = [(i, _shingles(t)) for i, t in rows if i is not None], {}
    for (i, a), (j, b) in itertools.combinations(sets, 2):
        common = len(a & b)
        if common and 100 * common >= 75 * (len(a) + len(b) - common):
            counts[i], counts[j] = counts.get(i, 0) + 1, counts.get(j, 0) + 1
    return sorted(((i, n, counts.get(i, 0), c) for i, n, c in _classes(rows)), key=repr)


@pytest.mark.parametrize("tile", [1 << 21, 300])
def test_link_counts(spark, monkeypatch, tile):
    monkeypatch.setattr(shingle_join, "TILE", tile)
    monkeypatch.setattr(shingle_join, "LEAST", 20)
    rows = _texts(5)
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2))
    want = _link_counts(rows)
    assert sorted((tuple(r) for r in shingle_join.link_counts(docs).collect()), key=repr) == want and max(w[2] for w in want) > 20


def test_overlaps_by_products_and_lists(monkeypatch):
    monkeypatch.setattr(shingle_join, "COLUMNS", 7)
    monkeypatch.setattr(shingle_join, "PAIRS", 50)
    rng = np.random.default_rng(3)
    sides = [[np.flatnonzero(rng.random(200) < np.where(np.arange(200) < 30, 0.8, 0.05)) for _ in range(k)] for k in (90, 70)]
    flat = [(np.repeat(np.arange(len(s)), [len(x) for x in s]), np.concatenate(s)) for s in sides]
    want = [[len(np.intersect1d(a, b)) for b in sides[1]] for a in sides[0]]
    assert shingle_join._overlaps(*flat, 90, 70).tolist() == want


def test_shingles_are_counted_before_their_hashes_are_cut(monkeypatch):
    import pyarrow as pa
    from pyspark import TaskContext

    monkeypatch.setattr(TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    monkeypatch.setattr(shingle_join, "shingles", lambda texts, width: (np.array([0, 0, 0, 1, 1]), np.array([5, 6, 1 << 60, 7, 7], dtype=np.uint64)))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["x", "y"]})
    table = next(t for t in next(shingle_join._dealer(5, 8)([batch])).column("ids").to_pylist() if t)
    assert np.frombuffer(table, "<i8").reshape(2, -1)[:, 2].tolist() == [3, 1]


def test_slices_with_the_same_rows(spark):
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g i"), (3, "x y"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    nulls = spark.createDataFrame([(None, None)] * 4, "doc_id long, text string").repartition(4)
    got = shingle_join.classes(docs.union(docs).union(nulls)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == sorted(_classes(rows) * 2 + [(None, 0, None)] * 4, key=repr)


def test_boundary_follows_cost(spark):
    schema = "n long, scan double, tokens array<long>"
    dear, cheap = [(8, 1000.0, list(range(8)))], [(8, 1.0, list(range(8)))]
    assert shingle_join.boundary(spark.createDataFrame(dear, schema)) >= 8
    assert shingle_join.boundary(spark.createDataFrame(cheap, schema)) == 0


# Vectors


def test_pigeonhole_join(spark, monkeypatch):
    monkeypatch.setattr(vector_join, "STRIP", 7)
    rng, rows = np.random.default_rng(1), []
    for _ in range(30):
        center = rng.standard_normal(20)
        rows += [(len(rows) + k, (center + rng.standard_normal(20) * rng.choice([0, 0.1, 0.25, 0.3])).astype("f4").tolist()) for k in range(rng.integers(1, 12))]
    rows = [(n, v) for n, (_, v) in enumerate(rows)]
    n = len(rows)
    rows += [(n, None), (n + 1, [0.0] * 20), (n + 2, [float("nan")] * 20), (n + 3, [1.0] * 5), (n + 4, [2.0] * 5), (n + 5, [1.0, None]), (None, [1.0] * 5), (n + 6, []), (n + 7, [1.0]), (n + 8, [3.0]), (n + 9, [-1.0])]
    good = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            good.setdefault(len(v), []).append((i, np.array(v, "f4").astype(float)))
    links, counts = Links([i for i, _ in rows if i is not None]), {}
    for same in good.values():
        for (i, a), (j, b) in itertools.combinations(same, 2):
            if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9:
                links.link(i, j)
                counts[i], counts[j] = counts.get(i, 0) + 1, counts.get(j, 0) + 1
    want = sorted(((i, counts.get(i, 0), links.least(i) if i is not None else None, i is not None and links.least(i) == i) for i, _ in rows), key=repr)
    vectors = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3))
    got = vector_join.near_vectors(vectors).collect()
    assert sorted((tuple(r) for r in got), key=repr) == want and len(counts) > 100
    assert vector_join.near_vectors(vectors.limit(0)).collect() == []


def test_vectors_of_doubles(spark):
    """Cosines that single precision would not tell apart, and components beyond its range."""
    just = [0.9, math.sqrt(1 - 0.81), 0.0, 0.0]
    rows = [(0, [1.0, 0.0, 0.0, 0.0]), (1, [0.9 + 1e-10, *just[1:]]), (2, [0.9 - 1e-10, *just[1:]]), (3, [0.0, 0.0, 1e39, 0.0]), (4, [0.0, 0.0, 2e300, 1e299]),
            (5, [0.0, -0.0, 3e-200, 0.0]), (6, [0.0, 0.0, float("inf"), 0.0]), (7, [0.0, 0.0, float("nan"), 1.0]), (8, [0.0, -0.0, 0.0, 0.0])]
    found = {r.vec_id: (r.n_links, r.component_id) for r in vector_join.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert found == {0: (1, 0), 1: (2, 0), 2: (1, 0), 3: (2, 3), 4: (2, 3), 5: (2, 3), 6: (0, 6), 7: (0, 7), 8: (0, 8)}


def test_tiles_cut_at_their_size():
    rows = [(20, 0, float(i), i, 1, b"", b"", 3) for i in range(vector_join.TILE + 2)] + [(20, 1, 0.0, 9, 1, b"", b"", 3)]
    import pyarrow as pa

    names = ["size", "block", "lead", "rep", "copies", "turned", "raw", "part"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows])
    tiles = [t - (3 << 32) for b in vector_join._tiled([batch]) for t in b.column("tile").to_pylist()]
    assert tiles == [0] * vector_join.TILE + [1, 1, 2]


def test_blocks_share_the_budget():
    for size in (1, 5, 20, 64, 100, 1536):
        cuts = vector_join.blocks(size)
        assert cuts[0].start == 0 and cuts[-1].stop == size and all(a.stop == b.start for a, b in itertools.pairwise(cuts))
        assert sum(vector_join._limits(size, 0.9)) >= 0.2


# Packing

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_hilbert_curve_is_a_walk_through_every_cell():
    for dimensions, bits in ((1, 4), (2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
        keys = packing.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_ids_are_the_library_s():
    library, encoder, rng = Tokenizer.from_file(WORDS), packing._Encoder(WORDS), random.Random(3)
    for pieces in (["È", "÷", "ß", "ÿ", "'", "'re", "'S", "'vex", "ll", "A", "b's", " ", "\n", "1", "22", ".", "!!", "'LL", "word", "<", "|", "D"],
                   ["A", " ", "\t", "<|endoftext|>", "\0", "\xa0", "　", "日本", "\x1c", "\r\n", "\x85", "ΑΣ", "é", "İ", "ﬁ", "​", "🙂"]):
        texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(8000)]
        assert [i.tolist() for i in encoder.ids(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_packing_is_an_exact_round_trip(spark):
    rng, library = random.Random(8), Tokenizer.from_file(WORDS)
    texts = [None, "", "x", "word " * 3000, *(" ".join(rng.choice(["ab", "cd", "efg", "hij"]) for _ in range(rng.randint(0, 300))) for _ in range(60)), "twin", "twin"]
    docs = with_clashes(spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string"))
    pieces = packing.packed(docs, WORDS, length=128, bytes_a_task=4000)
    digests = packing.piece_digests(pieces).collect()
    rows = [Row(**r.asDict() | {"ids": np.frombuffer(r.ids, "<u4").tolist()}) for r in pieces.collect()]
    documents, sequences = {}, {}
    for r in rows:
        documents.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for n, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted(documents[n], key=lambda r: r.start)
        assert [i for r in own for i in r.ids] == ids and all(r.doc_tokens == len(ids) for r in own)
        assert [r.start for r in own] == list(itertools.accumulate([0, *(len(r.ids) for r in own)]))[:-1]
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        sizes = list(itertools.accumulate([0, *(len(r.ids) for r in own)]))
        assert [r.offset for r in own] == sizes[:-1] and sizes[-1] <= 128
    used = sum(len(r.ids) for r in rows)
    assert used >= 0.9 * 128 * len(sequences)
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in digests) == sorted((r.doc_id, r.start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in rows)
    assert packing.packed(docs.limit(0), WORDS).collect() == []


def test_ranges_have_like_bytes(spark):
    """Copies of one document, long and short ones: no task has twice the mean, and ranges follow the curve."""
    rng = random.Random(4)
    words_ = ["".join(rng.choice(string.ascii_lowercase) for _ in range(4)) for _ in range(500)]
    texts = [" ".join(rng.choice(words_) for _ in range(rng.choice((5, 50, 400)))) for _ in range(600)] + [" ".join(words_[:200])] * 300
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = packing.keyed(docs, WORDS, 2).selectExpr("*", "xxhash64(ids, doc_id) AS salt")
    size = table.selectExpr("sum(octet_length(ids))").first()[0]
    held, keys = {}, {}
    for r in packing._dealt(written(table, "keyed"), size // 12).selectExpr("*", "spark_partition_id() AS task").collect():
        assert r.task == r.part
        held[r.part] = held.get(r.part, 0) + len(r.ids)
        keys.setdefault(r.part, []).append(r.key)
    assert len(held) >= 12 and max(held.values()) <= 2 * size / 12
    ends = [(min(k) >> 16, max(k) >> 16) for _, k in sorted(keys.items())]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_keys_do_not_follow_length():
    """A text and the same text three times over lie at the same place of the curve."""
    ids = [np.arange(k, k + 40, dtype=np.uint16) for k in range(0, 4000, 7)]
    assert (packing.curve_keys(ids) == packing.curve_keys([np.tile(i, 3) for i in ids])).all()


# Quotations


def test_quotations(spark):
    rows = [
        (1, 0, "user", "Hello there my friend\nhow do you do today"), (1, 1, "assistant", "> Hello there my friend\n\nI am fine really thanks"),
        (1, 2, "user", "On Monday Bob wrote:\n> I am fine, really   thanks\n> > Hello there my friend\nGood to hear that"), (1, 3, "user", "Another thing to say now"),
        (1, 4, "user", ">> hello THERE my friend!\nlate reply to first"), (2, 0, None, None), (None, 1, "user", "> Hello there my friend"), (2, 5, "user", "> never said by anyone\n> ok"),
        (3, 0, "user", "the very same line"), (3, 1, "user", "the very same line"), (3, 2, "user", "> the very same line\nyes"), (3, 3, "user", "> yes it is so"), (3, 4, "user", "yes it is so"),
    ]
    messages = with_clashes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {(r.conv_id, r.turn): r for r in quotations.linked(messages).collect()}
    assert len(got) == len(rows)
    want = {(1, 1): (0, 0, 1, 1), (1, 2): (1, 0, 2, 2), (1, 4): (0, 0, 1, 1), (3, 2): (0, 0, 1, 1)}
    for key, r in got.items():
        parent, thread, depth, linked = want.get(key, (None, key[1], 0, 0))
        assert (r.parent_turn, r.thread, r.depth, r.n_linked) == (parent, thread, depth, linked), key
    assert got[1, 2].text == "Good to hear that" and got[1, 2].quote_level == 2 and got[1, 1].chat == "<|assistant|>\nI am fine really thanks"
    assert got[2, 0].text == "" and got[2, 5].n_quoted == 2 and got[2, 5].text == ""
    assert quotations.linked(messages.limit(0)).collect() == []


def test_a_long_chain_of_replies(spark):
    rows = [(1, n, "user", f"> line number {n - 1} said\nline number {n} said") for n in range(20)]
    got = quotations.linked(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert all((r.thread, r.depth) == (0, r.turn) for r in got)


def _plain_links(rows):
    """Parents, linked lines and reply order of one conversation, message by message."""
    said, parents, n_linked = {}, {}, {}
    for turn, text in rows:
        message = quotations.parsed(text)
        votes = {}
        groups = {}
        for passage, level, key, lines, whole in message.asked:
            groups.setdefault(passage, []).append((level, key, lines, whole))
        for units in groups.values():
            whole = [u for u in units if u[3] and u[1] in said]
            for level, key, lines, _ in whole or [u for u in units if u[1] in said]:
                votes[level, said[key]] = votes.get((level, said[key]), 0) + lines
        n_linked[turn] = sum(votes.values())
        parents[turn] = min(votes, key=lambda v: (v[0], -votes[v], -v[1]))[1] if votes else None
        for key in message.said:
            said.setdefault(key, turn)
    order = []

    def walk(parent):
        for turn in sorted(t for t in parents if parents[t] == parent):
            order.append(turn)
            walk(turn)

    walk(None)
    return parents, n_linked, {t: i for i, t in enumerate(order)}


def test_random_reply_trees(spark):
    """Wrapped, nested, short and repeated passages against a plain walk; every quote of an earlier message is found."""
    rng = random.Random(3)
    rows, quoted_from = [], {}
    for conv in range(6):
        own = {}
        for turn in range(25):
            own[turn] = [" ".join(rng.choice(("yes", "no", "maybe", "Tea", "rain", "ä", "42")) for _ in range(rng.choice((1, 2, 9, 30)))) + f" {turn if rng.random() < 0.8 else ''}" for _ in range(rng.randint(1, 3))]
            text = ""
            if turn and rng.random() < 0.8:
                source = rng.randrange(turn)
                words = " ".join(own[source]).split()
                width = rng.randint(2, 12)
                mark = rng.choice((">", "> ", " > > "))
                text = "".join(f"{mark}{' '.join(words[i : i + width])}\n" for i in range(0, len(words), width))
                quoted_from[conv, turn] = source
            rows.append((conv, turn, "user", f"{text}\n" + "\n".join(own[turn])))
    got = {(r.conv_id, r.turn): r for r in quotations.linked(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)).collect()}
    for conv in range(6):
        parents, n_linked, order = _plain_links([(t, x) for c, t, _, x in rows if c == conv])
        for turn in parents:
            r = got[conv, turn]
            assert (r.parent_turn, r.n_linked, r.position) == (parents[turn], n_linked[turn], order[turn])
            if (conv, turn) in quoted_from:
                assert r.n_linked == r.n_quoted and r.parent_turn <= quoted_from[conv, turn]


def test_wrapped_short_and_endless_quotes(spark):
    long = "word " * 20_000
    rows = [
        (1, 0, "user", "Shall we go to the old harbour tomorrow morning?"), (1, 1, "user", "> Shall we go to the\n> old harbour tomorrow\n> morning?\nyes, agreed"),
        (1, 2, "user", "> yes, agreed\nfine"), (1, 3, "user", ">" * 100_000 + " fine\nmore"), (1, 4, "user", long), (1, 5, "user", f"> {long}\nread it"),
        (1, 0, "user", "Shall we go to the old harbour tomorrow morning?"), (1, 6, "user", None),
    ]
    got = {}
    for r in quotations.linked(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        got.setdefault(r.turn, []).append((r.parent_turn, r.n_quoted, r.n_linked, r.depth, r.position))
    assert got == {0: [(None, 0, 0, 0, 0)] * 2, 1: [(0, 3, 3, 1, 1)], 2: [(1, 1, 1, 2, 2)], 3: [(2, 1, 1, 3, 3)], 4: [(None, 0, 0, 0, 4)],
                   5: [(4, 1, 1, 1, 5)], 6: [(None, 0, 0, 0, 6)]}


# Pipeline


def test_every_numbered_query_is_registered():
    names = contract.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names


def test_pipeline_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
        seen.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
    assert seen[0] > seen[1] > seen[2] >= seen[3] == seen[4]
    assert docs.select("doc_id").distinct().count() == seen[4]


def _without_passages(text, items):
    """The text without the windows of the items, and whether anything else is left; by a plain scan."""
    def found(t):
        return [(m.start(), m.end()) for m in re.finditer("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))]

    places, all_words, windows = found(text), words(text), set()
    for item in map(words, items):
        windows |= {tuple(item[i : i + 10]) for i in range(max(len(item) - 10, 0) + 1 if item else 0)}
    hit = set()
    for n in {len(w) for w in windows}:
        for i in range(len(all_words) - n + 1):
            if tuple(all_words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
    out, at = "", 0
    for i in sorted(hit):
        if i - 1 not in hit:
            out += text[at : places[i][0]]
        at = places[i][1]
    return out + (text or "")[at:], not hit or len(hit) < len(all_words)


def test_rows_of_each_pipeline_stage(spark, tables):
    stages, docs = dict(corpus_pipeline.STAGES), spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")

    def run(name, before):
        after = written(stages[name](spark, before, tables), "tested")
        return after, [(r.doc_id, r.text) for r in before.collect()], sorted((r.doc_id, r.text) for r in after.collect()) if name != "packing" else after.collect()

    model = quality.fit(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    docs, before, got = run("quality", docs)
    scores = model.scores([t for _, t in before])
    assert got == sorted(r for r, score in zip(before, scores, strict=True) if score >= 0.5)
    docs, before, got = run("near_duplicates", docs)
    kept = {i for i, _, component in _classes(before) if i == component}
    assert got == sorted(r for r in before if r[0] in kept)
    docs, before, got = run("decontamination", docs)
    items = [r.text for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    cut = [(i, *_without_passages(t, items)) for i, t in before]
    assert got == sorted((i, t) for i, t, stays in cut if stays) and any((i, t) not in before for i, t in got)
    field = personal_data.fit(docs)
    docs, before, got = run("personal_data", docs)
    assert got == sorted((i, personal_data.redact(t, personal_data.all_spans(t, field)[1])) for i, t in before) and got != sorted(before)
    library = Tokenizer.from_file(WORDS)
    _, before, got = run("packing", docs)
    pieces = {}
    for r in sorted(got, key=lambda r: r.start):
        pieces.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert pieces == {i: [*library.encode(t, add_special_tokens=False).ids, 2] for i, t in before}
