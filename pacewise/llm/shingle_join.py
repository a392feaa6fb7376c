"""Exact Jaccard join of documents on word shingles, heavy-light by set size.

1. *Repeated shingles.* Each task turns its slice into distinct shingle hashes, dealt to buckets by their upper bits. A
   bucket counts in how many documents each of its shingles occurs and returns, for each document, only those that
   occur elsewhere, with a class of that count. Shingles travel as packed arrays, a row for a slice and bucket.
   A document that repeats too little of itself elsewhere has no partner and leaves; others are kept as sets,
   rarest shingles first.
2. *Copies.* Documents with equal sets collapse into their smallest id by a checksum of the set.
3. *Light sets*, up to a boundary, list all pairs of shingles of their prefix (subsets of fixed size 2): sets of
   enough overlap have such a pair in common. *Heavy sets* put every shingle of a shorter prefix in inverted lists. The
   boundary is the size with the least cost by the counted numbers of subsets and list entries. Sets near it do both.
4. Each list first links its members with two leaders of like size, checked exactly. Members of one component need no more
   checks. Then only shingles that
   several components have count: a document with too few of them has no link outside its component and leaves. The lists of 3
   over these shingles alone say which documents may link into which other components, and each such document meets a
   component's sets tile by tile, as a matrix in a task. So a large group of near copies costs as many checks as it has members, a
   document outside costs a row for each tile of it, and no link between components is lost.
5. *Counts of links* (``link_counts``): all links lie inside components, whose classes are compared block by block, each class
   weighted by its copies. A task returns a number for each class, not pairs.

Hashes have 40 bits and more, so that two different shingles of a pair of documents get the same one about once in
a million pairs; such a case changes an overlap by one. Within one text of n distinct shingles that happens with a chance of about
n^2 / 2^41, and its size in the join is then one less; n_shingles is counted from 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewise.llm.common import NOT_SPACE, Words, distinct, give_back, mix, slices, written
from pacewise.llm.components import components

#: Words of a shingle, and similarity in percent from which documents link.
SHINGLE, PERCENT = 5, 75
#: Bytes of text for each bucket; there are 256 at least.
BUCKET_BYTES = 16 << 20
#: Largest boundary between light and heavy sets that is considered.
LIGHT_MOST = 64


def shingles(texts: list[str | None], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text number and 64-bit hash of every shingle, repeats included; a text of fewer words is one shingle."""
    words = Words(texts, NOT_SPACE)
    count = np.diff(words.first)
    with np.errstate(over="ignore"):
        rows = max(len(words.hashes) - width + 1, 0)
        gram = np.full(rows, 0x5851F42D4C957F2D, dtype=np.uint64)
        for k in range(width):
            gram = mix(gram + words.hashes[k : k + rows])
        whole = words.of[:rows] == words.of[width - 1 : width - 1 + rows]
        short = np.flatnonzero((count > 0) & (count < width))
        each = np.empty(len(short), dtype=np.uint64)
        for n, text in enumerate(short):
            value = np.uint64(int(count[text]))
            for h in words.hashes[words.first[text] : words.first[text + 1]]:
                value = mix(np.array([value + h], dtype=np.uint64))[0]
            each[n] = value
    return np.concatenate((words.of[:rows][whole], short)), np.concatenate((gram[whole], each))


def _owner_kind(docs: int) -> str:
    """The type that holds the place of a document in a slice of so many."""
    return "<u2" if docs <= 1 << 16 else "<u4"


def _distinct_counts(of: np.ndarray, hashes: np.ndarray, docs: int) -> np.ndarray:
    """Distinct whole hashes of each text."""
    order = np.argsort(of, kind="stable")
    hashes, cuts = hashes[order], np.searchsorted(of[order], np.arange(docs + 1))
    return np.array([len(distinct(hashes[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)], dtype=np.int64)


_DEALT = "bucket int, chunk string, docs int, owners binary, tokens binary, ids binary"


def _cut(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary values: the bytes of ``values`` between cuts."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _dealer(width: int, bits: int):
    """Slices of (doc_id, text) to rows for each bucket; ``ids`` (with the number of shingles) goes with bucket 0."""
    import hashlib

    from pyspark import TaskContext

    def deal(batches):
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(some for whole in batches for some in slices(whole, 1)):
            docs, ids = batch.num_rows, batch.column(0).to_pylist()
            of, hashes = shingles(batch.column(1).to_pylist(), width)
            token = (hashes >> np.uint64(32 - bits)).astype(np.int64)
            place = max(docs - 1, 1).bit_length()
            if place + 32 + bits > 63:
                raise ValueError("too many documents in an Arrow batch for this number of buckets")
            # bucket, then document, then the lower bits
            keys = distinct((token >> 32 << (place + 32)) | (of.astype(np.int64) << 32) | (token & 0xFFFFFFFF))
            owner = (keys >> 32) & ((1 << place) - 1)
            sizes, cut_sizes = _distinct_counts(of, hashes, docs), np.bincount(owner, minlength=docs)
            cuts = np.searchsorted(keys, np.arange((1 << bits) + 1) << (place + 32))
            low, own = (keys & 0xFFFFFFFF).astype("<u4"), owner.astype(_owner_kind(docs))
            table = np.array([[i is not None, i or 0, n, m] for i, n, m in zip(ids, sizes.tolist(), cut_sizes.tolist(), strict=True)], dtype="<i8").tobytes()
            # slices with the same rows differ by their place; a slice that is read in another order differs by its content
            chunk = f"{part}-{number}-{hashlib.blake2b(table + low.tobytes(), digest_size=12).hexdigest()}"
            n = 1 << bits
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(n), pa.int32()), pa.array([chunk] * n), pa.array([docs] * n, pa.int32()),
                 _cut(own, cuts), _cut(low, cuts), pa.array([table] + [None] * (n - 1), pa.binary())],
                names=["bucket", "chunk", "docs", "owners", "tokens", "ids"])
            give_back()

    return deal


_KEPT = "bucket int, chunk string, docs int, owners binary, tokens binary, classes binary, ids binary"


def _repeated(group):
    """A bucket's shingles that occur in several documents, back by slice, with a class of their count."""
    give_back()
    docs = group.column("docs").to_numpy()
    owners, tokens = group.column("owners").to_pylist(), group.column("tokens").to_pylist()
    sizes = np.array([len(t) for t in tokens], dtype=np.int64) // 4
    every = np.frombuffer(b"".join(tokens), "<u4")
    ranked = np.sort(every.astype(np.uint64) << np.uint64(32) | np.arange(len(every), dtype=np.uint64))  # value, then place
    values, order = (ranked >> np.uint64(32)).astype(np.uint32), (ranked & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    runs = np.diff(np.concatenate((np.flatnonzero(np.concatenate((np.ones(min(len(values), 1), dtype=bool), values[1:] != values[:-1]))), [len(values)])))
    often = np.minimum(np.log2(np.maximum(runs, 2)) * 8, 255).astype(np.uint8)
    classes, keep = np.empty(len(every), dtype=np.uint8), np.empty(len(every), dtype=bool)
    classes[order], keep[order] = np.repeat(often, runs), np.repeat(runs > 1, runs)
    del ranked, values, order
    places = np.concatenate(([0], np.cumsum(sizes)))
    left = np.concatenate(([0], np.cumsum(keep)))[places]
    mine = [np.frombuffer(o, _owner_kind(n))[keep[a:b]].tobytes() for o, n, a, b in zip(owners, docs.tolist(), places, places[1:], strict=False)]
    kept = [group.column("bucket"), group.column("chunk"), group.column("docs"), pa.array(mine, pa.binary()), _cut(every[keep], left), _cut(classes[keep], left), group.column("ids")]
    return pa.table(kept, names=["bucket", "chunk", "docs", "owners", "tokens", "classes", "ids"])


_SETS = "doc_id long, n_shingles long, size long, unique long, first_sum long, second_sum long, scan double, tokens array<long>"


def _assembler(bits: int, percent: int):
    def assemble(group):
        """A slice's documents: those that may have partners with their repeated shingles, rarest first."""
        give_back()
        group = group.sort_by("bucket")
        if group.num_rows != 1 << bits:
            raise RuntimeError("a slice of documents was read in different ways; its input must keep its order when read again")
        docs = group.column("docs")[0].as_py()
        table = np.frombuffer(next(i for i in group.column("ids").to_pylist() if i is not None), "<i8").reshape(docs, 4)
        tokens = group.column("tokens").to_pylist()
        owner = np.frombuffer(b"".join(group.column("owners").to_pylist()), _owner_kind(docs)).astype(np.int64)
        token = np.frombuffer(b"".join(tokens), "<u4").astype(np.int64)
        token |= np.repeat(np.arange(1 << bits), [len(t) // 4 for t in tokens]) << 32
        rank = np.frombuffer(b"".join(group.column("classes").to_pylist()), np.uint8)
        repeated, size = np.bincount(owner, minlength=docs), table[:, 3]
        stays = (size > 0) & (100 * repeated >= percent * size) & (table[:, 0] > 0)
        keep = stays[owner]
        owner, token, rank = owner[keep], token[keep], rank[keep]
        order = np.lexsort((token, rank, owner))
        owner, token, rank = owner[order], token[order], rank[order]
        kept = np.where(stays, repeated, 0)
        start = np.cumsum(kept) - kept
        with np.errstate(over="ignore"):
            spread = mix(token.astype(np.uint64))
            sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(s))) for s in (spread, mix(spread + np.uint64(7)))]
            totals = [(s[start + kept] - s[start]).astype(np.int64) for s in sums]
        need = -(-percent * size // 100)
        listed = np.arange(len(owner)) - start[owner] < (repeated - need + 1)[owner]
        scan = np.bincount(owner, weights=np.where(listed, np.exp2(rank / 8), 0.0), minlength=docs).astype(np.float64)
        ids = pa.array(table[:, 1], mask=table[:, 0] == 0)
        sums_ = [pa.array(t, mask=~stays) for t in totals]
        offsets = pa.array(np.concatenate(([0], np.cumsum(kept))).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(token), mask=pa.array(~stays))
        return pa.table(
            [ids, pa.array(table[:, 2]), pa.array(size), pa.array(size - repeated), *sums_, pa.array(scan, mask=~stays), lists],
            names=["doc_id", "n_shingles", "size", "unique", "first_sum", "second_sum", "scan", "tokens"])

    return assemble


def shingle_sets(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_shingles (by whole hashes), size (by cut ones, as all that follows), unique (shingles in no other row), sums (a checksum of the shingles
    that occur elsewhere), scan (list entries to read) and tokens (those shingles); the last four are null without any possible partner."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(8, math.ceil(math.log2(max(1, size / BUCKET_BYTES))))
    dealt = plain.mapInArrow(_dealer(width, bits), _DEALT)
    kept = dealt.groupBy("bucket").applyInArrow(_repeated, _KEPT)
    return written(kept.groupBy("chunk").applyInArrow(_assembler(bits, percent), _SETS), "sets")


def _need(percent: int) -> Column:
    """The least overlap with any partner."""
    return F.ceil(F.col("n") * percent / 100).cast("int")


def boundary(sets: DataFrame, percent: int = PERCENT) -> int:
    """The largest size of light sets: the one with the least sum of subsets listed below and list entries read from there on."""
    prefix = F.size("tokens") - _need(percent) + 2
    rows = sets.where(F.col("n") <= 2 * LIGHT_MOST).groupBy("n").agg(F.sum(prefix * (prefix - 1) / 2).alias("light"), F.sum("scan").alias("heavy")).collect()
    light, heavy = {r.n: float(r.light) for r in rows}, {r.n: float(r.heavy) for r in rows}

    def cost(most: int) -> float:
        return sum(c for n, c in light.items() if n <= most) + sum(c for n, c in heavy.items() if n > most or 100 * n >= percent * (most + 1))

    return min(range(LIGHT_MOST + 1), key=lambda m: (cost(m), m))


def keys(sets: DataFrame, most: int, percent: int = PERCENT) -> DataFrame:
    """doc_id, n, light, key and place (shingles of the set before the key's, for lists) for all prefixes."""
    need = _need(percent)
    short = F.slice("tokens", F.lit(1), F.size("tokens") - need + 2)
    pairs = F.flatten(F.transform(short, lambda x, i: F.transform(F.slice(short, i + 2, F.size(short)), lambda y: F.xxhash64(x, y))))
    lists = F.slice("tokens", F.lit(1), F.size("tokens") - need + 1)
    light = sets.where(F.col("n") <= most).select("doc_id", "n", F.lit(True).alias("light"), F.explode(pairs).alias("key"), F.lit(0).cast("long").alias("place"))
    heavy = sets.where(100 * (F.col("n") + 1) > percent * (most + 1)).select("doc_id", "n", "unique", F.posexplode(lists))
    heavy = heavy.select("doc_id", "n", F.lit(False).alias("light"), F.col("col").alias("key"), (F.col("unique") + F.col("pos")).alias("place"))
    return light.union(heavy)


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, with their overlap."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("tokens_a"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("tokens_b"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b")
    both = both.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("tokens_a", "tokens_b")).alias("overlap"))
    return both.where(100 * F.col("overlap") >= percent * (F.col("n_a") + F.col("n_b") - F.col("overlap"))).select("a", "b", "overlap")


def _leaders(listed: DataFrame, choice: Column, band: Column) -> DataFrame:
    """Pairs of each list's members with one leader of like size."""
    banded = listed.withColumn("band", band)
    best = banded.groupBy("light", "key", "band").agg(F.min(F.struct(choice.alias("order"), "doc_id", "n")).alias("best"), F.count("*").alias("members"))
    best = best.where("members > 1").select("light", "key", "band", F.col("best.doc_id").alias("b"), F.col("best.n").alias("n_b"))
    pairs = banded.join(best, ["light", "key", "band"]).where("doc_id <> b")
    return pairs.select(F.greatest("doc_id", "b").alias("a"), F.least("doc_id", "b").alias("b"))


def _named(frame: DataFrame, groups: DataFrame) -> DataFrame:
    return frame.join(groups, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def _groups(links: DataFrame) -> DataFrame:
    return written(components(links).select(F.col("node").alias("doc_id"), "component"), "groups")


def _foreign(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """The sets that may link outside their component, with the shingles that other components have too, fewest components first.

    Shingles that only the own component has say nothing about links outside; a set with too few others has no such link.
    """
    named = _named(sets.select("doc_id", "n", "tokens"), groups).select("doc_id", "n", "component", F.explode("tokens").alias("token"))
    spread = named.groupBy("token", "component").agg(F.count("*").alias("sets")).groupBy("token").agg(F.count("*").alias("spread"), F.sum("sets").alias("sets"))
    known = named.join(spread.where("spread > 1"), "token")
    ordered = F.sort_array(F.collect_list(F.struct("spread", "token", "sets")))
    whole = known.groupBy("doc_id", "n", "component").agg(ordered.alias("ordered")).where(100 * F.size("ordered") >= percent * F.col("n"))
    scan = F.aggregate(F.slice("ordered", F.lit(1), F.size("ordered") - _need(percent) + 1), F.lit(0.0), lambda total, t: total + t["sets"])
    return written(whole.select("doc_id", "n", "component", (F.col("n") - F.size("ordered")).alias("unique"), scan.alias("scan"),
                                F.transform("ordered", lambda t: t["token"]).alias("tokens")), "foreign")


def _routes(listed: DataFrame, percent: int) -> DataFrame:
    """``a, component``: sets, and the other components that hold sets which their lists, sizes and places allow as partners.

    Of two components that meet in a list, the sets of the smaller one are routed to the other.
    """

    def fits(n_a: Column, n_b: Column, left_a: Column, left_b: Column) -> Column:
        return (100 + percent) * F.least(left_a, left_b) >= percent * (n_a + n_b)

    left = F.col("n") - F.col("place")
    each = listed.groupBy("light", "key", "component").agg(
        F.count("*").alias("members"), F.min("n").alias("small"), F.max("n").alias("large"), F.max(left).alias("most_left"))
    other = each.select("light", "key", *(F.col(c).alias(f"{c}_b") for c in ("component", "members", "small", "large", "most_left")))
    may = (100 * F.col("large") >= percent * F.col("small_b")) & (100 * F.col("large_b") >= percent * F.col("small"))
    may = may & fits(F.col("small"), F.col("small_b"), F.col("most_left"), F.col("most_left_b"))
    smaller = F.struct("members", "component") < F.struct(F.col("members_b").alias("members"), F.col("component_b").alias("component"))
    meeting = each.join(other, ["light", "key"]).where(smaller & may).select("light", "key", "component", "component_b", "small_b", "large_b", "most_left_b")
    # only those documents of the smaller side that the bounds of the other side allow
    one = listed.select("light", "key", "component", F.col("doc_id").alias("a"), F.col("n").alias("n_a"), left.alias("left_a"))
    near = (100 * F.col("n_a") >= percent * F.col("small_b")) & (100 * F.col("large_b") >= percent * F.col("n_a"))
    chosen = meeting.join(one, ["light", "key", "component"]).where(near & fits(F.col("n_a"), F.col("small_b"), F.col("left_a"), F.col("most_left_b")))
    return chosen.select("a", F.col("component_b").alias("component")).distinct()


def _outside_linker(percent: int):
    def link(group):
        """One link of each routed set (``second``) with each component of the group that holds a similar one."""
        give_back()
        component, second = group.column("component").to_numpy(), group.column("second").to_numpy(zero_copy_only=False)
        lists = group.column("tokens").combine_chunks()
        offsets, tokens = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        n, name = group.column("n").to_numpy(), group.column("doc_id").to_numpy()
        order = np.lexsort((second, component))
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def side(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return np.repeat(np.arange(len(rows)), offsets[rows + 1] - offsets[rows]), np.concatenate([tokens[offsets[r] : offsets[r + 1]] for r in rows])

        for rows in np.split(order, np.flatnonzero(np.diff(component[order])) + 1):
            held, coming = rows[~second[rows]], rows[second[rows]]
            if not len(held) or not len(coming):
                continue
            common = _overlaps(side(held), side(coming), len(held), len(coming))
            like = 100 * common >= percent * (n[held][:, None] + n[coming][None, :] - common)
            linked = np.flatnonzero(like.any(axis=0))
            found.append((name[coming[linked]], name[held[like[:, linked].argmax(axis=0)]]))
        one, two = (np.concatenate([f[i] for f in found]) if found else np.empty(0, dtype=np.int64) for i in (0, 1))
        return pa.table([pa.array(np.maximum(one, two)), pa.array(np.minimum(one, two))], names=["a", "b"])

    return link


def _across(routes: DataFrame, foreign: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join routed sets with the components they are routed to: one of each set with each component, if it has any.

    A component's sets are dealt to tiles, those routed to it to chunks, and each tile meets each chunk in a task, as a matrix: a
    routed set costs a row for each tile, not for each set of the component. Small components share tasks.
    """
    units = F.greatest(F.size("tokens"), F.lit(LEAST)).cast("long").alias("units")
    sets = foreign.select("doc_id", "component", "n", "tokens", units)
    coming = written(routes.join(sets.drop("component"), routes.a == sets.doc_id).drop("a"), "coming")
    held = written(sets.join(routes.select("component").distinct(), "component", "left_semi"), "held")
    loads = held.groupBy("component").agg(F.sum("units").alias("held")).join(coming.groupBy("component").agg(F.sum("units").alias("coming")), "component")
    loads = written(loads.select("component", (F.col("held") + F.col("coming")).alias("whole"), *(F.ceil(F.col(c) / TILE).cast("int").alias(t) for c, t in (("held", "tiles"), ("coming", "chunks")))), "loads")
    alone = (F.col("tiles") > 1) | (F.col("chunks") > 1)
    total = loads.where(~alone).agg(F.sum("whole")).first()[0] or 0
    bucket = F.concat(F.lit("b"), F.pmod(F.xxhash64("component"), F.lit(1 + 2 * total // TILE)))
    pair = F.when(alone, F.concat_ws("-", "component", "tile", "chunk")).otherwise(bucket).alias("pair")

    def dealt(rows: DataFrame, second: bool, own: str, own_count: str, other: str, other_count: str) -> DataFrame:
        place = F.pmod(F.xxhash64("doc_id"), F.col(own_count)).cast("int").alias(own)
        copies = F.explode(F.sequence(F.lit(0), F.col(other_count) - 1)).alias(other)
        spread = rows.join(loads, "component").select("doc_id", "component", "n", "tokens", "tiles", "chunks", place, copies)
        return spread.select(pair, "component", F.lit(second).alias("second"), "doc_id", "n", "tokens")

    both = dealt(held, False, "tile", "tiles", "chunk", "chunks").union(dealt(coming, True, "chunk", "chunks", "tile", "tiles"))
    return both.groupBy("pair").applyInArrow(_outside_linker(percent), "a long, b long")


#: What tells a class of copies from others: all of its shingles occur elsewhere, so that equal checksums mean equal sets.
_WHOLE = ["size", "first_sum", "second_sum"]


def _full() -> Column:
    return F.col("tokens").isNotNull() & (F.col("unique") == 0)


def similar(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sets of all documents; edges (a, b) whose components are those of all links: every copy with its class's smallest
    id, and checked links between classes that join whatever belongs together; and a row for each class, with its number of rows."""
    sets = shingle_sets(docs, width, percent)
    copies = sets.where(_full()).groupBy(*_WHOLE).agg(F.min("doc_id").alias("b"), F.count("*").alias("copies"))
    edges = [written(sets.where(_full()).join(copies.where("copies > 1"), _WHOLE).where("doc_id <> b").select(F.col("doc_id").alias("a"), "b"), "copies")]
    found = sets.where("tokens is not null").join(copies.withColumn("unique", F.lit(0).cast("long")), [*_WHOLE, "unique"], "left")
    # a set with shingles of its own is alone in its class, but for rows with the same id
    unlike = found.where("b is null or doc_id = b").groupBy("doc_id", "unique", *_WHOLE).agg(
        F.coalesce(F.max("copies"), F.count("*")).alias("copies"), F.first("scan").alias("scan"), F.first("tokens").alias("tokens"))
    reps = written(unlike.select("doc_id", F.col("size").alias("n"), "unique", "first_sum", "second_sum", "copies", "scan", "tokens"), "classes")
    several = reps.where("n > 1")
    listed = written(keys(several, boundary(several, percent), percent), "keys")
    band = F.log("n") / math.log(100 / percent)
    led = _leaders(listed, F.col("n"), F.floor(band)).union(_leaders(listed, F.xxhash64("doc_id", "key"), F.floor(band + 0.5))).distinct()
    links = written(verified(led, several, percent), "links").select("a", "b")
    foreign = _foreign(several, _groups(links), percent)
    outside = keys(foreign, boundary(foreign, percent), percent).join(foreign.select("doc_id", "component"), "doc_id")
    across = written(_across(written(_routes(written(outside, "outside"), percent), "routes"), foreign, percent), "across")
    return sets, written(links.union(across).union(edges[0]), "links"), reps


def classes(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id that links reach, itself included) of every row.

    Null and empty texts, and texts of white space only, have no shingles and no links; a text of fewer than ``width`` words has one.
    Rows with a null doc_id get a null component and link nothing. Rows with the same doc_id are one node with the links of
    each. ``docs`` must give its rows in the same order when it is read again, as files do; other columns are not read.
    """
    sets, edges, _ = similar(docs, width, percent)
    return _labelled(sets, components(edges))


def _labelled(sets: DataFrame, groups: DataFrame) -> DataFrame:
    rows = sets.select("doc_id", "n_shingles").join(groups.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    return rows.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


#: Shingles on one side of a comparison, and for how many a short set counts: 1024 sets at most meet 1024 others.
TILE, LEAST = 1 << 21, 1 << 11
#: Columns of a matrix product, and pairs counted at once from lists.
COLUMNS, PAIRS = 1 << 12, 1 << 22


def _overlaps(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], rows: int, columns: int) -> np.ndarray:
    """Shingles that each set of one side has in common with each of the other; sides are (set, shingle) pairs.

    Frequent shingles count by matrix products, rare ones by their lists.
    """
    total = np.zeros((rows, columns), dtype=np.int64)
    both = np.intersect1d(distinct(left[1]), distinct(right[1]), assume_unique=True)
    if not len(both):
        return total

    def known(side: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(both, side[1]), len(both) - 1)
        keep = both[at] == side[1]
        order = np.argsort(at[keep], kind="stable")
        return side[0][keep][order], at[keep][order]

    (one, one_at), (two, two_at) = known(left), known(right)
    often, other = np.bincount(one_at, minlength=len(both)), np.bincount(two_at, minlength=len(both))
    heavy = often * other * 64 > rows * columns if rows * columns > 4096 else np.zeros(len(both), dtype=bool)
    number = np.cumsum(heavy) - 1
    for at in range(0, int(heavy.sum()), COLUMNS):
        chosen = heavy & (number >= at) & (number < at + COLUMNS)
        sides = []
        for owner, place, size in ((one, one_at, rows), (two, two_at, columns)):
            use = chosen[place]
            matrix = np.zeros((size, COLUMNS), dtype=np.float32)
            matrix[owner[use], number[place[use]] - at] = 1
            sides.append(matrix)
        total += (sides[0] @ sides[1].T).astype(np.int64)
    first = np.cumsum(other) - other
    use = ~heavy[one_at]
    one, one_at = one[use], one_at[use]
    meets = other[one_at]
    ends = np.cumsum(meets)
    at = 0
    while at < len(one):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        some = meets[at:to]
        place = np.arange(int(some.sum())) - np.repeat(np.cumsum(some) - some, some) + np.repeat(first[one_at[at:to]], some)
        cell = np.repeat(one[at:to], some) * columns + two[place]
        total += np.bincount(cell, minlength=rows * columns).reshape(rows, columns)
        at = to
    return total


_COUNTED = "class long, links long"


def _link_counter(percent: int):
    def count(group):
        """Links of each class with those of the same component: of the other side, or of the own one if there is no second."""
        component, second = group.column("component").to_numpy(), group.column("second").to_numpy(zero_copy_only=False)
        order = np.lexsort((second, component))
        lists = group.column("tokens").combine_chunks()
        offsets, tokens = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        n, copies, name = (group.column(c).to_numpy() for c in ("n", "copies", "class"))
        links = np.zeros(len(n), dtype=np.int64)

        def side(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return np.repeat(np.arange(len(rows)), offsets[rows + 1] - offsets[rows]), np.concatenate([tokens[offsets[r] : offsets[r + 1]] for r in rows])

        cuts = np.flatnonzero(np.diff(component[order])) + 1
        for rows in np.split(order, cuts):
            a, b = rows[~second[rows]], rows[second[rows]]
            if within := not len(b):
                b = a
            if not len(a):
                continue
            common = _overlaps(side(a), side(b), len(a), len(b))
            like = 100 * common >= percent * (n[a][:, None] + n[b][None, :] - common)
            if within:
                np.fill_diagonal(like, False)
            else:
                links[b] += copies[a] @ like
            links[a] += like @ copies[b]
        some = np.flatnonzero(links)
        return pa.table([pa.array(name[some]), pa.array(links[some])], names=["class", "links"])

    return count


def _class() -> Column:
    return F.xxhash64("doc_id", "n", "unique", "first_sum", "second_sum")


def _counted_links(reps: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """class and links (rows of other classes that are similar enough) of each class with any.

    Links are inside components. Those of one tile at most are counted many in a task; larger ones are cut
    into tiles by size, and each pair of tiles that sizes allow is counted for itself. No pair of documents becomes a row.
    """
    units = F.greatest(F.size("tokens"), F.lit(LEAST)).cast("long")
    members = reps.where("n > 1").join(groups.select(F.col("node").alias("doc_id"), "component"), "doc_id")
    members = members.select("component", _class().alias("class"), "n", "copies", units.alias("units"), "tokens")
    sums = written(members.groupBy("component").agg(F.count("*").alias("members"), F.sum("units").alias("whole")).where("members > 1"), "sums")
    members = written(members.join(sums.select("component", "whole"), "component"), "members")
    columns = ["component", "class", "n", "copies", "tokens"]
    total = sums.where(F.col("whole") <= TILE).agg(F.sum("whole")).first()[0] or 0
    bucket = F.concat(F.lit("b"), F.pmod(F.xxhash64("component"), F.lit(1 + 4 * total // TILE)))
    small = members.where(F.col("whole") <= TILE).select(bucket.alias("pair"), F.lit(False).alias("second"), *columns)
    found = small.groupBy("pair").applyInArrow(_link_counter(percent), _COUNTED)
    large = members.where(F.col("whole") > TILE)
    amount = sums.where(F.col("whole") > TILE).agg(F.sum("whole")).first()[0] or 0
    if amount:
        order = ["component", "n", "class"]
        dealt = large.repartitionByRange(max(1, 4 * amount // TILE), *order).sortWithinPartitions(*order)
        dealt = written(dealt.mapInArrow(_running, "part long, before long, component long, class long, n long, copies long, units long, tokens array<long>"), "dealt")
        parts = dealt.groupBy("component", "part").agg(F.sum("units").alias("units"))
        start = parts.select("component", "part", (F.sum("units").over(Window.partitionBy("component").orderBy("part")) - F.col("units")).alias("start"))
        tiles = dealt.join(start, ["component", "part"]).select(*columns, F.floor((F.col("start") + F.col("before")) / TILE).alias("tile"))
        tiles = written(tiles, "tiles")
        bounds = tiles.groupBy("component", "tile").agg(F.min("n").alias("low"), F.max("n").alias("high"))
        far = bounds.select("component", F.col("tile").alias("tile_b"), F.col("low").alias("low_b"))
        meet = bounds.join(far, "component").where((F.col("tile") <= F.col("tile_b")) & (100 * F.col("high") >= percent * F.col("low_b")))
        one, two = (F.struct(F.lit(k).alias("second"), F.col(c).alias("tile")) for k, c in ((False, "tile"), (True, "tile_b")))
        sides = meet.select("component", F.concat_ws("-", "component", "tile", "tile_b").alias("pair"), F.explode(F.when(F.col("tile") == F.col("tile_b"), F.array(one)).otherwise(F.array(one, two))).alias("side"))
        pairs = tiles.join(sides.select("component", "pair", "side.second", "side.tile"), ["component", "tile"]).select("pair", "second", *columns)
        found = found.union(pairs.groupBy("pair").applyInArrow(_link_counter(percent), _COUNTED))
    return written(found.groupBy("class").agg(F.sum("links").alias("links")), "counted")


def _running(batches):
    """Rows with their partition and the units before them in their component there."""
    from pyspark import TaskContext

    part, last, behind = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        before, component, units = [], batch.column("component").to_pylist(), batch.column("units").to_pylist()
        for c, u in zip(component, units, strict=True):
            behind = behind if c == last else 0
            before.append(behind)
            last, behind = c, behind + u
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(before), pa.int64()), pa.array(before, pa.int64()), *(batch.column(c) for c in ("component", "class", "n", "copies", "units", "tokens"))],
            names=["part", "before", "component", "class", "n", "copies", "units", "tokens"])


def link_counts(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, n_links and component_id of every row of ``docs``; see ``classes``.

    n_links counts the other rows, with a doc_id, whose similarity is enough, copies included. A doc_id of several rows
    has the sum of theirs, links between them too. Rows without doc_id have 0 links.
    """
    sets, edges, reps = similar(docs, width, percent)
    groups = written(components(edges), "groups")
    links = _counted_links(reps, groups, percent)
    # rows of one class: copies, or rows of one id with shingles of their own, of which the others have none
    alike = F.when(100 * (F.col("n") - F.col("unique")) >= percent * (F.col("n") + F.col("unique")), F.col("copies") - 1).otherwise(0)
    own = F.when(F.col("unique") > 0, F.col("doc_id")).otherwise(0)
    of_class = reps.withColumn("class", _class()).join(links, "class", "left").select(
        F.col("n").alias("size"), "unique", "first_sum", "second_sum", own.alias("own"), (F.coalesce("links", F.lit(0)) + alike).alias("links"))
    key = [*_WHOLE, "unique"]
    rows = sets.where("tokens is not null").select("doc_id", own.alias("own"), *key).join(of_class, [*key, "own"])
    counts = rows.groupBy("doc_id").agg(F.sum("links").alias("n_links"))
    found = _labelled(sets, groups).join(counts, "doc_id", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id")


def one_of_each(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are alone or the smallest doc_id of their component; rows with a null id stay. Of rows with the
    same id that stays, all stay."""
    _, edges, _ = similar(docs, width, percent)
    gone = components(edges).where("node <> component").select(F.col("node").alias("doc_id"))
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
