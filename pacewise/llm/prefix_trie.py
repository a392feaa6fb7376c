"""Prefix trie of conversations from padded turn-id matrices.

Conversations are range-sharded by their sequences of turn ids. A task turns a stretch of its shard into a padded matrix of turn
ids, orders its rows with numpy's lexsort, and ORs the masks of changed cells along each row: where a prefix changes, a node
starts. One ``reduceat`` for each depth then gives all nodes of that depth. Nodes on the path of the first or last row of a
stretch may go on in the next one; these boundary nodes, two paths a stretch, are recombined afterwards.

A turn is the 128 bits of a SHA-256 of role and text. Rows without conv_id belong to no conversation; null turns come first, and
turns of equal number are ordered by that hash; null roles and texts are empty; repeated rows are turns more; other columns are not
read; an empty table has no nodes, not even a root. A task holds the ids of a whole conversation (24 bytes a turn), never those of a
node: ids of the conversations that end in a node are hashed as a stream.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.llm.common import written

#: Cells and rows of a matrix at most; a longer conversation is a matrix of its own.
CELLS, ROWS = 1 << 20, 1 << 16

_EMPTY = hashlib.sha256().hexdigest()
_NODE = (
    "edge boolean, node binary, parent binary, conv_id long, parent_conv_id long, depth long, size long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends string"
)
_NAMES = [part.split(" ")[0] for part in _NODE.split(", ")]


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns of each conversation in order, as structs with ``id`` and ``size`` (bytes of the text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    turn = F.struct(
        F.col("turn").isNotNull().alias("numbered"),
        F.coalesce("turn", F.lit(0)).alias("turn"),
        F.substring(digest, 1, 16).alias("id"),
        F.octet_length(text).cast("long").alias("size"),
    )
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def _shared_turns(conv_id: Column, within: int) -> Column:
    return (F.crc32(conv_id.cast("string")) % within).cast("int")


def rebuilt(found: DataFrame, family: int = 5, within: int = 9) -> DataFrame:
    """Every conversation with the first turns of its family's first conversation in place of as many of its own."""
    heads = found.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, within - 1).alias("head")
    )
    n = _shared_turns(F.col("conv_id"), within)
    joined = found.withColumn("head_id", F.col("conv_id") - F.col("conv_id") % family).join(heads, "head_id", "left")
    nothing = F.slice("turns", 1, 0)
    turns = F.concat(F.coalesce(F.slice("head", F.lit(1), n), nothing), F.slice("turns", n + 1, F.size("turns") + 1))
    return joined.select("conv_id", turns.alias("turns"))


class _Matrix:
    """A stretch of conversations in order, its nodes by depth."""

    def __init__(self, convs: np.ndarray, lengths: np.ndarray, ids: np.ndarray, sizes: np.ndarray):
        """``ids`` and ``sizes`` have all turns one after another; an id is a row of two numbers."""
        depth = int(lengths.max(initial=0))
        row = np.repeat(np.arange(len(convs)), lengths)
        column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        order = np.lexsort((ids[:, 1], ids[:, 0]))
        changed = np.ones(len(order), dtype=bool)
        changed[1:] = (ids[order[1:]] != ids[order[:-1]]).any(axis=1)
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.cumsum(changed) - 1
        cells = np.full((len(convs), depth), -1, dtype=np.int64)
        cells[row, column] = number
        weights = np.zeros((len(convs), depth), dtype=np.int64)
        weights[row, column] = sizes
        order = np.lexsort((convs, *cells.T[::-1]))
        self.order, self.convs, self.lengths = order, convs[order], lengths[order]
        self.weights, self.depth = weights[order], depth
        cells = cells[order]
        self.breaks = np.ones(cells.shape, dtype=bool)
        np.logical_or.accumulate(cells[1:] != cells[:-1], axis=1, out=self.breaks[1:])
        self.starts = self.breaks & (cells >= 0)

    def level(self, at: int) -> dict[str, np.ndarray]:
        """Nodes of depth ``at``: first rows, members, smallest member, ends, children that start here."""
        if at == 0:
            first = np.zeros(1, dtype=np.int64)
        else:
            first = np.flatnonzero(self.breaks[:, at - 1])
        real = np.flatnonzero(self.starts[first, at - 1]) if at else np.zeros(1, dtype=np.int64)
        below = self.starts[:, at].astype(np.int64) if at < self.depth else np.zeros(len(self.convs), dtype=np.int64)
        stop = np.append(first[1:], len(self.convs))
        return {
            "all": first,
            "real": real,
            "first": first[real],
            "edge": (first[real] == 0) | (stop[real] == len(self.convs)),
            "n": (stop - first)[real],
            "least": np.minimum.reduceat(self.convs, first)[real],
            "ends": np.add.reduceat((self.lengths == at).astype(np.int64), first)[real],
            "children": np.add.reduceat(below, first)[real],
            "size": self.weights[first[real], at - 1] if at else np.zeros(1, dtype=np.int64),
        }


def _prefix_keys(ids: bytes) -> list[bytes]:
    """A 128-bit key of every prefix, from the empty one on."""
    running = hashlib.blake2b(digest_size=16)
    keys = [running.digest()]
    for at in range(0, len(ids), 16):
        running.update(ids[at : at + 16])
        keys.append(running.digest())
    return keys


def _nodes(convs: np.ndarray, lengths: np.ndarray, raw: bytes, sizes: np.ndarray) -> pa.Table:
    """Nodes of a stretch of conversations; those at its edges carry keys and what the stretch knows of them."""
    matrix = _Matrix(convs, lengths, np.frombuffer(raw, dtype=">u8").reshape(-1, 2).astype(np.uint64), sizes)
    stops = np.cumsum(lengths) * 16
    outer = [raw[stops[i] - 16 * lengths[i] : stops[i]] for i in (matrix.order[0], matrix.order[-1])]
    top, bottom = (_prefix_keys(x) for x in outer)
    levels = [matrix.level(at) for at in range(matrix.depth + 1)]
    for at, level in enumerate(levels):
        place = np.searchsorted(levels[at - 1]["first"], level["first"], side="right") - 1 if at else np.full(1, -1)
        level["parent"] = place
        # Children at the edge are counted when they are whole.
        if at:
            np.subtract.at(levels[at - 1]["children"], place, level["edge"].astype(np.int64))
    leaves, saved = (np.zeros(len(convs), dtype=np.int64) for _ in range(2))
    for at in reversed(range(matrix.depth + 1)):
        level = levels[at]
        inner = ~level["edge"]
        leaves[level["first"][inner]] += level["children"][inner] == 0
        saved[level["first"][inner]] += ((level["n"] - 1) * level["size"])[inner]
        level["leaves"] = np.add.reduceat(leaves, level["all"])[level["real"]]
        level["saved"] = np.add.reduceat(saved, level["all"])[level["real"]]
    tables = []
    for at, level in enumerate(levels):
        edge, first = level["edge"], level["first"]
        above = levels[at - 1] if at else None
        open_parent = above["edge"][level["parent"]] if at else np.zeros(1, dtype=bool)

        def keys(rows: np.ndarray, depth: int, wanted: np.ndarray) -> pa.Array:
            return pa.array([(top if r == 0 else bottom)[depth] if w else None for r, w in zip(rows.tolist(), wanted.tolist(), strict=True)], pa.binary())

        digests, texts = [], []
        for r, n, is_edge in zip(first.tolist(), level["ends"].tolist(), edge.tolist(), strict=True):
            text = ",".join(map(str, matrix.convs[r : r + n].tolist())) if n else None
            digests.append(None if is_edge else hashlib.sha256(text.encode()).hexdigest() if n else _EMPTY)
            texts.append(text if is_edge else None)
        parent_row = above["first"][level["parent"]] if at else first
        parent_conv = pa.array(above["least"][level["parent"]], mask=open_parent | edge) if at else pa.nulls(1, pa.int64())
        columns = [
            pa.array(edge),
            keys(first, at, edge),
            keys(parent_row, at - 1, open_parent) if at else pa.nulls(1, pa.binary()),
            pa.array(level["least"]),
            parent_conv,
            pa.array(np.full(len(first), at, dtype=np.int64)),
            *(pa.array(level[k]) for k in ("size", "n", "children", "leaves", "saved")),
            pa.array(digests, pa.string()),
            pa.array(texts, pa.string()),
        ]
        tables.append(pa.table(columns, names=_NAMES))
    return pa.concat_tables(tables)


def _stretches(lengths: list[int], cells: int, rows: int):
    """Cuts of neighbouring conversations whose padded matrix is small enough."""
    start, widest = 0, 0
    for at, length in enumerate(lengths):
        widest = max(widest, length)
        if at > start and ((at - start + 1) * widest > cells or at - start >= rows):
            yield start, at
            start, widest = at, length
    if lengths:
        yield start, len(lengths)


def _shard(cells: int, rows: int):
    def run(batches):
        for batch in batches:
            turns = batch.column(1)
            lengths = pc.list_value_length(turns).to_numpy()
            flat = turns.flatten()
            ids, sizes = flat.field(0).cast(pa.binary(16)), flat.field(1).to_numpy()
            raw = ids.buffers()[1].to_pybytes()[16 * ids.offset : 16 * (ids.offset + len(ids))] if len(ids) else b""
            convs = batch.column(0).to_numpy()
            bounds = np.concatenate(([0], np.cumsum(lengths)))
            for a, b in _stretches(lengths.tolist(), cells, rows):
                some = slice(bounds[a], bounds[b])
                nodes = _nodes(convs[a:b], lengths[a:b].astype(np.int64), raw[16 * some.start : 16 * some.stop], sizes[some])
                yield from nodes.to_batches()

    return run


def _chained(batches):
    """SHA-256 of the ids that end in each node; rows come sorted by node and first id, and are never held together."""
    rows = ((n, t) for b in batches for n, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
    for node, texts in groupby(rows, key=lambda r: r[0]):
        running = hashlib.sha256()
        for at, (_, text) in enumerate(texts):
            running.update((b"," if at else b"") + text.encode())
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([running.hexdigest()])], ["node", "ends_sha256"])


def _whole_edges(parts: DataFrame) -> DataFrame:
    """Boundary nodes, each once, without what other boundary nodes below add."""
    some = parts.where("edge")
    whole = some.groupBy("node").agg(
        *(F.min(c).alias(c) for c in ("parent", "conv_id", "depth", "size")),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    ends = some.where("ends is not null").select("node", "ends", F.substring_index("ends", ",", 1).cast("long").alias("at"))
    hashed = ends.repartition("node").sortWithinPartitions("node", "at").select("node", "ends").mapInArrow(_chained, "node binary, ends_sha256 string")
    whole = whole.join(hashed, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))
    whole = written(whole, "trie-edges")
    children = whole.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("more"))
    whole = whole.join(children, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    own_leaf, own_saved = (F.col("n_children") == 0).cast("long"), (F.col("n_convs") - 1) * F.col("size")
    return whole.drop("more").withColumns({"own_leaf": own_leaf, "own_saved": own_saved})


def _with_descendants(whole: DataFrame) -> DataFrame:
    """Boundary nodes with the sums of all boundary nodes below; distances double in each round."""
    state = whole.select("node", F.col("parent").alias("above"), F.col("own_leaf").alias("leaves"), F.col("own_saved").alias("saved"))
    deepest, reach = whole.agg(F.max("depth")).first()[0] or 0, 1
    while reach <= deepest:
        state = written(state, "trie-sums")
        sums = state.where("above is not null").groupBy(F.col("above").alias("node"))
        sums = sums.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        up = state.select(F.col("node").alias("above"), F.col("above").alias("further"))
        state = state.join(sums, "node", "left").join(up, "above", "left").select(
            "node",
            F.col("further").alias("above"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
        reach *= 2
    totals = state.select("node", "leaves", "saved")
    joined = whole.join(totals, "node")
    sums = {"n_leaves": F.col("n_leaves") + F.col("leaves"), "saved_tokens": F.col("saved_tokens") + F.col("saved")}
    return joined.withColumns(sums)


def trie(found: DataFrame, cells: int = CELLS, rows: int = ROWS) -> DataFrame:
    """One row per node of the trie over ``conv_id, turns`` (see ``sequences``)."""
    ids, sizes = F.transform("turns", lambda t: t["id"]), F.transform("turns", lambda t: t["size"])
    keyed = written(found.select("conv_id", ids.alias("ids"), sizes.alias("sizes")), "trie-sequences")
    sharded = keyed.repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    turns = F.arrays_zip("ids", "sizes").alias("turns")
    parts = written(sharded.select("conv_id", turns).mapInArrow(_shard(cells, rows), _NODE), "trie-parts")
    result = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    edges = written(_with_descendants(_whole_edges(parts)), "trie-boundary")
    parents = edges.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    inner = parts.where("not edge")
    closed = inner.where("parent is null").select(*result)
    open_ones = inner.where("parent is not null").select("parent", *result).unionByName(edges.withColumn("parent_conv_id", F.lit(None).cast("long")).select("parent", *result))
    named = open_ones.join(parents, "parent", "left").withColumn("parent_conv_id", F.col("above"))
    return closed.unionByName(named.select(*result))


def prefix_nodes(conversations: DataFrame, family: int = 5, within: int = 9, cells: int = CELLS, rows: int = ROWS) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(written(sequences(conversations), "sequences"), family, within), cells, rows)
