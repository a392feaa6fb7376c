"""Near duplicates among vectors by a subspace pigeonhole join.

Two unit vectors of cosine c or more have a squared distance of 2 - 2c at most. After a fixed random rotation the
coordinates split into blocks; in at least one block the two are within that block's share of the budget, in
proportion to its dimensions, and over any blocks together they are within the whole budget. Vectors are sorted once, by the
nearest of some sampled vectors, and cut into tiles, a row each, whose vectors are ordered in strips of neighbours. Two tiles
meet unless the balls around them are too far apart: every task reads two ranges of the written tiles, so vectors are neither
copied nor shuffled for it. Where tiles meet, a strip meets the vectors that some block and the whole vector bring near its
ball; their distance over the leading blocks is screened as a matrix, and the cosine of what remains is checked exactly. A
task returns counts and a spanning forest, never pairs, so a group of near copies costs multiplications but no rows. Equal
vectors of a tile are one class beforehand.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise.llm.common import give_back, written
from pacewise.llm.components import components

#: Coordinates of a block.
BLOCK = 16
#: Vectors of a tile, and rows that are compared at once.
TILE, STRIP = 12_288, 256
#: Bytes of single precision that a tile holds at most, bytes of vectors that a task sorts, and bytes that a worker gets at once.
_TILE_BYTES, _PART_BYTES, _BATCH_BYTES = 16 << 20, 12 << 20, 12 << 20
#: Components that a worker turns into doubles at once.
_VALUES = 1 << 21
#: Rows of links that a worker sums up.
_ROWS = 1 << 19
#: Vectors that a strip is screened with at once (their products stay in the processor's cache), bytes of tiles that a worker keeps ready.
_COLUMNS, _READY_BYTES = 1024, 64 << 20
#: One of so many vectors tells whether strips are worth choosing their vectors: not if more than this share meets anyway.
_PROBE, _MOST = 16, 0.75
#: Sampled vectors, and for how many vectors one of them is a pivot that others are sorted around.
_SAMPLE, _PER_PIVOT = 256, 4 * TILE
#: What float32 coordinates may add to a squared distance, and the bands in which products of single and double precision are checked again.
_SLACK, _ROUGH, _BAND = 2e-5, 2e-5, 1e-9


@functools.cache
def rotation(size: int, seed: int = 7) -> np.ndarray:
    """A fixed random rotation; a process makes it once."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))[0]


def blocks(size: int) -> list[slice]:
    count = max(1, round(size / BLOCK))
    cuts = [size * b // count for b in range(count + 1)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]


def _limits(size: int, cosine: float) -> list[float]:
    """The greatest squared distance of each block."""
    return [(2 - 2 * cosine) * (b.stop - b.start) / size + _SLACK for b in blocks(size)]


def _units(vectors: np.ndarray) -> np.ndarray:
    """The rows scaled to length one, as doubles; very large and very small ones are scaled before they are squared."""
    vectors = vectors.astype(np.float64)
    largest = np.maximum(vectors.max(axis=1), -vectors.min(axis=1))
    odd = ~((largest > 1e-100) & (largest < 1e100))
    vectors[odd] /= largest[odd, None]
    vectors /= np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    return vectors


def _cosine(one: np.ndarray, two: np.ndarray) -> float:
    """Of two vectors of doubles, by sums that do not depend on what else is multiplied."""
    return math.fsum((_units(one[None])[0] * _units(two[None])[0]).tolist())


# Tiles


def _matrices(column: pa.Array):
    """(rows, matrix of doubles) of the vectors that can link, by length."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    starts, values = column.offsets.to_numpy()[:-1].astype(np.int64), column.values.to_numpy(zero_copy_only=False)
    for size in np.unique(lengths[lengths > 0]).tolist():
        every, step = np.flatnonzero(lengths == size), max(1, _VALUES // size)
        for at in range(0, len(every), step):
            rows = every[at : at + step]
            matrix = values[starts[rows][:, None] + np.arange(size)].astype(np.float64) + 0.0  # -0.0 equals 0.0; null became NaN
            good = np.isfinite(matrix).all(axis=1) & matrix.any(axis=1)
            yield rows[good], matrix[good]


def _packed(matrix: np.ndarray, kind: bytes) -> pa.Array:
    """Rows as bytes behind a mark: 4 for single precision, which holds them exactly, 8 for doubles."""
    data = matrix.astype("<f4" if kind == b"4" else "<f8").view(np.uint8).reshape(len(matrix), -1)
    data = np.hstack((np.full((len(data), 1), kind[0], dtype=np.uint8), data))
    offsets = np.arange(len(data) + 1, dtype=np.int64) * data.shape[1]
    return pa.Array.from_buffers(pa.large_binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def _unpacked(raws: list[bytes], size: int) -> np.ndarray:
    """Packed vectors as rows; in single precision if it holds them all."""
    if all(raw[:1] == b"4" for raw in raws):
        return np.ascontiguousarray(np.frombuffer(b"".join(raws), np.uint8).reshape(len(raws), -1)[:, 1:]).view("<f4")
    return np.stack([np.frombuffer(raw, "<f4" if raw[:1] == b"4" else "<f8", offset=1).astype("<f8") for raw in raws]).reshape(-1, size)


_KEYED = "size int, cell int, near double, vec_id long, raw binary"


def _keyer(pivots: dict[int, np.ndarray]):
    """(vec_id, embedding) to a row for each vector that can link: with its nearest pivot and how near that is."""

    def keyed(batches):
        names = ["size", "cell", "near", "vec_id", "raw"]
        for batch in batches:
            ids = batch.column(0)
            for rows, matrix in _matrices(batch.column(1)):
                known = ids.take(pa.array(rows)).is_valid().to_numpy(zero_copy_only=False)
                rows, matrix = rows[known], matrix[known]
                size = matrix.shape[1]
                with np.errstate(over="ignore"):
                    single = (matrix.astype(np.float32) == matrix).all(axis=1)
                for kind, some in ((b"4", np.flatnonzero(single)), (b"8", np.flatnonzero(~single))):
                    if not len(some):
                        continue
                    close = _units(matrix[some]).astype(np.float32) @ pivots.get(size, np.zeros((1, size), np.float32)).T
                    cell = close.argmax(axis=1)
                    near = close[np.arange(len(some)), cell].astype(np.float64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), size, np.int32)), pa.array(cell.astype(np.int32)), pa.array(near), ids.take(pa.array(rows[some])).cast(pa.int64()), _packed(matrix[some], kind)], names=names)
            give_back()

    return keyed


def _tiled(batches):
    """Sorted rows of a partition with the number of their tile, new for each size and cell; the first two columns have these."""
    now, seen, tile = None, 0, -1
    for batch in batches:
        tiles = []
        for size, cell, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column("part").to_pylist(), strict=True):
            if (size, cell) != now or seen == min(TILE, max(1, _TILE_BYTES // (4 * size))):
                now, seen, tile = (size, cell), 0, tile + 1
            seen += 1
            tiles.append((part << 32) + tile)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(tiles, pa.int64())], names=[*batch.schema.names[:-1], "tile"])


def _ordered(points: np.ndarray) -> np.ndarray:
    """An order of the points in which strips are neighbours: halves along the line between two far points, and so on."""
    done, todo = [], [np.arange(len(points))]
    while todo:
        some = todo.pop()
        if len(some) <= STRIP:
            done.append(some)
            continue
        here = points[some]
        far = here[((here - here.mean(axis=0)) ** 2).sum(axis=1).argmax()]
        line = here[((here - far) ** 2).sum(axis=1).argmax()] - far
        half = (-(-len(some) // STRIP) + 1) // 2 * STRIP
        parted = np.argpartition(here @ line, half - 1)
        todo += [some[parted[half:]], some[parted[:half]]]
    return np.concatenate(done) if done else np.arange(0)


_TILE_ROW = "tile long, size int, bytes long, first long, center array<float>, radius double, copies binary, data binary, ids array<long>, nodes array<long>, twins array<long>"
_TILE_TYPE = pa.schema([("tile", pa.int64()), ("size", pa.int32()), ("bytes", pa.int64()), ("first", pa.int64()), ("center", pa.list_(pa.float32())), ("radius", pa.float64()), ("copies", pa.binary()), ("data", pa.binary()),
                        ("ids", pa.list_(pa.int64())), ("nodes", pa.list_(pa.int64())), ("twins", pa.list_(pa.int64()))])


def _tile(tile: int, size: int, first: int, ids: np.ndarray, raws: list[bytes]) -> tuple[pa.RecordBatch, int]:
    """The row of a tile, and its number of classes. Classes are numbered from ``first`` on; the members of each are listed."""
    vectors = _unpacked(raws, size)
    _, firsts, of = np.unique(vectors.view(np.dtype((np.void, vectors.dtype.itemsize * size))).ravel(), return_index=True, return_inverse=True)
    vectors = vectors[firsts]
    units = _units(vectors)
    order = _ordered(units.astype(np.float32))
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    vectors, units, of = vectors[order], units[order], place[of.ravel()]
    copies = np.bincount(of, minlength=len(order)).astype("<i8")
    center = units.mean(axis=0).astype(np.float32)
    radius = math.sqrt(((units - center) ** 2).sum(axis=1).max()) + 1e-6
    data = vectors.tobytes()
    row = [tile, size, len(data), first, center.tolist(), radius, copies.tobytes(), data, ids.tolist(), (first + of).tolist(), (copies[of] - 1).tolist()]
    return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, _TILE_TYPE.types, strict=True)], schema=_TILE_TYPE), len(order)


def _gathered(batches):
    """Sorted rows of a partition to a row for each tile."""
    now, ids, raws, classes = None, [], [], 0

    def made():
        nonlocal ids, raws, classes
        row, more = _tile(now[0], now[1], (now[0] >> 32 << 32) + classes, np.concatenate(ids), [raw for some in raws for raw in some.to_pylist()])
        ids, raws, classes = [], [], classes + more
        give_back()
        return row

    for batch in _tiled(batches):
        tiles = batch.column("tile").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(tiles)) + 1).tolist(), len(tiles)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if now and now[0] != tiles[a]:
                yield made()
            now = (int(tiles[a]), batch.column(0)[a].as_py())
            ids.append(batch.column("vec_id").slice(a, b - a).to_numpy())
            raws.append(batch.column("raw").slice(a, b - a))
    if now:
        yield made()


# Comparing


class _Side:
    """A tile made ready: unit vectors, turned, and the balls around its strips by block."""

    def __init__(self, size: int, first: int, copies: bytes, data: bytes, lead: int, turn: np.ndarray):
        self.size, self.first = size, first
        self.copies = np.frombuffer(copies, "<i8")
        self.vectors = np.frombuffer(data, "<f4" if len(data) == 4 * size * len(self.copies) else "<f8").reshape(-1, size)
        self.turned = _units(self.vectors).astype(np.float32) @ turn.astype(np.float32)
        front = self.turned[:, :lead]
        half, one = np.einsum("ij,ij->i", front, front)[:, None] / 2, np.ones((len(front), 1), dtype=np.float32)
        self.left, self.right = np.hstack((front, -half, one)), np.hstack((front, one, -half))
        starts = np.arange(0, len(front), STRIP)
        self.centers = np.add.reduceat(self.turned, starts, axis=0) / np.diff([*starts, len(front)])[:, None].astype(np.float32)
        mine = self.turned - np.repeat(self.centers, STRIP, axis=0)[: len(front)]
        apart = np.stack([np.einsum("ij,ij->i", mine[:, b], mine[:, b]) for b in blocks(size)])
        self.reach = np.sqrt(np.maximum.reduceat(apart, starts, axis=1) + _SLACK)
        self.radius = np.sqrt(np.maximum.reduceat(apart.sum(axis=0), starts) + _SLACK)
        self.bytes = len(data) + self.turned.nbytes + self.left.nbytes + self.right.nbytes


def _meets(left: _Side, turned: np.ndarray, cosine: float) -> np.ndarray:
    """Which of the turned vectors (rows) some block and the whole vector bring near strips of ``left`` (columns)."""
    shape = len(turned), len(left.centers)
    whole, some = np.zeros(shape, dtype=np.float32), np.zeros(shape, dtype=bool)
    for number, (block, limit) in enumerate(zip(blocks(left.size), _limits(left.size, cosine), strict=True)):
        one, two = turned[:, block], left.centers[:, block]
        square = (one * one).sum(axis=1)[:, None] + (two * two).sum(axis=1)[None, :] - 2 * one @ two.T
        some |= square <= (left.reach[number] + math.sqrt(limit)) ** 2 + _SLACK
        whole += square
    return some & (whole <= (left.radius + math.sqrt(2 - 2 * cosine + _SLACK)) ** 2 + _SLACK)


def _alike(left: _Side, right: _Side, rows: np.ndarray, columns: np.ndarray, cosine: float) -> np.ndarray:
    """Which pairs have the cosine: by single precision, near it by doubles, and very near it by sums that depend on nothing else."""
    alike = np.empty(len(rows), dtype=bool)
    for at in range(0, len(rows), 1 << 14):
        i, j = rows[at : at + (1 << 14)], columns[at : at + (1 << 14)]
        product = np.einsum("ij,ij->i", left.turned[i], right.turned[j])
        some = product >= cosine
        close = np.flatnonzero(np.abs(product - cosine) < _ROUGH)
        if len(close):
            product = np.einsum("ij,ij->i", _units(left.vectors[i[close]]), _units(right.vectors[j[close]]))
            some[close] = product >= cosine
            for k in close[np.abs(product - cosine) < _BAND].tolist():
                some[k] = _cosine(left.vectors[i[k]], right.vectors[j[k]]) >= cosine
        alike[at : at + len(i)] = some
    return alike


def _links(left: _Side, right: _Side, cosine: float):
    """(rows of left, columns of right, None), a link for each place, or (rows, columns, matrix with a row for each of the columns); each pair once."""
    meets, bound = None, -(1 - cosine) - _SLACK
    if _meets(left, right.turned[::_PROBE], cosine).mean() <= _MOST:
        meets = _meets(left, right.turned, cosine)
    products, screens = np.empty(_COLUMNS * STRIP, dtype=np.float32), np.empty(_COLUMNS * STRIP, dtype=bool)
    for number, at in enumerate(range(0, len(left.left), STRIP)):
        strip = left.left[at : at + STRIP]
        near = np.arange(len(right.turned)) if meets is None else np.flatnonzero(meets[:, number])
        if left is right:
            near = near[near > at]
        few: list[tuple] = []
        every = len(near) and len(near) == near[-1] - near[0] + 1
        for a in range(0, len(near), _COLUMNS):
            columns = near[a : a + _COLUMNS]
            some = right.right[columns[0] : columns[-1] + 1] if every else right.right[columns]
            product, screen = (x[: len(some) * len(strip)].reshape(len(some), len(strip)) for x in (products, screens))
            np.greater_equal(np.matmul(some, strip.T, out=product), bound, out=screen)
            hits = np.count_nonzero(screen)
            if not hits:
                continue
            if left is right and at + STRIP > columns[0]:
                screen &= np.arange(at, at + len(strip))[None, :] < columns[:, None]
            if hits * 256 < screen.size:
                j, i = np.nonzero(screen)
                few.append((at + i, columns[j]))
                continue
            whole = right.turned[columns] @ left.turned[at : at + len(strip)].T
            found = whole >= cosine + _ROUGH
            found &= screen
            if np.count_nonzero(whole >= cosine - _ROUGH) > np.count_nonzero(found):
                j, i = np.nonzero(screen & (np.abs(whole - cosine) <= 2 * _ROUGH))
                found[j, i] = _alike(left, right, at + i, columns[j], cosine)
            if found.any():
                yield np.arange(at, at + len(strip)), columns, found
        if few:
            i, j = (np.concatenate(x) for x in zip(*few, strict=True))
            alike = _alike(left, right, i, j, cosine)
            if alike.any():
                yield i[alike], j[alike], None


def _merged(labels: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
    """Gives the ends of edges the smallest label among them, until nothing changes; labels point to nodes."""
    while True:
        for node in (one, two):
            while (labels[labels[node]] != labels[node]).any():
                labels[node] = labels[labels[node]]
        a, b = labels[one], labels[two]
        apart = a != b
        if not apart.any():
            return
        one, two, a, b = one[apart], two[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))


def _joined(labels: np.ndarray, one: np.ndarray, two: np.ndarray, found: np.ndarray) -> None:
    """_merged() for the links of a matrix: first a link of each node, then those whose ends still lie apart."""

    def ends() -> tuple[np.ndarray, np.ndarray]:
        for node in (one, two):
            while (labels[labels[node]] != labels[node]).any():
                labels[node] = labels[labels[node]]
        return labels[one], labels[two]

    a, b = ends()
    if (a == b[0]).all() and (b == b[0]).all():
        return
    some, more = np.flatnonzero(found.any(axis=1)), np.flatnonzero(found.any(axis=0))
    _merged(labels, np.concatenate((one[some], one[found[:, more].argmax(axis=0)])), np.concatenate((two[found[some].argmax(axis=1)], two[more])))
    a, b = ends()
    i, j = np.nonzero(found & (a[:, None] != b[None, :]))
    if len(i):
        _merged(labels, one[i], two[j])


_FOUND = "node long, links long, root long"


def _compared(left: _Side, right: _Side, cosine: float) -> pa.RecordBatch:
    """Classes of two tiles that link, with the number of rows that they link with and the first class that links reach."""
    shift = 0 if left is right else len(left.copies)
    nodes = left.first + np.arange(len(left.copies))
    if shift:
        nodes = np.concatenate((nodes, right.first + np.arange(len(right.copies))))
    links, labels = np.zeros(len(nodes), dtype=np.int64), np.arange(len(nodes))
    for rows, columns, found in _links(left, right, cosine):
        if found is None:
            np.add.at(links, rows, right.copies[columns])
            np.add.at(links, columns + shift, left.copies[rows])
            _merged(labels, rows, columns + shift)
        else:
            numbers = found.astype(np.float64)  # exact up to 2**53 rows
            links[rows] += (right.copies[columns].astype(np.float64) @ numbers).astype(np.int64)
            links[columns + shift] += (numbers @ left.copies[rows].astype(np.float64)).astype(np.int64)
            _joined(labels, columns + shift, rows, found)
    while (labels[labels] != labels).any():
        labels = labels[labels]
    some = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(links[some]), pa.array(nodes[labels[some]])], names=["node", "links", "root"])


def _summed(found: list[pa.RecordBatch]) -> pa.RecordBatch:
    """The links of several pairs of tiles as one: a row for each class, with the first class that all these links reach."""
    node, links, root = (np.concatenate([batch.column(c).to_numpy() for batch in found]) for c in range(3))
    names, of = np.unique(np.concatenate((node, root)), return_inverse=True)
    labels, total = np.arange(len(names)), np.zeros(len(names), dtype=np.int64)
    np.add.at(total, of[: len(node)], links)
    _merged(labels, of[: len(node)], of[len(node) :])
    while (labels[labels] != labels).any():
        labels = labels[labels]
    return pa.RecordBatch.from_arrays([pa.array(names), pa.array(total), pa.array(names[labels])], names=["node", "links", "root"])


def _comparer(cosine: float, leads: dict[int, int]):
    """Pairs of tiles to their links, summed up while they are read; ``leads`` has the coordinates to screen by size."""

    def compare(batches):
        ready: dict[int, _Side] = {}
        held = 0

        def side(batch, at: int, name: str) -> _Side:
            nonlocal held
            tile, size = (batch.column(f"{x}_{name}")[at].as_py() for x in ("tile", "size"))
            if tile in ready:
                ready[tile] = ready.pop(tile)
                return ready[tile]
            ready[tile] = _Side(size, *(batch.column(f"{x}_{name}")[at].as_py() for x in ("first", "copies", "data")), leads.get(size, size), rotation(size))
            held += ready[tile].bytes
            while held > _READY_BYTES and len(ready) > 2:
                held -= ready.pop(next(iter(ready))).bytes
            return ready[tile]

        found, seen = [], 0
        for batch in batches:
            for at in range(batch.num_rows):
                rows = _compared(side(batch, at, "a"), side(batch, at, "b"), cosine)
                if rows.num_rows:
                    found.append(rows)
                    seen += rows.num_rows
                if seen > _ROWS:
                    found = [_summed(found)]
                    seen = found[0].num_rows
                    if seen > _ROWS // 2:
                        yield found.pop()
                        seen = 0
            give_back()
        if found:
            yield _summed(found)

    return compare


def _lead(sample: np.ndarray, cosine: float) -> int:
    """Coordinates of the leading blocks that suffice to tell nearly all pairs of sampled unit vectors apart."""
    size = sample.shape[1]
    every = blocks(size)
    if len(sample) < 32:
        return every[len(every) // 2].stop
    turned = sample @ rotation(size)
    one, two = np.triu_indices(len(sample), 1)
    apart = np.zeros(len(one))
    far = (turned @ turned.T)[one, two] < cosine
    for block in every:
        part = turned[:, block]
        square = (part * part).sum(axis=1)
        apart += (square[:, None] + square[None, :] - 2 * part @ part.T)[one, two]
        if (far & (apart <= 2 - 2 * cosine)).mean() <= 1e-3:
            return block.stop
    return size


def near_vectors(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding: array of float or double).

    Null and zero vectors and those with a null or non-finite component link with nothing, and neither do rows without vec_id (their
    component is null, and they are not kept). Vectors of different lengths do not link. Rows with the same vec_id
    are one node: each has the links of all. Other columns are not read; an empty table gives an empty result.
    ``vectors`` is read several times.
    """
    spark = vectors.sparkSession
    kind = vectors.select("embedding").dtypes[0][1]
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind if kind == "array<float>" else "array<double>").alias("embedding"))
    total = vectors.count()
    sample: dict[int, list] = {}
    for row in plain.where("vec_id is not null and size(embedding) > 0").orderBy(F.xxhash64("vec_id"), "vec_id").limit(_SAMPLE).collect():
        found = np.array([row.embedding], dtype=np.float64)
        if np.isfinite(found).all() and found.any():
            sample.setdefault(found.shape[1], []).append(_units(found)[0])
    pivots = {size: np.stack(rows).astype(np.float32)[: max(1, total // _PER_PIVOT)] for size, rows in sample.items()}
    width = 4 * max(sample, default=1)

    keyed = plain.mapInArrow(_keyer(pivots), _KEYED)
    keys = ["size", "cell", "near", "vec_id"]
    parts = max(1, min(32, total // 4096), -(-total * width // _PART_BYTES))
    dealt = keyed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id().cast("long"))
    tiles = written(dealt.mapInArrow(_gathered, _TILE_ROW), "tiles")

    a, b = (tiles.select(*(F.col(c).alias(f"{c}_{name}") for c in ("tile", "size", "first", "center", "radius", "copies", "data"))) for name in "ab")
    apart = F.aggregate(F.zip_with("center_a", "center_b", lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda total, x: total + x)
    turn = sum(F.shiftright(f"tile_{name}", 32) + F.col(f"tile_{name}") for name in "ab") % 2 == 0  # both orders of two parts have work
    meet = (F.col("size_a") >= F.col("size_b")) & (F.col("size_a") <= F.col("size_b")) & ((F.col("tile_a") == F.col("tile_b") + 0) | ((F.col("tile_a") != F.col("tile_b")) & (turn == (F.col("tile_a") < F.col("tile_b")))))
    meet &= F.sqrt(apart) <= F.col("radius_a") + F.col("radius_b") + math.sqrt(2 - 2 * cosine) + 1e-5
    right = max(1, tiles.select("tile").rdd.getNumPartitions())
    pairs = a.coalesce(max(4, -(-8 * spark.sparkContext.defaultParallelism // right))).hint("shuffle_replicate_nl").join(b, meet).drop("center_a", "center_b", "radius_a", "radius_b")
    largest = tiles.agg(F.max("bytes")).first()[0] or 1
    batch, name = max(1, min(1000, _BATCH_BYTES // (2 * largest))), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, batch)
    try:
        found = written(pairs.mapInArrow(_comparer(cosine, {size: _lead(np.unique(rows, axis=0), cosine) for size, rows in sample.items()}), _FOUND), "found")
    finally:
        spark.conf.set(name, before)

    members = tiles.select(F.explode(F.arrays_zip("ids", "nodes", "twins")).alias("m")).select(F.col("m.ids").alias("vec_id"), F.col("m.nodes").alias("node"), F.col("m.twins").alias("twins"))
    several = members.groupBy("vec_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    same = members.join(several, "vec_id").select(F.col("node").alias("a"), F.col("low").alias("b"))
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(same)).withColumnRenamed("node", "in")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = members.join(links, "node", "left").join(groups, F.col("node") == F.col("in"), "left").where("twins > 0 or links is not null or component is not null")
    linked = written(linked.select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("twins")).alias("links"), F.coalesce("component", "node").alias("group")), "linked")
    least = linked.groupBy("group").agg(F.min("vec_id").alias("component"))
    own = linked.join(least, "group").groupBy("vec_id").agg(F.sum("links").alias("links"), F.min("component").alias("component"))
    rows = plain.select("vec_id").join(own, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return rows.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
