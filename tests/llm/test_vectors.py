"""Tiles of the vector join against brute force, and what it moves."""

import os
import re
from collections import Counter

import numpy as np

from pacewise.llm import vector_join
from tests.llm.helpers import Links


def _side(first, points, copies, lead, dtype="<f4"):
    points = points[vector_join._ordered(vector_join._units(points).astype("f4"))].astype(dtype)
    return vector_join._Side(points.shape[1], first, copies.astype("<i8").tobytes(), points.tobytes(), lead, vector_join.rotation(points.shape[1]))


def _shapes(rng, n, size):
    center, centers = rng.standard_normal(size), rng.standard_normal((5, size))
    yield rng.standard_normal((n, size))
    yield center + 0.02 * rng.standard_normal((n, size))
    yield center + 0.33 * rng.standard_normal((n, size))
    yield centers[rng.integers(0, 5, n)] + rng.choice([0.05, 0.2, 0.35], (n, 1)) * rng.standard_normal((n, size))
    yield rng.integers(0, 2, (n, size)) + np.eye(n, size)


def test_tiles_against_every_pair(monkeypatch):
    """Strips, chunks and both ways to count, by the cosine of doubles; ties at the cosine are decided once."""
    for strip, columns in ((7, 5), (256, 1024)):
        monkeypatch.setattr(vector_join, "STRIP", strip)
        monkeypatch.setattr(vector_join, "_COLUMNS", columns)
        rng = np.random.default_rng(strip)
        for number, (one, two) in enumerate(zip(_shapes(rng, 150, 40), _shapes(np.random.default_rng(strip), 90, 40), strict=True)):
            for lead, dtype in ((16, "<f4"), (40, "<f8")):
                left = _side(0, one, rng.integers(1, 4, len(one)), lead, dtype)
                right = _side(150, two, rng.integers(1, 4, len(two)), lead, dtype)
                for second in (left, right):
                    units, others = (vector_join._units(s.vectors) for s in (left, second))
                    near = units @ others.T >= 0.9
                    for i, j in zip(*np.nonzero(np.abs(units @ others.T - 0.9) < 1e-9), strict=True):
                        near[i, j] = vector_join._cosine(left.vectors[i], second.vectors[j]) >= 0.9
                    links, counts = Links(range(240)), Counter()
                    for i, j in zip(*np.nonzero(np.triu(near, 1) if second is left else near), strict=True):
                        links.link(int(i), int(second.first + j))
                        counts[int(i)] += int(second.copies[j])
                        counts[int(second.first + j)] += int(left.copies[i])
                    got = vector_join._compared(left, second, 0.9).to_pylist()
                    assert {r["node"]: r["links"] for r in got} == counts, (strip, number, lead)
                    forest = Links(range(240))
                    for r in got:
                        if r["node"] != r["root"]:
                            forest.link(r["node"], r["root"])
                    assert all(forest.least(n) == links.least(n) for n in range(240))


def test_vectors_move_once(spark, monkeypatch):
    """Vectors that all lie apart: one shuffle of them, one written table with each once, and no shuffle where tiles meet."""
    rng = np.random.default_rng(5)
    rows = [(n, v) for n, v in enumerate(rng.standard_normal((9000, 64)).astype("f4").tolist())]
    kept = {}
    write = vector_join.written

    def written(frame, name):
        kept[name] = (frame._jdf.queryExecution().executedPlan().toString(), write(frame, name))
        return kept[name][1]

    monkeypatch.setattr(vector_join, "written", written)
    found = vector_join.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert found.where("n_links = 0 and kept").count() == 9000
    assert "Exchange" not in kept["found"][0]
    assert len(re.findall("Exchange", kept["tiles"][0])) == 1
    folder = kept["tiles"][1].inputFiles()[0].removeprefix("file:").lstrip("/").rpartition("/")[0]
    assert sum(os.path.getsize(f"/{folder}/{x}") for x in os.listdir(f"/{folder}")) < 1.5 * 9000 * 256


def test_repeated_ids_and_copies(spark):
    """Many tiles, a large class of copies, near copies, and ids that stand for several different vectors."""
    rng = np.random.default_rng(6)
    base = rng.standard_normal((7000, 24))
    near = base[:400] + 0.1 * rng.standard_normal((400, 24))
    vectors = np.concatenate((base, near, np.repeat(base[:1], 1500, axis=0))).astype("f4")
    ids = np.arange(len(vectors))
    ids[500:510], ids[7000:7005] = 20, 6000 + np.arange(5)
    units = vectors / np.linalg.norm(vectors.astype("f8"), axis=1)[:, None]
    links, counts = Links(ids.tolist()), Counter()
    for at in range(0, len(units), 500):
        for i, j in zip(*np.nonzero(units[at : at + 500] @ units.T >= 0.9), strict=True):
            if at + i != j:
                counts[int(ids[at + i])] += 1
                if links.least(int(ids[at + i])) != links.least(int(ids[j])):
                    links.link(int(ids[at + i]), int(ids[j]))
    want = sorted((int(i), counts[int(i)], links.least(int(i)), links.least(int(i)) == i) for i in ids)
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<float>").repartition(5)
    assert sorted(tuple(r) for r in vector_join.near_vectors(frame).collect()) == want
