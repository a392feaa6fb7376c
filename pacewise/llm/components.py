"""Connected components of a graph given as edges, by alternating large and small stars.

Each round links every node's larger neighbours to its smallest one, then its smaller neighbours to the smallest.
Edges end as stars around the smallest node of each component. A hub costs a partial aggregate and a join whose large
partitions adaptive execution splits; no component is ever gathered in one task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over distinct edges (a, b) with a > b."""
    both = edges.select("a", "b")
    if large:
        both = both.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    joined = both.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", F.col("least").alias("b")))
    return moved.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple[int, int | None]]:
    """Distinct edges as a table, with their number and checksum: equal for equal sets, whatever their order."""
    table = written(edges, "edges")
    row = table.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("sum")).first()
    return table, (row.n, row.sum)


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node that links reach) of every node with an edge to another one.

    ``edges`` has columns a and b of an ordered type; direction, repeats, loops and nulls do not matter.
    """
    plain = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state, before = _stored(plain)
    while True:
        state, after = _stored(_star(_star(state, True), False))
        if after == before:
            break
        before = after
    stars = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
