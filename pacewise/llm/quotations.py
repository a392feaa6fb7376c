"""Chat formatting by quotation linking.

A message's lines are parsed into own lines and quoted ones with their level (the number of ``>`` in front). Passages, which are
neighbouring lines of one level without a blank one between them, are normalised, so that line breaks do not count, hashed, and
joined to the same hashes of passages and lines that messages of the conversation wrote themselves; what no whole passage finds
links line by line. Each hash stands for the earliest message with it, found by a partial aggregate, so a very common passage costs
one row. A message replies to the one that most of its outermost quoted lines come from. Following replies by doubling gives every
message its thread, its depth and, from the sizes of the branches before it, its place in reply order. The result stays a row
per message: no conversation is gathered in one place.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacewise.llm.common import by_batch, written

_MARKS = re.compile(r"[ \t]*(>[ \t>]*)")
_INTRO = re.compile(r"\s*(on .{0,200}|.{1,100}) (wrote|writes|said)\s*:\s*", re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+")


def normal(content: str) -> str:
    """Lower case, letters and digits only, single blanks."""
    return " ".join(_WORD.findall(content.lower()))


def _hash(content: str) -> bytes:
    return hashlib.blake2b(content.encode("utf-8", "surrogatepass"), digest_size=16).digest()


@dataclass
class Message:
    """What a text says itself and what it quotes; a unit is (passage, level, hash, lines, whole)."""

    own: list[str] = field(default_factory=list)
    level: int = 0
    n_quoted: int = 0
    said: list[bytes] = field(default_factory=list)
    asked: list[tuple[int, int, bytes, int, bool]] = field(default_factory=list)


def _passages(lines: list[tuple[int, str]]) -> list[list[tuple[int, str]]]:
    """Neighbouring lines of equal level, none of them blank."""
    found: list[list[tuple[int, str]]] = []
    before = None
    for level, content in lines:
        if not content.strip():
            before = None
            continue
        if level != before:
            found.append([])
        found[-1].append((level, content))
        before = level
    return found


def parsed(text: str | None) -> Message:
    lines = []
    for line in re.split(r"\r?\n", text or "") if text else []:
        marks = _MARKS.match(line)
        lines.append((marks[1].count(">"), line[marks.end() :]) if marks else (0, line))
    message = Message()
    own = []
    for at, (level, content) in enumerate(lines):
        if not level and not (at + 1 < len(lines) and lines[at + 1][0] and _INTRO.fullmatch(content)):
            own.append((0, content))
    message.own = [content for _, content in own]
    message.level = max((level for level, _ in lines), default=0)
    said = set()
    for passage in _passages(own):
        said |= {normal(content) for _, content in passage} | {normal(" ".join(c for _, c in passage))}
    message.said = sorted(_hash(s) for s in said if s)
    for number, passage in enumerate(p for p in _passages(lines) if p[0][0]):
        level, contents = passage[0][0], [normal(content) for _, content in passage]
        message.n_quoted += len(contents)
        if whole := " ".join(c for c in contents if c):
            message.asked.append((number, level, _hash(whole), len(contents), True))
        if len(contents) > 1:
            message.asked += [(number, level, _hash(c), 1, False) for c in contents if c]
    return message


_PARSED = (
    "conv_id {conv}, turn {turn}, role string, text string, quote_level long, n_quoted long, said array<binary>, "
    "asked array<struct<passage:int,level:int,hash:binary,lines:int,whole:boolean>>"
)
_UNIT = pa.struct([("passage", pa.int32()), ("level", pa.int32()), ("hash", pa.binary()), ("lines", pa.int32()), ("whole", pa.bool_())])
_UNIT_NAMES = ("passage", "level", "hash", "lines", "whole")


def _parse(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [parsed(t) for t in batch.column(3).to_pylist()]
    columns = [
        *(batch.column(i) for i in range(3)),
        pa.array([re.sub(r"^\s+|\s+$", "", "\n".join(m.own)) for m in found], pa.string()),
        pa.array([m.level for m in found], pa.int64()),
        pa.array([m.n_quoted for m in found], pa.int64()),
        pa.array([m.said for m in found], pa.list_(pa.binary())),
        pa.array([[dict(zip(_UNIT_NAMES, u, strict=True)) for u in m.asked] for m in found], pa.list_(_UNIT)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["conv_id", "turn", "role", "text", "quote_level", "n_quoted", "said", "asked"])


def linked(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (without quotes), quote_level, n_quoted, n_linked, parent_turn, thread, depth, position and chat of every row.

    ``quote_level`` is the deepest level, ``n_quoted`` counts quoted lines that are not blank, ``n_linked`` those found in an earlier
    message, in a whole passage or by themselves; ties for the parent go to the latest message. A message without a parent begins a
    thread (its own turn) at depth 0. Lines without a letter or digit link nothing by themselves. A line that only introduces a quote right
    below goes with it. Null texts have no lines and give an empty text and chat; rows with a null conv_id or turn link nothing, have
    their own turn as thread and a null position. Rows with the same conv_id and turn are one message in links. Sorted by conv_id and
    ``position`` (from 0) a conversation reads in reply order: each message stands behind its parent, with the branches of a parent,
    and threads, in the order of their turns.
    """
    rows = messages.select("conv_id", "turn", "role", "text")
    kinds = dict(rows.dtypes)
    rows = written(rows.mapInArrow(by_batch(_parse, 3), _PARSED.format(conv=kinds["conv_id"], turn=kinds["turn"])), "messages")
    named = rows.where("conv_id is not null and turn is not null")
    asked = named.select("conv_id", "turn", F.explode("asked").alias("unit")).select("conv_id", "turn", "unit.*")
    talks = asked.select("conv_id").distinct()
    said = named.join(talks, "conv_id", "left_semi").select("conv_id", "turn", F.explode("said").alias("hash"))
    first = said.groupBy("conv_id", "hash").agg(F.min("turn").alias("source"))
    found = asked.join(first, ["conv_id", "hash"]).where("source < turn")
    of_passage = Window.partitionBy("conv_id", "turn", "passage")
    counted = found.withColumn("found_whole", F.bool_or("whole").over(of_passage)).where("whole = found_whole")
    votes = counted.groupBy("conv_id", "turn", "level", "source").agg(F.sum("lines").alias("lines"))
    best = votes.groupBy("conv_id", "turn").agg(F.sum("lines").alias("n_linked"), F.min(F.struct("level", (-F.col("lines")).alias("less"), (-F.col("source")).alias("before"))).alias("best"))
    parents = best.select("conv_id", "turn", "n_linked", (-F.col("best.before")).alias("parent_turn"))
    nodes = written(named.select("conv_id", "turn").distinct().join(parents, ["conv_id", "turn"], "left"), "parents")
    placed = nodes.select("conv_id", "turn", "n_linked", "parent_turn").join(_threads(nodes), ["conv_id", "turn"])
    rows = rows.drop("said", "asked").join(placed, ["conv_id", "turn"], "left")
    return rows.select(
        "conv_id", "turn", "role", "text", "quote_level", "n_quoted", F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "parent_turn",
        F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), "position",
        F.when(F.col("text") != "", F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), "text")).otherwise("").alias("chat"))


def _ahead(state: DataFrame, *sums: str) -> DataFrame:
    """State of each message joined with that of the one its pointer ``above`` names: pointers and the named sums reach twice as far."""
    up = state.select("conv_id", F.col("turn").alias("above"), F.col("above").alias("further"), F.col("top").alias("higher"), *(F.col(s).alias(f"more_{s}") for s in sums))
    return state.join(up, ["conv_id", "above"], "left")


def _threads(nodes: DataFrame) -> DataFrame:
    """conv_id, turn, thread, depth and position of every message; a parent is always earlier, so there is no cycle.

    The first doubling sums the messages of each branch, along with thread and depth; the sizes of the branches before it are a
    message's distance from its parent, and the second doubling sums these along the way to the root.
    """
    start = nodes.select("conv_id", "turn", F.col("parent_turn").alias("above"), F.coalesce("parent_turn", "turn").alias("top"))
    state = written(start.withColumns({"depth": F.col("above").isNotNull().cast("long"), "size": F.lit(1).cast("long")}), "threads")
    rounds = 0
    while not state.where("above is not null").isEmpty():
        below = state.where("above is not null").groupBy("conv_id", F.col("above").alias("turn")).agg(F.sum("size").alias("more_size"))
        state = written(_ahead(state, "depth").join(below, ["conv_id", "turn"], "left").select(
            "conv_id", "turn", F.col("further").alias("above"), F.coalesce("higher", "top").alias("top"), (F.col("depth") + F.coalesce("more_depth", F.lit(0))).alias("depth"),
            (F.col("size") + F.coalesce("more_size", F.lit(0))).alias("size")), "threads")
        rounds += 1
    known = nodes.select("conv_id", "turn", "parent_turn").join(state.select("conv_id", "turn", F.col("top").alias("thread"), "depth", "size"), ["conv_id", "turn"])
    before = Window.partitionBy("conv_id", "parent_turn").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("size").over(before), F.lit(0)) + F.col("parent_turn").isNotNull().cast("long")
    known = known.select("conv_id", "turn", "thread", "depth", F.col("parent_turn").alias("above"), F.col("thread").alias("top"), offset.alias("position"))
    for _ in range(rounds):
        known = written(_ahead(known, "position").select(
            "conv_id", "turn", "thread", "depth", F.col("further").alias("above"), "top", (F.col("position") + F.coalesce("more_position", F.lit(0))).alias("position")), "positions")
    return known.select("conv_id", "turn", "thread", "depth", "position")
