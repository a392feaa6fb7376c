"""Renamed segments: where the data of each segment ends up, and the merge of colliding data."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewise import vocab
from pacewise.functions.normalize import parse_feed_timestamp
from pacewise.operators.bounded import stored, stored_with_count
from pacewise.schemas import MAPPING_COLUMNS, SPLIT_COLUMNS, require_columns


def merge_rules(mapping: DataFrame, note: str = vocab.MERGE_NOTE) -> DataFrame:
    """``seq, route, target_route`` of the rows that order a merge into another segment."""
    require_columns(mapping, MAPPING_COLUMNS + ("seq",), "mapping")
    return (
        mapping.filter(F.col("note").contains(note))
        .select(
            "seq",
            F.trim(F.col("route").cast("string")).alias("route"),
            F.trim(F.col("target_route").cast("string")).alias("target_route"),
        )
        .filter("route <> target_route")
    )


def _rule() -> Column:
    """What tells a rule from others, in the order in which rules act."""
    return F.struct("seq", "route", "target_route")


def _next_rules(stays: DataFrame, rules: DataFrame) -> DataFrame:
    """``stays`` (segment, since, and what else it has) with ``next``, the first rule that leaves the segment later, or null.

    ``since`` is the rule that brought the data, null for data that was there from the start. One sort for each segment.
    """
    leaving = rules.select(F.col("route").alias("segment"), _rule().alias("since"), _rule().alias("leaves"), F.lit(1).alias("kind"))
    events = stays.withColumn("kind", F.lit(0)).unionByName(leaving, allowMissingColumns=True)
    later = Window.partitionBy("segment").orderBy(F.col("since").desc_nulls_last(), "kind").rowsBetween(Window.unboundedPreceding, -1)
    return events.withColumn("next", F.last("leaves", ignorenulls=True).over(later)).filter("kind = 0").drop("kind", "leaves")


def _origins(rules: DataFrame) -> DataFrame:
    """``origin, next``: every segment that a rule names, and the first rule that takes its data along."""
    named = rules.select("route").union(rules.select("target_route")).distinct().toDF("origin")
    stays = named.select("origin", F.col("origin").alias("segment"), F.lit(None).cast(rules.select(_rule().alias("r")).schema["r"].dataType).alias("since"))
    return _next_rules(stays, rules).select("origin", "next")


def _moved(rules: DataFrame) -> DataFrame:
    """``origin, target_pair_id, copies`` when a rule takes all data along: chains of rules, followed by pointer jumping.

    A rule points to the first later rule that leaves its target. Each round makes every pointer twice as long, so there are as
    many rounds as the longest chain has binary digits; a round is two joins of tables with a row for each rule.
    """
    stays = rules.select(_rule().alias("rule"), F.col("target_route").alias("segment"), _rule().alias("since"))
    state = _next_rules(stays, rules).select("rule", F.col("segment").alias("place"), "next")
    state, unfinished = stored_with_count(state, "remap-rules", F.col("next").isNotNull())
    while unfinished:
        ahead = state.select(F.col("rule").alias("next"), F.col("place").alias("further"), F.col("next").alias("after"))
        state = state.join(ahead, "next", "left").select("rule", F.coalesce("further", "place").alias("place"), F.col("after").alias("next"))
        state, unfinished = stored_with_count(state, "remap-rules", F.col("next").isNotNull())
    ends = state.select(F.col("rule").alias("next"), "place")
    placed = _origins(rules).join(ends, "next", "left")
    return placed.select("origin", F.coalesce("place", "origin").alias("target_pair_id"), F.lit(1).alias("copies"))


def _copied(rules: DataFrame) -> DataFrame:
    """``origin, target_pair_id, copies`` when rules copy: every later rule of a segment copies what is there by then.

    Data at a segment meets its next rule, whose copy goes on from the target while the data stays for the rule after.
    Ways through that graph (two edges a rule) are counted up to 2, which says that data met itself: ``ways`` has those
    shorter than a power of two, ``leaps`` those of exactly that length, which doubles each round.
    """
    copied = rules.select(_rule().alias("rule"), F.col("target_route").alias("segment"), _rule().alias("since"))
    staying = rules.select(_rule().alias("rule"), F.col("route").alias("segment"), _rule().alias("since"))
    both = _next_rules(copied.unionByName(staying), rules).filter("next is not null")

    def counted(pairs: DataFrame, *keys: str) -> DataFrame:
        return pairs.groupBy(*keys).agg(F.least(F.lit(2), F.sum("n")).cast("int").alias("n"))

    leaps = counted(both.select("rule", "next", F.lit(1).alias("n")), "rule", "next")
    leaps, unfinished = stored_with_count(leaps, "remap-leaps", F.lit(True))
    ways = stored(_origins(rules).filter("next is not null").select("origin", F.col("next").alias("rule"), F.lit(1).alias("n")), "remap-ways")
    while unfinished:
        onward = leaps.select("rule", "next", F.col("n").alias("m"))
        longer = ways.join(onward, "rule").select("origin", F.col("next").alias("rule"), (F.col("n") * F.col("m")).alias("n"))
        ways = stored(counted(ways.unionByName(longer), "origin", "rule"), "remap-ways")
        second = leaps.select(F.col("rule").alias("next"), F.col("next").alias("after"), F.col("n").alias("m"))
        twice = leaps.join(second, "next").select("rule", F.col("after").alias("next"), (F.col("n") * F.col("m")).alias("n"))
        leaps, unfinished = stored_with_count(counted(twice, "rule", "next"), "remap-leaps", F.lit(True))
    own = _origins(rules).select("origin", F.col("origin").alias("target_pair_id"), F.lit(1).alias("n"))
    reached = ways.select("origin", F.col("rule.target_route").alias("target_pair_id"), "n")
    return counted(own.unionByName(reached), "origin", "target_pair_id").withColumnRenamed("n", "copies")


def resolve_rules(rules: DataFrame, keep_source: bool = False) -> DataFrame:
    """``origin, target_pair_id, copies, shared``: the final place of every segment a rule names.

    Rules act one after another in ``seq`` order, so chains depend on that order: A to B then B to
    C takes A to C, the other order leaves A in B. Rules equal in all columns count once. ``copies`` is 2 where data of the
    origin met itself and was de-duplicated. ``shared`` marks targets that can receive the data of several origins.
    No task sees all rules; the rounds write tables in the shared folder, so the rules are read when this is called.
    """
    rules = stored(rules.distinct(), "remap-given")
    final = _copied(rules) if keep_source else _moved(rules)
    meeting = F.sum("copies").over(Window.partitionBy("target_pair_id"))
    return stored(final.withColumn("shared", meeting >= 2), "remap-places")


def remap(rows: DataFrame, rules: DataFrame, keep_source: bool = False) -> DataFrame:
    """Rows with ``target_pair_id`` (the input ``pair_id`` stays), without any de-duplication."""
    places = resolve_rules(rules, keep_source).select("origin", "target_pair_id")
    joined = rows.join(places, rows.pair_id == places.origin, "left").drop("origin")
    return joined.withColumn("target_pair_id", F.coalesce("target_pair_id", "pair_id"))


def _moves(present: DataFrame, places: DataFrame) -> DataFrame:
    """``year, pair_id, target_pair_id, met, changes`` of every (year, segment) that has data.

    ``met`` says that data of two origins, or of one twice, comes together at the target in that year. ``changes`` is above 0
    where the target's data changes; a comparison, unlike a flag, counts as selective when Spark decides to prune partitions by it.
    """
    named = places.select(F.col("origin").alias("pair_id"), "target_pair_id", "copies")
    own = {"target_pair_id": F.coalesce("target_pair_id", "pair_id"), "copies": F.coalesce("copies", F.lit(1))}
    moves = present.select("year", "pair_id").join(named, "pair_id", "left").withColumns(own)
    there = Window.partitionBy("year", "target_pair_id")
    met = F.sum("copies").over(there) >= 2
    changes = met.cast("int") + F.max((F.col("pair_id") != F.col("target_pair_id")).cast("int")).over(there)
    return moves.select("year", "pair_id", "target_pair_id", met.alias("met"), changes.alias("changes"))


def _merged(rows: DataFrame, moves: DataFrame) -> DataFrame:
    """Rows of the (year, segment) pairs of ``moves`` at their targets; two scans, one for what met and one for the rest."""
    final = ("year", F.col("target_pair_id").alias("pair_id")) + SPLIT_COLUMNS
    joined = rows.join(moves, ["year", "pair_id"])
    return joined.filter("not met").select(*final).unionByName(joined.filter("met").select(*final).dropDuplicates())


def merge_segments(rows: DataFrame, rules: DataFrame, keep_source: bool = False, present: DataFrame | None = None) -> DataFrame:
    """Split rows under their final ``pair_id``, whole-row duplicates removed where data met.

    De-duplication applies to a (segment, year) that received the data of two or more origins;
    a plain move keeps repeated rows. Segments that no rule names pass through without a shuffle. ``present`` has the (year, pair_id)
    pairs of ``rows``, where they are known without reading rows, as from the folders of a split tree.
    """
    columns = ("year", "pair_id") + SPLIT_COLUMNS
    require_columns(rows, columns, "split rows")
    rows, places = rows.select(*columns), resolve_rules(rules, keep_source)
    named = places.select(F.col("origin").alias("pair_id")).distinct()
    if present is None:
        present = rows.select("year", "pair_id").distinct()
    moves = stored(_moves(present.join(named, "pair_id", "left_semi"), places), "remap-moves")
    return rows.join(named, "pair_id", "left_anti").select(*columns).unionByName(_merged(rows, moves))


#: Rows of changes (about 100 bytes each) up to which they are broadcast; beyond, Spark chooses the join.
BROADCAST_CHANGES = 100_000


def touched_segments(rows: DataFrame, moves: DataFrame) -> DataFrame:
    """New content of the (year, segment) pairs that ``moves`` changes.

    The changes, where they are few, are broadcast, and Spark opens only the partitions of ``rows`` that they name.
    """
    changes = moves.filter("changes > 0")
    few = changes.limit(BROADCAST_CHANGES + 1).count() <= BROADCAST_CHANGES
    return _merged(rows.select("year", "pair_id", *SPLIT_COLUMNS), F.broadcast(changes) if few else changes)


def planned_moves(present: DataFrame, rules: DataFrame, keep_source: bool = False) -> DataFrame:
    """What a merge does to each (year, segment) that has data, as a table; see ``_moves``."""
    return stored(_moves(present, resolve_rules(rules, keep_source)), "remap-moves")


def emptied_segments(moves: DataFrame) -> DataFrame:
    """``year, pair_id`` of data that moved away and that nothing replaces."""
    kept = moves.select("year", F.col("target_pair_id").alias("pair_id"))
    return moves.select("year", "pair_id").distinct().join(kept, ["year", "pair_id"], "left_anti")


def chronological() -> list[Column]:
    """Sort keys of split rows inside a segment: by time, unreadable times last, then as text."""
    stamp = parse_feed_timestamp(F.concat_ws(" ", "date", "time"))
    return [stamp.asc_nulls_last(), F.col("date").asc(), F.col("time").asc()]
