"""Histogram re-aggregated at the four summary levels, in three equivalent forms.

* :func:`expand_levels` copies each histogram row to its levels and aggregates once. After a
  repartition by segment no later step shuffles again. The summary takes the copies as they are
  (:func:`level_copies`), because percentiles do not need the aggregate.
* :func:`grouping_sets_levels` is the same with ``GROUPING SETS``.
* :func:`union_levels` is the union of four aggregates.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise import vocab
from pacewise.operators.clean import positive_measures
from pacewise.schemas import HISTOGRAM_COLUMNS, LEVEL_COLUMNS, require_columns

_KEYS = ("pair_id", "day_type", "time_period", "travel_time_sec")


def level_input(histogram: DataFrame) -> DataFrame:
    """Trimmed, cast and guarded histogram rows. Trimming may merge keys, so levels re-aggregate."""
    require_columns(histogram, HISTOGRAM_COLUMNS, "histogram table")
    return (
        histogram.select(
            *(F.trim(c).alias(c) for c in HISTOGRAM_COLUMNS[:4]),
            F.col("travel_time_sec").try_cast("int").alias("travel_time_sec"),
            F.col("total_volume").try_cast("long").alias("volume"),
        )
        .filter(
            F.col("pair_id").isNotNull()
            & F.col("day_type").isNotNull()
            & F.col("time_period").isNotNull()
            & (F.col("vehicle_type_group") == vocab.VEHICLE_GROUP)
            & positive_measures()
        )
        .select(*_KEYS, "volume")
    )


def sentinel_rows(rows: DataFrame) -> DataFrame:
    """Rows whose day type or period equals the filler ``ALL`` and would mix with a higher level."""
    return rows.filter((F.col("day_type") == vocab.ALL) | (F.col("time_period") == vocab.ALL))


def one_level(rows: DataFrame, level: tuple[str, bool, bool]) -> DataFrame:
    """Volume per travel time at one level; dimensions the level leaves out read ``ALL``."""
    name, by_day, by_period = level
    keys = ["pair_id", *["day_type"] * by_day, *["time_period"] * by_period, "travel_time_sec"]
    summed = rows.groupBy(*keys).agg(F.sum("volume").alias("volume"))
    filler = {"summary_level": F.lit(name)}
    if not by_day:
        filler["day_type"] = F.lit(vocab.ALL)
    if not by_period:
        filler["time_period"] = F.lit(vocab.ALL)
    return summed.withColumns(filler).select(*LEVEL_COLUMNS)


def union_levels(rows: DataFrame, levels: Sequence[tuple[str, bool, bool]] = vocab.LEVELS) -> DataFrame:
    result = one_level(rows, levels[0])
    for level in levels[1:]:
        result = result.unionByName(one_level(rows, level))
    return result


def grouping_sets_levels(
    rows: DataFrame, levels: Sequence[tuple[str, bool, bool]] = vocab.LEVELS
) -> DataFrame:
    sets = [
        [F.col(c) for c in ["pair_id", *["day_type"] * d, *["time_period"] * p, "travel_time_sec"]]
        for _, d, p in levels
    ]
    no_day, no_period = F.grouping("day_type"), F.grouping("time_period")
    name = F.lit(None).cast("string")
    for level, by_day, by_period in levels:
        name = F.when(
            (no_day == int(not by_day)) & (no_period == int(not by_period)), F.lit(level)
        ).otherwise(name)
    return (
        rows.groupingSets(sets, *_KEYS)
        .agg(
            name.alias("summary_level"),
            F.when(no_day == 1, vocab.ALL).otherwise(F.col("day_type")).alias("day_value"),
            F.when(no_period == 1, vocab.ALL).otherwise(F.col("time_period")).alias("period_value"),
            F.sum("volume").alias("volume"),
        )
        .select(
            "summary_level",
            "pair_id",
            F.col("day_value").alias("day_type"),
            F.col("period_value").alias("time_period"),
            "travel_time_sec",
            "volume",
        )
    )


def level_copies(rows: DataFrame, levels: Sequence[tuple[str, bool, bool]] = vocab.LEVELS) -> DataFrame:
    """Each row once per level, not aggregated; the segment column passes through unchanged."""
    day, period, filler = F.col("day_type"), F.col("time_period"), F.lit(vocab.ALL)
    copies = F.array(
        *(
            F.struct(
                F.lit(name).alias("summary_level"),
                (day if by_day else filler).alias("day_type"),
                (period if by_period else filler).alias("time_period"),
            )
            for name, by_day, by_period in levels
        )
    )
    return rows.select("pair_id", F.explode(copies).alias("level"), "travel_time_sec", "volume").select(
        "level.*", "pair_id", "travel_time_sec", "volume"
    )


def expand_levels(rows: DataFrame, levels: Sequence[tuple[str, bool, bool]] = vocab.LEVELS) -> DataFrame:
    return (
        level_copies(rows, levels)
        .groupBy("summary_level", "pair_id", "day_type", "time_period", "travel_time_sec")
        .agg(F.sum("volume").alias("volume"))
        .select(*LEVEL_COLUMNS)
    )
