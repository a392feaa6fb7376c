"""Reliability summary: percentiles, buffer measures and grade at every level."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise import vocab
from pacewise.functions import measures
from pacewise.operators.levels import grouping_sets_levels, level_copies, level_input, union_levels
from pacewise.operators.weighted import weighted_percentile_disc
from pacewise.schemas import GROUP_COLUMNS, SUMMARY_COLUMNS


# The segment comes first because the window sort then tells most rows apart by their first bytes.
_SORTED_KEYS = ("pair_id", "summary_level", "day_type", "time_period")


def level_percentiles(level_rows: DataFrame) -> DataFrame:
    percentiles = weighted_percentile_disc(level_rows, _SORTED_KEYS, "travel_time_sec", "volume")
    return percentiles.select(*GROUP_COLUMNS, *(name for name, _, _ in vocab.PERCENTILES))


def with_buffer(percentiles: DataFrame) -> DataFrame:
    p50, p95 = F.col("p50_travel_time_sec"), F.col("p95_travel_time_sec")
    return percentiles.withColumn("buffer_time_sec", measures.buffer_time(p50, p95)).withColumn(
        "buffer_index", measures.buffer_index(p50, p95)
    )


def with_grade(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reliability_level", measures.grade(F.col("buffer_index")))


def summarise(histogram: DataFrame, form: str = "expand") -> DataFrame:
    """Summary of a histogram table.

    ``form`` picks how levels are built: ``expand`` (default), ``grouping_sets`` or ``union``.
    With ``expand`` the histogram is repartitioned by segment once, and the copies per level, one
    sort, both windows and the percentile aggregate all run on that partitioning. A segment's share
    of a histogram is bounded by its cells, so one busy segment does not unbalance it.
    """
    rows = level_input(histogram)
    if form == "expand":
        levels = level_copies(rows.repartition("pair_id"))
    elif form == "grouping_sets":
        levels = grouping_sets_levels(rows)
    elif form == "union":
        levels = union_levels(rows)
    else:
        raise ValueError(f"unknown form {form!r}")
    return with_grade(with_buffer(level_percentiles(levels))).select(*SUMMARY_COLUMNS)


def level_counts(summary: DataFrame) -> DataFrame:
    return summary.groupBy("summary_level").agg(F.count("*").alias("n_rows"))


def invalid_percentiles(summary: DataFrame) -> DataFrame:
    """Rows that break ``p95 >= p50``."""
    return summary.filter("p95_travel_time_sec < p50_travel_time_sec")
