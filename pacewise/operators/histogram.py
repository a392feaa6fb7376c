"""Additive travel-time histogram: the step that condenses facts to a bounded size."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise import vocab
from pacewise.operators.clean import positive_measures
from pacewise.schemas import HISTOGRAM_COLUMNS, HISTOGRAM_INPUT, require_columns


def histogram(
    clean: DataFrame,
    excluded_dates: Sequence[str] | None = None,
    day_types: Sequence[str] = vocab.DAY_TYPES,
    by: Sequence[str] = (),
) -> DataFrame:
    """Volume per segment, day type, period and travel time, all vehicle types together, and per value of the columns ``by``.

    Dates given replace the default exclusion; an empty list excludes none. They are compared as dates, so partition and
    row-group pruning still work. Partial sums run before the shuffle, so a segment that holds
    most rows sends no more than its distinct (day type, period, travel time) cells per task.
    """
    require_columns(clean, HISTOGRAM_INPUT, "clean table")
    chosen = vocab.EXCLUDED_DATES if excluded_dates is None else excluded_dates
    dates = [F.lit(date.fromisoformat(d)) for d in chosen]
    return (
        clean.select(*HISTOGRAM_INPUT, *by)
        .filter(
            (~F.col("record_date").isin(*dates) if dates else F.col("record_date").isNotNull())
            & F.col("pair_id").isNotNull()
            & F.col("day_type").isin(*day_types)
            & F.col("time_period").isNotNull()
            & positive_measures()
        )
        .withColumn("vehicle_type_group", F.lit(vocab.VEHICLE_GROUP))
        .groupBy("pair_id", "day_type", "time_period", "vehicle_type_group", "travel_time_sec", *by)
        .agg(F.sum("volume").alias("total_volume"))
        .select(*HISTOGRAM_COLUMNS, *by)
    )


def summed_cells(cells: DataFrame) -> DataFrame:
    """The histogram of cells that are kept apart, by month for example."""
    keys = [c for c in HISTOGRAM_COLUMNS if c != "total_volume"]
    return cells.groupBy(*keys).agg(F.sum("total_volume").alias("total_volume")).select(*HISTOGRAM_COLUMNS)
