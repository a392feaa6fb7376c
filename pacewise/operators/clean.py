"""Typed, filtered and calendar-joined observations."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise import vocab
from pacewise.functions.normalize import clock_digits, clock_text, hour_band, hour_of, minute_of, parse_date
from pacewise.schemas import CLEAN_COLUMNS, SEGMENT_COLUMNS, require_columns


def typed(raw: DataFrame) -> DataFrame:
    """Renamed, trimmed, cast and derived columns; bad texts become null."""
    require_columns(raw, SEGMENT_COLUMNS + ("pair_id",), "segment rows")
    day, digits, hour, minute = (F.col(c) for c in ("record_date", "digits", "clock_hour", "clock_minute"))
    return (
        raw.select(
            F.trim("pair_id").alias("pair_id"),
            parse_date(F.col("RecordDate")).alias("record_date"),
            clock_digits(F.col("RecordTime")).alias("digits"),
            F.col("VehicleType").cast("string").alias("vehicle_type"),
            F.col("TravelTime").try_cast("int").alias("travel_time_sec"),
            F.col("Volume").try_cast("long").alias("volume"),
        )
        .withColumns({"clock_hour": hour_of(digits), "clock_minute": minute_of(digits)})
        .withColumns(
            {
                "record_time_minute": clock_text(hour, minute),
                "time_period": hour_band(hour),
                "record_year": F.year(day),
                "record_month": F.date_format(day, "yyyy-MM"),
            }
        )
        .drop("digits")
    )


def positive_measures(travel_time: str = "travel_time_sec", volume: str = "volume") -> Column:
    return (F.col(travel_time) > 0) & (F.col(volume) > 0)


def valid(
    rows: DataFrame,
    excluded: Sequence[str] = vocab.EXCLUDED_PAIR_IDS,
    strict_minute: bool = False,
) -> DataFrame:
    """Rows that have a wanted segment, a date, a classified hour, a vehicle and positive measures.

    A comparison with null is not true, so each one also drops nulls. Cheap tests come first.
    ``strict_minute`` also drops minutes above 59, which are kept by default.
    """
    pair, vehicle = F.col("pair_id"), F.col("vehicle_type")
    kept = (
        (pair != "")
        & (vehicle != "")
        & positive_measures()
        & F.col("record_date").isNotNull()
        & (F.col("time_period") != vocab.UNCLASSIFIED)
    )
    if excluded:
        kept = kept & ~pair.isin(*excluded)
    if strict_minute:
        kept = kept & (F.col("clock_minute") < 60)
    return rows.filter(kept).drop("clock_hour", "clock_minute")


def exclude_pairs(rows: DataFrame, excluded: DataFrame) -> DataFrame:
    """Rows of segments that are not listed; for lists too long for a literal."""
    return rows.join(excluded.select("pair_id"), "pair_id", "left_anti")


def with_day_type(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Clean columns after the inner calendar join; dates the calendar lacks drop out.

    ``calendar`` comes from :func:`pacewise.sources.dimensions.calendar`, which has one row per
    date: its size is bounded by the calendar itself, whatever the facts grow to. Spark broadcasts
    it by its measured size.
    """
    return rows.join(calendar, rows.record_date == calendar.cal_date, "inner").select(
        *CLEAN_COLUMNS
    )


def uncovered_dates(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Dates with rows but without a calendar entry, and the rows each loses."""
    return (
        rows.filter(F.col("record_date").isNotNull())
        .groupBy("record_date")
        .agg(F.count("*").alias("lost_rows"))
        .join(calendar, F.col("record_date") == calendar.cal_date, "left_anti")
    )


def build_clean(
    raw: DataFrame,
    calendar: DataFrame,
    excluded: Sequence[str] = vocab.EXCLUDED_PAIR_IDS,
    strict_minute: bool = False,
) -> DataFrame:
    return with_day_type(valid(typed(raw), excluded, strict_minute), calendar)
