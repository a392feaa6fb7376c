"""Rows for the map and the BI tool."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise.functions.geojson import feature, feature_text
from pacewise.functions.measures import minutes
from pacewise.schemas import COORDINATES, GROUP_COLUMNS, SUMMARY_COLUMNS, require_columns
from pacewise.sources.dimensions import location_duplicates


def missing_locations(summary: DataFrame, locations: DataFrame) -> DataFrame:
    """Summary segments without a location row."""
    return summary.select("pair_id").distinct().join(locations.select("pair_id"), "pair_id", "left_anti")


def check_locations(summary: DataFrame, locations: DataFrame) -> None:
    """Raise when the location join would multiply or lose segments."""
    duplicates = location_duplicates(locations).count()
    if duplicates:
        raise ValueError(f"{duplicates} segments have more than one location row")
    missing = missing_locations(summary, locations).count()
    if missing:
        raise ValueError(f"{missing} summary segments have no location row")


def with_location(summary: DataFrame, locations: DataFrame) -> DataFrame:
    """Summary joined to its locations; segments with a null coordinate drop out."""
    require_columns(summary, SUMMARY_COLUMNS, "summary table")
    return summary.join(locations, "pair_id", "inner").dropna(subset=list(COORDINATES))


def without_coordinates(summary: DataFrame, locations: DataFrame) -> DataFrame:
    """Segments that :func:`with_location` drops, with the summary rows each loses."""
    incomplete = F.lit(False)
    for name in COORDINATES:
        incomplete = incomplete | F.col(name).isNull()
    lost = locations.filter(incomplete).select("pair_id")
    return summary.join(lost, "pair_id").groupBy("pair_id").agg(F.count("*").alias("lost_rows"))


def features(located: DataFrame) -> DataFrame:
    """``type, geometry, properties`` of each summary row."""
    return located.select(feature().alias("feature")).select("feature.*")


def feature_lines(located: DataFrame) -> DataFrame:
    """Group keys and JSON text, one row per feature; built on the executors."""
    return located.select(*GROUP_COLUMNS, feature_text(feature()).alias("value"))


def bi_rows(summary: DataFrame) -> DataFrame:
    """Summary with its three durations in minutes as well."""
    require_columns(summary, SUMMARY_COLUMNS, "summary table")
    return summary.select(
        *SUMMARY_COLUMNS,
        minutes(F.col("p50_travel_time_sec")).alias("p50_travel_time_min"),
        minutes(F.col("p95_travel_time_sec")).alias("p95_travel_time_min"),
        minutes(F.col("buffer_time_sec")).alias("buffer_time_min"),
    )


def bi_sorted(summary: DataFrame) -> DataFrame:
    return bi_rows(summary).orderBy(*GROUP_COLUMNS)
