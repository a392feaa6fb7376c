"""Schemas by name, and the required-column check every stage starts with.

Fixed values: the column, property and filter names below are the formats of files, tables and
documents.
"""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


FEED_COLUMNS = ("datetime", "start_gantry", "end_gantry", "vehicle_type", "travel_time_sec", "volume")
FEED = _strings(*FEED_COLUMNS)

SPLIT_COLUMNS = ("date", "time", "vehicle_type", "travel_time_sec", "volume")
SPLIT = _strings(*SPLIT_COLUMNS)

SEGMENT_COLUMNS = ("RecordDate", "RecordTime", "VehicleType", "TravelTime", "Volume")
SEGMENT = T.StructType(
    [
        T.StructField("RecordDate", T.StringType()),
        T.StructField("RecordTime", T.StringType()),
        T.StructField("VehicleType", T.ShortType()),
        T.StructField("TravelTime", T.IntegerType()),
        T.StructField("Volume", T.IntegerType()),
    ]
)

MAPPING_COLUMNS = ("route", "note", "target_route")
CALENDAR_COLUMNS = ("record_date", "day_type")
GANTRY_LIST = _strings("name", "gantry_id")

LOCATION_TEXT = (
    "pair_roadname", "start_gantry_id", "start_roadname", "start_link_id",
    "end_gantry_id", "end_roadname", "end_link_id", "direction",
)
LOCATION_NUMBERS = ("start_longitude", "start_latitude", "end_longitude", "end_latitude", "distance_km")
COORDINATES = LOCATION_NUMBERS[:4]
LOCATION_COLUMNS = (
    "pair_id", "pair_roadname",
    "start_gantry_id", "start_roadname", "start_link_id", "start_longitude", "start_latitude",
    "end_gantry_id", "end_roadname", "end_link_id", "end_longitude", "end_latitude",
    "distance_km", "direction",
)

CLEAN_COLUMNS = (
    "pair_id", "record_date", "record_year", "record_month", "record_time_minute",
    "day_type", "time_period", "vehicle_type", "travel_time_sec", "volume",
)
HISTOGRAM_INPUT = ("pair_id", "record_date", "day_type", "time_period", "travel_time_sec", "volume")
HISTOGRAM_COLUMNS = (
    "pair_id", "day_type", "time_period", "vehicle_type_group", "travel_time_sec", "total_volume",
)
#: Histogram cells of single months.
MONTH_CELLS = (
    "pair_id string, day_type string, time_period string, vehicle_type_group string, travel_time_sec int, total_volume long, record_month string"
)
GROUP_COLUMNS = ("summary_level", "pair_id", "day_type", "time_period")
LEVEL_COLUMNS = GROUP_COLUMNS + ("travel_time_sec", "volume")
SUMMARY_COLUMNS = GROUP_COLUMNS + (
    "p50_travel_time_sec", "p95_travel_time_sec", "buffer_time_sec", "buffer_index", "reliability_level",
)

FEATURE_PROPERTIES = (
    "pair_id", "pair_roadname", "summary_level", "day_type", "time_period", "direction",
    "start_gantry_id", "start_roadname", "start_link_id",
    "end_gantry_id", "end_roadname", "end_link_id", "distance_km",
    "p50_travel_time_sec", "p95_travel_time_sec", "buffer_time_sec", "buffer_index", "reliability_level",
)
_PROPERTY_TYPES = {
    "distance_km": T.DoubleType(),
    "buffer_index": T.DoubleType(),
    "p50_travel_time_sec": T.IntegerType(),
    "p95_travel_time_sec": T.IntegerType(),
    "buffer_time_sec": T.IntegerType(),
}
FEATURE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField(
            "geometry",
            T.StructType(
                [
                    T.StructField("type", T.StringType()),
                    T.StructField("coordinates", T.ArrayType(T.ArrayType(T.DoubleType()))),
                ]
            ),
        ),
        T.StructField(
            "properties",
            T.StructType(
                [T.StructField(n, _PROPERTY_TYPES.get(n, T.StringType())) for n in FEATURE_PROPERTIES]
            ),
        ),
    ]
)
#: Index of the parts of a written document, in the order in which they make it up.
DOCUMENT_PARTS = "part string, bytes long, start long, features long, first_pair_id string"
FEATURE_COLLECTION = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("features", T.ArrayType(FEATURE)),
    ]
)

SERVED_PROPERTIES = (
    "pair_id", "p50_travel_time_sec", "p95_travel_time_sec", "buffer_time_sec",
    "reliability_level", "summary_level", "day_type", "time_period", "direction",
)
FILTER_KEYS = ("summary_level", "day_type", "time_period", "direction")


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> DataFrame:
    """Return ``df`` unchanged, or raise naming the columns it lacks in sorted order."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks required columns {missing}; it has {df.columns}")
    return df
