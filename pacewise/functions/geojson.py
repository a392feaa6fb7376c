"""GeoJSON feature of one summary row joined to its location."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pacewise.schemas import COORDINATES, FEATURE_PROPERTIES


def feature() -> Column:
    """Feature struct: a two-point line in longitude, latitude order and 18 properties."""
    ends = F.array(
        F.array(F.col("start_longitude"), F.col("start_latitude")),
        F.array(F.col("end_longitude"), F.col("end_latitude")),
    )
    return F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("LineString").alias("type"), ends.alias("coordinates")).alias("geometry"),
        F.struct(*FEATURE_PROPERTIES).alias("properties"),
    )


def _not_finite(number: Column) -> Column:
    return F.coalesce(F.isnan(number) | (F.abs(number) == F.lit(float("inf"))), F.lit(False))


def feature_text(item: Column) -> Column:
    """JSON text of a feature. Nulls are kept; NaN and Infinity are not JSON, so they raise."""
    bad = F.lit(False)
    for name in COORDINATES + ("distance_km", "buffer_index"):
        bad = bad | _not_finite(F.col(name))
    return F.when(
        bad, F.raise_error(F.concat(F.lit("number without a JSON form at "), F.col("pair_id"))).cast("string")
    ).otherwise(F.to_json(item, {"ignoreNullFields": "false"}))
