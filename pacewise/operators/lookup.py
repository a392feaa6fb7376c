"""Filtered lookup of features, as a map page asks for them."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewise import vocab
from pacewise.schemas import FILTER_KEYS, SERVED_PROPERTIES


def level_filters(
    summary_level: str, day_type: str = "", time_period: str = "", direction: str = ""
) -> dict[str, str]:
    """Filter values for a level: a dimension the level leaves out is asked for as ``ALL``."""
    used = {name: (by_day, by_period) for name, by_day, by_period in vocab.LEVELS}
    by_day, by_period = used.get(summary_level, (False, False))
    return {
        "summary_level": summary_level,
        "day_type": day_type if by_day else vocab.ALL,
        "time_period": time_period if by_period else vocab.ALL,
        "direction": direction,
    }


def filter_rows(rows: DataFrame, filters: Mapping[str, str | None]) -> DataFrame:
    """Equality on the filter keys that carry a value; other keys and empty values do not filter."""
    for key in FILTER_KEYS:
        if filters.get(key):
            rows = rows.filter(F.col(key) == filters[key])
    return rows


def with_route_name(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``route_name`` from the location names; the segment id only where the segment is not listed.

    Of several names of a segment the last one wins: the one with the largest ``seq``, where the names have that column, and
    of those the largest name. A segment never gives more than one row.
    """
    order = F.col("seq") if "seq" in names.columns else F.lit(0)
    latest = F.max(F.struct(order.alias("seq"), F.col("pair_roadname").alias("name")))
    listed = names.groupBy(F.col("pair_id").alias("listed_id")).agg(latest["name"].alias("listed_name"))
    joined = rows.join(listed, F.col("pair_id") == F.col("listed_id"), "left")
    route = F.when(F.col("listed_id").isNull(), F.col("pair_id")).otherwise(F.col("listed_name"))
    return joined.withColumn("route_name", route).drop("listed_id", "listed_name")


def lookup(features: DataFrame, filters: Mapping[str, str | None], names: DataFrame) -> DataFrame:
    """Nine served properties, ``route_name`` and the geometry of the matching features."""
    flat = features.select("properties.*", "geometry")
    return with_route_name(filter_rows(flat, filters), names).select(
        *SERVED_PROPERTIES, "route_name", "geometry"
    )
