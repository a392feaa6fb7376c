"""Small dimensions: calendar, location, renamed segments, gantry list."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise import vocab
from pacewise.functions.normalize import parse_date
from pacewise.schemas import (
    CALENDAR_COLUMNS,
    GANTRY_LIST,
    LOCATION_COLUMNS,
    LOCATION_NUMBERS,
    MAPPING_COLUMNS,
    require_columns,
)


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header when the name ends in ``.csv``, otherwise Parquet."""
    if path.lower().endswith(".csv"):
        return spark.read.option("header", "true").option("encoding", "UTF-8").csv(path)
    return spark.read.parquet(path)


def _dated(raw: DataFrame, day_types: tuple[str, ...]) -> DataFrame:
    require_columns(raw, CALENDAR_COLUMNS, "calendar")
    return raw.select(
        parse_date(F.col("record_date")).alias("cal_date"), F.trim("day_type").alias("day_type")
    ).filter(F.col("cal_date").isNotNull() & F.col("day_type").isin(*day_types))


def calendar(raw: DataFrame, day_types: tuple[str, ...] = vocab.DAY_TYPES) -> DataFrame:
    """One row per date. Conflicting day types are settled by the smallest label."""
    return _dated(raw, day_types).groupBy("cal_date").agg(F.min("day_type").alias("day_type"))


def calendar_conflicts(raw: DataFrame, day_types: tuple[str, ...] = vocab.DAY_TYPES) -> DataFrame:
    """Dates that carry more than one day type."""
    return (
        _dated(raw, day_types)
        .groupBy("cal_date")
        .agg(F.min("day_type").alias("kept_day_type"), F.max("day_type").alias("other_day_type"))
        .filter("kept_day_type <> other_day_type")
    )


def location(raw: DataFrame) -> DataFrame:
    """Fourteen location columns: trimmed texts and double coordinates. Bad numbers become null."""
    require_columns(raw, LOCATION_COLUMNS, "location")
    return raw.select(
        *(
            (F.col(n).try_cast("double") if n in LOCATION_NUMBERS else F.trim(n)).alias(n)
            for n in LOCATION_COLUMNS
        )
    )


def location_duplicates(locations: DataFrame) -> DataFrame:
    """Segment ids with more than one location row."""
    return locations.groupBy("pair_id").agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Renaming table with its file order as ``seq``.

    A mapping file is one small CSV; Spark reads it in order, so ids that grow along the scan
    keep the order of its rows.
    """
    raw = require_columns(read_dimension(spark, path), MAPPING_COLUMNS, "mapping")
    numbered = raw.withColumn("seq", F.monotonically_increasing_id())
    return numbered.select("seq", *MAPPING_COLUMNS)


def read_gantries(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ``name, gantry_id`` list; blank lines are skipped."""
    try:
        return spark.read.schema(GANTRY_LIST).option("header", "false").csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"gantry list not found: {path}") from error
        raise


def read_route_names(spark: SparkSession, path: str) -> DataFrame:
    """``seq, pair_id, pair_roadname`` for lookups, ``seq`` in the order of the file's rows; a missing file gives no names.

    A task reads one block of a file from its start on, so file, block and an id that grows along the task give that order.
    """
    try:
        raw = read_dimension(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "seq long, pair_id string, pair_roadname string")
        raise
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row_id"))
    return raw.select(place.alias("seq"), "pair_id", "pair_roadname")
