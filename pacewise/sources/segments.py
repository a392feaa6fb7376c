"""Segment files: one set of rows per segment and year, as text lines or as Parquet."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.functions.normalize import decoded_path, parent_folder
from pacewise.schemas import SEGMENT_COLUMNS, require_columns
from pacewise.sources.listing import list_empty_files, list_files


def _pair_of(path):
    """Segment id from the parent folder, written plainly or as ``pair_id=value``."""
    return F.regexp_replace(parent_folder(path, "csv"), "^pair_id=", "")


def unit_of(path: Column) -> Column:
    """What is converted and replaced as one: year and segment of a split tree (``year=/pair_id=``), else the file's stem."""
    year, pair = (F.regexp_extract(path, r"/year=([0-9]+)/pair_id=([^/]+)/[^/]+$", n) for n in (1, 2))
    return F.when(year != "", F.concat(year, F.lit("_"), pair)).otherwise(F.regexp_extract(path, r"([^/]+)\.csv$", 1))


def list_segment_files(spark: SparkSession, root: str) -> DataFrame:
    """``source_file``, ``pair_id``, ``length`` of every CSV file that lies in a segment folder."""
    path = F.col("path")
    empty = list_empty_files(spark, root, "*.csv").withColumn("length", F.lit(0).cast("long"))
    return (
        list_files(spark, root)
        .select("path", "length")
        .unionByName(empty)
        .filter(path.endswith(".csv") & ~path.rlike("/[_.][^/]*$"))
        .select(path.alias("source_file"), _pair_of(path).alias("pair_id"), "length")
    )


def split_partitions(spark: SparkSession, root: str) -> DataFrame:
    """``year, pair_id`` of the folders of a split tree that hold rows, from their names alone: no file is opened."""
    below = r"/year=([0-9]+)/pair_id=(.+)/[^/]+\.csv$"
    year, pair = (F.regexp_extract("path", below, n) for n in (1, 2))
    found = list_files(spark, root).filter(year != "").filter(~F.col("path").rlike("/[_.][^/]*$"))
    return found.select(year.cast("int").alias("year"), pair.alias("pair_id")).distinct()


def line_columns(text: DataFrame) -> DataFrame:
    """Text scan with the file, the segment and the start of the block each line was read from."""
    path = decoded_path(F.col("_metadata.file_path"))
    return text.select(
        path.alias("source_file"),
        _pair_of(path).alias("pair_id"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.regexp_replace("value", r"^\uFEFF", "").alias("line"),
    )


def with_row_id(lines: DataFrame) -> DataFrame:
    """Lines of a scan with an id that grows along each task.

    ``block_start`` is 0 only in the task that reads the head of a file, so among those lines the
    smallest ``row_id`` is the first line.
    """
    return lines.withColumn("row_id", F.monotonically_increasing_id())


def read_segment_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """Text lines of the given CSV files; only these are opened."""
    if not files:
        return spark.createDataFrame(
            [], "source_file string, pair_id string, block_start long, line string, row_id long"
        )
    return with_row_id(line_columns(spark.read.text(files)))


#: Files up to which a scan is given their names, and up to which a table of names is broadcast; beyond, Spark chooses the join.
NAMED_FILES, BROADCAST_FILES = 1_000, 100_000


def read_listed_lines(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """Text lines of those CSV files under ``root`` that ``files`` (``source_file``, a table) names.

    A few are read by name. Of many no name passes through the driver: the tree is scanned, the names are joined, and of the other
    files only those are opened that are not older than the oldest named one.
    """
    few = [row.source_file for row in files.select("source_file").limit(NAMED_FILES + 1).collect()]
    if len(few) <= NAMED_FILES:
        return read_segment_lines(spark, few)
    named = files.select("source_file").distinct()
    small = files.limit(BROADCAST_FILES + 1).count() <= BROADCAST_FILES
    listed = list_files(spark, root).withColumnRenamed("path", "source_file")
    oldest = listed.join(named, "source_file", "left_semi").agg(F.min("modified")).first()[0]
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(root)
    lines = line_columns(text.filter(F.col("_metadata.file_modification_time") >= F.lit(oldest)))
    one_slash = F.regexp_replace("source_file", "^file:/+", "file:/")
    named = named.select(one_slash.alias("same"))
    lines = lines.withColumn("same", one_slash).join(F.broadcast(named) if small else named, "same", "left_semi")
    return with_row_id(lines.drop("same"))


def read_segment_table(spark: SparkSession, path: str, partitioned: bool = False) -> DataFrame:
    """Segment Parquet with ``pair_id``.

    ``partitioned`` reads a table partitioned by ``pair_id``. Otherwise files are looked up
    recursively and ``pair_id`` is the name of the parent folder; it is taken from ``_metadata``,
    which, unlike ``input_file_name()``, leaves filters free to reach the scan.
    """
    if partitioned:
        keys = spark.read.parquet(path)
        return require_columns(keys, SEGMENT_COLUMNS + ("pair_id",), "segment table")
    found = spark.read.option("recursiveFileLookup", "true").parquet(path)
    require_columns(found, SEGMENT_COLUMNS, "segment Parquet")
    if "pair_id" in found.columns:
        return found
    return found.withColumn("pair_id", parent_folder(F.col("_metadata.file_path"), "parquet"))
