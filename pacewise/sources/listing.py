"""File listing as a DataFrame. Only paths are read, never content."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.functions.normalize import decoded_path


def list_files(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """``path``, ``length`` and ``modified`` of every file under ``folder``; raises if the folder is missing."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        found = reader.load(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"input folder not found: {folder}") from error
        raise
    return found.select(decoded_path(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified"))


def list_empty_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``path`` of files without a byte, which no Spark scan ever reports.

    They are the names in the driver's own file index that the scan leaves out.
    """
    listed = list_files(spark, folder)
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    indexed = [(name,) for name in reader.text(folder).inputFiles()]
    one_slash = F.regexp_replace(decoded_path(F.col("path")), "^file:/+", "file:/")
    names = spark.createDataFrame(indexed, "path string").select(one_slash.alias("path"))
    return names.join(listed.select(one_slash.alias("path")), "path", "left_anti")
