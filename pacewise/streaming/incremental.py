"""Conversion of segment files that arrived since the last run.

The file source remembers in its checkpoint which files it has seen and starts a batch when others arrive. The batch runs the
conversion job, whose manifest decides which units have changed: a unit is always converted from all of its files, and a
repeated batch finds nothing to do.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from pacewise.plans.jobs import convert


def checkpoint_folder(spark: SparkSession, name: str, given: str | None = None) -> str:
    """Folder for a query's progress: the one given, or a folder under ``spark.checkpoint.dir``."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given
    if not shared:
        raise ValueError("name a checkpoint folder or set spark.checkpoint.dir")
    return f"{shared.rstrip('/')}/{name}"


def convert_new_files(
    spark: SparkSession,
    split_root: str,
    output: str,
    report: str,
    checkpoint: str | None = None,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Convert all files not yet seen, then stop.

    The verdicts of each batch that converted something are kept under ``report/batch=N``.
    """
    names = (
        spark.readStream.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(split_root)
        .select(F.col("_metadata.file_path"))
    )

    def convert_batch(batch: DataFrame, number: int) -> None:
        convert(batch.sparkSession, split_root, output, f"{report}/batch={number}")

    return (
        names.writeStream.foreachBatch(convert_batch)
        .option("checkpointLocation", checkpoint_folder(spark, "convert_new_files", checkpoint))
        .trigger(availableNow=True)
        .start()
    )
