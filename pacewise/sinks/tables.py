"""Catalog tables with a partition layout, independent of the table format."""

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def lay_out(
    df: DataFrame,
    partition_by: Sequence[str],
    sort_by: Sequence[str | Column],
    partitions: int | None = None,
) -> DataFrame:
    """Rows gathered by partition value and sorted inside each task.

    ``REBALANCE`` rather than ``repartition``: adaptive execution splits a value that holds too
    many rows over several tasks and joins small ones, so the number of distinct values does not
    limit the write. The sort gives narrow row-group statistics.
    """
    if partitions is not None and partitions <= 0:
        raise ValueError("the number of write partitions must be positive")
    sized = [partitions] if partitions else []
    return df.hint("rebalance", *sized, *partition_by).sortWithinPartitions(*sort_by)


def create_namespace(spark: SparkSession, table: str) -> None:
    namespace = table.rpartition(".")[0]
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")


def write_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str],
    overwrite: bool = False,
    fmt: str = "parquet",
    partitions: int | None = None,
    month_of: str | None = None,
) -> None:
    """Create ``table``; an existing one raises unless ``overwrite``, which leaves it as it is until the new rows are written.

    ``month_of`` names a date column: Iceberg then partitions by its month transform, other
    formats by ``partition_by``.
    """
    spark = df.sparkSession
    create_namespace(spark, table)
    laid_out = lay_out(df, partition_by, sort_by, partitions)
    if fmt == "iceberg":
        keys = [F.partitioning.months(month_of)] if month_of else [F.col(c) for c in partition_by]
        writer = laid_out.writeTo(table).using(fmt).tableProperty("format-version", "2").partitionedBy(*keys)
        if month_of:
            writer = writer.tableProperty("write.spark.fanout.enabled", "true")
        if overwrite:
            writer.createOrReplace()
        else:
            writer.create()
        return
    write = partial(_save, laid_out, fmt, partition_by)
    if overwrite:
        _recover(spark, table)
    if overwrite and spark.catalog.tableExists(table):
        _publish(spark, table, write)
    else:
        write(table)


def _save(rows: DataFrame, fmt: str, partition_by: Sequence[str], table: str) -> None:
    """Creates a table whose partitions are its folders: the catalog keeps no list of them, which a renamed table would not match."""
    conf, tracked = rows.sparkSession.conf, "spark.sql.hive.manageFilesourcePartitions"
    before = conf.get(tracked)
    conf.set(tracked, "false")
    try:
        rows.write.format(fmt).partitionBy(*partition_by).saveAsTable(table)
    finally:
        conf.set(tracked, before)


def _beside(table: str, kind: str) -> str:
    """Name of a table in the same namespace, for what is not published yet or any more."""
    return f"{table}__{kind}"


def _recover(spark: SparkSession, table: str) -> None:
    """Undoes a run that stopped between the two renames of :func:`_publish`."""
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(_beside(table, "old")):
        spark.sql(f"ALTER TABLE {_beside(table, 'old')} RENAME TO {table}")


def _publish(spark: SparkSession, table: str, write: Callable[[str], None]) -> None:
    """Replaces a table: written beside it, then put in its place by renaming in the catalog.

    A write that fails leaves the old table as it was. One that stops between the renames leaves it as ``__old``, where the next
    overwrite takes it back from. Names in the catalog change, no row is copied by Spark.
    """
    new, old = _beside(table, "new"), _beside(table, "old")
    for name in (new, old):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    write(new)
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.catalog.refreshTable(table)
    spark.sql(f"DROP TABLE {old}")


def write_clean(clean: DataFrame, table: str, partitions: int | None = None, **options) -> None:
    """Clean table by month of the record date."""
    sort = (
        "record_month", "record_date", "record_time_minute", "pair_id", "vehicle_type",
        "day_type", "time_period",
    )
    write_table(
        clean, table, ["record_month"], sort, partitions=partitions, month_of="record_date", **options
    )


def write_histogram(histogram: DataFrame, table: str, **options) -> None:
    """Histogram table by day type and period."""
    sort = ("day_type", "time_period", "pair_id", "travel_time_sec")
    write_table(histogram, table, ["day_type", "time_period"], sort, **options)


def write_summary(summary: DataFrame, table: str, partitions: int | None = None, **options) -> None:
    """Summary table by level."""
    sort = ("summary_level", "pair_id", "day_type", "time_period")
    write_table(summary, table, ["summary_level"], sort, partitions=partitions, **options)
