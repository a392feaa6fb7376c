"""The eight batch stages, each reading and writing its own data set."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pacewise import vocab
from pacewise.operators import conversion
from pacewise.operators.bounded import checkpointed, stored
from pacewise.operators.clean import build_clean, typed
from pacewise.operators.export import check_locations, with_location
from pacewise.operators.histogram import histogram, summed_cells
from pacewise.operators.levels import expand_levels, level_input, sentinel_rows
from pacewise.operators.quality import quality_report
from pacewise.operators.remap import chronological, emptied_segments, merge_rules, merge_segments, planned_moves, touched_segments
from pacewise.operators.split import observe_feed, only_known_pairs, pair_reuse, split_feed, split_metrics, split_tagged
from pacewise.operators.summary import invalid_percentiles, level_counts, summarise
from pacewise.schemas import SUMMARY_COLUMNS, require_columns
from pacewise.sinks import files, tables
from pacewise.sources.dimensions import calendar, location, read_dimension, read_mapping
from pacewise.sources.feed import FeedFilter, read_feed
from pacewise.sources.segments import list_segment_files, read_listed_lines, read_segment_table, split_partitions, unit_of


def split(
    spark: SparkSession,
    feed: str,
    output: str,
    year: int | str | None = None,
    start: str | None = None,
    end: str | None = None,
    append: bool = False,
    reset: bool = False,
    recursive: bool = True,
    only_existing_pairs: bool = False,
    all_counters: bool = False,
) -> dict[str, int]:
    """Raw feed to split rows; returns row counters, which the write itself collects.

    Arguments and input files are checked before output is touched. A repeated run replaces what it wrote, unless ``append``.
    ``all_counters`` adds those of files and segments (read, empty, reused, new, skipped), which take a pass of their own.
    """
    wanted = FeedFilter.of(year, start, end)
    raw = read_feed(spark, feed, wanted, recursive)
    more = _split_counters(spark, raw, wanted, output, reset, only_existing_pairs) if all_counters else {}
    read, written = Observation("read"), Observation("written")
    observed = observe_feed(raw, read, wanted)
    rows = split_tagged(observed)
    if only_existing_pairs:
        known = None if reset else _known_pairs(spark, output)
        if known is None or known.isEmpty():
            # Nothing can be kept. Spark would drop the whole plan, so the counters run by themselves.
            observed.write.format("noop").mode("overwrite").save()
            if reset:
                files.write_split(split_feed(raw, wanted).limit(0), output, reset=True)
            return more | read.get | {"rows_written": 0}
        rows = only_known_pairs(rows, known)
    rows = rows.observe(written, F.count("*").alias("rows_written"))
    files.write_split(rows, output, wanted.year, append, reset)
    return more | read.get | written.get


def _split_counters(
    spark: SparkSession, raw: DataFrame, wanted: FeedFilter, output: str, reset: bool, only_existing_pairs: bool
) -> dict[str, int]:
    """Counters of files and segments, before the run changes the output."""
    counts = split_metrics(raw, wanted).first().asDict()
    known = spark.createDataFrame([], "pair_id string") if reset else _known_pairs(spark, output)
    found = {"pairs_reused": 0, "pairs_new": 0, "pairs_skipped": 0, "rows_skipped": 0}
    for row in pair_reuse(split_feed(raw, wanted), known, only_existing_pairs).collect():  # three states at most
        found[f"pairs_{row.status}"] = row.pairs
        if row.status == "skipped":
            found["rows_skipped"] = row.n_rows
    return counts | found


def _known_pairs(spark: SparkSession, output: str) -> DataFrame:
    """Segments present in the output, fixed by a checkpoint before the run replaces their files."""
    try:
        known = list_segment_files(spark, output).select("pair_id").distinct()
    except FileNotFoundError:
        return spark.createDataFrame([], "pair_id string")
    return checkpointed(known, f"{output.rstrip('/')}_checkpoint")


def merge(
    spark: SparkSession, split_root: str, mapping_path: str, output: str | None = None, keep_source: bool = False
) -> None:
    """Split rows under their final segments, into a new folder or, without ``output``, in place.

    Where data of two origins meets is decided from folder names alone. In place, only folders whose content changes are read and
    replaced, and those whose data moved away are removed. New content is complete in a folder beside the tree before the tree is
    touched, and sources go last; a run that stops in between loses nothing and can be repeated.
    """
    rules = merge_rules(read_mapping(spark, mapping_path))
    present = split_partitions(spark, split_root)
    rows = files.read_split(spark, split_root)
    if output is not None:
        merged = merge_segments(rows, rules, keep_source, present)
        files.write_split(merged, output, reset=True, sort_by=chronological())
        return
    moves = planned_moves(present, rules, keep_source)
    beside = f"{split_root.rstrip('/')}_merged"
    files.write_split(touched_segments(rows, moves), beside, reset=True, sort_by=chronological())
    files.write_split(files.read_split(spark, beside), split_root, sort_by=chronological())
    files.drop_folders(spark, split_root, emptied_segments(moves).select("year", "pair_id"))


def convert(
    spark: SparkSession,
    split_root: str,
    output: str,
    report: str,
    overwrite: bool = False,
    dry_run: bool = False,
) -> DataFrame:
    """Segment CSV to Parquet; returns the planned files (dry run) or the verdict of each file.

    What is converted and replaced as one is a unit: a segment's year of a split tree, or a file of a plain tree. A manifest
    beside the rows names the files of each unit. A unit is planned again, as a whole, when it has other files than then or one of
    them was rejected, and always with ``overwrite``; one that has no file any more, or no accepted row, loses its rows.
    Verdicts are written to ``report`` first: the row pass joins a table of known size, and a rejected file stays on record.
    """
    found = list_segment_files(spark, split_root).withColumn("unit", unit_of(F.col("source_file")))
    manifest = _manifest(spark, output)
    planned = conversion.planned_files(found, None if overwrite else conversion.unchanged_files(found, manifest))
    if dry_run:
        return planned.drop("unit")
    planned = stored(planned, "planned-files")
    lines = read_listed_lines(spark, split_root, planned.filter("length > 0"))
    conversion.file_verdicts(lines, planned).write.mode("overwrite").parquet(report)
    verdicts = spark.read.parquet(report)
    files.write_segments(conversion.accepted_rows(lines, verdicts), output)
    news = checkpointed(conversion.unit_news(found, manifest, verdicts), f"{report.rstrip('/')}_checkpoint")
    gone = conversion.units_without_rows(news, manifest).select("pair_id", F.col("unit").alias("source"))
    files.drop_folders(spark, output, gone)
    news.write.mode("append").parquet(f"{output.rstrip('/')}/_manifest")
    return verdicts


def _manifest(spark: SparkSession, output: str) -> DataFrame:
    """The latest state of every unit of the output: its files, their verdicts, and the run that said so."""
    try:
        runs = spark.read.schema(conversion.MANIFEST).parquet(f"{output.rstrip('/')}/_manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], conversion.MANIFEST)
    latest = runs.groupBy("pair_id", "unit").agg(F.max("run").alias("run"))
    return runs.join(latest, ["pair_id", "unit", "run"]).select(*runs.columns)


def clean(
    spark: SparkSession,
    segments: str,
    calendar_path: str,
    table: str,
    partitioned: bool = True,
    excluded: Sequence[str] = vocab.EXCLUDED_PAIR_IDS,
    strict_minute: bool = False,
    write_partitions: int | None = None,
    overwrite: bool = False,
    fmt: str = "parquet",
) -> None:
    """Segment Parquet and calendar to the clean table."""
    raw = read_segment_table(spark, segments, partitioned)
    days = calendar(read_dimension(spark, calendar_path))
    rows = build_clean(raw, days, excluded, strict_minute)
    tables.write_clean(rows, table, write_partitions, overwrite=overwrite, fmt=fmt)


def build_histogram(
    spark: SparkSession,
    clean_table: str,
    table: str,
    excluded_dates: Sequence[str] | None = None,
    overwrite: bool = False,
    fmt: str = "parquet",
) -> None:
    """Clean table to the histogram table."""
    tables.write_histogram(
        histogram(spark.table(clean_table), excluded_dates), table, overwrite=overwrite, fmt=fmt
    )


def refresh_histogram(
    spark: SparkSession,
    clean_table: str,
    cells: str,
    table: str,
    months: Sequence[str] | None = None,
    excluded_dates: Sequence[str] | None = None,
    fmt: str = "parquet",
) -> None:
    """The histogram table after the given months (``YYYY-MM``) of the clean table were added, replaced or removed.

    ``cells`` is a folder that keeps the histogram cells of each month. Only the given months of the clean table are read (all
    without ``months``, as the first time); their cells are replaced, and the table is summed from the cells of all months,
    whose number is bounded by months, segments and travel times. A run that stops on the way can be repeated.
    """
    rows = spark.table(clean_table)
    if months is not None:
        rows = rows.filter(F.col("record_month").isin(*months))
    fresh = stored(histogram(rows, excluded_dates, by=["record_month"]), "month-cells")
    left = fresh.select("record_month").distinct()
    known = files.read_month_cells(spark, cells).select("record_month").distinct()
    gone = known if months is None else known.filter(F.col("record_month").isin(*months))
    gone = stored(gone.join(left, "record_month", "left_anti"), "months-gone")
    files.write_month_cells(fresh, cells)
    files.drop_folders(spark, cells, gone)
    tables.write_histogram(summed_cells(files.read_month_cells(spark, cells)), table, overwrite=True, fmt=fmt)


def build_summary(
    spark: SparkSession,
    histogram_table: str,
    table: str,
    output_partitions: int | None = None,
    overwrite: bool = False,
    fmt: str = "parquet",
) -> tuple[DataFrame, int]:
    """Histogram table to the summary table; returns rows per level and the count of p95 < p50.

    A day type or period that equals the filler of higher levels raises.
    """
    source = spark.table(histogram_table)
    if not sentinel_rows(level_input(source)).isEmpty():
        raise ValueError(f"{histogram_table} uses {vocab.ALL!r} as a day type or time period")
    result = summarise(source)
    tables.write_summary(result, table, output_partitions, overwrite=overwrite, fmt=fmt)
    written = spark.table(table)
    return level_counts(written).orderBy("summary_level"), invalid_percentiles(written).count()


def quality(
    spark: SparkSession,
    segments: str,
    calendar_path: str,
    clean_table: str,
    histogram_table: str,
    summary_table: str,
    location_path: str,
    partitioned: bool = True,
) -> DataFrame:
    """Quality report over the data sets of one build."""
    return quality_report(
        typed(read_segment_table(spark, segments, partitioned)),
        read_dimension(spark, calendar_path),
        spark.table(clean_table),
        expand_levels(level_input(spark.table(histogram_table))),
        spark.table(summary_table),
        location(read_dimension(spark, location_path)),
    )


def export_geojson(
    spark: SparkSession,
    summary_table: str,
    location_path: str,
    output: str,
    overwrite: bool = False,
    collection: bool = False,
) -> str:
    """Summary and locations to GeoJSON; raises on duplicate or missing locations."""
    summary = require_columns(spark.table(summary_table), SUMMARY_COLUMNS, "summary table")
    locations = location(read_dimension(spark, location_path))
    check_locations(summary, locations)
    return files.write_geojson(with_location(summary, locations), output, overwrite, collection)


def export_bi_csv(
    spark: SparkSession, summary_table: str, output: str, overwrite: bool = False, single_file: bool = False
) -> None:
    """Summary to the BI CSV."""
    files.write_bi_csv(spark.table(summary_table), output, overwrite, single_file)
