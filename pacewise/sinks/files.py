"""File outputs: split rows by year and segment, segment Parquet, BI CSV, GeoJSON."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacewise import vocab
from pacewise.functions.normalize import decoded_path
from pacewise.operators.export import bi_rows, feature_lines
from pacewise.schemas import GROUP_COLUMNS, MONTH_CELLS, SPLIT
from pacewise.sinks.tables import lay_out
from pacewise.sources.segments import unit_of

def write_split(
    rows: DataFrame,
    root: str,
    year: int | None = None,
    append: bool = False,
    reset: bool = False,
    sort_by: Sequence[Column] = (),
) -> None:
    """Headerless CSV under ``year=/pair_id=``.

    By default each (year, segment) that ``rows`` has data for is replaced as a whole, so a repeated run gives the same files'
    rows. With ``year``, that year is replaced for all segments, including those without new rows, and other years stay.
    ``append`` adds rows, ``reset`` replaces everything. The year leads the layout so that replacing it is one overwrite of one
    folder. ``sort_by`` orders the rows of a segment.
    """
    laid_out = lay_out(rows if year is None else rows.filter(F.col("year") == year), ["year", "pair_id"], ["year", "pair_id", *sort_by])
    if year is not None and not append and not reset:
        laid_out.drop("year").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("pair_id").csv(f"{root}/year={year}")
        return
    writer = laid_out.write.mode("append" if append and not reset else "overwrite")
    writer.option("partitionOverwriteMode", "static" if reset else "dynamic").partitionBy("year", "pair_id").csv(root)


def read_split(spark: SparkSession, root: str) -> DataFrame:
    """Rows written by :func:`write_split`, with ``year`` and ``pair_id``."""
    schema = T.StructType(
        SPLIT.fields + [T.StructField("year", T.IntegerType()), T.StructField("pair_id", T.StringType())]
    )
    return spark.read.schema(schema).csv(root)


def write_segments(rows: DataFrame, root: str) -> None:
    """Snappy Parquet, one folder per unit, under ``pair_id=/source=``.

    A unit (see ``unit_of``) is a segment's year of a split tree, or a file of a plain tree. The write replaces exactly the units
    it brings rows for, so whatever part files a unit came from, a repeated run gives the same table.
    """
    keyed = rows.withColumn("source", unit_of(F.col("source_file"))).drop("source_file")
    keys = ["pair_id", "source"]
    (
        lay_out(keyed, keys, [*keys, "RecordDate", "RecordTime"])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*keys)
        .parquet(root)
    )


def write_month_cells(cells: DataFrame, root: str) -> None:
    """Histogram cells as Parquet under ``record_month=``; the months that ``cells`` has replace theirs, others stay."""
    laid_out = lay_out(cells, ["record_month"], ["record_month", "day_type", "time_period", "pair_id", "travel_time_sec"])
    laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("record_month").parquet(root)


def read_month_cells(spark: SparkSession, root: str) -> DataFrame:
    """Cells written by :func:`write_month_cells`; none where nothing was written yet."""
    try:
        return spark.read.schema(MONTH_CELLS).parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MONTH_CELLS)


#: What Spark escapes in names of partition folders, besides control characters; a fixed format.
_ESCAPED = frozenset("\"#%'*/:=?\\\x7f{[]^")


def partition_folder(name: str, value: object) -> str:
    """``name=value`` as Spark writes it."""
    text = "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 else c for c in str(value))
    return f"{name}={text or '__HIVE_DEFAULT_PARTITION__'}"


def drop_folders(spark: SparkSession, root: str, partitions: DataFrame) -> None:
    """Removes partition folders, one for each row, nested in the order of its columns.

    Their names (what changed in a run, not data) pass through the driver.
    """
    for row in partitions.toLocalIterator():
        below = "/".join(partition_folder(c, row[c]) for c in partitions.columns)
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{below}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_bi_csv(summary: DataFrame, path: str, overwrite: bool = False, single_file: bool = False) -> None:
    """CSV in key order, in ordered parts, each with a header.

    ``single_file`` asks for one document: only the first part has the header, so that the parts, joined in the order of
    their names, are one CSV file, whatever their number.
    """
    rows = bi_rows(summary)
    mode = "overwrite" if overwrite else "errorifexists"
    if not single_file:
        ordered = rows.orderBy(*GROUP_COLUMNS)
        ordered.write.mode(mode).option("header", "true").option("encoding", "UTF-8").csv(path)
        return
    head = ",".join(rows.columns)
    lines = rows.select(F.lit(1).alias("part"), *GROUP_COLUMNS, F.to_csv(F.struct(*rows.columns)).alias("value"))
    _write_document(lines, [(0, head)], path, mode)


def write_geojson(located: DataFrame, path: str, overwrite: bool = False, collection: bool = False) -> str:
    """GeoJSON features in key order; returns the form written.

    The default ``lines`` has one feature per line in ordered parts. ``collection`` writes one FeatureCollection document as
    ordered parts: joined in the order of their names they are the document, whatever their number. A comma leads
    every feature but the first, which one aggregate finds.
    """
    lines, mode = feature_lines(located), "overwrite" if overwrite else "errorifexists"
    if not collection:
        lines.orderBy(*GROUP_COLUMNS).select("value").write.mode(mode).text(path)
        return "lines"
    key = F.struct(*GROUP_COLUMNS, "value")
    first = lines.agg(F.min(key).alias("first"))
    leads = F.when(key == first.scalar(), F.lit("")).otherwise(F.lit(","))
    body = lines.select(F.lit(1).alias("part"), *GROUP_COLUMNS, F.concat(leads, "value").alias("value"))
    head = f'{{"type": "FeatureCollection", "name": "{vocab.COLLECTION_NAME}", "features": ['
    _write_document(body, [(0, head), (2, "]}")], path, mode)
    _index_parts(body.sparkSession, path)
    return "collection"


def _index_parts(spark: SparkSession, path: str) -> None:
    """Writes ``_parts`` beside the parts: name, length, first byte in the whole document, number of features, first segment.

    Whoever serves the document can give any byte range of it, and the reader knows that it has a feature a line.
    """
    name = F.substring_index(decoded_path(F.col("path")), "/", -1).alias("part")
    sizes = spark.read.format("binaryFile").load(path).select(name, F.col("length").alias("bytes"))
    feature = F.regexp_extract("value", r"(?s)^,?(\{.*\})$", 1)
    row_id = F.monotonically_increasing_id()
    lines = spark.read.text(path).select(decoded_path(F.col("_metadata.file_name")).alias("part"), feature.alias("value"), F.col("_metadata.file_block_start").alias("block"), row_id.alias("row_id"))
    first = F.min_by(F.get_json_object("value", "$.properties.pair_id"), F.struct("block", "row_id")).alias("first_pair_id")
    counts = lines.filter("value <> ''").groupBy("part").agg(F.count("*").alias("features"), first)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    start = F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start")
    index = sizes.join(counts, "part", "left").select("part", "bytes", start, F.coalesce("features", F.lit(0)).alias("features"), "first_pair_id")
    index.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/_parts")


def _write_document(body: DataFrame, frame: list[tuple[int, str]], path: str, mode: str) -> None:
    """Lines in key order with the lines of ``frame`` before (0) or behind (2) them, as text parts."""
    edge = body.sparkSession.createDataFrame(frame, "part int, value string")
    whole = body.unionByName(edge, allowMissingColumns=True).orderBy("part", *GROUP_COLUMNS, "value")
    whole.select("value").write.mode(mode).text(path)
