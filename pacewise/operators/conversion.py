"""Segment text lines to typed rows, with whole-file rejection.

A file is taken whole or not at all. The verdict of a file is an aggregate over its lines; only
that small table is joined back, so lines themselves are never grouped by file.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise import vocab
from pacewise.schemas import SEGMENT, SEGMENT_COLUMNS

_INTEGERS = tuple(f.name for f in SEGMENT if f.name not in ("RecordDate", "RecordTime"))
_WHOLE_NUMBER = r"^\s*-?[0-9]+\s*$"


def _is_null(text: Column) -> Column:
    return text.isNull() | text.isin(*vocab.NULL_SPELLINGS)


def _typed(name: str) -> Column:
    text = F.col(name)
    if name not in _INTEGERS:
        return F.when(~_is_null(text), text)
    return F.when(text.rlike(_WHOLE_NUMBER), F.trim(text).try_cast(SEGMENT[name].dataType))


def _cells() -> Column:
    """The cells of ``line`` as texts; ``misfit`` is set when there are not five."""
    names = ", ".join(f"{n} string" for n in SEGMENT_COLUMNS)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "misfit"}
    return F.from_csv("line", F.lit(f"{names}, misfit string"), options)


def _is_header(cells: Column) -> Column:
    header = F.lit(False)
    for name in SEGMENT_COLUMNS:
        header = header | F.lower(F.trim(F.coalesce(cells[name], F.lit("")))).isin(*vocab.HEADER_WORDS)
    return header


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines with five text cells and the flags ``header``, ``wrong_arity``, ``wrong_type``.

    Blank lines are dropped.
    """
    kept = [c for c in lines.columns if c != "line"]
    rows = lines.filter(F.col("line") != "").select(*kept, _cells().alias("cells"))
    wrong_type = F.lit(False)
    for name in _INTEGERS:
        wrong_type = wrong_type | (~_is_null(F.col(name)) & _typed(name).isNull())
    flags = {"wrong_arity": F.col("misfit").isNotNull(), "wrong_type": wrong_type}
    return rows.select(*kept, "cells.*", _is_header(F.col("cells")).alias("header")).withColumns(flags).drop("misfit")


def file_verdicts(lines: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """One row per file: ``status`` (converted or failed), ``reason``, ``data_rows``.

    Rejected are files without rows, files with a line that has not five cells, files with a cell
    of the wrong type, and files with a header line after the first line. ``files`` adds files that
    have no line at all.
    """
    in_head = F.col("block_start") == 0
    header, row_id = F.col("header"), F.col("row_id")
    counted = (
        parse_lines(lines)
        .groupBy("pair_id", "source_file")
        .agg(
            F.count_if(~header).alias("data_rows"),
            F.count_if("wrong_arity").alias("arity_errors"),
            F.count_if(F.col("wrong_type") & ~header).alias("type_errors"),
            F.count_if(header).alias("headers"),
            F.min(F.when(in_head, row_id)).alias("first_row"),
            F.min(F.when(in_head & header, row_id)).alias("first_header"),
        )
    )
    if files is not None:
        counted = files.select("pair_id", "source_file").join(counted, ["pair_id", "source_file"], "left")
    misplaced = (F.col("headers") > 1) | (
        (F.col("headers") == 1) & ~F.col("first_header").eqNullSafe(F.col("first_row"))
    )
    reason = (
        F.when(F.col("data_rows").isNull(), "empty file")
        .when(F.col("arity_errors") > 0, "not five columns")
        .when(misplaced, "header after the first row")
        .when(F.col("type_errors") > 0, "wrong type")
    )
    return counted.select(
        "pair_id",
        "source_file",
        F.when(reason.isNull(), "converted").otherwise("failed").alias("status"),
        reason.alias("reason"),
        F.coalesce("data_rows", F.lit(0)).alias("data_rows"),
    )


def accepted_rows(lines: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Typed rows of all files that were not rejected.

    Pass verdicts that were written as a table: Spark then knows their size and chooses the join by it.
    """
    failed = verdicts.filter("status = 'failed'").select("pair_id", "source_file")
    kept = lines.filter(F.col("line") != "").join(failed, ["pair_id", "source_file"], "left_anti")
    # A filter on the parsed cells would be pushed down and parse each line once more per cell.
    rows = F.inline(F.filter(F.array(_cells()), lambda cells: ~_is_header(cells)))
    return kept.select("pair_id", "source_file", rows).select(
        "pair_id", "source_file", *(_typed(n).alias(n) for n in SEGMENT_COLUMNS)
    )


def planned_files(files: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Files still to convert: those without an output, or all when ``done`` is not given."""
    if done is None:
        return files
    return files.join(done.select("source_file").distinct(), "source_file", "left_anti")


#: Columns of the manifest; a unit without files any more has one row with the status ``removed``.
MANIFEST = "pair_id string, unit string, source_file string, status string, data_rows long, run long"


def _fingerprints(files: DataFrame) -> DataFrame:
    """Number and checksum of each unit's file names."""
    return files.groupBy("pair_id", "unit").agg(
        F.count("source_file").alias("n_files"), F.bit_xor(F.xxhash64("source_file")).alias("names")
    )


def unchanged_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """``source_file`` of the units that have the files of their last conversion, none of them rejected."""
    rejected = manifest.groupBy("pair_id", "unit").agg(F.count_if(F.col("status") == "failed").alias("n_failed"))
    then = _fingerprints(manifest).join(rejected, ["pair_id", "unit"]).filter("n_failed = 0").drop("n_failed")
    same = _fingerprints(files).join(then, ["pair_id", "unit", "n_files", "names"]).select("pair_id", "unit")
    return files.join(same, ["pair_id", "unit"], "left_semi").select("source_file")


def unit_news(files: DataFrame, manifest: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Manifest rows of a run: the judged files, and the units that have no file any more."""
    run = F.coalesce(manifest.agg(F.max("run")).scalar(), F.lit(0)) + 1
    judged = verdicts.join(files.select("source_file", "unit"), "source_file").select(
        "pair_id", "unit", "source_file", "status", F.col("data_rows").cast("long").alias("data_rows")
    )
    gone = (
        manifest.filter("status <> 'removed'").select("pair_id", "unit").distinct()
        .join(files.select("pair_id", "unit").distinct(), ["pair_id", "unit"], "left_anti")
        .select("pair_id", "unit", F.lit(None).cast("string").alias("source_file"), F.lit("removed").alias("status"), F.lit(0).cast("long").alias("data_rows"))
    )
    return judged.unionByName(gone).withColumn("run", run.cast("long"))


def units_without_rows(news: DataFrame, manifest: DataFrame) -> DataFrame:
    """Units of a run that had rows before and have none now."""

    def accepted(state: DataFrame) -> DataFrame:
        rows = F.sum(F.when(F.col("status") == "converted", F.col("data_rows")).otherwise(0))
        return state.groupBy("pair_id", "unit").agg(rows.alias("n_rows"))

    had = accepted(manifest).filter("n_rows > 0").select("pair_id", "unit")
    return accepted(news).filter("n_rows = 0").join(had, ["pair_id", "unit"], "left_semi").select("pair_id", "unit")


def conversion_metrics(files: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Per segment: files seen, converted, skipped and failed."""
    status = F.coalesce(F.col("status"), F.lit("skipped"))
    known = files.select("pair_id", "source_file")
    return (
        known.join(verdicts.select("pair_id", "source_file", "status"), ["pair_id", "source_file"], "left")
        .groupBy("pair_id")
        .agg(
            F.count("*").alias("files"),
            F.count_if(status == "converted").alias("converted"),
            F.count_if(status == "skipped").alias("skipped"),
            F.count_if(status == "failed").alias("failed"),
        )
    )
