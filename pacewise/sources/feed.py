"""Raw feed: headerless CSV files in ``YYYYMMDD/HH`` folders."""

import re
from dataclasses import dataclass
from datetime import date, datetime
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise import vocab
from pacewise.functions.normalize import decoded_path, is_date_folder, is_hour_folder
from pacewise.schemas import FEED
from pacewise.sources.listing import list_files

_DATE = re.compile("[0-9]{8}")
_HOUR = re.compile("[01][0-9]|2[0-3]")


@dataclass(frozen=True)
class FeedFilter:
    """Validated year and inclusive date range."""

    year: int | None = None
    start: date | None = None
    end: date | None = None

    @staticmethod
    def of(year: int | str | None = None, start: str | None = None, end: str | None = None) -> "FeedFilter":
        wanted = None
        if year is not None:
            text = str(year).strip()
            if len(text) != 4 or not (text.isascii() and text.isdigit()):
                raise ValueError(f"year must have four digits, not {year!r}")
            wanted = int(text)
        first, last = _argument_date(start), _argument_date(end)
        if first and last and first > last:
            raise ValueError("the start date must not be later than the end date")
        return FeedFilter(wanted, first, last)

    def keeps(self, day: Column) -> Column:
        """Predicate on a date column; a null date is rejected."""
        kept = day.isNotNull()
        if self.year is not None:
            kept = kept & (F.year(day) == self.year)
        if self.start is not None:
            kept = kept & (day >= F.lit(self.start))
        if self.end is not None:
            kept = kept & (day <= F.lit(self.end))
        return kept


def _argument_date(text: str | None) -> date | None:
    if not text:
        return None
    compact = text.strip().replace("-", "")
    if len(compact) != 8 or not (compact.isascii() and compact.isdigit()):
        raise ValueError(f"dates are YYYYMMDD or YYYY-MM-DD, not {text!r}")
    return datetime.strptime(compact, "%Y%m%d").date()


def feed_file_name(name: Column) -> Column:
    """Case-insensitive test of a feed file name."""
    lower = F.lower(name)
    return lower.startswith(vocab.FEED_FILE_PREFIX) & lower.endswith(vocab.FEED_FILE_SUFFIX)


def _placed(below: Column) -> dict[str, Column]:
    """Parts of a path below the feed root: day and hour folder, file name, number of parts."""
    parts = F.split(below, "/")
    return {
        "file_name": F.element_at(parts, -1),
        "day": F.element_at(parts, 1),
        "hour": F.coalesce(F.get(parts, F.lit(1)), F.lit("")),
        "depth": F.size(parts),
    }


def _standard(below: Column, wanted: FeedFilter) -> tuple[Column, Column, Column]:
    """Tests of a path: in an hour folder at any depth, a feed file of an hour folder, a feed file directly in a date folder."""
    at = _placed(below)
    dated = (at["depth"] >= 2) & is_date_folder(at["day"]) & wanted.keeps(F.try_to_date(at["day"], "yyyyMMdd"))
    in_hour = dated & is_hour_folder(at["hour"]) & (at["depth"] >= 3)
    named = feed_file_name(at["file_name"])
    return in_hour, named & in_hour & (at["depth"] == 3), named & dated & (at["depth"] == 2)


def _days_with_hours(below: DataFrame, wanted: FeedFilter) -> DataFrame:
    """``day`` of the date folders that have hour folders: one short row a calendar day at most."""
    in_hour, _, _ = _standard(F.col("below"), wanted)
    return below.filter(in_hour).select(_placed(F.col("below"))["day"].alias("day")).distinct()


def select_feed_files(files: DataFrame, wanted: FeedFilter = FeedFilter()) -> DataFrame:
    """Distinct feed file paths of a standard tree.

    ``files`` has ``path`` and ``below``, the path below the feed root. Only ``YYYYMMDD/HH/file``
    is read; a date folder without hour folders gives the files directly in it; deeper nesting
    is skipped. Date folders are tested before any file is opened.
    """
    _, standard, direct = _standard(F.col("below"), wanted)
    day = F.when(direct, _placed(F.col("below"))["day"]).alias("day")
    chosen = files.filter(standard | direct).select("path", day)
    return chosen.join(_days_with_hours(files, wanted), "day", "left_anti").select("path").distinct()


def _flat(path: Column, below: Column, wanted: FeedFilter) -> Column:
    """Test of a path: a feed file directly in the input folder; a date folder in the path must pass the filter."""
    day = F.regexp_extract(path, "/([0-9]{8})/", 1)
    return ~below.contains("/") & feed_file_name(below) & ((day == "") | wanted.keeps(F.try_to_date(day, "yyyyMMdd")))


def select_flat_files(files: DataFrame, wanted: FeedFilter = FeedFilter()) -> DataFrame:
    """Distinct feed files directly in the input folder; a date folder in the path must pass the filter."""
    return files.filter(_flat(F.col("path"), F.col("below"), wanted)).select("path").distinct()


def date_folders(wanted: FeedFilter) -> str | None:
    """A glob of the date folders that can pass, or null where the filter leaves them open at one end.

    It bounds a listing before any folder is entered; days inside a month are left to the exact test.
    """
    day = "[0-3][0-9]"
    if wanted.start and wanted.end:
        first, last = wanted.start.year * 12 + wanted.start.month - 1, wanted.end.year * 12 + wanted.end.month - 1
        months = [(m // 12, m % 12 + 1) for m in range(first, last + 1) if wanted.year in (None, m // 12)]
        return "{" + ",".join(f"{y:04}{m:02}{day}" for y, m in months) + "}" if months else None
    return f"{wanted.year:04}[01][0-9]{day}" if wanted.year is not None else None


@dataclass(frozen=True)
class _Selection:
    """Where an input folder is listed, how its paths read below the feed root, and whether it is a flat one."""

    files: DataFrame
    scan: str
    root: str
    prefix: str
    flat: bool

    def below(self, path: Column) -> Column:
        rest = F.substring_index(path, self.root + "/", -1) if self.root else path
        return F.concat(F.lit(self.prefix), rest) if self.prefix else rest


def _listed(spark: SparkSession, folder: str, wanted: FeedFilter, recursive: bool, is_root: bool) -> tuple[DataFrame, str]:
    """Files of an input folder, and what was listed; of a feed root only date folders that can pass, if there are any."""
    chosen = date_folders(wanted) if recursive and is_root else None
    if chosen:
        try:
            scan = f"{folder.rstrip('/')}/{chosen}"
            return list_files(spark, scan, recursive), scan
        except FileNotFoundError:
            pass  # no such date folder: the input may be flat
    return list_files(spark, folder, recursive), folder


def _selection(spark: SparkSession, folder: str, wanted: FeedFilter, recursive: bool) -> _Selection:
    root = urlparse(folder).path.rstrip("/")
    names = [""] + root.split("/")
    in_hour = bool(_HOUR.fullmatch(names[-1]) and _DATE.fullmatch(names[-2]))
    in_day = bool(_DATE.fullmatch(names[-1]))
    listed, scan = _listed(spark, folder, wanted, recursive, not (in_hour or in_day))
    prefix = f"{names[-2]}/{names[-1]}/" if in_hour else f"{names[-1]}/" if in_day else ""
    plain = _Selection(listed, scan, root, "", True)
    if not recursive:
        return plain
    if not prefix and listed.filter(plain.below(F.col("path")).rlike("^[0-9]{8}/")).isEmpty():
        return plain
    return _Selection(listed, scan, root, prefix, False)


def _selected(chosen: _Selection, wanted: FeedFilter) -> DataFrame:
    files = chosen.files.withColumn("below", chosen.below(F.col("path")))
    return select_flat_files(files, wanted) if chosen.flat else select_feed_files(files, wanted)


def find_feed_files(
    spark: SparkSession, folder: str, wanted: FeedFilter = FeedFilter(), recursive: bool = True
) -> DataFrame:
    """Feed files of an input folder, which may be the feed root, a date folder or an hour folder."""
    return _selected(_selection(spark, folder, wanted, recursive), wanted)


def read_feed(
    spark: SparkSession, folder: str, wanted: FeedFilter = FeedFilter(), recursive: bool = True
) -> DataFrame:
    """Six text columns plus ``source_file``; raises when no file qualifies.

    The folder is scanned as a whole. What qualifies is a test of ``_metadata.file_path``, which Spark applies to its file index,
    so other files are not opened and no file name passes through this program. Only files directly in a date folder need
    more: the days that have hour folders, from the listing; that table has a row a calendar day and is broadcast.
    """
    chosen = _selection(spark, folder, wanted, recursive)
    if _selected(chosen, wanted).isEmpty():
        raise FileNotFoundError(f"no feed file qualifies in {folder}")
    path = decoded_path(F.col("_metadata.file_path"))
    below = chosen.below(path)
    reader = spark.read.schema(FEED).option("header", "false")
    scan = (reader.option("recursiveFileLookup", "true") if recursive else reader).csv(chosen.scan)
    columns = [F.col(c) for c in FEED.names] + [path.alias("source_file")]
    if chosen.flat:
        return scan.filter(_flat(path, below, wanted)).select(*columns)
    _, standard, direct = _standard(below, wanted)
    days = _days_with_hours(chosen.files.select(chosen.below(F.col("path")).alias("below")), wanted)
    fresh_day = F.when(direct, _placed(below)["day"]).alias("day")
    rows = scan.filter(standard | direct).select(*columns, fresh_day)
    return rows.join(F.broadcast(days), "day", "left_anti").drop("day")
