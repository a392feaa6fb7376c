"""Lenient date, time and key normalisation, safe under ANSI mode (nothing here raises on bad text)."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pacewise import vocab


_DAY = r"^\s*(\d{4})(?:([-/])(\d{1,2})\2(\d{1,2})|(\d{2})(\d{2}))(?!\d).*$"


def parse_date(text: Column) -> Column:
    """Date from ``yyyy/M/d``, ``yyyy-M-d``, ``yyyyMMdd`` or any text Spark casts to a date.

    Whatever follows the day is ignored; bad texts are null. All notations are first brought to
    ISO form, so each row costs one pattern match and one cast.
    """
    iso = F.regexp_replace(text.cast("string"), F.lit(_DAY), F.lit("$1-$3$5-$4$6"))
    return iso.try_cast("date")


def parse_feed_timestamp(text: Column) -> Column:
    """Timestamp from ``yyyy/M/d H:m``; the whole text must match, otherwise null."""
    return F.try_to_timestamp(text, F.lit("yyyy/M/d H:m"))


def feed_date_text(ts: Column) -> Column:
    """Un-padded date text such as ``2026/6/14``."""
    return F.date_format(ts, "yyyy/M/d")


def feed_time_text(ts: Column) -> Column:
    """Clock text ``HH:mm``."""
    return F.date_format(ts, "HH:mm")


def pair_id(start: Column, end: Column) -> Column:
    """Segment id ``start_end``; null when either end is null."""
    return F.concat(start, F.lit("_"), end)


def clock_digits(text: Column) -> Column:
    return F.regexp_replace(text.cast("string"), "[^0-9]", "")


# Up to two digits are an hour; three digits are one and two; of more, the first four count.
_HOUR = r"^(\d{1,2}$|\d(?=\d{2}$)|\d{2})"
_MINUTE = r"^(?:\d(?=\d{2}$)|\d{2})(\d{2})"


def hour_of(digits: Column) -> Column:
    """Hour of clock digits; null without digits."""
    return F.regexp_extract(digits, _HOUR, 1).try_cast("int")


def minute_of(digits: Column) -> Column:
    """Minute of clock digits, zero for a bare hour. It is not checked against 59."""
    return F.concat(F.lit("0"), F.regexp_extract(digits, _MINUTE, 1)).try_cast("int")


def clock_text(hour: Column, minute: Column) -> Column:
    """``HH:MM``. A missing part is left out, so this is never null; the hour band is the real guard."""

    def two(part: Column) -> Column:
        return F.lpad(part.cast("string"), 2, "0")

    return F.concat_ws(":", two(hour), two(minute))


def hour_band(
    hour: Column,
    bands: Sequence[tuple[str, int, int]] = vocab.TIME_BANDS,
    default: str = vocab.UNCLASSIFIED,
) -> Column:
    """Label of the inclusive hour range that holds ``hour``, looked up once per row."""
    labels = [default] * (max(high for _, _, high in bands) + 1)
    for label, low, high in reversed(bands):
        labels[low : high + 1] = [label] * (high - low + 1)
    return F.coalesce(F.get(F.array(*map(F.lit, labels)), hour), F.lit(default))


def decoded_path(path: Column) -> Column:
    """File path with percent-encoding undone (a literal ``+`` stays a ``+``)."""
    plus_kept = F.replace(path, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(plus_kept), path)


def parent_folder(path: Column, extension: str) -> Column:
    """Name of the folder that directly holds the file, or ``''`` for another kind of path."""
    return F.regexp_extract(decoded_path(path), rf"/([^/]+)/[^/]+\.{extension}$", 1)


def is_date_folder(name: Column) -> Column:
    return name.rlike("^[0-9]{8}$")


def is_hour_folder(name: Column) -> Column:
    return name.rlike("^([01][0-9]|2[0-3])$")
