"""Consistency checks as one report: ``check, scope, bad_rows``.

Each input is read once or twice, whatever the number of checks on it: checks that share a grain
share an aggregate.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise import vocab
from pacewise.schemas import COORDINATES
from pacewise.sources.dimensions import calendar, calendar_conflicts

NULL_CHECKED = ("pair_id", "record_date", "vehicle_type", "travel_time_sec", "volume")


def _report(counted: DataFrame, checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rows ``check, scope, bad_rows`` from the columns of a one-row DataFrame."""
    items = F.array(
        *(
            F.struct(
                F.lit(check).alias("check"),
                F.lit(scope).alias("scope"),
                F.coalesce(F.col(column).cast("long"), F.lit(0)).alias("bad_rows"),
            )
            for check, scope, column in checks
        )
    )
    return counted.select(F.explode(items).alias("item")).select("item.*")


def row_checks(rows: DataFrame, days: DataFrame, columns: Sequence[str] = NULL_CHECKED) -> DataFrame:
    """Null or blank values per column, and rows on dates the calendar lacks."""

    def blank(name: str) -> Column:
        return F.count_if(F.col(name).isNull() | (F.trim(F.col(name).cast("string")) == "")).alias(f"{name}_blank")

    per_date = rows.groupBy("record_date").agg(F.count("*").alias("n_rows"), *(blank(c) for c in columns))
    joined = per_date.join(days, F.col("record_date") == F.col("cal_date"), "left")
    uncovered = F.col("record_date").isNotNull() & F.col("cal_date").isNull()
    counted = joined.agg(
        F.sum(F.when(uncovered, F.col("n_rows"))).alias("uncovered"),
        *(F.sum(f"{c}_blank").alias(f"{c}_blank") for c in columns),
    )
    checks = [("null_or_blank", c, f"{c}_blank") for c in columns] + [("uncovered_dates", "rows", "uncovered")]
    return _report(counted, checks)


def calendar_checks(raw_calendar: DataFrame) -> DataFrame:
    """Dates with more than one day type."""
    counted = calendar_conflicts(raw_calendar).agg(F.count("*").alias("dates"))
    return _report(counted, [("calendar_conflicts", "dates", "dates")])


def duplicate_checks(clean: DataFrame) -> DataFrame:
    """Rows beyond the first for one segment, date, minute and vehicle type."""
    extra = clean.groupBy("pair_id", "record_date", "record_time_minute", "vehicle_type").agg(
        (F.count("*") - 1).alias("extra")
    )
    return _report(extra.agg(F.sum("extra").alias("extra")), [("duplicate_observations", "rows", "extra")])


def segment_checks(summary: DataFrame, locations: DataFrame) -> DataFrame:
    """Duplicate and missing locations, rows lost to null coordinates, and p95 below p50."""
    incomplete = F.lit(False)
    for name in COORDINATES:
        incomplete = incomplete | F.col(name).isNull()
    listed = locations.groupBy("pair_id").agg(
        F.count("*").alias("n_locations"), F.bool_or(incomplete).alias("incomplete")
    )
    used = summary.groupBy("pair_id").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("p95_travel_time_sec") < F.col("p50_travel_time_sec")).alias("n_invalid"),
    )
    counted = used.join(listed, "pair_id", "full").agg(
        F.count_if(F.col("n_locations") > 1).alias("duplicates"),
        F.count_if(F.col("n_rows").isNotNull() & F.col("n_locations").isNull()).alias("missing"),
        F.sum(F.when(F.col("incomplete"), F.col("n_rows"))).alias("lost"),
        F.sum("n_invalid").alias("invalid"),
    )
    return _report(
        counted,
        [
            ("location_duplicates", "pairs", "duplicates"),
            ("missing_locations", "pairs", "missing"),
            ("null_coordinates", "rows", "lost"),
            ("p95_below_p50", "rows", "invalid"),
        ],
    )


def level_checks(summary: DataFrame, levels: DataFrame) -> DataFrame:
    """Per level: rows short of every segment having every cell, and volume off the finest level.

    Every level of the vocabulary is reported: one without rows lacks all of them, and one without volume the whole volume.
    """

    def of(name: str, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("summary_level") == name, value)), F.lit(0)).alias(name)

    names = [name for name, _, _ in vocab.LEVELS]
    counts = summary.agg(*(of(n, F.lit(1)) for n in names), F.count_distinct("pair_id").alias("segments"))
    volumes = levels.agg(*(of(n, F.col("volume")) for n in names))
    short, off = [], []
    for name, by_day, by_period in vocab.LEVELS:
        cells = (len(vocab.DAY_TYPES) if by_day else 1) * (len(vocab.TIME_BANDS) if by_period else 1)
        short.append(F.lit(cells) * F.col("segments") - F.col(name))
        off.append(F.abs(F.col(name) - F.col(names[2])))

    def shaped(one: DataFrame, check: str, bad: list[Column]) -> DataFrame:
        named = one.select(*(b.alias(n) for n, b in zip(names, bad, strict=True)))
        return _report(named, [(check, n, n) for n in names])

    return shaped(counts, "level_shortfall", short).unionByName(shaped(volumes, "rollup_difference", off))


def quality_report(
    rows: DataFrame,
    raw_calendar: DataFrame,
    clean: DataFrame,
    levels: DataFrame,
    summary: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    """All checks over one build; ``rows`` are the typed rows before the calendar join."""
    return (
        row_checks(rows, calendar(raw_calendar))
        .unionByName(calendar_checks(raw_calendar))
        .unionByName(duplicate_checks(clean))
        .unionByName(segment_checks(summary, locations))
        .unionByName(level_checks(summary, levels))
    )
