"""Weighted percentiles, levels and grades."""

import random
from datetime import date
from fractions import Fraction
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pacewise import vocab
from pacewise.operators import levels, summary, weighted
from pacewise.operators.histogram import histogram
from pacewise.plans import jobs
from pacewise.schemas import HISTOGRAM_COLUMNS
from pacewise.sinks import tables
from tests.helpers import rows

SCHEMA = "pair_id string, day_type string, time_period string, vehicle_type_group string, travel_time_sec int, total_volume long"

GOLDEN = [
    ("single value", {100: 1}, 100, 100, 0.0, "穩定"),
    ("exact 95 % boundary", {100: 19, 130: 1}, 100, 100, 0.0, "穩定"),
    ("exact 50 % boundary", {100: 10, 125: 10}, 100, 125, 0.25, "普通"),
    ("just under 0.5", {200: 3, 299: 1}, 200, 299, 0.495, "普通"),
    ("index 0.5", {200: 3, 300: 1}, 200, 300, 0.5, "不穩定"),
    ("index 1.0", {60: 5, 80: 4, 120: 1}, 60, 120, 1.0, "高風險"),
    ("weight beats row count", {10: 1, 20: 1, 30: 98}, 30, 30, 0.0, "穩定"),
]


def hist(spark, data):
    return spark.createDataFrame([(*r[:3], "ALL", *r[3:]) for r in data], SCHEMA)


@pytest.mark.parametrize("form", ["expand", "grouping_sets", "union"])
def test_golden_percentiles(spark, form):
    data = [(name, "Weekday", "日間", t, v) for name, h, *_ in GOLDEN for t, v in h.items()]
    result = summary.summarise(hist(spark, data), form).filter("summary_level = 'L4_OVERALL'")
    got = {r.pair_id: (r.p50_travel_time_sec, r.p95_travel_time_sec, r.buffer_index, r.reliability_level)
           for r in result.collect()}
    assert got == {name: (p50, p95, bi, g) for name, _, p50, p95, bi, g in GOLDEN}


def test_golden_levels(spark):
    data = [("S", "Weekday", "早尖峰", 100, 10), ("S", "Weekday", "早尖峰", 125, 10),
            ("S", "Weekend", "早尖峰", 100, 5), ("S", "Weekend", "早尖峰", 300, 5)]
    got = {tuple(r)[:1] + tuple(r)[2:] for r in summary.summarise(hist(spark, data)).collect()}
    assert got == {
        ("L1_DAY_TYPE", "Weekday", "ALL", 100, 125, 25, 0.25, "普通"),
        ("L1_DAY_TYPE", "Weekend", "ALL", 100, 300, 200, 2.0, "高風險"),
        ("L2_TIME_PERIOD", "ALL", "早尖峰", 100, 300, 200, 2.0, "高風險"),
        ("L3_DAY_TYPE_TIME_PERIOD", "Weekday", "早尖峰", 100, 125, 25, 0.25, "普通"),
        ("L3_DAY_TYPE_TIME_PERIOD", "Weekend", "早尖峰", 100, 300, 200, 2.0, "高風險"),
        ("L4_OVERALL", "ALL", "ALL", 100, 300, 200, 2.0, "高風險"),
    }


def brute(values, share):
    """Smallest value whose running weight reaches the share of the total, in exact fractions."""
    total, running = sum(values.values()), 0
    for value in sorted(values):
        running += values[value]
        if running >= total * share:
            return value


def test_random_groups_against_brute_force(spark):
    rng = random.Random(5)
    groups = {f"g{i}": {rng.randint(1, 60): rng.randint(1, 12) for _ in range(rng.randint(1, 25))} for i in range(200)}
    data = [(g, t, v) for g, h in groups.items() for t, v in h.items()]
    df = spark.createDataFrame(data, "g string, t int, v long")
    got = {r.g: (r.p50_travel_time_sec, r.p95_travel_time_sec)
           for r in weighted.weighted_percentile_disc(df, ["g"], "t", "v").collect()}
    want = {g: (brute(h, Fraction(1, 2)), brute(h, Fraction(19, 20))) for g, h in groups.items()}
    assert got == want
    scaled = weighted.weighted_percentile_disc(df.withColumn("v", F.col("v") * 1000), ["g"], "t", "v")
    assert {r.g: tuple(r)[1:] for r in scaled.collect()} == want


def test_repeated_values_count_together(spark):
    rng = random.Random(11)
    data = [(rng.choice("abcd"), rng.randint(1, 9), rng.randint(1, 5)) for _ in range(300)]
    df = spark.createDataFrame(data, "g string, t int, v long")
    summed = df.groupBy("g", "t").agg(F.sum("v").alias("v"))
    assert rows(weighted.weighted_percentile_disc(df, ["g"], "t", "v")) == rows(
        weighted.weighted_percentile_disc(summed, ["g"], "t", "v"))


def test_agrees_with_a_sorted_array_form(spark):
    """A second formulation: fold the sorted (value, weight) array of each group."""
    rng = random.Random(9)
    data = [(rng.choice("abc"), t, rng.randint(1, 9)) for t in range(1, 80)]
    df = spark.createDataFrame(data, "g string, t int, v long")
    folded = df.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("t", "v"))).alias("a"), F.sum("v").alias("n")).selectExpr(
        "g",
        """aggregate(a, named_struct('run', 0L, 'hit', cast(null as int)),
           (s, x) -> named_struct('run', s.run + x.v, 'hit',
             coalesce(s.hit, if((s.run + x.v) * 20 >= n * 19, x.t, null)))).hit AS p95""",
    )
    direct = weighted.weighted_percentile_disc(df, ["g"], "t", "v", [("p95", 19, 20)])
    assert rows(folded) == rows(direct.select("g", "p95"))


def test_level_forms_agree_and_roll_up(spark):
    rng = random.Random(3)
    data = [(f" p{rng.randint(0, 3)}" if rng.random() < 0.2 else f"p{rng.randint(0, 3)}", rng.choice(vocab.DAY_TYPES),
             rng.choice(vocab.TIME_BANDS)[0], rng.randint(-1, 9), rng.randint(-1, 5)) for _ in range(400)]
    source = levels.level_input(hist(spark, data))
    expanded = rows(levels.expand_levels(source))
    assert expanded == rows(levels.union_levels(source)) == rows(levels.grouping_sets_levels(source))
    totals = {}
    for level, *_, volume in expanded:
        totals[level] = totals.get(level, 0) + volume
    assert len(totals) == 4 and len(set(totals.values())) == 1
    assert all(t > 0 and v > 0 for *_, t, v in expanded)
    assert {r[1] for r in expanded} == {"p0", "p1", "p2", "p3"}


def test_summary_properties_on_skewed_segment(spark):
    """One segment holds most rows; every percentile occurs in its group and p50 <= p95."""
    clean = spark.range(20_000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("p"), (F.col("id") % 47).cast("string"))).alias("pair_id"),
        F.lit("2026-01-05").cast("date").alias("record_date"),
        F.when(F.col("id") % 7 < 5, "Weekday").otherwise("Weekend").alias("day_type"),
        F.element_at(F.array(*(F.lit(b[0]) for b in vocab.TIME_BANDS)), (F.col("id") % 5 + 1).cast("int")).alias("time_period"),
        (F.col("id") * 7 % 301 + 1).cast("int").alias("travel_time_sec"),
        (F.col("id") % 4 + 1).alias("volume"),
    )
    table = histogram(clean)
    result = summary.summarise(table)
    assert summary.invalid_percentiles(result).count() == 0
    seen = {(r.pair_id, r.travel_time_sec) for r in table.select("pair_id", "travel_time_sec").collect()}
    for r in result.collect():
        assert (r.pair_id, r.p50_travel_time_sec) in seen and (r.pair_id, r.p95_travel_time_sec) in seen
    counts = {r.summary_level: r.n_rows for r in summary.level_counts(result).collect()}
    pairs = clean.select("pair_id").distinct().count()
    assert counts == {"L1_DAY_TYPE": pairs * 2, "L2_TIME_PERIOD": pairs * 5, "L3_DAY_TYPE_TIME_PERIOD": pairs * 10,
                      "L4_OVERALL": pairs}


def test_histogram_default_and_replaced_exclusion(spark):
    schema = "pair_id string, record_date date, day_type string, time_period string, travel_time_sec int, volume long"
    from datetime import date

    clean = spark.createDataFrame(
        [("A", date(2026, 7, 1), "Weekday", "日間", 10, 1), ("A", date(2026, 7, 2), "Weekday", "日間", 10, 2),
         ("A", date(2026, 7, 3), "Holiday", "日間", 10, 4), ("A", date(2026, 7, 4), "Weekend", "日間", 0, 8)], schema)
    assert [r.total_volume for r in histogram(clean).collect()] == [2]
    assert [r.total_volume for r in histogram(clean, ["2026-07-02"]).collect()] == [1]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match=r"\['day_type', 'record_date', 'time_period', 'travel_time_sec', 'volume'\]"):
        histogram(spark.sql("SELECT 'A' AS pair_id"))
    with pytest.raises(ValueError, match="total_volume"):
        levels.level_input(spark.sql("SELECT 'A' AS pair_id"))
    with pytest.raises(ValueError, match="unknown form"):
        summary.summarise(hist(spark, [("A", "Weekday", "日間", 1, 1)]), "other")


def _month_rows(spark, *months):
    """Clean rows of some months, with volumes that differ by month."""
    data = [
        (pair, date(2026, month, day), 2026, f"2026-{month:02}", "07:05", kind, "早尖峰", "31", 60 + day % 3, volume + i)
        for month, volume in months for day, kind in ((3, "Weekday"), (4, "Weekend"), (5, "Weekday")) for i, pair in enumerate(("A_B", "C_D"))
    ]
    types = ("pair_id string, record_date date, record_year int, record_month string, record_time_minute string, day_type string, "
             "time_period string, vehicle_type string, travel_time_sec int, volume long")
    return spark.createDataFrame(data, types)


def test_refreshed_histogram_equals_a_rebuilt_one(spark, tmp_path):
    """After a first build, and after months were added, replaced and removed; months that did not change are not opened."""
    spark.sql("CREATE NAMESPACE IF NOT EXISTS kept")
    steps = [([(1, 10), (2, 20), (3, 30)], None), ([(1, 10), (2, 25), (3, 30), (4, 40)], ["2026-02", "2026-04"]),
             ([(1, 10), (3, 30), (4, 40)], ["2026-02"]), ([(1, 10), (4, 40)], None)]
    for months, changed in steps:
        clean = _month_rows(spark, *months)
        tables.write_clean(clean, "kept.clean", overwrite=True)
        if changed:
            folder = spark.sql("DESCRIBE EXTENDED kept.clean").filter("col_name = 'Location'").first().data_type.removeprefix("file:")
            (Path(folder) / "record_month=2026-01" / "part-broken.parquet").write_bytes(b"not a Parquet file")
            spark.catalog.refreshTable("kept.clean")
        for _ in range(2):
            jobs.refresh_histogram(spark, "kept.clean", str(tmp_path / "cells"), "kept.histogram", changed)
            assert rows(spark.table("kept.histogram").select(*HISTOGRAM_COLUMNS)) == rows(histogram(clean))
