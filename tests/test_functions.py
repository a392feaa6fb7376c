"""Golden scalar cases, worked out by hand."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from pacewise.functions import display, measures, normalize

DATES = [
    ("2026/6/14", date(2026, 6, 14)),
    ("2026/06/14", date(2026, 6, 14)),
    ("2026-06-14", date(2026, 6, 14)),
    ("20260614", date(2026, 6, 14)),
    ("2026-6-4", date(2026, 6, 4)),
    ("2026-06-14T01:02", date(2026, 6, 14)),
    ("2026/6/14 23:55", date(2026, 6, 14)),
    ("  2026/6/14", date(2026, 6, 14)),
    ("20260614 12", date(2026, 6, 14)),
    ("2026/13/45", None),
    ("2026/2/30", None),
    ("2026/6/145", None),
    ("2026/6-14", None),
    ("junk", None),
    ("", None),
    (None, None),
]

TIMES = [
    ("23:55", 23, 55, "23:55", "夜間"),
    ("2355", 23, 55, "23:55", "夜間"),
    ("23:55:00", 23, 55, "23:55", "夜間"),
    ("955", 9, 55, "09:55", "日間"),
    ("7:05", 7, 5, "07:05", "早尖峰"),
    ("5", 5, 0, "05:00", "凌晨"),
    ("12", 12, 0, "12:00", "日間"),
    ("100", 1, 0, "01:00", "凌晨"),
    ("0775", 7, 75, "07:75", "早尖峰"),
    ("24:00", 24, 0, "24:00", "未分類"),
    ("99", 99, 0, "99:00", "未分類"),
    ("ab", None, 0, "00", "未分類"),
    ("", None, 0, "00", "未分類"),
    (None, None, None, "", "未分類"),
]


def test_dates(spark):
    df = spark.createDataFrame(list(enumerate(t for t, _ in DATES)), "i int, t string")
    got = [r.d for r in df.select("i", normalize.parse_date(F.col("t")).alias("d")).orderBy("i").collect()]
    assert got == [d for _, d in DATES]


def test_date_column_of_date_type(spark):
    df = spark.sql("SELECT DATE '2026-06-14' AS d").select(normalize.parse_date(F.col("d")).alias("d"))
    assert df.first().d == date(2026, 6, 14)


def test_times(spark):
    df = spark.createDataFrame(list(enumerate(t[0] for t in TIMES)), "i int, t string")
    digits = normalize.clock_digits(F.col("t"))
    hour, minute = normalize.hour_of(digits), normalize.minute_of(digits)
    out = df.select("i", hour.alias("h"), minute.alias("m"), normalize.clock_text(hour, minute).alias("x"),
                    normalize.hour_band(hour).alias("b")).orderBy("i")
    assert [tuple(r)[1:] for r in out.collect()] == [t[1:] for t in TIMES]


@pytest.mark.parametrize(
    "hour, label",
    [(0, "凌晨"), (5, "凌晨"), (6, "早尖峰"), (8, "早尖峰"), (9, "日間"), (15, "日間"), (16, "晚尖峰"),
     (18, "晚尖峰"), (19, "夜間"), (23, "夜間"), (24, "未分類"), (None, "未分類")],
)
def test_hour_bands(spark, hour, label):
    assert spark.range(1).select(normalize.hour_band(F.lit(hour).cast("int")).alias("b")).first().b == label


def test_custom_bands_first_range_wins(spark):
    bands = (("early", 0, 12), ("late", 12, 23))
    got = spark.range(1).select(normalize.hour_band(F.lit(12), bands, "none").alias("b")).first().b
    assert got == "early"


def test_feed_timestamp_needs_the_whole_text(spark):
    texts = ["2026/06/14 23:55", "2026/6/4 7:05", "2026/06/14", "2026/06/14 23:55:01", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ts = normalize.parse_feed_timestamp(F.col("t"))
    out = df.select(normalize.feed_date_text(ts).alias("d"), normalize.feed_time_text(ts).alias("t"))
    assert [tuple(r) for r in out.collect()] == [
        ("2026/6/14", "23:55"), ("2026/6/4", "07:05"), (None, None), (None, None), (None, None), (None, None)
    ]


def test_pair_id_is_null_with_a_missing_end(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None), (None, "B")], "a string, b string")
    got = [r.p for r in df.select(normalize.pair_id(F.col("a"), F.col("b")).alias("p")).collect()]
    assert got == ["A_B", None, None]


def test_parent_folder_undoes_percent_encoding(spark):
    paths = ["file:/x/A_B/p.parquet", "file:/x/A%20B+C/p.parquet", "file:/x/p.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r.f for r in df.select(normalize.parent_folder(F.col("p"), "parquet").alias("f")).collect()]
    assert got == ["A_B", "A B+C", ""]


def test_minutes(spark):
    df = spark.createDataFrame([(155,), (100,), (125,), (25,)], "s int")
    assert [r.m for r in df.select(measures.minutes(F.col("s")).alias("m")).collect()] == [2.58, 1.67, 2.08, 0.42]


def test_buffer_index_needs_a_positive_p50(spark):
    df = spark.createDataFrame([(0, 5), (4, 5), (None, 5)], "a int, b int")
    got = [r.x for r in df.select(measures.buffer_index(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got == [None, 0.25, None]


def test_grade_bounds(spark):
    cases = [(0.0, "穩定"), (0.2499, "穩定"), (0.25, "普通"), (0.495, "普通"), (0.5, "不穩定"), (0.99, "不穩定"),
             (1.0, "高風險"), (7.0, "高風險"), (None, None)]
    df = spark.createDataFrame([(x,) for x, _ in cases], "x double")
    assert [r.g for r in df.select(measures.grade(F.col("x")).alias("g")).collect()] == [g for _, g in cases]


def test_duration_text(spark):
    cases = [(0.0, "0 秒"), (59.0, "59 秒"), (60.0, "1 分"), (125.0, "2 分 5 秒"), (59.5, "1 分"), (None, "—"),
             (float("nan"), "—")]
    df = spark.createDataFrame([(x,) for x, _ in cases], "x double")
    assert [r.t for r in df.select(display.duration_text(F.col("x")).alias("t")).collect()] == [t for _, t in cases]


def test_grade_colour(spark):
    cases = [("穩定", "#22C55E"), ("普通", "#F59E0B"), ("不穩定", "#F97316"), ("高風險", "#EF4444"),
             ("other", "#94A3B8"), (None, "#94A3B8")]
    df = spark.createDataFrame([(x,) for x, _ in cases], "x string")
    assert [r.c for r in df.select(display.grade_colour(F.col("x")).alias("c")).collect()] == [c for _, c in cases]
