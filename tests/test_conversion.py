"""Whole-file rejection, incremental conversion and its report."""

import os

import pytest
from pyspark.sql import functions as F

from pacewise.operators import conversion
from pacewise.plans import jobs
from pacewise.sources import segments
from pacewise.sources.segments import list_segment_files, read_segment_lines, read_segment_table
from pacewise.streaming.incremental import checkpoint_folder, convert_new_files

GOOD = "2026/6/14,23:55,31,62,14\n"
FILES = {
    "P1/2025_P1.csv": GOOD * 2,
    "P1/2026_P1.csv": "RecordDate,RecordTime,VehicleType,TravelTime,Volume\n" + GOOD,
    "P2/2025_P2.csv": GOOD + "2026/6/14,23:55,31\n",
    "P2/2026_P2.csv": GOOD + "2026/6/14,23:55,31,62,many\n",
    "P3/empty.csv": "",
    "P3/late_header.csv": GOOD + "date,time,a,b,c\n",
    "P3/nulls.csv": "\n2026/6/14,23:55,31,62,\n\n,23:55,NA,62,14\n",
    "P4/too_big.csv": "2026/6/14,23:55,40000,62,14\n",
    "P4/six.csv": "2026/6/14,23:55,31,62,14,9\n",
    "P4/decimal.csv": "2026/6/14,23:55,31,62.5,14\n",
    "P4/bom.csv": "﻿date,time,x,y,volume\n" + GOOD,
}
WANT = {
    "2025_P1": ("converted", None, 2), "2026_P1": ("converted", None, 1), "2025_P2": ("failed", "not five columns", 2),
    "2026_P2": ("failed", "wrong type", 2), "empty": ("failed", "empty file", 0),
    "late_header": ("failed", "header after the first row", 1), "nulls": ("converted", None, 2),
    "too_big": ("failed", "wrong type", 1), "six": ("failed", "not five columns", 1),
    "decimal": ("failed", "wrong type", 1), "bom": ("converted", None, 1),
}


@pytest.fixture
def root(tmp_path):
    for name, text in FILES.items():
        path = tmp_path / "split" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    return tmp_path / "split"


def stems(df):
    return {r.source_file.rsplit("/", 1)[1][:-4]: (r.status, r.reason, r.data_rows) for r in df.collect()}


def table(spark, path):
    return spark.read.parquet(str(path)).groupBy("pair_id", "source").count().collect()


def test_verdicts(spark, root):
    files = list_segment_files(spark, str(root))
    lines = read_segment_lines(spark, [str(p) for p in root.glob("*/*.csv")])
    assert stems(conversion.file_verdicts(lines, files)) == WANT


def test_convert_is_incremental(spark, root, tmp_path):
    out, report = str(tmp_path / "out"), str(tmp_path / "report")
    assert jobs.convert(spark, str(root), out, report, dry_run=True).count() == len(FILES)
    assert not (tmp_path / "out").exists()
    assert stems(jobs.convert(spark, str(root), out, report)) == WANT
    counts = {(r.pair_id, r.source): r["count"] for r in table(spark, out)}
    assert counts == {("P1", "2025_P1"): 2, ("P1", "2026_P1"): 1, ("P3", "nulls"): 2, ("P4", "bom"): 1}
    rows = read_segment_table(spark, out, partitioned=True).filter("source = 'nulls'")
    assert {tuple(r)[:5] for r in rows.collect()} == {("2026/6/14", "23:55", 31, 62, None), (None, "23:55", None, 62, 14)}
    assert dict(rows.dtypes) | {"VehicleType": "smallint", "TravelTime": "int", "Volume": "int"} == dict(rows.dtypes)

    (root / "P2/2025_P2.csv").write_text(GOOD * 3)
    (root / "P1/2025_P1.csv").write_text(GOOD * 9)
    again = stems(jobs.convert(spark, str(root), out, report))
    assert set(again) == {n for n, v in WANT.items() if v[0] == "failed"} and again["2025_P2"][0] == "converted"
    counts = {(r.pair_id, r.source): r["count"] for r in table(spark, out)}
    assert counts[("P2", "2025_P2")] == 3 and counts[("P1", "2025_P1")] == 2
    metrics = {r.pair_id: tuple(r)[1:] for r in conversion.conversion_metrics(
        list_segment_files(spark, str(root)), spark.read.parquet(report)).collect()}
    assert metrics == {"P1": (2, 0, 2, 0), "P2": (2, 1, 0, 1), "P3": (3, 0, 1, 2), "P4": (4, 0, 1, 3)}

    jobs.convert(spark, str(root), out, report, overwrite=True)
    counts = {(r.pair_id, r.source): r["count"] for r in table(spark, out)}
    assert counts[("P1", "2025_P1")] == 9 and len(counts) == 5


def test_many_files_are_joined_and_older_ones_stay_closed(spark, root, tmp_path, monkeypatch):
    out, report = str(tmp_path / "out"), str(tmp_path / "report")
    assert stems(jobs.convert(spark, str(root), out, report)) == WANT
    counts = {tuple(r) for r in table(spark, out)}
    for path in root.glob("*/*.csv"):
        if WANT[path.stem][0] == "converted":
            path.write_bytes(b"\x1f\x8b not text\n" * 3)  # would be rejected if it were read
            os.utime(path, (1, 1))
    (root / "P1/2027_P1.csv").write_text(GOOD * 4)
    monkeypatch.setattr(segments, "NAMED_FILES", 0)
    for limit in (100, 0):
        monkeypatch.setattr(segments, "BROADCAST_FILES", limit)
        seen = segments.read_listed_lines(spark, str(root), list_segment_files(spark, str(root)).filter("source_file like '%2027%'"))
        assert [(r.pair_id, r.line) for r in seen.collect()] == [("P1", GOOD.strip())] * 4
        assert stems(seen.select("source_file", F.lit("").alias("status"), F.lit("").alias("reason"), F.lit(0).alias("data_rows")).distinct()) == {"2027_P1": ("", "", 0)}
    again = stems(jobs.convert(spark, str(root), out, report))
    assert set(again) == {n for n, v in WANT.items() if v[0] == "failed"} | {"2027_P1"}
    assert {tuple(r) for r in table(spark, out)} == counts | {("P1", "2027_P1", 4)}


def test_plain_folder_layout(spark, tmp_path):
    folder = tmp_path / "seg" / "01F A+B"
    spark.sql("SELECT '2026/6/14' RecordDate, '5' RecordTime, 31S VehicleType, 5 TravelTime, 2 Volume").write.parquet(str(folder))
    read = read_segment_table(spark, str(tmp_path / "seg"))
    assert [r.pair_id for r in read.collect()] == ["01F A+B"]


def test_stream_converts_each_file_once(spark, root, tmp_path):
    out, report, progress = (str(tmp_path / n) for n in ("out", "report", "progress"))
    convert_new_files(spark, str(root), out, report, progress, files_per_batch=4).awaitTermination()
    counts = {(r.pair_id, r.source): r["count"] for r in table(spark, out)}
    assert counts == {("P1", "2025_P1"): 2, ("P1", "2026_P1"): 1, ("P3", "nulls"): 2, ("P4", "bom"): 1}
    verdicts = stems(spark.read.parquet(report))
    assert verdicts == WANT
    (root / "P5").mkdir()
    (root / "P5/new.csv").write_text(GOOD)
    convert_new_files(spark, str(root), out, report, progress).awaitTermination()
    counts = {(r.pair_id, r.source): r["count"] for r in table(spark, out)}
    assert len(counts) == 5 and counts[("P5", "new")] == 1


def test_stream_progress_defaults_to_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_folder(spark, "x") == f"{shared}/x"
    assert checkpoint_folder(spark, "x", "/given") == "/given"
