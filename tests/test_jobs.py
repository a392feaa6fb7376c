"""The batch stages end to end, write modes, exports and lookups."""

import csv
import json
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pacewise.operators import clean, export, lookup, remap
from pacewise.plans import jobs
from pacewise.schemas import LOCATION_COLUMNS, SUMMARY_COLUMNS
from pacewise.sinks import files, tables
from pacewise.sources import dimensions
from pacewise.sources.documents import read_features, read_parts
from pacewise.sources.segments import read_segment_table, split_partitions
from tests.helpers import plan, rows

LOCATION_ROW = (" A_B ", "路 A", "A", "a", "1", "121.5", "25", "B", "b", "2", "121.75", "25.25", "3.5", "North")
SUMMARY_TYPES = ("summary_level string, pair_id string, day_type string, time_period string, p50_travel_time_sec int, "
                 "p95_travel_time_sec int, buffer_time_sec int, buffer_index double, reliability_level string")


def location_rows(spark, *changes):
    base = dict(zip(LOCATION_COLUMNS, LOCATION_ROW))
    data = [tuple((base | change)[c] for c in LOCATION_COLUMNS) for change in changes]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in LOCATION_COLUMNS))


def summary_rows(spark, *pairs):
    data = [("L4_OVERALL", p, "ALL", "ALL", 100, 155, 55, 0.55, "不穩定") for p in pairs]
    return spark.createDataFrame(data, SUMMARY_TYPES)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """Every stage from raw feed to the summary table."""
    base = tmp_path_factory.mktemp("build")
    for day, hour, lines in [("20260612", "07", 5), ("20260613", "18", 5), ("20260701", "09", 2)]:
        folder = base / "feed" / day / hour
        folder.mkdir(parents=True)
        stamp = f"{day[:4]}/{day[4:6]}/{day[6:]} {hour}:05"
        text = "".join(f"{stamp},A,B,31,{100 + 10 * i},{i + 1}\n" for i in range(lines))
        text += f"{stamp},OLD,B,31,100,1\n" + f"{stamp},01F0532S,01F0532N,31,100,1\n"
        (folder / "TDCS_M04A_x.csv").write_text(text)
    (base / "mapping.csv").write_text("route,note,target_route\nOLD_B,合併,A_B\n", encoding="utf-8-sig")
    (base / "calendar.csv").write_text(
        "record_date,day_type\n2026/6/12,Weekday\n2026-06-13,Weekend\n20260701,Weekday\n20260701,Holiday\n", encoding="utf-8-sig")
    with open(base / "location.csv", "w", encoding="utf-8-sig", newline="") as f:
        csv.writer(f).writerows([LOCATION_COLUMNS, LOCATION_ROW])
    paths = {n: str(base / n) for n in ("feed", "split", "merged", "segments", "report", "mapping.csv", "calendar.csv", "location.csv")}
    jobs.split(spark, paths["feed"], paths["split"])
    jobs.merge(spark, paths["split"], paths["mapping.csv"], paths["merged"])
    jobs.convert(spark, paths["merged"], paths["segments"], paths["report"])
    jobs.clean(spark, paths["segments"], paths["calendar.csv"], "built.clean", write_partitions=4, overwrite=True)
    jobs.build_histogram(spark, "built.clean", "built.histogram", overwrite=True)
    counts, invalid = jobs.build_summary(spark, "built.histogram", "built.summary", overwrite=True)
    return base, paths, {r.summary_level: r.n_rows for r in counts.collect()}, invalid


def test_tables(spark, built):
    _, _, counts, invalid = built
    assert invalid == 0
    assert counts == {"L1_DAY_TYPE": 2, "L2_TIME_PERIOD": 2, "L3_DAY_TYPE_TIME_PERIOD": 2, "L4_OVERALL": 1}
    clean_table = spark.table("built.clean")
    assert {r.pair_id for r in clean_table.collect()} == {"A_B"}
    # The row of the old segment equals one of the new segment and was merged away.
    assert clean_table.count() == 12
    assert spark.table("built.histogram").filter("time_period = '日間'").count() == 0
    assert "record_month" in spark.catalog.listColumns("built.clean")[-1].name
    l4 = spark.table("built.summary").filter("summary_level = 'L4_OVERALL'").first()
    assert (l4.p50_travel_time_sec, l4.p95_travel_time_sec, l4.reliability_level) == (130, 140, "穩定")


def test_quality_of_the_build(spark, built):
    _, paths, _, _ = built
    report = jobs.quality(spark, paths["segments"], paths["calendar.csv"], "built.clean", "built.histogram", "built.summary",
                          paths["location.csv"])
    bad = {(r.check, r.scope): r.bad_rows for r in report.collect() if r.bad_rows}
    # The clean rows of the three days (5, 5 and 2) share one minute and vehicle type per day.
    assert bad == {("duplicate_observations", "rows"): 4 + 4 + 1, ("level_shortfall", "L2_TIME_PERIOD"): 3, ("level_shortfall", "L3_DAY_TYPE_TIME_PERIOD"): 8}


def test_filler_in_the_histogram_raises(spark, built):
    spark.table("built.histogram").withColumn("day_type", F.lit("ALL")).write.mode("overwrite").saveAsTable("built.mixed")
    with pytest.raises(ValueError, match="'ALL'"):
        jobs.build_summary(spark, "built.mixed", "built.never")


def test_create_only_unless_overwrite(spark, built):
    with pytest.raises(AnalysisException, match="already exists|ALREADY_EXISTS"):
        jobs.build_histogram(spark, "built.clean", "built.histogram")
    before = rows(spark.table("built.histogram"))
    jobs.build_histogram(spark, "built.clean", "built.histogram", overwrite=True)
    assert rows(spark.table("built.histogram")) == before
    jobs.build_histogram(spark, "built.clean", "built.other", ["2026-06-12"], overwrite=True)
    assert {r.time_period for r in spark.table("built.other").collect()} == {"晚尖峰", "日間"}


def test_write_partitions_must_be_positive(spark, built):
    with pytest.raises(ValueError, match="positive"):
        tables.write_summary(spark.table("built.summary"), "built.never", partitions=0)


def test_geojson_lines_and_collection(spark, built):
    base, paths, _, _ = built
    lines, document = str(base / "lines"), str(base / "document")
    assert jobs.export_geojson(spark, "built.summary", paths["location.csv"], lines) == "lines"
    assert jobs.export_geojson(spark, "built.summary", paths["location.csv"], document, collection=True) == "collection"
    loaded = json.loads(joined(base / "document"))
    assert loaded["type"] == "FeatureCollection" and loaded["name"] == "tdcs_reliability_map"
    assert len(loaded["features"]) == 7
    first = loaded["features"][0]
    assert first["geometry"] == {"type": "LineString", "coordinates": [[121.5, 25.0], [121.75, 25.25]]}
    assert len(first["properties"]) == 18 and first["properties"]["pair_roadname"] == "路 A"
    one = read_features(spark, lines).select(F.to_json(F.struct("*")).alias("j"))
    (base / "whole").write_text(joined(base / "document"), encoding="utf-8")
    other = read_features(spark, str(base / "whole"), collection=True).select(F.to_json(F.struct("*")).alias("j"))
    assert rows(one) == rows(other)
    with pytest.raises(AnalysisException):
        jobs.export_geojson(spark, "built.summary", paths["location.csv"], lines)
    jobs.export_geojson(spark, "built.summary", paths["location.csv"], lines, overwrite=True)


def test_a_collection_is_read_back_from_its_own_parts(spark, tmp_path):
    pairs = [f"P{i:03}" for i in range(40)]
    located = export.with_location(summary_rows(spark, *pairs).repartition(5), dimensions.location(location_rows(spark, *({"pair_id": p} for p in pairs))))
    for name, gathered in (("one", "true"), ("many", "false")):
        path = tmp_path / name
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", gathered)
        try:
            files.write_geojson(located, str(path), collection=True)
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        found = read_features(spark, str(path), collection=True)
        assert sorted(r.properties.pair_id for r in found.collect()) == pairs
        assert found.first().geometry.coordinates == [[121.5, 25.0], [121.75, 25.25]]
        whole = joined(path).encode()
        index = read_parts(spark, str(path)).orderBy("start").collect()
        assert sum(r.features for r in index) == 40 and (len(index) > 1) == (name == "many")
        for r in index:
            assert whole[r.start : r.start + r.bytes] == (path / r.part).read_bytes()
            assert r.first_pair_id is None or f'"pair_id":"{r.first_pair_id}"'.encode() in (path / r.part).read_bytes().split(b"Feature")[-r.features]
    (tmp_path / "foreign").write_text(json.dumps(json.loads(joined(tmp_path / "many")), indent=2), encoding="utf-8")
    assert read_features(spark, str(tmp_path / "foreign"), collection=True).count() == 40


def test_the_last_route_name_of_a_file_counts(spark, tmp_path):
    columns = ",".join(LOCATION_COLUMNS)
    listed = [("A_B", "Zeta"), ("C_D", "Only"), *((f"X{i}", "filler" * 20) for i in range(3000)), ("A_B", "Alpha")]
    lines = [",".join([pair, name, *[""] * (len(LOCATION_COLUMNS) - 2)]) for pair, name in listed]
    (tmp_path / "location.csv").write_text(columns + "\n" + "\n".join(lines) + "\n", encoding="utf-8-sig")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        names = dimensions.read_route_names(spark, str(tmp_path / "location.csv"))
        assert names.rdd.getNumPartitions() > 3
        got = {r.pair_id: r.route_name for r in lookup.with_route_name(summary_rows(spark, "A_B", "C_D", "E_F"), names).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {"A_B": "Alpha", "C_D": "Only", "E_F": "E_F"}


def test_a_failed_overwrite_leaves_the_old_table(spark):
    good = spark.range(10).select(F.col("id").alias("n"), (F.col("id") % 2).alias("k"))
    bad = good.withColumn("n", F.when(F.col("n") < 9, F.col("n")).otherwise(F.raise_error(F.lit("half-way")).cast("long")))
    tables.write_table(good, "built.staged", ["k"], ["n"], overwrite=True)
    with pytest.raises(Exception, match="half-way"):
        tables.write_table(bad, "built.staged", ["k"], ["n"], overwrite=True)
    assert spark.table("built.staged").count() == 10
    tables.write_table(good.filter("n > 3"), "built.staged", ["k"], ["n"], overwrite=True)
    assert spark.table("built.staged").count() == 6
    spark.sql("ALTER TABLE built.staged RENAME TO built.staged__old")  # a run that stopped between the renames
    tables.write_table(good.filter("n > 4"), "built.staged", ["k"], ["n"], overwrite=True)
    assert rows(spark.table("built.staged").select("n")) == {(n,): 1 for n in range(5, 10)}
    assert not spark.catalog.tableExists("built.staged__old") and not spark.catalog.tableExists("built.staged__new")


def test_lookup_on_written_features(spark, built):
    base, paths, _, _ = built
    path = str(base / "served")
    jobs.export_geojson(spark, "built.summary", paths["location.csv"], path, overwrite=True)
    features = read_features(spark, path)
    names = dimensions.read_route_names(spark, str(base / "none.csv"))
    assert lookup.lookup(features, {}, names).count() == 7
    assert lookup.lookup(features, {"direction": "East"}, names).count() == 0
    asked = lookup.level_filters("L1_DAY_TYPE", "Weekend", "日間", "North")
    found = lookup.lookup(features, asked, names).collect()
    assert [(r.day_type, r.time_period, r.route_name) for r in found] == [("Weekend", "ALL", "A_B")]
    assert "buffer_index" not in found[0].asDict()


def test_bi_csv(spark, built):
    base, _, _, _ = built
    path = base / "bi"
    jobs.export_bi_csv(spark, "built.summary", str(path), single_file=True)
    read = list(csv.DictReader(joined(path).splitlines()))
    keys = [(r["summary_level"], r["pair_id"], r["day_type"], r["time_period"]) for r in read]
    assert keys == sorted(keys) and len(keys) == 7
    assert list(read[0]) == [*SUMMARY_COLUMNS, "p50_travel_time_min", "p95_travel_time_min", "buffer_time_min"]
    with pytest.raises(AnalysisException):
        jobs.export_bi_csv(spark, "built.summary", str(path))
    jobs.export_bi_csv(spark, "built.summary", str(path), overwrite=True)


def joined(folder):
    return "".join(p.read_text(encoding="utf-8") for p in sorted(folder.glob("part-*")))


def test_a_document_is_the_same_in_one_part_and_in_many(spark, tmp_path):
    pairs = [f"P{i:03}" for i in range(60)]
    summary = summary_rows(spark, *pairs).repartition(7)
    located = export.with_location(summary, dimensions.location(location_rows(spark, *({"pair_id": p} for p in pairs))))
    size = "spark.sql.adaptive.coalescePartitions.enabled"
    for name, gathered in (("one", "true"), ("many", "false")):
        spark.conf.set(size, gathered)
        try:
            assert files.write_geojson(located, str(tmp_path / name), collection=True) == "collection"
            files.write_bi_csv(summary, str(tmp_path / f"{name}_csv"), single_file=True)
        finally:
            spark.conf.unset(size)
    assert len(list((tmp_path / "one").glob("part-*"))) < len(list((tmp_path / "many").glob("part-*")))
    for name in ("one", "many"):
        features = json.loads(joined(tmp_path / name))["features"]
        assert [f["properties"]["pair_id"] for f in features] == pairs
        read = list(csv.DictReader(joined(tmp_path / f"{name}_csv").splitlines()))
        assert [r["pair_id"] for r in read] == pairs and read[0]["p50_travel_time_min"] == "1.67"


def test_location_checks(spark):
    summary = summary_rows(spark, "A_B", "C_D")
    with pytest.raises(ValueError, match="1 segments have more than one"):
        export.check_locations(summary, dimensions.location(location_rows(spark, {}, {"pair_id": "A_B"})))
    with pytest.raises(ValueError, match="1 summary segments have no location"):
        export.check_locations(summary, dimensions.location(location_rows(spark, {})))
    half = dimensions.location(location_rows(spark, {}, {"pair_id": "C_D", "end_latitude": None}))
    export.check_locations(summary, half)
    assert [r.pair_id for r in export.with_location(summary, half).collect()] == ["A_B"]
    assert rows(export.without_coordinates(summary, half)) == {("C_D", 1): 1}


def test_numbers_without_json_form_raise(spark):
    located = export.with_location(summary_rows(spark, "A_B"), dimensions.location(location_rows(spark, {"distance_km": "NaN"})))
    with pytest.raises(Exception, match="without a JSON form at A_B"):
        export.feature_lines(located).collect()
    missing = export.with_location(summary_rows(spark, "A_B"), dimensions.location(location_rows(spark, {"distance_km": None})))
    assert json.loads(export.feature_lines(missing).first().value)["properties"]["distance_km"] is None


def test_route_name_falls_back_only_for_absent_segments(spark):
    summary = summary_rows(spark, "A_B", "C_D", "E_F")
    names = spark.createDataFrame([("A_B", "Road"), ("C_D", ""), ("C_X", "x")], "pair_id string, pair_roadname string")
    got = {r.pair_id: r.route_name for r in lookup.with_route_name(summary, names).collect()}
    assert got == {"A_B": "Road", "C_D": "", "E_F": "E_F"}
    twice = spark.createDataFrame([(2, "A_B", "New"), (1, "A_B", "Old")], "seq int, pair_id string, pair_roadname string")
    assert rows(lookup.with_route_name(summary, twice).select("pair_id", "route_name")) == {("A_B", "New"): 1, ("C_D", "C_D"): 1, ("E_F", "E_F"): 1}


def test_calendar_conflict_is_settled_and_reported(spark, tmp_path):
    raw = spark.createDataFrame([("2026/7/1", "Weekend"), ("2026-07-01", " Weekday "), ("x", "Weekday"), ("20260702", "Holiday")],
                                "record_date string, day_type string")
    assert rows(dimensions.calendar(raw)) == {(date(2026, 7, 1), "Weekday"): 1}
    assert rows(dimensions.calendar_conflicts(raw)) == {(date(2026, 7, 1), "Weekday", "Weekend"): 1}
    raw.write.parquet(str(tmp_path / "calendar"))
    assert dimensions.read_dimension(spark, str(tmp_path / "calendar")).count() == 4
    with pytest.raises(ValueError, match="day_type"):
        dimensions.calendar(raw.drop("day_type"))


def test_clean_guards(spark):
    schema = "pair_id string, RecordDate string, RecordTime string, VehicleType string, TravelTime string, Volume string"
    good = ("A_B", "2026/6/14", "7:05", "31", "60", "2")
    cases = [good, (None, *good[1:]), (" ", *good[1:]), ("01F0532S_01F0532N", *good[1:]), ("A_B", "x", *good[2:]),
             (*good[:2], "24:00", *good[3:]), (*good[:2], "", *good[3:]), (*good[:2], None, *good[3:]),
             (*good[:3], None, "60", "2"), (*good[:3], "", "60", "2"), (*good[:4], "0", "2"), (*good[:4], "60", "-1"),
             (*good[:4], "many", "2"), (*good[:4], "60", None), (*good[:2], "0775", *good[3:])]
    typed = clean.typed(spark.createDataFrame(cases, schema))
    assert [r.record_time_minute for r in clean.valid(typed).collect()] == ["07:05", "07:75"]
    assert [r.record_time_minute for r in clean.valid(typed, strict_minute=True).collect()] == ["07:05"]
    assert clean.valid(typed, excluded=()).count() == 3
    calendar = dimensions.calendar(spark.createDataFrame([("2026/6/15", "Weekday")], "record_date string, day_type string"))
    assert clean.with_day_type(clean.valid(typed), calendar).count() == 0
    assert rows(clean.uncovered_dates(clean.valid(typed), calendar)) == {(date(2026, 6, 14), 2): 1}


def test_gantry_list_and_mapping_order(spark, tmp_path):
    (tmp_path / "gantry.csv").write_text("基隆,01F0005\n\n八堵,01F0029\n", encoding="utf-8")
    got = dimensions.read_gantries(spark, str(tmp_path / "gantry.csv")).collect()
    assert [tuple(r) for r in got] == [("基隆", "01F0005"), ("八堵", "01F0029")]
    with pytest.raises(FileNotFoundError):
        dimensions.read_gantries(spark, str(tmp_path / "none.csv")).collect()
    text = "route,note,target_route\n" + "".join(f"r{i},合併,t{i}\n" for i in range(300))
    (tmp_path / "mapping.csv").write_text(text, encoding="utf-8-sig")
    ordered = dimensions.read_mapping(spark, str(tmp_path / "mapping.csv")).orderBy("seq")
    assert [r.route for r in ordered.collect()] == [f"r{i}" for i in range(300)]


def test_segment_table_needs_its_columns(spark, tmp_path):
    spark.sql("SELECT 1 AS RecordDate").write.parquet(str(tmp_path / "seg" / "A_B"))
    with pytest.raises(ValueError, match="RecordTime"):
        read_segment_table(spark, str(tmp_path / "seg"))


def segment_rows(spark, paths):
    return rows(spark.read.parquet(paths["segments"]).groupBy("pair_id").count())


def test_repeated_runs_never_double_rows(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("feed", "split", "segments", "report")}
    folder = tmp_path / "feed" / "20260612" / "07"
    folder.mkdir(parents=True)
    line = "2026/06/12 07:05,{},B,31,100,1\n"
    (folder / "TDCS_M04A_x.csv").write_text(line.format("A") * 5 + line.format("C") * 2 + line.format("NA"))
    for year in (None, 2026):
        for _ in range(2):
            counters = jobs.split(spark, paths["feed"], paths["split"], year=year, all_counters=True)
            jobs.convert(spark, paths["split"], paths["segments"], paths["report"])
            assert segment_rows(spark, paths) == {("A_B", 5): 1, ("C_B", 2): 1}
    assert counters["files"] == 1 and counters["empty_files"] == 0 and counters["pairs"] == 2 and counters["pairs_reused"] == 2
    assert counters["rows_without_pair"] == 1 and counters["rows_written"] == 7 and counters["pairs_new"] == 0
    for _ in range(2):
        jobs.convert(spark, paths["split"], paths["segments"], paths["report"], overwrite=True)
    assert segment_rows(spark, paths) == {("A_B", 5): 1, ("C_B", 2): 1}
    assert jobs.convert(spark, paths["split"], paths["segments"], paths["report"]).count() == 0

    # a part file more: the unit is converted again from all of its files
    (tmp_path / "split/year=2026/pair_id=A_B/more.csv").write_text("2026/6/12,07:10,31,90,2\n")
    assert jobs.convert(spark, paths["split"], paths["segments"], paths["report"]).count() == 2
    assert segment_rows(spark, paths) == {("A_B", 6): 1, ("C_B", 2): 1}

    # a segment that vanishes, and one whose file has a header only
    (folder / "TDCS_M04A_x.csv").write_text(line.format("A"))
    jobs.split(spark, paths["feed"], paths["split"], year=2026)
    jobs.convert(spark, paths["split"], paths["segments"], paths["report"])
    assert segment_rows(spark, paths) == {("A_B", 1): 1}
    (tmp_path / "split/year=2026/pair_id=D_B").mkdir()
    (tmp_path / "split/year=2026/pair_id=D_B/x.csv").write_text("RecordDate,RecordTime,VehicleType,TravelTime,Volume\n")
    assert jobs.convert(spark, paths["split"], paths["segments"], paths["report"]).count() == 1
    assert jobs.convert(spark, paths["split"], paths["segments"], paths["report"]).count() == 0
    assert segment_rows(spark, paths) == {("A_B", 1): 1}


def test_repeated_merge_and_convert(spark, built):
    base, paths, _, _ = built
    before = rows(spark.read.parquet(paths["segments"]).drop("source"))
    for _ in range(2):
        jobs.merge(spark, paths["split"], paths["mapping.csv"], paths["merged"])
        jobs.convert(spark, paths["merged"], paths["segments"], paths["report"], overwrite=True)
    assert rows(spark.read.parquet(paths["segments"]).drop("source")) == before


def _split_tree(spark, root):
    """Renamed segments in two years, and folders that no rule names, whose files cannot be read."""
    line = "{},00:05,31,{},1\n"
    for year, pair, text in [(2025, "A", line.format("2025/1/2", 60) * 2), (2025, "B", line.format("2025/1/2", 60) + line.format("2025/1/1", 5)),
                             (2026, "A", line.format("2026/1/1", 7) * 2), (2026, "D:x", line.format("2026/1/1", 8))]:
        folder = root / f"year={year}" / f"pair_id={pair.replace(':', '%3A')}"
        folder.mkdir(parents=True)
        (folder / "part-0.csv").write_text(text)
    for year, pair in [(2024, "Z"), (2026, "C"), (2026, "Z")]:
        folder = root / f"year={year}" / f"pair_id={pair}"
        folder.mkdir(parents=True)
        (folder / "part-0.csv.gz").write_bytes(b"not a gzip file")


def test_merge_in_place_opens_no_untouched_partition(spark, tmp_path):
    _split_tree(spark, tmp_path / "split")
    (tmp_path / "mapping.csv").write_text("route,note,target_route\nA,合併,B\nD:x,合併,E\n", encoding="utf-8-sig")
    for _ in range(2):  # the second run finds nothing to move
        jobs.merge(spark, str(tmp_path / "split"), str(tmp_path / "mapping.csv"))
        left = {str(p.relative_to(tmp_path / "split")) for p in (tmp_path / "split").glob("year=*/pair_id=*")}
        assert left == {f"year={y}/pair_id={p}" for y, p in [(2024, "Z"), (2025, "B"), (2026, "B"), (2026, "C"), (2026, "E"), (2026, "Z")]}
        good = files.read_split(spark, str(tmp_path / "split")).filter("pair_id in ('B', 'E')")
        assert rows(good.select("year", "pair_id", "date", "travel_time_sec")) == {
            (2025, "B", "2025/1/1", "5"): 1, (2025, "B", "2025/1/2", "60"): 1, (2026, "B", "2026/1/1", "7"): 2, (2026, "E", "2026/1/1", "8"): 1}
        (part,) = (tmp_path / "split/year=2025/pair_id=B").glob("*.csv")
        assert [r.split(",")[0] for r in part.read_text().splitlines()] == ["2025/1/1", "2025/1/2"]


def test_merge_scans_twice_at_most(spark, tmp_path):
    _split_tree(spark, tmp_path / "split")
    mapping = spark.createDataFrame([(0, "A", "合併", "B")], "seq int, route string, note string, target_route string")
    moves = remap.planned_moves(split_partitions(spark, str(tmp_path / "split")), remap.merge_rules(mapping))
    text = plan(remap.touched_segments(files.read_split(spark, str(tmp_path / "split")), moves))
    assert text.count("FileScan csv") <= 2 and "dynamicpruning" in text.lower()


def test_part_files_are_sorted(spark, built):
    """The sort keys of the three tables, read back part by part."""
    keys = {
        "built.clean": ("record_month", "record_date", "record_time_minute", "pair_id", "vehicle_type", "day_type", "time_period"),
        "built.histogram": ("day_type", "time_period", "pair_id", "travel_time_sec"),
        "built.summary": ("summary_level", "pair_id", "day_type", "time_period"),
    }
    for table, columns in keys.items():
        seen = {}
        for row in spark.table(table).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), *columns).collect():
            seen.setdefault(row.file, []).append((row.at, tuple(row[c] for c in columns)))
        for found in seen.values():
            ordered = [r for _, r in sorted(found, key=lambda f: f[0])]
            assert ordered == sorted(ordered), table
