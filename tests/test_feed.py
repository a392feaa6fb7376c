"""Feed folders, file selection and split output."""

import pytest

from pacewise.operators import split
from pacewise.plans import jobs
from pacewise.sinks.files import read_split
from pacewise.sources import feed as feed_source
from pacewise.sources.feed import FeedFilter, date_folders, find_feed_files, read_feed
from tests.helpers import rows

LINE = "{} {},A,B,31,62,14\n"


def put(path, text="", encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)


@pytest.fixture
def feed(tmp_path):
    root = tmp_path / "feed"
    put(root / "20260113/00/TDCS_M04A_a.csv", LINE.format("2026/01/13", "00:05"), "utf-8-sig")
    put(root / "20260113/23/tdcs_m04a_b.CSV", LINE.format("2026/01/13", "23:55") + "bad,A,B,31,62,14\n,C,D,1,2,3\n")
    put(root / "20260113/24/TDCS_M04A_wrong_hour.csv", LINE.format("2026/01/13", "12:00"))
    put(root / "20260113/TDCS_M04A_beside_hours.csv", LINE.format("2026/01/13", "13:00"))
    put(root / "20260113/20260113/00/TDCS_M04A_nested.csv", LINE.format("2026/01/13", "14:00"))
    put(root / "20260113/00/TDCS_M05A_other.csv", LINE.format("2026/01/13", "15:00"))
    put(root / "20260114/TDCS_M04A_no_hours.csv", "2026/01/14 06:00,A,,31,62,14\n2026/01/14 06:00,B,C,31,62,14\n")
    put(root / "20251231/05/TDCS_M04A_c.csv", LINE.format("2025/12/31", "05:00") + LINE.format("2026/01/01", "00:00"))
    put(root / "20251399/05/TDCS_M04A_bad_date.csv", LINE.format("2025/12/31", "06:00"))
    put(root / "misc/TDCS_M04A_d.csv", LINE.format("2026/01/13", "16:00"))
    return root


def names(df):
    return sorted(r.path.rsplit("/", 1)[1] for r in df.collect())


def test_root_reads_hour_folders_only(spark, feed):
    assert names(find_feed_files(spark, str(feed))) == [
        "TDCS_M04A_a.csv", "TDCS_M04A_c.csv", "TDCS_M04A_no_hours.csv", "tdcs_m04a_b.CSV"]


def test_date_and_hour_folder_as_input(spark, feed):
    assert names(find_feed_files(spark, str(feed / "20260113"))) == ["TDCS_M04A_a.csv", "tdcs_m04a_b.CSV"]
    assert names(find_feed_files(spark, str(feed / "20260113/00"))) == ["TDCS_M04A_a.csv"]
    assert names(find_feed_files(spark, str(feed / "20260114"))) == ["TDCS_M04A_no_hours.csv"]
    late = FeedFilter.of(start="20260114")
    assert names(find_feed_files(spark, str(feed / "20260113/00"), late)) == []


def test_other_structure_and_flat_mode(spark, feed):
    assert names(find_feed_files(spark, str(feed / "misc"))) == ["TDCS_M04A_d.csv"]
    assert names(find_feed_files(spark, str(feed / "20260113"), recursive=False)) == ["TDCS_M04A_beside_hours.csv"]
    early = FeedFilter.of(2025)
    assert names(find_feed_files(spark, str(feed / "20260113"), early, recursive=False)) == []


def test_date_filters(spark, feed):
    assert names(find_feed_files(spark, str(feed), FeedFilter.of(2025))) == ["TDCS_M04A_c.csv"]
    wanted = FeedFilter.of(start="2026-01-14", end="20260114")
    assert names(find_feed_files(spark, str(feed), wanted)) == ["TDCS_M04A_no_hours.csv"]


@pytest.mark.parametrize("bad", [{"year": "26"}, {"year": "20x6"}, {"start": "2026/01/01"}, {"end": "202601"},
                                 {"start": "20260114", "end": "20260113"}])
def test_arguments_are_checked(bad):
    with pytest.raises(ValueError):
        FeedFilter.of(**bad)


def test_missing_input_and_empty_selection(spark, feed, tmp_path):
    with pytest.raises(FileNotFoundError):
        find_feed_files(spark, str(tmp_path / "nowhere"))
    with pytest.raises(FileNotFoundError):
        read_feed(spark, str(feed), FeedFilter.of(1999))


def test_split_rows_and_metrics(spark, feed):
    raw = read_feed(spark, str(feed))
    assert rows(split.split_feed(raw)) == {
        (2026, "A_B", "2026/1/13", "00:05", "31", "62", "14"): 1,
        (2026, "A_B", "2026/1/13", "23:55", "31", "62", "14"): 1,
        (2026, "B_C", "2026/1/14", "06:00", "31", "62", "14"): 1,
        (2025, "A_B", "2025/12/31", "05:00", "31", "62", "14"): 1,
        (2026, "A_B", "2026/1/1", "00:00", "31", "62", "14"): 1,
    }
    counted = split.split_metrics(raw, FeedFilter.of(end="20260113")).first().asDict()
    assert counted == {"files": 4, "empty_files": 1, "rows_read": 8, "rows_unparsed": 2, "rows_out_of_range": 2,
                       "rows_without_pair": 0, "rows_written": 4, "pairs": 1, "pair_years": 2}
    known = spark.createDataFrame([("A_B",)], "pair_id string")
    got = rows(split.pair_reuse(split.split_feed(raw), known, only_existing=True))
    assert got == {("reused", 1, 4): 1, ("skipped", 1, 1): 1}


def test_year_overwrite_drops_stale_segments_and_keeps_other_years(spark, feed, tmp_path):
    out = str(tmp_path / "split")
    counters = jobs.split(spark, str(feed), out)
    assert counters == {"rows_read": 8, "rows_unparsed": 2, "rows_out_of_range": 0, "rows_without_pair": 1, "rows_written": 5}
    before = rows(read_split(spark, out))
    assert sum(before.values()) == 5
    for path in (feed / "20260114").iterdir():
        path.write_text(LINE.format("2026/01/14", "07:00"))
    jobs.split(spark, str(feed), out, year=2026)
    after = rows(read_split(spark, out))
    years = [(r[-2], r[-1], r[0]) for r in after.elements()]
    assert sorted(years) == [(2025, "A_B", "2025/12/31"), (2026, "A_B", "2026/1/13"), (2026, "A_B", "2026/1/13"),
                             (2026, "A_B", "2026/1/14")]
    with pytest.raises(FileNotFoundError):
        jobs.split(spark, str(feed), out, year=1999)
    assert rows(read_split(spark, out)) == after
    jobs.split(spark, str(feed), out, year=2026, append=True)
    assert sum(rows(read_split(spark, out)).values()) == sum(after.values()) + 3
    jobs.split(spark, str(feed), out, year=2025, reset=True)
    assert [r[0] for r in rows(read_split(spark, out))] == ["2025/12/31"]


def test_only_existing_pairs(spark, feed, tmp_path):
    out = str(tmp_path / "split")
    jobs.split(spark, str(feed), out, year=2025)
    jobs.split(spark, str(feed), out, year=2026, only_existing_pairs=True)
    assert {r.pair_id for r in read_split(spark, out).collect()} == {"A_B"}
    jobs.split(spark, str(feed), out, year=2026, only_existing_pairs=True)
    assert read_split(spark, out).filter("year = 2026").count() == 2
    fresh = str(tmp_path / "fresh")
    counters = jobs.split(spark, str(feed), fresh, only_existing_pairs=True)
    assert counters["rows_read"] == 8 and counters["rows_written"] == 0
    assert not list((tmp_path / "fresh").glob("**/*.csv"))
    jobs.split(spark, str(feed), out, only_existing_pairs=True, reset=True)
    assert not list((tmp_path / "split").glob("**/pair_id=*"))


def test_rejected_date_folders_are_not_listed(spark, feed, monkeypatch):
    asked = []

    def listing(session, folder, recursive=True):
        asked.append(folder)
        return list_files(session, folder, recursive)

    list_files = feed_source.list_files
    monkeypatch.setattr(feed_source, "list_files", listing)
    assert names(find_feed_files(spark, str(feed), FeedFilter.of(2025))) == ["TDCS_M04A_c.csv"]
    assert asked == [f"{feed}/2025[01][0-9][0-3][0-9]"]
    assert not list_files(spark, asked[0]).filter("path like '%/2026%'").count()
    put(feed.parent / "flat/TDCS_M04A_x.csv", LINE.format("2026/01/13", "00:05"))
    assert names(find_feed_files(spark, str(feed.parent / "flat"), FeedFilter.of(2025))) == ["TDCS_M04A_x.csv"]


def test_date_folder_globs():
    assert date_folders(FeedFilter.of()) is None and date_folders(FeedFilter.of(start="20260101")) is None
    assert date_folders(FeedFilter.of(start="20251130", end="20260102")) == "{" + ",".join(f"{m}[0-3][0-9]" for m in (202511, 202512, 202601)) + "}"
    assert date_folders(FeedFilter.of(2026, "20251130", "20260102")) == "{202601[0-3][0-9]}"


def test_files_that_do_not_qualify_are_not_opened(spark, tmp_path):
    put(tmp_path / "feed/20260113/00/TDCS_M04A_a.csv", LINE.format("2026/01/13", "00:05"))
    put(tmp_path / "feed/20260114/TDCS_M04A_b.csv", LINE.format("2026/01/14", "00:05"))
    for below in ("20260113/00/TDCS_M05A_x.csv.gz", "20260113/00/deep/TDCS_M04A_x.csv.gz", "20251231/00/TDCS_M04A_x.csv.gz", "notes/x.gz"):
        put(tmp_path / "feed" / below, "not a gzip file")
    for wanted in (FeedFilter.of(2026), FeedFilter.of(start="20260101")):
        found = read_feed(spark, str(tmp_path / "feed"), wanted)
        assert sorted(r.datetime for r in found.collect()) == ["2026/01/13 00:05", "2026/01/14 00:05"]
    (tmp_path / "feed/20260114/07").mkdir()
    put(tmp_path / "feed/20260114/07/TDCS_M04A_c.csv", LINE.format("2026/01/14", "07:05"))
    again = read_feed(spark, str(tmp_path / "feed"), FeedFilter.of(2026))
    assert sorted(r.datetime for r in again.collect()) == ["2026/01/13 00:05", "2026/01/14 07:05"]
