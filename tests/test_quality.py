"""Every check of the quality report with a bad input."""

from datetime import date

from pacewise.operators.quality import quality_report
from pacewise.sources import dimensions
from tests.helpers import rows
from tests.test_jobs import location_rows


def test_each_check_counts_its_bad_rows(spark):
    day = date(2026, 6, 14)
    typed = spark.createDataFrame(
        [("A_B", day, "31", 60, 1), (" ", day, None, None, 1), (None, None, "31", 60, None), ("A_B", date(2026, 6, 20), "31", 1, 1)],
        "pair_id string, record_date date, vehicle_type string, travel_time_sec int, volume long")
    calendar = spark.createDataFrame([("2026/6/14", "Weekday"), ("20260614", "Weekend")], "record_date string, day_type string")
    clean = spark.createDataFrame([("A_B", day, "07:05", "31")] * 3 + [("A_B", day, "07:10", "31")],
                                  "pair_id string, record_date date, record_time_minute string, vehicle_type string")
    levels = spark.createDataFrame([("L1_DAY_TYPE", 10), ("L2_TIME_PERIOD", 9), ("L3_DAY_TYPE_TIME_PERIOD", 10), ("L4_OVERALL", 10)],
                                   "summary_level string, volume long")
    summary = spark.createDataFrame(
        [("L1_DAY_TYPE", "A_B", 5, 4), ("L4_OVERALL", "A_B", 5, 6), ("L4_OVERALL", "C_D", 5, 6), ("L4_OVERALL", "E_F", 5, 6)],
        "summary_level string, pair_id string, p50_travel_time_sec int, p95_travel_time_sec int")
    locations = dimensions.location(location_rows(spark, {}, {"pair_id": "C_D", "start_longitude": None}, {"pair_id": "X"}, {"pair_id": "X"}))
    report = rows(quality_report(typed, calendar, clean, levels, summary, locations))
    assert report == {
        ("null_or_blank", "pair_id", 2): 1, ("null_or_blank", "record_date", 1): 1, ("null_or_blank", "vehicle_type", 1): 1,
        ("null_or_blank", "travel_time_sec", 1): 1, ("null_or_blank", "volume", 1): 1, ("uncovered_dates", "rows", 1): 1,
        ("calendar_conflicts", "dates", 1): 1, ("duplicate_observations", "rows", 2): 1, ("location_duplicates", "pairs", 1): 1,
        ("missing_locations", "pairs", 1): 1, ("null_coordinates", "rows", 1): 1, ("p95_below_p50", "rows", 1): 1,
        ("level_shortfall", "L1_DAY_TYPE", 5): 1, ("level_shortfall", "L2_TIME_PERIOD", 15): 1,
        ("level_shortfall", "L3_DAY_TYPE_TIME_PERIOD", 30): 1, ("level_shortfall", "L4_OVERALL", 0): 1,
        ("rollup_difference", "L1_DAY_TYPE", 0): 1, ("rollup_difference", "L2_TIME_PERIOD", 1): 1,
        ("rollup_difference", "L3_DAY_TYPE_TIME_PERIOD", 0): 1, ("rollup_difference", "L4_OVERALL", 0): 1,
    }
