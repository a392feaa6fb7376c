"""Closed vocabularies and formats.

Fixed values: the tables below are data that results are compared on, so they are stated
plainly. Every function that uses one takes it as a parameter with this default.
"""

# Day types and the filler used for a dimension that a level leaves out.
DAY_TYPES = ("Weekday", "Weekend")
ALL = "ALL"

# Hour bands (label, first hour, last hour), both ends inclusive.
TIME_BANDS = (
    ("凌晨", 0, 5),
    ("早尖峰", 6, 8),
    ("日間", 9, 15),
    ("晚尖峰", 16, 18),
    ("夜間", 19, 23),
)
UNCLASSIFIED = "未分類"

# Reliability grades (label, exclusive upper bound of the buffer index).
GRADES = (("穩定", 0.25), ("普通", 0.50), ("不穩定", 1.00))
TOP_GRADE = "高風險"

# Summary levels (name, keeps day type, keeps time period).
LEVELS = (
    ("L1_DAY_TYPE", True, False),
    ("L2_TIME_PERIOD", False, True),
    ("L3_DAY_TYPE_TIME_PERIOD", True, True),
    ("L4_OVERALL", False, False),
)

# Percentiles as exact fractions (numerator, denominator).
PERCENTILES = (("p50_travel_time_sec", 1, 2), ("p95_travel_time_sec", 19, 20))

# Service-area segments left out of the clean table.
EXCLUDED_PAIR_IDS = (
    "01F0532S_01F0532N",
    "01F0557N_01F0557S",
    "03F0698S_03F0698N",
    "03F0746S_03F0746N",
    "03F0783N_03F0783S",
    "03F1710S_03F1710N",
    "03F1739N_03F1739S",
    "03F2306S_03F2306N",
    "03F2336N_03F2336S",
    "03F2747S_03F2747N",
    "03F2777N_03F2777S",
    "03F3187S_03F3187N",
    "03F3211N_03F3211S",
)

# Fixed value: dates left out of the histogram unless the caller names others.
EXCLUDED_DATES = ("2026-07-01",)

# Fixed value: text that marks a mapping row as a merge.
MERGE_NOTE = "合併"

# Words that identify a header row in a segment file.
HEADER_WORDS = (
    "date",
    "time",
    "recorddate",
    "record_date",
    "recordtime",
    "record_time",
    "vehicletype",
    "vehicle_type",
    "travel_time",
    "traveltime",
    "volume",
    "traffic_volume",
    "trafficvolume",
)

# Spellings read as null in a segment file (the Apache Arrow CSV defaults).
NULL_SPELLINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)

# Grade colours of the map and the colour of anything else.
GRADE_COLOURS = (
    ("穩定", "#22C55E"),
    ("普通", "#F59E0B"),
    ("不穩定", "#F97316"),
    ("高風險", "#EF4444"),
)
OTHER_COLOUR = "#94A3B8"

# Names and formats of files and documents.
FEED_FILE_PREFIX = "tdcs_m04a_"
FEED_FILE_SUFFIX = ".csv"
COLLECTION_NAME = "tdcs_reliability_map"
VEHICLE_GROUP = "ALL"
