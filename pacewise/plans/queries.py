"""Registered queries: one per operator or tight group, each over whole sample tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise import vocab
from pacewise.functions import display
from pacewise.functions.normalize import clock_digits, clock_text, hour_band, hour_of, minute_of, parse_date
from pacewise.operators import clean, conversion, export, levels, lookup, quality, remap, split, summary, weighted
from pacewise.operators.bounded import stored
from pacewise.operators.histogram import histogram
from pacewise.plans import adapters
from pacewise.schemas import FEATURE, GROUP_COLUMNS
from pacewise.sources import dimensions
from pacewise.sources.feed import FeedFilter, select_feed_files

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# Shared inputs


def event_clean(spark: SparkSession, folder: str) -> DataFrame:
    days = dimensions.calendar(adapters.event_calendar(spark, folder))
    return clean.build_clean(adapters.event_segments(spark, folder), days)


def event_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return histogram(event_clean(spark, folder))


def event_levels(spark: SparkSession, folder: str) -> DataFrame:
    rows = levels.level_input(event_histogram(spark, folder))
    return levels.expand_levels(rows.repartition("pair_id"))


def event_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summary.summarise(event_histogram(spark, folder))


def lane_result(spark: SparkSession, folder: str) -> DataFrame:
    return summary.summarise(histogram(adapters.lanes(spark, folder)))


def event_locations(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.location(adapters.event_location(spark, folder))


def lane_locations(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.location(adapters.lane_location(spark, folder))


# Raw feed


@_query
def split_parse(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_feed(adapters.event_feed(spark, folder))


@_query
def split_year_filter(spark: SparkSession, folder: str) -> DataFrame:
    wanted = FeedFilter.of("2024", "20240105", "2024-01-20")
    return split.split_feed(adapters.event_feed(spark, folder), wanted)


@_query
def split_metrics(spark: SparkSession, folder: str) -> DataFrame:
    wanted = FeedFilter.of(start="20240105")
    return split.split_metrics(adapters.event_feed(spark, folder), wanted)


@_query
def feed_file_selection(spark: SparkSession, folder: str) -> DataFrame:
    """Feed paths by event: odd names, nested folders, and weekends without hour folders."""
    ts, kind = F.col("ts"), F.col("event_type")
    day, hour = F.date_format(ts, "yyyyMMdd"), F.date_format(ts, "HH")
    stamp = F.date_format(ts, "yyyyMMdd_HHmm")
    name = (
        F.when(kind == "purchase", F.concat(F.lit("TDCS_M05A_"), stamp, F.lit(".csv")))
        .when(kind == "click", F.concat(F.lit("tdcs_m04a_"), stamp, F.lit(".CSV")))
        .otherwise(F.concat(F.lit("TDCS_M04A_"), stamp, F.lit(".csv")))
    )
    below = (
        F.when((kind == "error") | (F.weekday(ts) >= 5), F.concat_ws("/", day, name))
        .when(kind == "signup", F.concat_ws("/", day, day, hour, name))
        .otherwise(F.concat_ws("/", day, hour, name))
    )
    files = adapters.table(spark, folder, "events").select(below.alias("below"))
    files = files.withColumn("path", F.concat(F.lit("/feed/"), "below"))
    return select_feed_files(files, FeedFilter.of(2024, "20240103", "20240125"))


@_query
def known_pairs_semi(spark: SparkSession, folder: str) -> DataFrame:
    rows = adapters.lanes(spark, folder).select("pair_id", "record_date", "vehicle_type", "travel_time_sec", "volume")
    return split.only_known_pairs(rows, lane_locations(spark, folder))


@_query
def unknown_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return split.unknown_pairs(adapters.lanes(spark, folder), lane_locations(spark, folder))


@_query
def pair_reuse(spark: SparkSession, folder: str) -> DataFrame:
    return split.pair_reuse(adapters.lanes(spark, folder), lane_locations(spark, folder))


# Renamed segments

_EVENT_MAPPING = [
    (1, "click_0", "合併", "click_1"),
    (2, "click_1", "路段合併", "click_2"),
    (3, "view_2", "合併", "view_3"),
    (4, "view_1", "合併", "view_2"),
    (5, "error_5", "合併", "error_5"),
    (6, "signup_0", "停用", "signup_1"),
    (7, "purchase_0", "合併", "purchase_new"),
    (8, " click_9 ", "已合併", "view_9"),
    (9, "error_1", None, "error_2"),
]


@_query
def remap_pairs(spark: SparkSession, folder: str) -> DataFrame:
    mapping = spark.createDataFrame(_EVENT_MAPPING, "seq int, route string, note string, target_route string")
    rows = adapters.event_segments(spark, folder).select("event_id", "pair_id")
    return remap.remap(rows, remap.merge_rules(mapping))


@_query
def remap_kept_source(spark: SparkSession, folder: str) -> DataFrame:
    """Sources stay, so a row appears at every place a rule copied it to."""
    mapping = spark.createDataFrame(_EVENT_MAPPING, "seq int, route string, note string, target_route string")
    rows = adapters.event_segments(spark, folder).select("event_id", "pair_id")
    return remap.remap(rows, remap.merge_rules(mapping), keep_source=True)


@_query
def remap_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Nations pass their rows on by five, in chain order or, for odd remainders, against it."""
    key = F.col("n_nationkey")
    mapping = adapters.table(spark, folder, "nation").select(
        key.alias("key"),
        F.when(key % 5 % 2 == 0, key).otherwise(-key).alias("seq"),
        F.concat(F.lit("N"), key).alias("route"),
        F.lit(vocab.MERGE_NOTE).alias("note"),
        F.concat(F.lit("N"), key + 5).alias("target_route"),
    ).filter("key < 20").drop("key")
    sellers = adapters.table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    rows = (
        adapters.table(spark, folder, "lineitem")
        .select("l_suppkey", F.col("l_quantity").cast("long").alias("volume"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(F.concat(F.lit("N"), "s_nationkey").alias("pair_id"), "volume")
    )
    return (
        remap.remap(rows, remap.merge_rules(mapping))
        .groupBy("pair_id", "target_pair_id")
        .agg(F.count("*").alias("n_rows"), F.sum("volume").alias("volume"))
    )


def _coarse_split_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Split rows by buying nation, coarse enough to repeat; N8 has its name only from 1998 on."""
    orders = adapters.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    buyers = adapters.table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    items = adapters.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    ordered = F.col("o_orderdate")
    name = F.concat(F.lit("N"), "c_nationkey")
    return (
        items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.year(ordered).alias("year"),
            F.when((F.col("c_nationkey") == 8) & (F.year(ordered) < 1998), "N8old").otherwise(name).alias("pair_id"),
            F.date_format(ordered, "yyyy/M/'1'").alias("date"),
            F.lit("00:00").alias("time"),
            F.col("l_linenumber").cast("string").alias("vehicle_type"),
            F.floor(F.datediff("l_shipdate", "o_orderdate") / 1000).cast("string").alias("travel_time_sec"),
            F.floor(F.col("l_quantity") / 25).cast("string").alias("volume"),
        )
    )


@_query
def remap_dedup(spark: SparkSession, folder: str) -> DataFrame:
    pairs = [("N0", "N5"), ("N1", "N99"), ("N2", "N7"), ("N7", "N12"), ("N3", "N8")]
    mapping = spark.createDataFrame(
        [(i, a, "合併", b) for i, (a, b) in enumerate(pairs)],
        "seq int, route string, note string, target_route string",
    )
    return remap.merge_segments(_coarse_split_rows(spark, folder), remap.merge_rules(mapping))


# Conversion with whole-file rejection


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of one file per segment and day, with several kinds of damage.

    One segment has decimal travel times, purchases of zero volume lack the last cell, views have a
    header and signups of a weekend have it at the end.
    """
    ts, kind, volume = F.col("ts"), F.col("event_type"), adapters.event_volume()
    decimal = (kind == "error") & (F.col("user_id") % 10 == 3)
    travel_time = F.when(decimal, F.format_string("%.2f", "value")).otherwise(
        F.floor("value").cast("string")
    )
    last = F.when((kind == "purchase") & (volume == "0"), F.lit(None)).otherwise(volume)
    pair = adapters.event_pair()
    events = adapters.table(spark, folder, "events").select(
        pair.alias("pair_id"),
        F.concat(F.lit("/split/"), pair, F.lit("/"), F.date_format(ts, "yyyyMMdd"), F.lit(".csv")).alias("source_file"),
        F.lit(0).alias("block_start"),
        F.col("event_id").alias("row_id"),
        F.concat_ws(
            ",",
            F.date_format(ts, "yyyy/M/d"),
            F.date_format(ts, "HH:mm"),
            (F.col("user_id") % 5).cast("string"),
            travel_time,
            last,
        ).alias("line"),
        kind.alias("kind"),
        (F.weekday(ts) >= 5).alias("weekend"),
    )
    first, final = F.col("kind") == "view", (F.col("kind") == "signup") & F.col("weekend")
    heads = (
        events.filter(first | final)
        .groupBy("pair_id", "source_file", "kind")
        .agg((F.max("row_id") + 1).alias("after"))
        .select(
            "pair_id",
            "source_file",
            F.lit(0).alias("block_start"),
            F.when(F.col("kind") == "view", F.lit(-1)).otherwise(F.col("after")).alias("row_id"),
            F.lit("RecordDate,RecordTime,VehicleType,TravelTime,Volume").alias("line"),
        )
    )
    return events.drop("kind", "weekend").unionByName(heads)


def _files(lines: DataFrame) -> DataFrame:
    return lines.select("pair_id", "source_file").distinct()


@_query
def csv_header_reject(spark: SparkSession, folder: str) -> DataFrame:
    return conversion.file_verdicts(event_lines(spark, folder))


@_query
def converted_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = event_lines(spark, folder)
    return conversion.accepted_rows(lines, conversion.file_verdicts(lines))


@_query
def conversion_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Files left after the first half of the month was converted."""
    files = _files(event_lines(spark, folder))
    return conversion.planned_files(files, files.filter(F.col("source_file").rlike("202401(0[0-9]|1[0-5])")))


@_query
def conversion_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Files of the first half of the month are skipped, the others judged."""
    lines = event_lines(spark, folder)
    todo = lines.filter(~F.col("source_file").rlike("202401(0[0-9]|1[0-5])"))
    return conversion.conversion_metrics(_files(lines), conversion.file_verdicts(todo))


# Normalisation


def _choose(*texts: Column) -> Column:
    """Notation of a text by event number."""
    chosen = texts[0]
    for number, text in enumerate(texts[1:], start=1):
        chosen = F.when(F.col("event_id") % len(texts) == number, text).otherwise(chosen)
    return chosen


@_query
def norm_date(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    forms = ("yyyy/M/d", "yyyy/MM/dd", "yyyy-MM-dd", "yyyyMMdd", "yyyy-MM-dd'T'HH:mm", "yyyy/M/d HH:mm")
    text = _choose(*(F.date_format(ts, f) for f in forms), F.col("event_type"))
    return adapters.table(spark, folder, "events").select("event_id", parse_date(text).alias("record_date"))


@_query
def norm_time(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    forms = ("HH:mm", "HHmm", "H:mm", "HH:mm:ss", "H")
    text = _choose(*(F.date_format(ts, f) for f in forms), F.col("event_type"), F.lit(None).cast("string"))
    digits, hour, minute = F.col("digits"), F.col("clock_hour"), F.col("clock_minute")
    return (
        adapters.table(spark, folder, "events")
        .select("event_id", clock_digits(text).alias("digits"))
        .select("event_id", hour_of(digits).alias("clock_hour"), minute_of(digits).alias("clock_minute"))
        .withColumn("record_time_minute", clock_text(hour, minute))
    )


@_query
def hour_bands(spark: SparkSession, folder: str) -> DataFrame:
    """Bands of event hours; the hour past midnight is shifted beyond the last band."""
    hour = F.hour("ts")
    shifted = F.when(hour == 0, F.lit(24)).otherwise(hour)
    return (
        adapters.table(spark, folder, "events")
        .select(shifted.alias("hour"), hour_band(shifted).alias("time_period"))
        .groupBy("hour", "time_period")
        .agg(F.count("*").alias("n_rows"))
    )


# Clean table


@_query
def clean_filter(spark: SparkSession, folder: str) -> DataFrame:
    return clean.valid(clean.typed(adapters.event_segments(spark, folder)))


@_query
def exclude_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = clean.typed(adapters.event_segments(spark, folder))
    kept = clean.valid(rows, excluded=("click_3", "error_0", "view_7"))
    return kept.groupBy("pair_id").agg(F.count("*").alias("n_rows"), F.sum("volume").alias("volume"))


@_query
def exclude_ids_by_table(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of the lanes that have a location are excluded."""
    rows = adapters.lanes(spark, folder)
    kept = clean.exclude_pairs(rows, lane_locations(spark, folder))
    return kept.groupBy("pair_id").agg(F.count("*").alias("n_rows"), F.sum("volume").alias("volume"))


@_query
def calendar_dim(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.calendar(adapters.event_calendar_noisy(spark, folder))


@_query
def calendar_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.calendar_conflicts(adapters.event_calendar_noisy(spark, folder))


@_query
def clean_join(spark: SparkSession, folder: str) -> DataFrame:
    return event_clean(spark, folder)


@_query
def uncovered_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Ship dates on which nothing was ordered."""
    rows = adapters.table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("record_date"))
    ordered = adapters.table(spark, folder, "orders").select(
        F.to_date("o_orderdate").cast("string").alias("record_date"), F.lit("Weekday").alias("day_type")
    )
    return clean.uncovered_dates(rows, dimensions.calendar(ordered))


# Histogram and levels


@_query
def event_volume_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return event_histogram(spark, folder)


@_query
def lane_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return histogram(adapters.lanes(spark, folder))


@_query
def histogram_exclude_dates(spark: SparkSession, folder: str) -> DataFrame:
    return histogram(event_clean(spark, folder), ["2024-01-01", "2024-01-15"])


def _level(number: int) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = levels.level_input(histogram(adapters.lanes(spark, folder)))
        return levels.one_level(rows, vocab.LEVELS[number - 1])

    run.__name__ = f"level_l{number}"
    return run


for _number in (1, 2, 3, 4):
    _query(_level(_number))


@_query
def levels_union(spark: SparkSession, folder: str) -> DataFrame:
    return levels.union_levels(levels.level_input(histogram(adapters.lanes(spark, folder))))


@_query
def levels_grouping_sets(spark: SparkSession, folder: str) -> DataFrame:
    return levels.grouping_sets_levels(levels.level_input(histogram(adapters.lanes(spark, folder))))


@_query
def levels_expanded(spark: SparkSession, folder: str) -> DataFrame:
    rows = levels.level_input(histogram(adapters.lanes(spark, folder)))
    return levels.expand_levels(rows.repartition("pair_id"))


@_query
def sentinel_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Histogram rows whose band would be mistaken for the filler; late-night events are named so."""
    named = event_histogram(spark, folder).withColumn(
        "time_period", F.when(F.col("time_period") == "夜間", vocab.ALL).otherwise(F.col("time_period"))
    )
    return levels.sentinel_rows(levels.level_input(named))


# Percentiles and summary


@_query
def running_volume(spark: SparkSession, folder: str) -> DataFrame:
    return weighted.with_running_weight(event_levels(spark, folder), GROUP_COLUMNS, "travel_time_sec", "volume")


@_query
def total_volume(spark: SparkSession, folder: str) -> DataFrame:
    return weighted.with_total_weight(event_levels(spark, folder), GROUP_COLUMNS, "volume")


@_query
def weighted_p50_p95(spark: SparkSession, folder: str) -> DataFrame:
    return summary.level_percentiles(event_levels(spark, folder))


@_query
def buffer_index(spark: SparkSession, folder: str) -> DataFrame:
    return summary.with_buffer(summary.level_percentiles(event_levels(spark, folder)))


@_query
def grade(spark: SparkSession, folder: str) -> DataFrame:
    rows = summary.with_grade(summary.with_buffer(summary.level_percentiles(event_levels(spark, folder))))
    return rows.groupBy("summary_level", "reliability_level").agg(F.count("*").alias("n_rows"))


@_query
def reliability_summary(spark: SparkSession, folder: str) -> DataFrame:
    return event_summary(spark, folder)


@_query
def lane_summary(spark: SparkSession, folder: str) -> DataFrame:
    return lane_result(spark, folder)


@_query
def lane_summary_grouping_sets(spark: SparkSession, folder: str) -> DataFrame:
    return summary.summarise(histogram(adapters.lanes(spark, folder)), form="grouping_sets")


@_query
def lane_summary_union(spark: SparkSession, folder: str) -> DataFrame:
    return summary.summarise(histogram(adapters.lanes(spark, folder)), form="union")


@_query
def level_counts(spark: SparkSession, folder: str) -> DataFrame:
    return summary.level_counts(lane_result(spark, folder)).orderBy("summary_level")


@_query
def invalid_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    bad = summary.invalid_percentiles(lane_result(spark, folder))
    return bad.agg(F.count("*").alias("n_invalid"))


# Locations, exports, lookups


@_query
def location_dim(spark: SparkSession, folder: str) -> DataFrame:
    return event_locations(spark, folder)


@_query
def location_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Location rows listed once per user of a segment."""
    users = adapters.table(spark, folder, "events").select("user_id", adapters.event_pair().alias("user_pair")).distinct()
    listed = event_locations(spark, folder).join(users, F.col("pair_id") == F.col("user_pair"))
    return dimensions.location_duplicates(listed)


@_query
def location_missing(spark: SparkSession, folder: str) -> DataFrame:
    return export.missing_locations(lane_result(spark, folder), lane_locations(spark, folder))


@_query
def location_without_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    return export.without_coordinates(lane_result(spark, folder), lane_locations(spark, folder))


@_query
def map_join(spark: SparkSession, folder: str) -> DataFrame:
    return export.with_location(event_summary(spark, folder), event_locations(spark, folder))


@_query
def map_join_partial(spark: SparkSession, folder: str) -> DataFrame:
    """Lanes without a location or coordinate are absent."""
    located = export.with_location(lane_result(spark, folder), lane_locations(spark, folder))
    return located.groupBy("pair_id", "direction", "start_longitude", "end_latitude").agg(
        F.count("*").alias("n_rows")
    )


def _ends(geometry: Column) -> list[Column]:
    names = (("start_longitude", 0, 0), ("start_latitude", 0, 1), ("end_longitude", 1, 0), ("end_latitude", 1, 1))
    return [geometry["coordinates"][i][j].alias(name) for name, i, j in names]


@_query
def geojson_features(spark: SparkSession, folder: str) -> DataFrame:
    """Feature texts, read back from JSON field by field."""
    located = export.with_location(event_summary(spark, folder), event_locations(spark, folder))
    read = export.feature_lines(located).select(F.from_json("value", FEATURE).alias("f"))
    return read.select(
        F.col("f.type").alias("type"),
        F.col("f.geometry.type").alias("geometry_type"),
        *_ends(F.col("f.geometry")),
        "f.properties.*",
    )


@_query
def bi_export(spark: SparkSession, folder: str) -> DataFrame:
    return export.bi_sorted(lane_result(spark, folder))


@_query
def lookup_filter(spark: SparkSession, folder: str) -> DataFrame:
    locations = event_locations(spark, folder)
    features = export.features(export.with_location(event_summary(spark, folder), locations))
    filters = lookup.level_filters("L3_DAY_TYPE_TIME_PERIOD", "Weekday", "早尖峰", "North")
    served = lookup.lookup(features, filters, locations)
    return served.select("*", *_ends(F.col("geometry"))).drop("geometry")


@_query
def lookup_level_without_period(spark: SparkSession, folder: str) -> DataFrame:
    """A period given for a level without periods is asked for as the filler."""
    filters = lookup.level_filters("L1_DAY_TYPE", "Weekend", "早尖峰")
    return lookup.filter_rows(lane_result(spark, folder).withColumn("direction", F.lit("South")), filters)


@_query
def lookup_route_name(spark: SparkSession, folder: str) -> DataFrame:
    """Lanes with a location get its name, the others their own id."""
    pairs = adapters.lanes(spark, folder).groupBy("pair_id").agg(F.count("*").alias("n_rows"))
    return lookup.with_route_name(pairs, lane_locations(spark, folder))


@_query
def lookup_route_name_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """Segments whose name was written again with each event of an even user: the latest one counts."""
    events = adapters.table(spark, folder, "events").select("event_id", "user_id", adapters.event_pair().alias("pair_id"))
    name = F.concat(F.lit("Road "), (F.col("event_id") * 7 % 10).cast("string"))
    names = events.filter("user_id % 2 = 0").select(F.col("event_id").alias("seq"), "pair_id", name.alias("pair_roadname"))
    pairs = events.groupBy("pair_id").agg(F.count("*").alias("n_rows"))
    return lookup.with_route_name(pairs, names)


@_query
def duration_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = lane_result(spark, folder)
    return rows.select(
        *GROUP_COLUMNS,
        display.duration_text(F.col("p50_travel_time_sec")).alias("p50_text"),
        display.duration_text(F.col("p95_travel_time_sec")).alias("p95_text"),
        display.duration_text(F.col("buffer_time_sec")).alias("buffer_text"),
    )


@_query
def grade_colour(spark: SparkSession, folder: str) -> DataFrame:
    rows = event_summary(spark, folder)
    return rows.select(*GROUP_COLUMNS, display.grade_colour(F.col("reliability_level")).alias("colour"))


def _quality_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean events, their rows by level and their summary; the histogram behind both is built once, as a table."""
    observed = event_clean(spark, folder)
    condensed = stored(histogram(observed), "quality-histogram")
    by_level = levels.expand_levels(levels.level_input(condensed).repartition("pair_id"))
    return observed, by_level, stored(summary.summarise(condensed), "quality-summary")


@_query
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    """Checks over the events; the noisy calendar misses and contradicts some days."""
    observed, by_level, result = _quality_inputs(spark, folder)
    return quality.quality_report(
        clean.typed(adapters.event_segments(spark, folder)),
        adapters.event_calendar_noisy(spark, folder),
        observed,
        by_level,
        result,
        event_locations(spark, folder),
    )


@_query
def quality_report_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """The same checks over damaged data, so that each finds something.

    Cells of some events are lost or unreadable; purchases lack a level and errors a location, signups have a wrong percentile,
    views no coordinate, clicks two locations; volumes of three levels are wrong.
    """
    n = F.col("event_id")
    damaged = adapters.event_segments(spark, folder).withColumns(
        {
            "pair_id": F.when(n % 101 == 0, " ").when(n % 103 != 0, F.col("pair_id")),
            "RecordDate": F.when(n % 107 == 0, "someday").otherwise(F.col("RecordDate")),
            "VehicleType": F.when(n % 109 != 0, F.col("VehicleType")),
            "TravelTime": F.when(n % 113 == 0, "many").otherwise(F.col("TravelTime").cast("string")),
            "Volume": F.when(n % 127 != 0, F.col("Volume")),
        }
    )
    observed, by_level, result = _quality_inputs(spark, folder)
    kind, level = F.substring_index("pair_id", "_", 1), F.col("summary_level")
    doubled = F.when(level == "L1_DAY_TYPE", F.col("volume") * 2).when(level == "L4_OVERALL", F.col("volume") + 1).otherwise(F.col("volume"))
    wrong_levels = by_level.withColumn("volume", doubled).filter(~((level == "L2_TIME_PERIOD") & (kind == "click")))
    p95 = F.when(kind == "signup", F.lit(0)).otherwise(F.col("p95_travel_time_sec"))
    wrong_summary = result.withColumn("p95_travel_time_sec", p95).filter(~((level == "L4_OVERALL") & (kind == "purchase")))
    located = event_locations(spark, folder).filter(kind != "error")
    located = located.withColumn("start_longitude", F.when(kind != "view", F.col("start_longitude")))
    wrong_locations = located.unionByName(located.filter(kind == "click"))
    return quality.quality_report(
        clean.typed(damaged), adapters.event_calendar_noisy(spark, folder), observed, wrong_levels, wrong_summary, wrong_locations
    )
