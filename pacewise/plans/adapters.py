"""The sample tables in the shape of the data model.

*Events* plays the observations of a segment: type and user give the segment, the property ``k``
the volume. *Lanes* plays shipments between nations: order to ship date gives the duration, the
quantity the volume, the order priority the time band. All rows of the tables are used.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise import vocab
from pacewise.functions.normalize import pair_id
from pacewise.operators.clean import positive_measures


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _event_end() -> Column:
    return F.col("user_id") % 10


def event_pair() -> Column:
    return pair_id(F.col("event_type"), _event_end().cast("string"))


def event_volume() -> Column:
    return F.get_json_object("props", "$.k")


def event_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Raw feed: six texts and the file they would lie in.

    A volume of zero comes with an unreadable time and a volume of one without an end gantry, so
    that both kinds of bad row occur.
    """
    ts, volume = F.col("ts"), event_volume()
    readable = F.date_format(ts, "yyyy/MM/dd HH:mm")
    return table(spark, folder, "events").select(
        F.when(volume == "0", F.date_format(ts, "yyyy/MM/dd")).otherwise(readable).alias("datetime"),
        F.col("event_type").alias("start_gantry"),
        F.when(volume != "1", _event_end().cast("string")).alias("end_gantry"),
        (F.col("user_id") % 5).cast("string").alias("vehicle_type"),
        F.floor("value").cast("string").alias("travel_time_sec"),
        volume.alias("volume"),
        F.date_format(ts, "yyyyMMdd/HH").alias("source_file"),
    )


def event_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segment rows with dates in four and times in three notations."""
    ts, n = F.col("ts"), F.col("event_id")
    date_text = (
        F.when(n % 4 == 0, F.date_format(ts, "yyyy/M/d"))
        .when(n % 4 == 1, F.date_format(ts, "yyyy/MM/dd"))
        .when(n % 4 == 2, F.date_format(ts, "yyyy-MM-dd"))
        .otherwise(F.date_format(ts, "yyyyMMdd"))
    )
    time_text = (
        F.when(n % 3 == 0, F.date_format(ts, "HH:mm"))
        .when(n % 3 == 1, F.date_format(ts, "HHmm"))
        .otherwise(F.date_format(ts, "H:mm"))
    )
    return table(spark, folder, "events").select(
        "event_id",
        event_pair().alias("pair_id"),
        date_text.alias("RecordDate"),
        time_text.alias("RecordTime"),
        (F.col("user_id") % 5).cast("smallint").alias("VehicleType"),
        F.floor("value").cast("int").alias("TravelTime"),
        event_volume().cast("int").alias("Volume"),
    )


def _day_type(day: Column) -> Column:
    return F.when(F.weekday(day) >= 5, "Weekend").otherwise("Weekday")


def event_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Raw calendar: one text date per day that has events."""
    days = table(spark, folder, "events").select(F.to_date("ts").alias("day")).distinct()
    return days.select(F.date_format("day", "yyyy/M/d").alias("record_date"), _day_type(F.col("day")).alias("day_type"))


def event_calendar_noisy(spark: SparkSession, folder: str) -> DataFrame:
    """Raw calendar with repeats, conflicts and gaps.

    Signups call their day a weekend, errors a holiday, and Sundays are holidays to all.
    """
    day = F.to_date("ts")
    kind = (
        F.when((F.col("event_type") == "error") | (F.weekday(day) == 6), "Holiday")
        .when(F.col("event_type") == "signup", "Weekend")
        .otherwise(_day_type(day))
    )
    return table(spark, folder, "events").select(day.cast("string").alias("record_date"), kind.alias("day_type"))


def _raw_location(pairs: DataFrame, start: Column, end: Column) -> DataFrame:
    """Location rows from two small numbers of the segment."""
    return pairs.select(
        F.concat(F.lit(" "), "pair_id").alias("pair_id"),
        F.concat(F.lit("Road "), "pair_id").alias("pair_roadname"),
        F.concat(F.lit("G"), start.cast("string")).alias("start_gantry_id"),
        F.concat(F.lit("Start "), start.cast("string"), F.lit(" ")).alias("start_roadname"),
        F.lit(None).cast("string").alias("start_link_id"),
        (F.lit(120.0) + start * 0.25).cast("string").alias("start_longitude"),
        (F.lit(22.0) + start * 0.125).cast("string").alias("start_latitude"),
        F.concat(F.lit("G"), end.cast("string")).alias("end_gantry_id"),
        F.concat(F.lit("End "), end.cast("string")).alias("end_roadname"),
        F.lit(None).cast("string").alias("end_link_id"),
        (F.lit(120.0) + end * 0.25).cast("string").alias("end_longitude"),
        (F.lit(22.0) + end * 0.125).cast("string").alias("end_latitude"),
        (start + end).cast("string").alias("distance_km"),
        F.when(start > end, "North").otherwise("South").alias("direction"),
    )


def event_location(spark: SparkSession, folder: str) -> DataFrame:
    """Raw location: one row per event segment."""
    pairs = table(spark, folder, "events").select(
        event_pair().alias("pair_id"), F.length("event_type").alias("start"), _event_end().alias("end")
    )
    return _raw_location(pairs.distinct(), F.col("start"), F.col("end"))


def lanes(spark: SparkSession, folder: str) -> DataFrame:
    """Clean observations of all line items whose lane, dates and quantity are valid."""
    return lane_rows(spark, folder).filter(
        F.col("pair_id").isNotNull() & F.col("time_period").isNotNull() & positive_measures()
    )


def lane_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Observations of all line items, not yet filtered."""
    bands = [name for name, _, _ in vocab.TIME_BANDS]
    priority = F.left("o_orderpriority", F.lit(1))
    period = F.lit(None).cast("string")
    for number, band in enumerate(bands, start=1):
        period = F.when(priority == str(number), band).otherwise(period)
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    buyers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    sellers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    day = F.to_date("o_orderdate")
    return (
        items.join(orders, items.l_orderkey == orders.o_orderkey)
        .join(buyers, F.col("o_custkey") == buyers.c_custkey)
        .join(sellers, F.col("l_suppkey") == sellers.s_suppkey)
        .select(
            F.concat(F.lit("N"), "s_nationkey", F.lit("_N"), "c_nationkey").alias("pair_id"),
            day.alias("record_date"),
            _day_type(day).alias("day_type"),
            period.alias("time_period"),
            F.col("l_linenumber").cast("string").alias("vehicle_type"),
            F.datediff("l_shipdate", "o_orderdate").alias("travel_time_sec"),
            F.col("l_quantity").cast("long").alias("volume"),
        )
    )


def lane_location(spark: SparkSession, folder: str) -> DataFrame:
    """Raw location of the lanes that stay inside one region.

    Those of the first region have no known end, as in a list that is still being filled.
    """
    nations = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    sellers = nations.withColumnRenamed("n_nationkey", "start")
    buyers = nations.withColumnRenamed("n_nationkey", "end_key")
    pairs = sellers.join(buyers, "n_regionkey").select(
        F.concat(F.lit("N"), "start", F.lit("_N"), "end_key").alias("pair_id"),
        "start",
        F.when(F.col("n_regionkey") > 0, F.col("end_key")).alias("end"),
    )
    return _raw_location(pairs, F.col("start"), F.col("end"))
