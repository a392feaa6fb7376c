"""The physical plans the design relies on."""

import pytest
from pyspark.sql import functions as F

from pacewise.operators import clean, remap, summary
from pacewise.operators.histogram import histogram
from pacewise.plans import adapters, queries
from pacewise.sinks.tables import lay_out
from pacewise.sources import dimensions
from pacewise.sources.segments import read_segment_table
from tests.helpers import plan


@pytest.fixture(scope="module")
def segments(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans") / "A_B"
    spark.sql("SELECT '2026/6/14' RecordDate, '5' RecordTime, 31S VehicleType, 5 TravelTime, 2 Volume, 1 unused").write.parquet(str(root))
    return str(root.parent)


def test_filters_and_columns_reach_the_scan(spark, segments):
    text = plan(clean.valid(clean.typed(read_segment_table(spark, segments))))
    assert "GreaterThan(TravelTime,0)" in text and "GreaterThan(Volume,0)" in text
    assert "unused" not in text


def test_calendar_is_broadcast_and_facts_do_not_move(spark, segments):
    calendar = dimensions.calendar(spark.createDataFrame([("2026/6/14", "Weekday")], "record_date string, day_type string"))
    text = plan(clean.build_clean(read_segment_table(spark, segments), calendar))
    facts, _, _ = text.partition("BroadcastExchange")
    assert "BroadcastHashJoin" in text and "Exchange" not in facts


def test_summary_of_a_histogram_moves_it_once(spark, tables):
    table = queries.lane_histogram(spark, tables)
    whole = plan(summary.summarise(table))
    assert whole.count("Exchange hashpartitioning") == 2
    assert "Exchange hashpartitioning(pair_id" in whole and "REPARTITION_BY_COL" in whole
    assert plan(summary.summarise(table, "union")).count("Exchange hashpartitioning") > 2


def test_histogram_sums_before_its_shuffle(spark, tables):
    text = plan(histogram(adapters.lanes(spark, tables)))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text


def test_excluded_dates_are_compared_as_dates(spark, tmp_path):
    spark.sql("SELECT 'A' pair_id, DATE '2026-06-14' record_date, 'Weekday' day_type, '日間' time_period, 5 travel_time_sec, 2L volume").write.parquet(str(tmp_path / "c"))
    text = plan(histogram(spark.read.parquet(str(tmp_path / "c")), ["2026-07-01"]))
    assert "cast(record_date" not in text
    assert "PushedFilters" in text and "record_date" in text.split("PushedFilters")[1]


#: Queries that write small tables while they are built: the rounds of renamed segments, the histogram of a report.
WITH_ROUNDS = {"remap_pairs", "remap_kept_source", "remap_chain", "remap_dedup", "quality_report", "quality_report_dirty"}


def test_no_job_starts_while_a_query_is_built(spark, tables):
    """Apart from reading schemas, which Spark does in jobs of its own."""
    tracker = spark.sparkContext.statusTracker()
    assert WITH_ROUNDS <= set(queries.registry())
    for name, build in queries.registry().items():
        if name in WITH_ROUNDS:
            continue
        spark.sparkContext.setJobGroup(name, name)
        build(spark, tables)
        for job in tracker.getJobIdsForGroup(name):
            stages = [tracker.getStageInfo(s) for s in tracker.getJobInfo(job).stageIds]
            assert all(s is None or s.name.startswith("parquet at") for s in stages), (name, [s.name for s in stages])
    spark.sparkContext.setJobGroup("", "")


def test_split_counters_expand_nothing(spark, tables):
    assert "Expand" not in plan(queries.registry()["split_metrics"](spark, tables))


def test_unmapped_segments_are_not_shuffled(spark, tables):
    mapping = spark.createDataFrame([(0, "A", "合併", "B")], "seq int, route string, note string, target_route string")
    rows = spark.range(10).select(F.lit(2024).alias("year"), F.lit("A").alias("pair_id"), *(F.lit("1").alias(c) for c in
                                  ("date", "time", "vehicle_type", "travel_time_sec", "volume")))
    text = plan(remap.merge_segments(rows, remap.merge_rules(mapping)))
    first_branch = text.split("BroadcastExchange")[0]
    assert "Union" in first_branch and "Exchange" not in first_branch


def test_no_python_in_any_query(spark, tables):
    for name, build in queries.registry().items():
        text = plan(build(spark, tables))
        assert "Python" not in text and "InPandas" not in text, name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("cold")).otherwise("hot").alias("key"), F.uuid().alias("value"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "1m")
    try:
        lay_out(rows.repartition(8), ["key"], ["key", "value"]).write.partitionBy("key").parquet(str(tmp_path / "t"))
    finally:
        spark.conf.unset(size)
    assert len(list((tmp_path / "t/key=hot").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000
