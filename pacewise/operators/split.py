"""Split raw feed rows into segment rows, with the filters and counters of that job."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pacewise import vocab
from pacewise.functions.normalize import feed_date_text, feed_time_text, pair_id, parse_feed_timestamp
from pacewise.schemas import FEED_COLUMNS, SPLIT_COLUMNS, require_columns
from pacewise.sources.feed import FeedFilter


def tag_feed(raw: DataFrame, wanted: FeedFilter = FeedFilter(), nulls: Sequence[str] = vocab.NULL_SPELLINGS) -> DataFrame:
    """Feed rows with parsed time, segment id and what keeps or drops them.

    Cells that spell a null (``nulls``) become null, so a gantry ``NA`` gives no segment.
    """
    require_columns(raw, FEED_COLUMNS, "feed")
    raw = raw.withColumns({c: F.when(~F.col(c).isin(*nulls), F.col(c)) for c in FEED_COLUMNS})
    ts = F.col("ts")
    return (
        raw.withColumn("ts", parse_feed_timestamp(F.col("datetime")))
        .withColumn("pair_id", pair_id(F.col("start_gantry"), F.col("end_gantry")))
        .withColumn("parsed", ts.isNotNull())
        .withColumn("in_range", F.coalesce(wanted.keeps(ts.cast("date")), F.lit(False)))
        .withColumn("kept", F.col("in_range") & F.col("pair_id").isNotNull())
    )


def observe_feed(raw: DataFrame, observation: Observation, wanted: FeedFilter = FeedFilter()) -> DataFrame:
    """Tagged feed rows (see ``tag_feed``); whatever action runs them also counts what will be dropped and why."""
    parsed, in_range, pair = F.col("parsed"), F.col("in_range"), F.col("pair_id")
    return tag_feed(raw, wanted).observe(
        observation,
        F.count("*").alias("rows_read"),
        F.count_if(~parsed).alias("rows_unparsed"),
        F.count_if(parsed & ~in_range).alias("rows_out_of_range"),
        F.count_if(in_range & pair.isNull()).alias("rows_without_pair"),
    )


def split_tagged(tagged: DataFrame) -> DataFrame:
    """``year, pair_id`` and the five split columns of the tagged rows that are kept."""
    ts = F.col("ts")
    return tagged.filter("kept").select(
        F.year(ts).alias("year"),
        "pair_id",
        feed_date_text(ts).alias("date"),
        feed_time_text(ts).alias("time"),
        *SPLIT_COLUMNS[2:],
    )


def split_feed(raw: DataFrame, wanted: FeedFilter = FeedFilter()) -> DataFrame:
    """``year, pair_id`` and the five split columns of the rows that parse, pass and have both ends."""
    return split_tagged(tag_feed(raw, wanted))


def only_known_pairs(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of segments that already exist."""
    return rows.join(known.select("pair_id").distinct(), "pair_id", "left_semi")


def unknown_pairs(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Segments that do not exist yet, with the number of rows skipped for each."""
    counts = rows.groupBy("pair_id").agg(F.count("*").alias("skipped_rows"))
    return counts.join(known.select("pair_id").distinct(), "pair_id", "left_anti")


def split_metrics(raw: DataFrame, wanted: FeedFilter = FeedFilter()) -> DataFrame:
    """One row of counters for a split job, in one pass.

    ``raw`` carries ``source_file``. A file is empty when none of its rows parse and pass the
    filter.
    """
    return summed_metrics(partial_metrics(raw, wanted))


def partial_metrics(raw: DataFrame, wanted: FeedFilter = FeedFilter()) -> DataFrame:
    """Row counters by file and by the (segment, year) that kept rows go to; small beside the rows."""
    kept = F.col("kept")
    return (
        tag_feed(raw, wanted)
        .groupBy("source_file", F.when(kept, F.col("pair_id")).alias("pair"), F.when(kept, F.year("ts")).alias("year"))
        .agg(
            F.count("*").alias("rows_read"),
            F.count_if(~F.col("parsed")).alias("rows_unparsed"),
            F.count_if(F.col("parsed") & ~F.col("in_range")).alias("rows_out_of_range"),
            F.count_if(F.col("in_range") & F.col("pair_id").isNull()).alias("rows_without_pair"),
            F.count_if("in_range").alias("rows_in_range"),
            F.count_if(kept).alias("rows_written"),
        )
    )


def summed_metrics(partial: DataFrame) -> DataFrame:
    """The counters of a job: sums by file, and the distinct segments and years, each from a small grouped result."""
    counters = ("rows_read", "rows_unparsed", "rows_out_of_range", "rows_without_pair", "rows_written")
    by_file = partial.groupBy("source_file").agg(F.sum("rows_in_range").alias("reached"), *(F.sum(c).alias(c) for c in counters))
    named = F.col("source_file").isNotNull()
    files = by_file.select(
        named.cast("long").alias("files"), (named & (F.col("reached") == 0)).cast("long").alias("empty_files"), *counters
    )
    by_pair = partial.where("pair is not null").select("pair", "year").distinct().groupBy("pair").agg(F.count("*").alias("pair_years"))
    pairs = by_pair.select(F.lit(1).cast("long").alias("pairs"), "pair_years")
    every = files.unionByName(pairs, allowMissingColumns=True)
    return every.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in every.columns))


def pair_reuse(rows: DataFrame, known: DataFrame, only_existing: bool = False) -> DataFrame:
    """``status, pairs, n_rows``: segments reused, and new ones either created or skipped."""
    per_pair = rows.groupBy("pair_id").agg(F.count("*").alias("n_rows"))
    marked = per_pair.join(
        known.select("pair_id").distinct().withColumn("seen", F.lit(True)), "pair_id", "left"
    )
    status = F.when(F.col("seen"), F.lit("reused")).otherwise(
        F.lit("skipped" if only_existing else "new")
    )
    return marked.groupBy(status.alias("status")).agg(
        F.count("*").alias("pairs"), F.sum("n_rows").alias("n_rows")
    )
