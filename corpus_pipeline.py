"""The corpus pipeline: quality, near copies, benchmark passages, personal data, packing.

Each stage works on whole tables of all that the stage before kept; all but the last return the columns of documents. Stages set the
session's number of rows of an Arrow batch.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pacewise.llm import decontamination, packing, personal_data, quality, shingle_join
from pacewise.llm.common import small_batches, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_small_batches(stage: Stage) -> Stage:
    """The stage in a session with small Arrow batches."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    run.__doc__ = stage.__doc__
    return run


@_in_small_batches
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.5 or more; the model learns from all labelled documents of its input."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


@_in_small_batches
def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of smallest id, of each group that shingle similarity of 0.75 or more links."""
    return shingle_join.one_of_each(docs, width=5, percent=75)


@_in_small_batches
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with all passages of the benchmark cut out; one that consists of nothing else goes."""
    return decontamination.cleaned(docs, table(spark, sf_dir, "benchmark"))


@_in_small_batches
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return personal_data.redacted(docs, personal_data.fit(docs))


@_in_small_batches
def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 ids along a space-filling curve."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), length=4096, end_id=2)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", into_sequences),
]

#: SQL can express none of the trained stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
