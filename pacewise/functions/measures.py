"""Buffer time, buffer index, grade and minute conversion."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pacewise import vocab


def buffer_time(p50: Column, p95: Column) -> Column:
    return p95 - p50


def buffer_index(p50: Column, p95: Column) -> Column:
    """``(p95 - p50) / p50`` as a double; null unless p50 is positive."""
    return F.when(p50 > 0, buffer_time(p50, p95).cast("double") / p50.cast("double"))


def grade(
    index: Column,
    grades: Sequence[tuple[str, float]] = vocab.GRADES,
    top: str = vocab.TOP_GRADE,
) -> Column:
    """First grade whose upper bound exceeds the index; null stays null."""
    chain = F.when(index.isNull(), F.lit(None).cast("string"))
    for label, bound in grades:
        chain = chain.when(index < F.lit(bound), F.lit(label))
    return chain.otherwise(F.lit(top))


def minutes(seconds: Column) -> Column:
    return F.round(seconds / F.lit(60.0), 2)
