"""Exact volume-weighted discrete percentiles."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacewise import vocab


def _group(keys: Sequence[str]):
    return Window.partitionBy(*keys)


def with_running_weight(
    rows: DataFrame, keys: Sequence[str], value: str, weight: str, name: str = "cumulative_volume"
) -> DataFrame:
    """Sum of weights from the smallest value of the group up to this row."""
    window = _group(keys).orderBy(F.col(value).asc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(name, F.sum(weight).over(window))


def with_total_weight(
    rows: DataFrame, keys: Sequence[str], weight: str, name: str = "total_volume"
) -> DataFrame:
    """Sum of weights of the whole group."""
    return rows.withColumn(name, F.sum(weight).over(_group(keys)))


def weighted_percentile_disc(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    fractions: Sequence[tuple[str, int, int]] = vocab.PERCENTILES,
) -> DataFrame:
    """Per group, the smallest value whose running weight reaches ``num/den`` of the total.

    A value may occur in several rows: the last of them carries the full running weight, so the
    result is the same as after summing them. Give histogram rows, not raw facts: a group is then
    no larger than its number of histogram cells, whatever its share of the facts, and its window
    stays small. The test ``running * den >= total * num`` is exact integer arithmetic, valid
    while ``total * den`` fits a long.
    """
    ranked = with_total_weight(with_running_weight(rows, keys, value, weight), keys, weight)
    reached = (
        F.min(F.when(F.col("cumulative_volume") * den >= F.col("total_volume") * num, F.col(value))).alias(name)
        for name, num, den in fractions
    )
    return ranked.groupBy(*keys).agg(*reached)
