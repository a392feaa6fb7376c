"""Texts and colours shown next to a summary row."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pacewise import vocab


def duration_text(seconds: Column) -> Column:
    """``M 分 S 秒`` after rounding half up to seconds, without a zero part; ``—`` for no number."""
    number = seconds.cast("double")
    total = F.floor(number + F.lit(0.5))
    whole = F.floor(total / F.lit(60))
    rest = total - whole * 60
    return (
        F.when(number.isNull() | F.isnan(number), F.lit("—"))
        .when(whole == 0, F.concat(rest.cast("string"), F.lit(" 秒")))
        .when(rest == 0, F.concat(whole.cast("string"), F.lit(" 分")))
        .otherwise(F.concat(whole.cast("string"), F.lit(" 分 "), rest.cast("string"), F.lit(" 秒")))
    )


def grade_colour(
    level: Column,
    colours: Sequence[tuple[str, str]] = vocab.GRADE_COLOURS,
    other: str = vocab.OTHER_COLOUR,
) -> Column:
    label, colour = colours[0]
    chain = F.when(level == label, F.lit(colour))
    for label, colour in colours[1:]:
        chain = chain.when(level == label, F.lit(colour))
    return chain.otherwise(F.lit(other))
