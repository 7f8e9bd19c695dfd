"""Small column helpers: dates, numbers, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dotted_date(text: Column) -> Column:
    """'2024.09.01' as a date; unknown or impossible dates give NULL."""
    return F.try_to_date(F.replace(text, F.lit("."), F.lit("-")), "yyyy-MM-dd")


def game_key(text: Column) -> Column:
    return text.try_cast("bigint")


def rating(text: Column) -> Column:
    """'1500' and '1500.0' both give 1500; anything that is no number gives NULL."""
    return text.try_cast("double").try_cast("int")


def int_div(value: Column, by: Column | int) -> Column:
    return F.call_function("div", value, by if isinstance(by, Column) else F.lit(by))


def chunk_name(start: Column, end: Column) -> Column:
    return F.format_string("games_%d_%d", start, end)


def drop_nan_text(text: Column) -> Column:
    """JSON writers that emit a bare NaN for a missing value decode to '"NaN"'."""
    return F.nullif(text, F.lit('"NaN"'))
