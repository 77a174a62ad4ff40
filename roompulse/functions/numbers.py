"""Counts written for people, and rates that round the same way everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The count spellings seen at ingestion are an optional decimal
# number followed by nothing, by w/W or by 万, both meaning ten thousand.
COUNT_PATTERN = r"^([0-9]+(?:\.[0-9]+)?)([wW万]?)$"
TEN_THOUSAND = 10_000


def try_parse_count(text: Column) -> Column:
    """``"1,234+"`` → 1234, ``"1.2w"`` and ``"1.2万"`` → 12000, anything else → null."""
    bare = F.trim(F.regexp_replace(text.cast("string"), r"[+,]", ""))
    number = F.nullif(F.regexp_extract(bare, COUNT_PATTERN, 1), F.lit(""))
    unit = F.regexp_extract(bare, COUNT_PATTERN, 2)
    factor = F.when(unit == "", F.lit(1)).otherwise(F.lit(TEN_THOUSAND))
    return F.floor(number.try_cast("decimal(24,6)") * factor).cast("bigint")


def parse_count(text: Column) -> Column:
    """As :func:`try_parse_count`, with 0 where nothing can be read."""
    return F.coalesce(try_parse_count(text), F.lit(0).cast("bigint"))


def whole_div(numerator: Column, denominator: Column) -> Column:
    """Integer quotient (operands must not be negative); null when dividing by zero."""
    zero = F.lit(0).cast("bigint")
    return F.call_function("div", numerator.cast("bigint"), F.nullif(denominator.cast("bigint"), zero))


def ratio(numerator: Column, denominator: Column, digits: int, factor: int = 1) -> Column:
    """``factor * numerator / denominator`` rounded half up to ``digits`` decimals.

    Worked in whole numbers, so ties never depend on how a double is stored.
    """
    scale = 10**digits
    top = numerator.cast("bigint") * F.lit(2 * factor * scale).cast("bigint") + denominator.cast("bigint")
    return whole_div(top, denominator.cast("bigint") * 2).cast("double") / F.lit(float(scale))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with one decimal; a total of zero counts as one."""
    return ratio(part, F.greatest(whole.cast("bigint"), F.lit(1).cast("bigint")), 1, 100)


def half_up(value: Column, digits: int = 0) -> Column:
    """Half-up rounding of a double, spelled out so that it is portable."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5).cast("double") / F.lit(scale)
