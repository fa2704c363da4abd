"""Value-level cleaning rules, each from Column to Column, all null-safe and safe under ANSI mode."""

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from .calendar import col

_INT_MIN, _INT_MAX = -2147483648, 2147483647


def to_double(c) -> Column:
    """Number or null; text that is no number becomes null."""
    return col(c).try_cast("double")


def to_int(c) -> Column:
    """Whole number by truncation ('3.0' -> 3); anything else, or out of range, becomes null."""
    number = to_double(c)
    return F.when(number.between(_INT_MIN, _INT_MAX), number).cast("int")


def cast_to(c, type_name: str) -> Column:
    """Lenient cast used by `enforce_types`."""
    if type_name == "int":
        return to_int(c)
    return col(c).try_cast(type_name)


def enforce_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns in a single projection; the others keep their type."""
    wanted = {}
    for field in df.schema.fields:
        target = types.get(field.name)
        if target is None or field.dataType.simpleString() == target:
            wanted[field.name] = F.col(field.name)
        elif target == "int" and field.dataType.simpleString() in ("tinyint", "smallint"):
            wanted[field.name] = F.col(field.name).cast("int")
        else:
            wanted[field.name] = cast_to(field.name, target)
    return df.select([expr.alias(name) for name, expr in wanted.items()])


def keep_between(c, low=None, high=None) -> Column:
    """Null outside [low, high]; either bound may be left open."""
    value = col(c)
    tests = [value >= low] if low is not None else []
    if high is not None:
        tests.append(value <= high)
    return F.when(reduce(and_, tests), value) if tests else value


def null_sentinels(c, *sentinels: str) -> Column:
    value = col(c)
    return F.when(~value.isin(*sentinels), value)


def keep_listed(c, *allowed: str) -> Column:
    value = col(c)
    return F.when(value.isin(*allowed), value)


def keep_matching(c, pattern: str) -> Column:
    value = col(c)
    return F.when(value.rlike(pattern), value)


def strip_all(c, text: str = "_") -> Column:
    """Every occurrence removed."""
    return F.replace(col(c), F.lit(text), F.lit(""))


def strip_edges(c, text: str = "_") -> Column:
    """Blanks, then leading and trailing runs of `text`, removed."""
    return F.btrim(F.trim(col(c)), F.lit(text))


def leading_digits(c, width: int = 2) -> Column:
    """First `width` digits once everything that is no digit is dropped."""
    digits = F.regexp_replace(col(c), "[^0-9]", "")
    return F.left(digits, F.lit(width)).try_cast("int")


def years_part(c) -> Column:
    return F.regexp_extract(col(c), r"(\d+) Years", 1).try_cast("int")


def months_part(c) -> Column:
    return F.regexp_extract(col(c), r"and (\d+) Months", 1).try_cast("int")


def duration_months(c) -> Column:
    """'X Years and Y Months' in months; null when either part is missing."""
    return years_part(c) * 12 + months_part(c)


def null_default(c, default) -> Column:
    return F.coalesce(col(c), F.lit(default))


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(columns))


def clip(c, low, high) -> Column:
    """Into [low, high]; null stays null."""
    value = col(c)
    return F.when(value.isNotNull(), F.least(F.greatest(value, col(low)), col(high)))


def finite(c) -> Column:
    """NaN and infinities become null."""
    value = col(c)
    infinite = F.lit(float("inf"))
    return F.when(~F.isnan(value) & (value != infinite) & (value != -infinite), value)


def no_nan(c) -> Column:
    value = col(c)
    return F.when(~F.isnan(value), value)


def valid_score(c) -> Column:
    """A probability, or null."""
    return keep_between(no_nan(to_double(c)), 0.0, 1.0)


def valid_label(c) -> Column:
    """0 or 1, or null."""
    number = no_nan(to_double(c))
    return F.when(number.isin(0.0, 1.0), number).cast("int")
