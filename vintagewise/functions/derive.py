"""Feature arithmetic: ratios, bands, groups, list counts and vector summaries."""

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from .calendar import col


def ratio(numerator, denominator, places: int = 4) -> Column:
    """Null unless the denominator is positive."""
    below = col(denominator)
    return F.round(F.when(below > 0, col(numerator) / below), places)


def residual(total, *parts, places: int = 2) -> Column:
    return F.round(reduce(lambda left, part: left - col(part), parts, col(total)), places)


def band(c, cuts: Sequence[tuple[float, str]], top: str) -> Column:
    """Label of the first cut the value is below; `top` beyond the last; null stays null."""
    value = col(c)
    chain = F
    for limit, name in cuts:
        chain = chain.when(value < limit, name)
    return chain.when(value.isNotNull(), top)


def grouped(c, groups: Mapping[str, Sequence[str]], default: str) -> Column:
    """Name of the group that lists the value; `default` for unlisted and null values."""
    value = col(c)
    chain = F
    for name, members in groups.items():
        chain = chain.when(value.isin(*members), name)
    return chain.otherwise(default)


def positive_flag(c) -> Column:
    return F.when(col(c) > 0, 1).otherwise(0)


def distinct_items(c, none_text: str = "No Loan") -> Column:
    """Number of different names in a list like 'a, b, and c'; 0 for `none_text`, null for null."""
    names = F.split(F.trim(col(c)), r"\s*,(?:\s*and\s)?\s*")
    return F.when(col(c) == none_text, 0).otherwise(F.array_size(F.array_distinct(F.array_remove(names, ""))))


def row_mean(columns: Sequence[str], places: int = 2) -> Column:
    """Mean across columns; null if any of them is."""
    return F.round(reduce(add, [F.col(c) for c in columns]) / len(columns), places)


def row_norm(columns: Sequence[str], places: int = 2) -> Column:
    """Euclidean length across columns; null if any of them is."""
    return F.round(F.sqrt(reduce(add, [F.col(c) * F.col(c) for c in columns])), places)


def loan_customer(loan_id) -> Column:
    """Customer id carried inside a loan id, or null."""
    found = F.regexp_extract(col(loan_id), r"(CUS_0x[0-9a-f]+)", 1)
    return F.when(found != "", found)


def loan_date(loan_id) -> Column:
    """Date suffix of a loan id, or null."""
    found = F.regexp_extract(col(loan_id), r"(\d{4}_\d{2}_\d{2})$", 1)
    return F.to_date(F.when(found != "", found), "yyyy_MM_dd")


def run_id(path) -> Column:
    """Run id at the end of a '<kind>_YYYY_MM_DD_<run>.<ext>' path."""
    return F.regexp_extract(col(path), r"_\d{4}_\d{2}_\d{2}_([^/]+?)(?:\.[A-Za-z]+)?$", 1)


def gini_of(auc) -> Column:
    return 2 * col(auc) - 1
