"""Data contracts as small violation tables."""

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F


class ContractError(ValueError):
    """A guard found violations."""


def require_empty(violations: DataFrame, message: str, examples: int = 5) -> None:
    """Fail with a few example rows unless the violation table is empty."""
    found = violations.limit(examples).collect()
    if found:
        shown = "; ".join(", ".join(f"{k}={v}" for k, v in row.asDict().items()) for row in found)
        raise ContractError(f"{message}: {shown}")


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ContractError(message)
    return df


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on more than one row: a join on them would fan out. Counts are combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated or null keys with their row counts."""
    has_null = reduce(or_, [F.col(k).isNull() for k in keys])
    counted = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return counted.where((F.col("n_rows") > 1) | has_null)


def require_unique(df: DataFrame, keys: Sequence[str], name: str) -> None:
    require_empty(key_violations(df, keys), f"{name} has repeated or null keys")
