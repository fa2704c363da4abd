"""Run history: latest run per key, pivots, top groups and cumulative shares."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from .ordering import running_counts


def latest_run(df: DataFrame, keys: Sequence[str], run: str = "inference_id") -> DataFrame:
    """The row with the highest run id per key; of rows that share it, one.

    The maximum of the id alone is combined before the shuffle and joined back, so no row is sorted for it and a key with
    many reruns does not gather them in one task.
    """
    newest = df.groupBy(*keys).agg(F.max(run).alias("_newest")).toDF(*[f"_{k}" for k in keys], "_newest")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col(run).eqNullSafe(F.col("_newest")))
    return df.join(newest, same, "left_semi").dropDuplicates(list(keys))


def run_number(run: str) -> Column:
    """A run id's digits as one number, which aggregates by hashing; an id without digits comes first.

    Ids of one form, such as times or counters, keep their order.
    """
    return F.coalesce(F.right(F.regexp_replace(run, r"\D", ""), F.lit(37)).try_cast("decimal(38, 0)"), F.lit(-1).cast("decimal(38, 0)"))


def newest_rows(df: DataFrame, keys: Sequence[str], run: str = "inference_id") -> DataFrame:
    """All rows of each key's newest run, by `run_number`. The maximum is combined before the shuffle; nothing is sorted
    for it, and a key with many reruns does not gather them in one task."""
    newest = df.groupBy(*keys).agg(F.max(run_number(run)).alias("_newest")).toDF(*[f"_{k}" for k in keys], "_newest")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], run_number(run) == F.col("_newest"))
    return df.join(newest, same, "left_semi")


def group_figures(df: DataFrame, key: str, value: str) -> DataFrame:
    """Group size and group maximum on every row, and whether the row holds the maximum."""
    figures = df.groupBy(key).agg(F.count("*").alias("size"), F.max(value).alias("_best"))
    joined = df.join(figures.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
    return joined.withColumn("keep", F.col(value) == F.col("_best")).drop("_best")


def cumulative_share(df: DataFrame, name: str, value: str) -> DataFrame:
    """Rows by falling value with their place and running share of the whole; ties go by name.

    The order is taken by ranges, so no task sees the whole table.
    """
    rows = df.where(F.col(value).isNotNull()).select(
        F.struct((-F.col(value)).alias("_v"), F.col(name).alias("_name")).alias("_order"))
    counts = rows.groupBy("_order").agg(F.count("*").alias("n"), (-F.sum("_order._v")).alias("amount"))
    ranked = running_counts(counts, "_order", ["n", "amount"])
    reached = F.col("amount_before") + F.col("amount")
    return ranked.select(
        F.col("_order._name").alias(name), (-F.col("_order._v")).alias(value),
        (F.col("n_before") + F.col("n")).alias("place"),
        (reached / F.col("amount_total")).alias("cumulative_share"),
    )


def pivot_months(df: DataFrame, row: str, month: str, value: str, months: Sequence) -> DataFrame:
    """One column per listed month. The months are given, so no extra job looks for them."""
    return df.groupBy(row).pivot(month, list(months)).agg(F.first(value, ignorenulls=True))


def pivot_days(df: DataFrame, row: str, day: str, value: str) -> DataFrame:
    """One row per group and month, with a column for each day of a month, d01 to d31, whatever days occur.

    The columns are fixed, so that no job looks for them, and results of all months have one schema.
    """
    cells = [F.max(F.when(F.dayofmonth(day) == d, F.col(value))).alias(f"d{d:02}") for d in range(1, 32)]
    return df.groupBy(row, F.trunc(day, "MM").alias("month")).agg(*cells)


def months_of(df: DataFrame, month: str) -> list:
    """Distinct months on the driver, for pivots: one value per future column."""
    return sorted(r[0] for r in df.select(month).distinct().collect() if r[0] is not None)


def top_groups(df: DataFrame, group: str, value: str, n: int) -> DataFrame:
    """All rows of the n groups with the largest maximum; ties go by name."""
    best = df.groupBy(group).agg(F.max(value).alias("_top")).orderBy(F.desc("_top"), group).limit(n)
    return df.join(best.select(group), group, "left_semi")


def history(*tables: DataFrame) -> DataFrame:
    """Runs written with different columns, as one table."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out

