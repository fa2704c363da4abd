"""Column profiles, shares, rates and histograms, as tables."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.clean import no_nan
from .joins import one_value, small_side


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    number = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [f.name for f in df.schema.fields
            if f.name not in exclude and (f.dataType.simpleString() in number
                                          or f.dataType.simpleString().startswith("decimal"))]


def other_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    numeric = set(numeric_columns(df))
    return [c for c in df.columns if c not in exclude and c not in numeric]


def prefixed_columns(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def long_numbers(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per kept key, feature and value; NaN counts as missing."""
    wide = df.select(*keep, *[no_nan(F.col(c).cast("double")).alias(c) for c in columns])
    return wide.unpivot(list(keep), list(columns), "feature", "value")


def long_texts(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    wide = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in columns])
    return wide.unpivot(list(keep), list(columns), "feature", "value")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column in one pass, one row."""
    columns = df.columns if columns is None else columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and percentage, one row per column."""
    columns = df.columns if columns is None else list(columns)
    counted = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    flat = counted.unpivot(["_rows"], columns, "column_name", "null_count")
    return flat.select("column_name", "null_count", (100 * F.col("null_count") / F.col("_rows")).alias("null_pct"))


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min and max, one row per column, in one pass."""
    return long_numbers(df, columns).groupBy("feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("stddev"),
        F.min("value").alias("low"), F.max("value").alias("high"),
    )


def moments(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample variance and deviation and missing rate per feature of a long table."""
    return long.groupBy(*by, "feature").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.var_samp("value").alias("var"),
        F.stddev_samp("value").alias("std"),
        F.avg(F.col("value").isNull().cast("int")).alias("missing_rate"),
    )


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows"))


def shares(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Count and share of each value inside its group."""
    counts = frequencies(df, [*by, value])
    if by:
        # null groups are groups too
        totals = counts.groupBy(*by).agg(F.sum("n_rows").alias("_rows")).toDF(*[f"_{c}" for c in by], "_rows")
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
        counts = counts.join(totals, same).drop(*[f"_{c}" for c in by])
    else:
        counts = counts.withColumn("_rows", one_value(counts, F.sum("n_rows")))
    return counts.withColumn("share", F.col("n_rows") / F.col("_rows")).drop("_rows")


def top_and_rest(df: DataFrame, value: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """The k most frequent values and their shares, with the share of all others.

    Ties go by name. The rank filter reaches the shuffle, so each task forwards k rows per group at most.
    """
    order = Window.partitionBy(*by).orderBy(F.desc("n_rows"), F.asc(value))
    ranked = shares(df, value, by).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    whole = Window.partitionBy(*by)
    rest = F.greatest(F.lit(0.0), 1.0 - F.sum("share").over(whole))
    return ranked.withColumn("rest_share", rest)


def rate_by(df: DataFrame, flag: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows and mean flag per group."""
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), F.avg(flag).alias("rate"))


def in_order(report: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Exactly the listed names, in their order; a name without data keeps null figures."""
    listed = F.posexplode(F.array(*[F.lit(name) for name in names])).alias("place", column)
    order = report.sparkSession.range(1).select(listed)
    return order.join(report, column, "left").orderBy("place")


def month_null_rate(df: DataFrame, column: str, month: str = "snapshot_date") -> DataFrame:
    return df.groupBy(month).agg(
        F.count("*").alias("n_rows"), F.avg(F.col(column).isNull().cast("int")).alias("null_rate")
    )


def moments_of_counts(counts: DataFrame, by: Sequence[str] = (), groups: int | None = None) -> DataFrame:
    """`moments` from a table of rows (by, feature, value, n), missing values included.

    Deviations are taken from the mean, which a first pass over the counts finds; equal values have none. `groups` bounds
    the number of (by, feature) combinations.
    """
    keys = [*by, "feature"]
    known = F.when(F.col("value").isNotNull(), F.col("n"))
    first = counts.groupBy(*keys).agg(
        F.coalesce(F.sum(known), F.lit(0)).alias("_n"),
        F.when(F.min("value") == F.max("value"), F.min("value")).otherwise(F.sum(F.col("value") * F.col("n")) / F.sum(known)).alias("_mean"),
        (F.sum("n") - F.coalesce(F.sum(known), F.lit(0))).alias("_missing"), F.sum("n").alias("_rows"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in keys])
    named = first.select(*[F.col(c).alias(f"_key_{c}") for c in keys], "_n", "_mean", "_missing", "_rows")
    away = F.col("value") - F.col("_mean")
    out = counts.join(small_side(named, groups), same).groupBy(*keys).agg(
        F.max("_n").alias("n"), F.max("_mean").alias("mean"), F.sum(away * away * F.col("n")).alias("_squares"),
        (F.max("_missing") / F.max("_rows")).alias("missing_rate"))
    out = out.withColumn("var", F.when(F.col("n") > 1, F.col("_squares") / (F.col("n") - 1)))
    return out.select(*keys, "n", "mean", "var", F.sqrt("var").alias("std"), "missing_rate")


def equal_width_histogram(long: DataFrame, bins: int, features: int | None = None) -> DataFrame:
    """Counts in `bins` equal steps between each feature's extremes; the maximum falls in the last step."""
    present = long.where(F.col("value").isNotNull())
    extremes = present.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    placed = present.join(small_side(extremes, features), "feature")
    step = F.when(F.col("hi") > F.col("lo"),
                  F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins))
    bin_no = F.least(F.coalesce(step, F.lit(0)), F.lit(bins - 1)).cast("int")
    counted = placed.groupBy("feature", bin_no.alias("bin")).agg(F.count("*").alias("n_rows"))
    grid = extremes.select("feature", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counted, ["feature", "bin"], "left").select(
        "feature", "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )
