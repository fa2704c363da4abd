"""Tables partitioned by month: write, read a range, list and check months."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.calendar import date_lit, full_months, month_start


def write_partitions(df: DataFrame, path: str, *keys: str, fmt: str = "parquet") -> None:
    """Replace exactly the partitions present in `df`; a rerun gives the same table.

    The rebalance hint gathers each partition into few files and lets AQE split one that is large.
    """
    writer = df.hint("rebalance", *keys).write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*keys).save(path)


def write_months(df: DataFrame, path: str, *extra_keys: str, month: str = "snapshot_date",
                 fmt: str = "parquet") -> None:
    """Replace the months (and extra keys) present in `df`."""
    write_partitions(df, path, *extra_keys, month, fmt=fmt)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All months of a table."""
    return spark.read.parquet(path)


def read_csv_table(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def between_months(df: DataFrame, first, last, month: str = "snapshot_date") -> DataFrame:
    """Months in [first, last]; prunes partitions when `month` is the partition column."""
    return df.where(F.col(month).between(date_lit(first), date_lit(last)))


def read_months(spark: SparkSession, path: str, first, last, month: str = "snapshot_date") -> DataFrame:
    """A month range that must be complete."""
    from ..operators.guards import require_empty

    df = between_months(read_table(spark, path), first, last, month)
    require_empty(missing_months(df, month_spine(spark, first, last), month), f"missing months in {path}")
    return df


def month_spine(spark: SparkSession, first, last, name: str = "snapshot_date") -> DataFrame:
    """First-of-month dates from the month of `first` up to `last`."""
    months = F.sequence(month_start(date_lit(first)), date_lit(last), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias(name))


def own_spine(df: DataFrame, month: str = "snapshot_date") -> DataFrame:
    """Every month between the first and the last one of a table."""
    extent = df.agg(F.min(month).alias("lo"), F.max(month).alias("hi"))
    months = F.sequence(month_start("lo"), F.col("hi").cast("date"), F.expr("interval 1 month"))
    return extent.select(F.explode(months).alias(month))


def union_months(*spines: DataFrame) -> DataFrame:
    out = spines[0]
    for spine in spines[1:]:
        out = out.union(spine)
    return out.distinct()


def month_counts(df: DataFrame, spine: DataFrame, month: str = "snapshot_date") -> DataFrame:
    """Rows per month of the spine, 0 where there is none."""
    counts = df.groupBy(month_start(month).alias(month)).agg(F.count("*").alias("n_rows"))
    return spine.join(counts, month, "left").fillna(0, subset=["n_rows"])


def empty_months(df: DataFrame, spine: DataFrame, month: str = "snapshot_date") -> DataFrame:
    return month_counts(df, spine, month).where("n_rows = 0").select(month)


def missing_months(df: DataFrame, spine: DataFrame, month: str = "snapshot_date") -> DataFrame:
    """Months of the spine with no row at all."""
    present = df.select(month_start(month).alias(month)).distinct()
    return spine.join(present, month, "left_anti")


def latest_month(df: DataFrame, cutoff, month: str = "snapshot_date") -> DataFrame:
    """Latest month on or before the cutoff, how stale it is in months, and whether it is stale."""
    at = date_lit(cutoff)
    found = df.where(F.col(month) <= at).agg(F.max(month).alias("latest"))
    return found.select(
        at.alias("cutoff"), "latest", full_months(at, "latest").alias("months_behind"),
        F.coalesce(F.col("latest") < at, F.lit(True)).alias("is_stale"),
    )
