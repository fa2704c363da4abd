"""Time windows, customer-grouped folds and split statistics."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.calendar import window_split
from ..schemas import OOT_MONTHS, SPLIT_SEED, TRAIN_MONTHS, TRAIN_RATIO
from .guards import require_empty


def time_split(df: DataFrame, train_date, train_months: int = TRAIN_MONTHS, oot_months: int = OOT_MONTHS,
               label_date: str = "snapshot_date") -> DataFrame:
    """Rows inside the two label windows, with their name in `split`."""
    named = df.withColumn("split", window_split(label_date, train_date, train_months, oot_months))
    return named.where(F.col("split").isNotNull())


def split_stats(df: DataFrame, label: str = "label", by: Sequence[str] = ("split",)) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.avg(label).alias("bad_rate"),
        (F.count_if(F.col(label) == 0) > 0).alias("has_good"), (F.count_if(F.col(label) == 1) > 0).alias("has_bad"))


def require_two_classes(df: DataFrame, splits: Sequence[str] = ("train_test", "oot")) -> None:
    """Fail on an empty or single-class window."""
    expected = df.sparkSession.createDataFrame([(s,) for s in splits], "split string")
    seen = expected.join(split_stats(df), "split", "left")
    whole = F.coalesce(F.col("has_good") & F.col("has_bad"), F.lit(False))
    require_empty(seen.where(~whole).select("split", "n_rows"), "empty or single-class window")


def group_folds(df: DataFrame, group: str, label: str, folds: int, seed: int = SPLIT_SEED,
                name: str = "fold") -> DataFrame:
    """Fold number per row: a group is never divided, and groups with and without a bad label are dealt
    evenly over the folds in hash order.

    The deal needs the place of each group in its class. The leading bits of the hash cut the order into
    ranges of equal size, so places are counted inside a range and shifted by the totals below it.
    """
    hashed = F.xxhash64(F.col(group), F.lit(seed))
    groups = df.groupBy(group).agg(F.max(label).alias("_class"))
    ranged = groups.select(group, "_class", hashed.alias("_hash"), F.shiftright(hashed, 53).alias("_range"))
    inside = Window.partitionBy("_class", "_range").orderBy("_hash", group)
    placed = ranged.withColumn("_place", F.row_number().over(inside))
    below = Window.partitionBy("_class").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_class", "_range").agg(F.count("*").alias("_n"))
    shifts = sizes.select("_class", "_range", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_shift"))
    dealt = placed.join(shifts, ["_class", "_range"]).select(
        group, ((F.col("_shift") + F.col("_place") - 1) % folds).cast("int").alias(name))
    # rows without a group are a group of their own, never dropped
    return df.join(dealt.withColumnRenamed(group, "_group"), F.col(group).eqNullSafe(F.col("_group"))).drop("_group")


def train_test_split(df: DataFrame, group: str = "Customer_ID", label: str = "label", ratio: float = TRAIN_RATIO,
                     seed: int = SPLIT_SEED) -> DataFrame:
    """The train/test window divided by customer: fold 0 of round(1 / (1 - ratio)) is the test part."""
    folds = max(2, round(1 / (1 - ratio)))
    window = group_folds(df.where(F.col("split") == "train_test"), group, label, folds, seed, "_fold")
    parted = window.withColumn("split", F.when(F.col("_fold") == 0, "test").otherwise("train")).drop("_fold")
    return parted.unionByName(df.where(F.col("split") == "oot"))
