"""Histories from saved monitoring runs: the newest run of every model and month, chosen from partition values.

The tables are those of `monitoring.save_monitoring`, partitioned by model, run and month. Which runs exist is read from
the partition values alone; the rows are then read from the chosen partitions only.
"""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.history import run_number

RUN_KEYS = ("model_name", "inference_id")
# runs (models x months) up to which the newest ones are listed in a filter
LISTED_RUNS = 5_000

def saved_runs(spark: SparkSession, path: str, month: str = "snapshot_date") -> DataFrame:
    """The runs a table holds: (model_name, inference_id, month). No column is read from the files."""
    return spark.read.parquet(path).select(*RUN_KEYS, month).distinct()


def newest_runs(spark: SparkSession, path: str, month: str = "snapshot_date") -> DataFrame:
    """The newest run of each model and month. Of ids with the same number the one that sorts last counts."""
    best = F.max(F.struct(run_number("inference_id").alias("number"), "inference_id")).alias("_best")
    return saved_runs(spark, path, month).groupBy("model_name", month).agg(best).select(
        "model_name", month, F.col("_best.inference_id").alias("inference_id"))


def read_newest(spark: SparkSession, path: str, month: str = "snapshot_date") -> DataFrame:
    """All rows of the newest runs. Other runs' files are not opened.

    The list of runs is counted first, from partition values. A short one becomes a filter on the partition columns, which
    prunes when the scan is planned; a long one is joined.
    """
    chosen = newest_runs(spark, path, month)
    rows = spark.read.parquet(path)
    place = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (*RUN_KEYS, month)])
    if chosen.count() > LISTED_RUNS:
        same = reduce(and_, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*RUN_KEYS, month)])
        return rows.alias("l").join(chosen.alias("r"), same, "left_semi")
    return rows.where(place.isin([r.place for r in chosen.select(place.alias("place")).collect()]))


def auc_history(spark: SparkSession, root: str, registry: DataFrame) -> DataFrame:
    """(model_name, snapshot_date, auc, auc_oot): of each month the newest run that has an AUC, beside the model's
    out-of-time one. A model of the registry that was never measured has one row with its out-of-time AUC alone."""
    metrics = spark.read.parquet(f"{root}/metrics").where(F.col("auc").isNotNull() & ~F.isnan("auc"))
    best = F.max(F.struct(run_number("inference_id").alias("number"), "inference_id", "auc")).alias("_best")
    observed = metrics.groupBy("model_name", "snapshot_date").agg(best).select("model_name", "snapshot_date", F.col("_best.auc").alias("auc"))
    return registry.select("model_name", "auc_oot").join(observed, "model_name", "left").select(
        "model_name", "snapshot_date", "auc", "auc_oot")


def psi_history(spark: SparkSession, root: str) -> DataFrame:
    """Score PSI against the reference and the month before, and the largest feature PSI, of the newest runs."""
    return read_newest(spark, f"{root}/metrics").select(
        "model_name", "snapshot_date", "inference_id", "score_psi", "score_psi_vs_prev_month", "max_feature_psi")


def top_feature_psi(spark: SparkSession, root: str, n: int, keep: Sequence[str] = ("psi",)) -> DataFrame:
    """The newest covariate rows of each model's n features with the largest PSI of any month; ties go by name."""
    rows = read_newest(spark, f"{root}/covariates")
    best = rows.groupBy("model_name", "feature").agg(F.max("psi").alias("_top"))
    place = F.expr("row_number() over (partition by model_name order by _top desc, feature)")
    chosen = best.withColumn("_place", place).where(F.col("_place") <= n).select("model_name", "feature")
    return rows.join(chosen, ["model_name", "feature"], "left_semi").select("model_name", "feature", "snapshot_date", *keep)
