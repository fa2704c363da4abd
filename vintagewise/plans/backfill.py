"""Layers written to disk: whole history or a month range, in one job per table."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas as S
from ..functions.calendar import date_lit
from ..session import ensure_checkpoint_dir
from ..operators.guards import require_empty, require_rows
from ..sources import raw, store
from . import gold, silver

CLEANERS = {
    "loans": silver.loans,
    "financials": silver.financials,
    "attributes": silver.attributes,
    "clickstream": silver.clickstream,
}


def write_bronze(rows: DataFrame, source: str, root: str) -> None:
    """Raw text rows as CSV by month; rows without a readable month are kept apart, by source, and do not end the job."""
    undated = raw.undated(rows)
    if not undated.isEmpty():
        undated.write.mode("append").option("header", True).csv(f"{root}/bronze_violations/{source}")
    store.write_months(raw.dated(rows), f"{root}/bronze/{source}", fmt="csv")


def build_bronze(spark: SparkSession, source: str, csv_path, root: str, snapshot=None) -> None:
    """Split a raw file by month as CSV text: every month in one scan, or one snapshot."""
    rows = raw.read_raw(spark, csv_path, source)
    if snapshot is not None:
        rows = require_rows(raw.at_snapshot(rows, snapshot), f"no rows in {source} for {snapshot}")
    write_bronze(rows, source, root)


def read_bronze(spark: SparkSession, source: str, root: str) -> DataFrame:
    columns = S.RAW_COLUMNS[source]
    rows = store.read_csv_table(spark, f"{root}/bronze/{source}", S.text_schema(columns))
    return rows.select(*columns)


def _months(rows: DataFrame, first, last) -> DataFrame:
    return rows if first is None else store.between_months(raw.dated(rows), first, last)


def build_silver(spark: SparkSession, source: str, root: str, first=None, last=None) -> None:
    """Clean one source; every month of the range must have rows, or the whole table some."""
    rows = _months(read_bronze(spark, source, root), first, last)
    if first is None:
        require_rows(rows, f"no {source} rows")
    else:
        require_empty(store.missing_months(rows, store.month_spine(spark, first, last)), f"{source} has no rows in months")
    store.write_months(CLEANERS[source](rows), f"{root}/silver/{source}")


def build_labels(spark: SparkSession, root: str, first=None, last=None, dpd: int = S.LABEL_DPD,
                 mob: int = S.LABEL_MOB) -> None:
    loans = _months(store.read_table(spark, f"{root}/silver/loans"), first, last)
    store.write_months(gold.label_store(loans, dpd, mob), f"{root}/gold/label_store")


def build_features(spark: SparkSession, root: str, first=None, last=None) -> None:
    """Feature rows of the loans started in the range; clicks are read from the months before it too, so that the
    first months have their windows, and every cutoff's window must be complete."""
    tables = {name: store.read_table(spark, f"{root}/silver/{name}") for name in CLEANERS}
    loans = _months(tables["loans"], first, last).where("mob = 0")
    for name in ("financials", "attributes", "clickstream"):
        have = tables[name].select("snapshot_date").distinct()
        gaps = loans.select("snapshot_date").distinct().join(have, "snapshot_date", "left_anti")
        require_empty(gaps, f"{name} misses months that have new loans")
    clicks = tables["clickstream"]
    if first is not None:
        clicks = clicks.where(F.col("snapshot_date").between(
            F.add_months(date_lit(first), 1 - S.CLICK_WINDOW_MONTHS), date_lit(last)))
    windows = gold.window_completeness(clicks).where("not complete")
    needed = windows.join(loans.select("snapshot_date").distinct(),
                          windows["cutoff"] == loans["snapshot_date"], "left_semi")
    require_empty(needed, "incomplete click windows")
    features = gold.feature_store(loans, _months(tables["financials"], first, last),
                                  _months(tables["attributes"], first, last), clicks)
    store.write_months(features, f"{root}/gold/feature_store")


def click_round_trip(clicks: DataFrame, first, last) -> DataFrame:
    """Clicks through both file layers in the shared folder: CSV by month, then typed Parquet, then a range."""
    spark = clicks.sparkSession
    root = f"{ensure_checkpoint_dir(spark)}/round-trip-{uuid.uuid4().hex}"
    store.write_months(clicks, f"{root}/bronze/clickstream", fmt="csv")
    build_silver(spark, "clickstream", root)
    return store.read_months(spark, f"{root}/silver/clickstream", first, last)
