"""Raw monthly files: text in, one snapshot or all snapshots out."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.calendar import date_lit
from ..schemas import RAW_COLUMNS, text_schema


def read_raw(spark: SparkSession, path, source: str) -> DataFrame:
    """CSV with a header as text columns; a header that differs from the schema fails the read."""
    reader = spark.read.schema(text_schema(RAW_COLUMNS[source]))
    return reader.option("header", True).option("enforceSchema", False).csv(path)


def at_snapshot(df: DataFrame, snapshot, column: str = "snapshot_date") -> DataFrame:
    """Rows of one snapshot; both sides are compared as dates, so text and timestamps match too."""
    if df.schema[column].dataType.simpleString() == "date":
        return df.where(F.col(column) == date_lit(snapshot))
    return df.where(as_date(column) == date_lit(snapshot))


def as_date(column: str):
    """The date a text gives, null where it gives none."""
    return F.try_to_date(F.col(column).cast("string"))


def dated(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """The rows with a readable snapshot date, as a date ready to partition by. `undated` has the others."""
    return df.withColumn(column, as_date(column)).where(F.col(column).isNotNull())


def undated(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """The rows whose snapshot date is null or not a date, as they came."""
    return df.where(as_date(column).isNull())


def source_extent(df: DataFrame, source: str, column: str = "snapshot_date") -> DataFrame:
    """First and last snapshot of a source, with the column's type."""
    type_name = df.schema[column].dataType.simpleString()
    extent = df.agg(
        F.to_date(F.min(column)).alias("first_snapshot"), F.to_date(F.max(column)).alias("last_snapshot")
    )
    return extent.select(F.lit(source).alias("source"), "*", F.lit(type_name).alias("column_type"))
