"""Monthly catch-up: new raw files are taken up once, split by month, and the run ends."""

from pyspark.sql import DataFrame, SparkSession

from ..plans.backfill import write_bronze
from ..schemas import RAW_COLUMNS, text_schema


def ingest_available(spark: SparkSession, source: str, csv_folder: str, root: str) -> None:
    """Take up every file not seen before. The months in them replace those of the bronze table, as a batch does, so a
    month sent again, or a run repeated after a failure, counts once; files of one run that share a month add up."""

    def take_up(batch: DataFrame, _number: int) -> None:
        write_bronze(batch, source, root)

    files = (spark.readStream.schema(text_schema(RAW_COLUMNS[source]))
             .option("header", True).option("enforceSchema", False).csv(csv_folder))
    query = (files.writeStream.foreachBatch(take_up)
             .option("checkpointLocation", f"{root}/_ingest/{source}")
             .trigger(availableNow=True).start())
    query.awaitTermination()
