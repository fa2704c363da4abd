"""Every row beside the next one in descending order of a key, without sorting all rows in one task."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

_PLACES = [StructField("_bucket", IntegerType()), StructField("_tail", IntegerType())]


def key_cuts(df: DataFrame, key: str, buckets: int) -> list[int]:
    """Ascending keys, the greatest last, that cut the rows into about `buckets` equal parts: the borders of a range
    partitioning of the keys alone. None if there are no keys."""
    keys = df.select(key).where(F.col(key).isNotNull()).repartitionByRange(buckets, key)
    found = keys.groupBy(F.spark_partition_id().alias("part")).agg(F.max(key).alias("cut")).collect()
    return sorted({row.cut for row in found})


def lined_up(df: DataFrame, key: str, cuts: list[int], tie: str) -> DataFrame:
    """The rows in buckets, sorted: `_bucket`, then descending key, then `tie`.

    Bucket b holds the keys above cut b - 1 up to cut b, so a cut is the first key of its bucket in descending order.
    Rows with that key also stand, with `_tail` 1, behind the last row of the bucket of greater keys, and those with
    the greatest key behind the last row of all: a reader always finds the next row in its own bucket. Null keys come
    after all others; if there are no others, the first of them follows the last.
    """
    borders = np.array(cuts, np.int64)
    schema = StructType([*df.schema.fields, *_PLACES])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(key)
            known = keys.is_valid().to_numpy(zero_copy_only=False)
            values = keys.fill_null(borders[0] if borders.size else 0).to_numpy()
            bucket = np.where(known, np.searchsorted(borders, values), 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bucket), pa.array(np.zeros(bucket.size, np.int32))], names)
            first = known & (borders[np.minimum(bucket, borders.size - 1)] == values) if borders.size else ~known
            if first.any():
                again = batch.filter(pa.array(first))
                behind = (bucket[first] + 1) % max(borders.size, 1)
                yield pa.RecordBatch.from_arrays(
                    [*again.columns, pa.array(behind.astype(np.int32)), pa.array(np.ones(behind.size, np.int32))], names)

    placed = df.mapInArrow(run, schema)
    dealt = placed.repartition(max(len(cuts), 1), "_bucket")
    return dealt.sortWithinPartitions(F.col("_bucket"), F.col("_tail"), F.desc_nulls_last(key), F.col(tie))
