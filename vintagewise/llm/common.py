"""What several operators share: word rules, folders every executor reaches, bounded slices of Arrow batches."""

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir

# Words are maximal runs of anything but these six characters, which is how bytes.split() cuts as well.
BLANK = r"[\x20\x09-\x0D]"
TEXT_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def words(text: str | Column) -> Column:
    """The words of a text; none for a null."""
    return F.array_remove(F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), f"{BLANK}+"), "")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that all executors reach."""
    return f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The store behind a path as Spark spells it, for use inside tasks."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b or b"" for b in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about `limit` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def hex_of(text: Column) -> Column:
    return F.sha2(text, 256)
