"""Session defaults and the shared checkpoint folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Small sides are broadcast on purpose only below this many rows; see `operators.joins.small_side`.
BROADCAST_ROW_LIMIT = 20_000


def build_session(app_name: str = "vintagewise", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution, UTC dates and skew handling on.

    Sizes that depend on the cluster (shuffle partitions, split size) are left to the caller:
    pass them as keyword arguments with dots replaced by double underscores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # a chain of joins on one key still splits a hot key, at the price of a further shuffle when it occurs
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # wide cleaning projections: a generated method beyond this size is never compiled by the JVM, so such a
        # stage runs faster operator by operator
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    settings.update({name.replace("__", "."): str(value) for name, value in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the session's own setting, or a scratch folder in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="vintagewise-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor, unlike a cached block."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back.

    For results that several later steps read: they are computed once, later plans start at a plain scan
    that still prunes columns, and a lost executor costs a re-read only.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
