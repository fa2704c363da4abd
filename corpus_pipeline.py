"""The corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. Between stages the rows are written as Parquet and read
again. All but the last return the columns of documents.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from vintagewise.llm import bpe, minhash, mixing, quality, secrets
from vintagewise.session import stored

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the production policy of the rule ledger rejects."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of every group of near-duplicates, the document with the smallest id."""
    return minhash.deduplicated(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; n_chars follows."""
    return secrets.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that the sources' words meet their target weights."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode, as digests beside the ids."""
    path = public_tokenizers.path(TOKENIZER)
    ids = bpe.encode(docs.select("doc_id", "source", "text"), path, drop_text=True)
    return bpe.decode(ids, path).select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("mask_secrets", mask_secrets),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode),
]

# BPE merges and the secret automaton are beyond SQL; tests/llm holds the rows against a plain Python version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
