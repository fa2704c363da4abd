"""Near-duplicate groups by circulant MinHash.

A shingle's hash is scrambled once; coordinate k of the signature is the least value of a second fixed permutation
taken at the scrambled hash shifted round by k. Two permutations thus give all coordinates. The first of them are cut
into bands, and texts that share a band meet in a bucket; four bits of every coordinate tell which of these meetings can
be links at all. Links are then confirmed on the full shingle sets.

Texts with equal sets are one class, which its smallest id represents; only representatives are compared, so copies
never make pairs. In a bucket every member is first compared with one member. What this links is joined to components, and
only members that ended in a component other than the first member's are then compared with the rest of the bucket,
where set sizes and signatures allow a link. No bucket is cut, whatever its size, and no two members of different
components go uncompared.

With 32 bands of 4 a pair at similarity 0.75 shares no bucket with probability 5e-6, at 0.8 with 5e-8.

Defined results: a text without words, empty or null, has an empty set and is alone; repeated rows of one id are one
document and stay or go together; a null id takes no part, has no component and is kept; an empty table gives an empty
one; further columns are not looked at.
"""

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stored
from .common import slices, text_bytes
from .components import components
from .shingles import mix64, shared, shingle_sets

BANDS, ROWS = 32, 4
SHARED, OF = 75, 100  # a link: OF * intersection >= SHARED * union
SIZE = 1024  # coordinates
FEW = 256  # of them, looked at first
# Most coordinates whose four bits may differ, of the first and of all: at similarity 0.75 the means are 60 and 240, the
# deviations 6.8 and 13.6, so a link is passed over with probability 2e-8.
FEW_APART, ALL_APART = 98, 315
SIGNS = [f"sign_{i}" for i in range(FEW // 16)]
_CHUNK = 128


def _permute(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signature(hashes: np.ndarray, size: int) -> np.ndarray:
    """The `size` coordinates of a set of shingle hashes that is not empty."""
    first = (mix64(hashes ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(size, dtype=np.uint32)
    least = np.full(size, 0xFFFFFFFF, np.uint32)
    for at in range(0, first.size, _CHUNK):
        least = np.minimum(least, _permute(first[at:at + _CHUNK, None] + shifts).min(axis=0))
    return least


def band_keys(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit bucket key per band, the band's number included."""
    keys = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None], len(signatures), 0)
    cells = signatures.reshape(-1, bands, rows)
    for k in range(rows):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, k])
    return keys.view(np.int64)


SKETCH = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, signs array<bigint>"


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: set size, 128 bits that identify the set, the band keys, and four bits per coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows, full = batch.num_rows, []
            numbers = np.zeros((3, rows), np.int64)
            signatures = np.zeros((rows, SIZE), np.uint32)
            for i, hashes in enumerate(shingle_sets(text_bytes(batch.column("text")))):
                numbers[0, i] = hashes.size
                if hashes.size:
                    full.append(i)
                    numbers[1, i] = mix64(hashes).sum(dtype=np.uint64).view(np.int64)
                    numbers[2, i] = mix64(hashes + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64).view(np.int64)
                    signatures[i] = signature(hashes, SIZE)
            signatures = signatures[full]
            low = (signatures & 15).astype(np.uint8)
            signs = np.ascontiguousarray(low[:, 0::2] << 4 | low[:, 1::2]).view(np.int64)
            counts = np.zeros(rows, np.int32)
            counts[full] = 1
            lists = [pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(counts)]) * x.shape[1], pa.int32()), pa.array(x.ravel(), pa.int64()))
                for x in (band_keys(signatures[:, :BANDS * ROWS]), signs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x) for x in numbers], *lists],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands", "signs"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SKETCH)


def confirmed(pairs: DataFrame, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Those pairs (a, b) of ids whose full sets are similar enough."""
    texts = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("t"))
    left, right = texts.toDF("a", "text_a"), texts.toDF("b", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_b"):
            # rows come sorted by a, so its text often stays the same
            held, own = None, None
            hit = []
            sets = shingle_sets(text_bytes(batch.column("text_b")))
            for a, other in zip(text_bytes(batch.column("text_a")), sets, strict=True):
                if a != held:
                    held, own = a, next(shingle_sets([a]))
                both = shared(own, other)
                hit.append(both > 0 and OF * both >= SHARED * (own.size + other.size - both))
            kept = batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))
            if kept.num_rows:
                yield kept

    joined = pairs.join(right, "b").join(left, "a")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    sketch = stored(sketches(docs, doc_id, text), "sketch")
    alike = ["n_shingles", "set_a", "set_b"]
    named = sketch.where("doc_id is not null and n_shingles > 0")
    classes = stored(named.groupBy(*alike).agg(F.min("doc_id").alias("rep")), "classes")
    first = stored(sketch.join(classes, alike).where("doc_id = rep").select(
        "rep", "n_shingles", "bands", *[F.col("signs")[i].alias(c) for i, c in enumerate(SIGNS)],
        F.slice("signs", len(SIGNS) + 1, (SIZE - FEW) // 16).alias("more"),
    ).dropDuplicates(["rep"]), "representatives")

    buckets = first.select("rep", F.explode("bands").alias("key"))
    leads = stored(buckets.groupBy("key").agg(F.min("rep").alias("lead"), F.count("*").alias("n")).where("n > 1"), "leads")
    met = stored(buckets.join(leads, "key").where("rep <> lead").select("key", "rep", "lead", "n"), "met")
    x, y = _sided(first, "x"), _sided(first, "y")
    stars = met.select(F.col("lead").alias("x_rep"), F.col("rep").alias("y_rep")).distinct()
    stars = stars.join(y, "y_rep").join(x, "x_rep").where(_can_link()).select(F.col("x_rep").alias("a"), F.col("y_rep").alias("b"))
    links = stored(confirmed(stars, docs, doc_id, text), "stars")
    known = components(links)

    links = links.unionByName(confirmed(_apart(met, first, known), docs, doc_id, text))
    found = components(links)
    labels = classes.join(found, F.col("rep") == F.col("node"), "left").select(
        *alike, F.coalesce("component", "rep").alias("component"))
    joined = sketch.join(labels, alike, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _sided(first: DataFrame, side: str) -> DataFrame:
    return first.select(*[F.col(c).alias(f"{side}_{c}") for c in ("rep", "n_shingles", *SIGNS, "more", "bands")])


def _differing(a: Column, b: Column) -> Column:
    """How many of 16 coordinates differ."""
    bits = a.bitwiseXOR(b)
    bits = bits.bitwiseOR(F.shiftrightunsigned(bits, 2))
    bits = bits.bitwiseOR(F.shiftrightunsigned(bits, 1))
    return F.bit_count(bits.bitwiseAND(F.lit(0x1111111111111111)))


def _can_link(met: Column | None = None) -> Column:
    """Whether set sizes and signatures of sides x and y leave a link possible; `met` is asked between the two looks."""
    n = [F.col("x_n_shingles"), F.col("y_n_shingles")]
    few = reduce(add, [_differing(F.col(f"x_{c}"), F.col(f"y_{c}")) for c in SIGNS])
    rest = F.aggregate(F.zip_with("x_more", "y_more", _differing), F.lit(0), lambda total, x: total + x)
    first = (OF * F.least(*n) >= SHARED * F.greatest(*n)) & (few <= FEW_APART)
    return (first if met is None else first & met) & (few + rest <= ALL_APART)


def _apart(met: DataFrame, first: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs still to be compared: bucket mates, neither of them the lead, in different components.

    Buckets whose members all ended in the lead's component need none. Of the buckets two texts share, they are compared
    in one, that of the least key.
    """
    of = lambda column: known.select(F.col("node").alias(column), F.col("component").alias(f"{column}_in"))
    placed = met.where("n > 2").join(of("rep"), "rep", "left").join(of("lead"), "lead", "left").select(
        "key", "rep", F.coalesce("rep_in", "rep").alias("inside"), F.coalesce("lead_in", "lead").alias("lead_in"))
    open_keys = placed.groupBy("key").agg(F.min("inside").alias("lo"), F.max("inside").alias("hi")).where("lo <> hi")
    members = stored(placed.join(open_keys.select("key"), "key").withColumn("main", F.expr("inside = lead_in")), "open")
    x = members.where("not main").select("key", F.col("inside").alias("x_inside"), F.col("rep").alias("x_rep"))
    y = members.select("key", F.col("inside").alias("y_inside"), F.col("rep").alias("y_rep"), "main")
    pairs = x.join(_sided(first, "x"), "x_rep").join(y.join(_sided(first, "y"), "y_rep"), "key").where(
        (F.col("x_inside") != F.col("y_inside")) & (F.col("main") | (F.col("x_rep") < F.col("y_rep")))
        & _can_link(F.array_min(F.array_intersect("x_bands", "y_bands")) == F.col("key")))
    return pairs.select(F.least("x_rep", "y_rep").alias("a"), F.greatest("x_rep", "y_rep").alias("b")).distinct()


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, columns unchanged, of the document that stays of each group; rows with a null id stay."""
    gone = linked(docs, doc_id, text).where("not kept").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs[doc_id].cast("bigint") == gone["_gone"], "left_anti")
