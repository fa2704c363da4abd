"""Ranked lexical search over bit-sliced Bloom signatures.

Index. Each document sets bits for (term, level) pairs, a level standing for a least number of occurrences. Documents of
similar size share a block and a signature width; a block keeps one row of document bits per signature position.
Search. A term's possible documents are the conjunction of its rows, so presence is overestimated and never missed. The
weights of an item's terms, summed over the rows of each level, times the gain of that level at the document's length,
bound its score from above. The documents with the highest bounds are scored exactly first; their lowest score then
rules out whatever is bounded below it, and all other documents are scored exactly from their whole texts.

Terms are the runs of ASCII letters, digits and non-ASCII characters, with only A-Z in lower case. A document counts if
it has a term.

Defined results: null, empty and blank texts have no terms and are never found; an item without terms, a null item and an
empty table give no rows; repeated rows are documents of their own; rows of one item with equal score and id are
ranked in any order, as they are alike; only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from ..session import stored
from .common import slices, text_bytes

LEVELS = (1, 2, 3, 5, 9, 17, 33, 65)  # occurrences; a document between two levels may have one less than the next
HASHES = 5
BITS = 12  # signature positions per entry of the largest document of a class
SLICE_BYTES = 8 << 20
ITEMS = 2_000  # items that are searched together: bounds what is broadcast
TOGETHER = 128  # items whose weights form one matrix in a task

_OTHER = bytes(b for b in range(128) if not chr(b).isalnum())
TERM = bytes.maketrans(_OTHER + bytes(range(65, 91)), b" " * len(_OTHER) + bytes(range(97, 123)))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def measure(length, documents: int, total: int):
    """What a document's length adds to its counts; for one number or an array."""
    return 75 + 25 * length * documents // total


def gain(count, m):
    return 1_000_000_000 * count // (1000 * count + 12 * m)


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ keys >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ keys >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return keys ^ keys >> np.uint64(31)


def positions(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """The signature positions of terms at a level, one row per term."""
    mixed = _mixed(hashes + np.uint64((level * 0x9E3779B97F4A7C15) % 2**64))
    first, step = mixed & np.uint64(0xFFFFFFFF), mixed >> np.uint64(32) | np.uint64(1)
    return ((first[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(width)).astype(np.int64)


def _hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _blocks(texts: Sequence[bytes]) -> Iterator[tuple]:
    """(width, places of the documents, their lengths, rows of bits, terms, documents per term) of a slice of texts."""
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    runs = [np.fromiter(map(number.__getitem__, found), np.int64, len(found)) for found in map(terms, texts)]
    lengths = np.array([r.size for r in runs], np.int64)
    if not lengths.any():
        return
    words, count = list(number), len(number)
    hashes = _hashes(words)
    keys, times = np.unique(np.repeat(np.arange(len(texts)), lengths) * count + np.concatenate(runs), return_counts=True)
    doc, term = np.divmod(keys, count)
    entries = np.zeros(len(texts), np.int64)
    for least in LEVELS:
        entries += np.bincount(doc[times >= least], minlength=len(texts))
    # a class holds documents of up to 2^class entries
    size_class = np.ceil(np.log2(np.maximum(entries, 8))).astype(np.int64)
    for c in np.unique(size_class[lengths > 0]).tolist():
        inside = np.flatnonzero((size_class == c) & (lengths > 0))
        column = np.full(len(texts), -1, np.int64)
        column[inside] = np.arange(inside.size)
        width = BITS << c
        bits = np.zeros((width, inside.size), bool)
        for level, least in enumerate(LEVELS):
            held = (times >= least) & (column[doc] >= 0)
            at = positions(hashes[term[held]], level, width)
            bits[at, column[doc[held]][:, None]] = True
        mine = column[doc] >= 0
        documents = np.bincount(term[mine], minlength=count)
        seen = np.flatnonzero(documents)
        yield width, inside, lengths[inside], np.packbits(bits, axis=1), [words[i] for i in seen.tolist()], documents[seen]


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of the index: (width, keys, lengths, rows, terms, documents), stored in the shared folder.

    `rows` holds `width` rows of document bits, a multiple of eight; `documents` says how many of the block's documents
    hold each of `terms`.
    """
    schema = StructType([
        StructField("width", LongType()), StructField("keys", ArrayType(docs.schema[key].dataType)),
        StructField("lengths", ArrayType(LongType())), StructField("rows", BinaryType()),
        StructField("terms", ArrayType(StringType())), StructField("documents", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SLICE_BYTES):
            ids = batch.column(key)
            for width, inside, lengths, rows, words, documents in _blocks(text_bytes(batch.column(text))):
                of = ids.take(pa.array(inside))
                yield pa.RecordBatch.from_arrays([
                    pa.array([width], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(of)], pa.int32()), of),
                    pa.array([lengths], pa.list_(pa.int64())), pa.array([rows.tobytes()], pa.binary()),
                    pa.array([words], pa.list_(pa.binary())).cast(pa.list_(pa.string())), pa.array([documents], pa.list_(pa.int64())),
                ], schema.names)

    return stored(docs.select(key, text).mapInArrow(run, schema), "bit_slices")


class _Item:
    """A part of an item list as arrays: its terms' weights as one matrix, so that a block is weighed by products."""

    def __init__(self, items: Sequence[tuple[int, list[bytes]]], weights: dict[bytes, int]):
        self.numbers = [n for n, _ in items]
        index: dict[bytes, int] = {}
        for _, found in items:
            for t in found:
                index.setdefault(t, len(index))
        self.hashes = _hashes(list(index))
        # sums of whole numbers below 2^53 are exact in doubles
        self.matrix = np.zeros((len(items), len(index)))
        for i, (_, found) in enumerate(items):
            for t, n in Counter(found).items():
                self.matrix[i, index[t]] = n * weights[t]

    def bounds(self, width: int, rows: np.ndarray, lengths: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores of a block's documents, one row per item."""
        out = np.zeros((len(self.numbers), lengths.size), np.int64)
        alive, held, reached = np.arange(self.hashes.size), None, np.zeros(lengths.size, np.int64)
        for level in range(len(LEVELS)):
            most = np.minimum(LEVELS[level + 1] - 1, lengths) if level + 1 < len(LEVELS) else lengths
            most = np.maximum(most, LEVELS[level])
            found = np.bitwise_and.reduce(rows[positions(self.hashes[alive], level, width)], axis=1)
            held = found if held is None else held & found
            some = held.any(axis=1)
            alive, held = alive[some], held[some]
            if not alive.size:
                break
            present = np.unpackbits(held, axis=1, count=lengths.size).astype(np.float64)
            worth = gain(most, m)
            out += (self.matrix[:, alive] @ present).astype(np.int64) * (worth - reached)
            reached = worth
        return out


def search(docs: DataFrame, items: DataFrame, top: int = 20, key: str = "doc_id", text: str = "text",
           item: str = "item_id", item_text: str = "text", index: DataFrame | None = None) -> DataFrame:
    """The `top` documents of every item: (item, rank, key, score), the highest first, equal scores by ascending key."""
    index = build_index(docs, key, text) if index is None else index
    size = index.select(F.size("keys").cast("long").alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b).alias("l"))
    documents, total = size.agg(F.sum("n"), F.sum("l")).first()
    queries = items.select(F.col(item).alias("item"), F.col(item_text).alias("text")).where(F.col("text").isNotNull())
    # items go through in groups of at most ITEMS on average, each broadcast on its own
    queries = stored(queries.withColumn("group", F.lit(0)).withColumn("number", F.monotonically_increasing_id()), "items")
    groups = 1 + queries.count() // ITEMS
    found = [_found(docs, index, queries.where(F.col("number") % groups == g), documents or 0, total or 0, top, key, text)
             for g in range(groups)]
    out = found[0]
    for other in found[1:]:
        out = out.union(other)
    return out.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")


def _found(docs, index, queries, documents, total, top, key, text) -> DataFrame:
    spark = docs.sparkSession
    texts = {r.number: terms(r.text.encode()) for r in queries.select("number", "text").toLocalIterator()}
    wanted = sorted({t for found in texts.values() for t in found})
    vocabulary = spark.createDataFrame(pa.table({"term": pa.array([t.decode() for t in wanted], pa.string())}))
    counted = index.select(F.explode(F.arrays_zip("terms", "documents")).alias("t")).select("t.terms", "t.documents")
    counted = counted.join(F.broadcast(vocabulary), counted.terms == vocabulary.term).groupBy("term").agg(F.sum("documents").alias("n"))
    holding = {r.term.encode(): r.n for r in counted.toLocalIterator()}
    weights = {t: weight(documents, holding.get(t, 0)) for t in wanted}
    listed = [(n, found) for n, found in sorted(texts.items()) if found]
    parts = spark.sparkContext.broadcast([listed[i:i + TOGETHER] for i in range(0, len(listed), TOGETHER)])
    sizes = spark.sparkContext.broadcast(weights)
    kind = docs.schema[key].dataType.simpleString()

    def bounded(limits):
        """Documents by bound: with limits all that may reach them, without the highest of each task."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            groups = [_Item(part, sizes.value) for part in parts.value]
            held: dict[int, tuple] = {}
            for batch in batches:
                for row in range(batch.num_rows):
                    width = batch.column("width")[row].as_py()
                    keys = batch.column("keys")[row].values
                    lengths = batch.column("lengths")[row].values.to_numpy()
                    rows = np.frombuffer(batch.column("rows")[row].as_buffer(), np.uint8).reshape(width, -1)
                    m = measure(lengths, documents, total)
                    for group in groups:
                        bounds = group.bounds(width, rows, lengths, m)
                        if limits is not None:
                            floor = np.array([limits.value.get(n, 1) for n in group.numbers])
                            which, column = np.nonzero(bounds >= floor[:, None])
                            if which.size:
                                yield pa.RecordBatch.from_arrays([
                                    pa.array(np.array(group.numbers)[which]), keys.take(pa.array(column)),
                                    pa.array(bounds[which, column])], ["number", "key", "bound"])
                            continue
                        for n, line in zip(group.numbers, bounds, strict=True):
                            best = np.argpartition(-line, min(top, line.size) - 1)[:top]
                            best = best[line[best] > (held[n][0][-1] if n in held and len(held[n][0]) == top else 0)]
                            if best.size:
                                old = held.get(n, ([], []))
                                joined = sorted(zip([*old[0], *line[best].tolist()], [*old[1], *keys.take(pa.array(best)).to_pylist()], strict=True),
                                                key=lambda x: -x[0])[:top]
                                held[n] = [b for b, _ in joined], [k for _, k in joined]
            if held:
                yield pa.RecordBatch.from_arrays([
                    pa.array([n for n, (b, _) in held.items() for _ in b], pa.int64()),
                    pa.array([k for _, ks in held.values() for k in ks], keys.type),
                    pa.array([b for bs, _ in held.values() for b in bs], pa.int64())], ["number", "key", "bound"])

        return index.select("width", "keys", "lengths", "rows").mapInArrow(run, f"number bigint, key {kind}, bound bigint")

    def scored(candidates: DataFrame) -> DataFrame:
        """Exact scores of all rows of the documents named, from their whole texts."""
        asked = candidates.groupBy("key").agg(F.collect_set("number").alias("numbers"))  # at most ITEMS a document
        rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
        joined = rows.join(asked, F.col("k").eqNullSafe(F.col("key"))).select("key", F.col("t").alias("text"), "numbers")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asking = {n: list(Counter(found).items()) for part in parts.value for n, found in part}
            worth = sizes.value
            for batch in slices(batches):
                out: tuple[list, list, list] = [], [], []
                for i, (data, numbers) in enumerate(zip(text_bytes(batch.column("text")), batch.column("numbers").to_pylist(), strict=True)):
                    found = terms(data)
                    if not found:
                        continue
                    times, m = Counter(found), measure(len(found), documents, total)
                    for n in numbers:
                        score = sum(c * worth[t] * gain(times[t], m) for t, c in asking[n] if t in times)
                        if score > 0:
                            out[0].append(n)
                            out[1].append(i)
                            out[2].append(score)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), batch.column("key").take(pa.array(out[1], pa.int64())),
                                                  pa.array(out[2], pa.int64())], ["number", "key", "score"])

        return joined.mapInArrow(run, f"number bigint, key {kind}, score bigint")

    first = _highest(bounded(None).withColumnRenamed("bound", "score"), top)
    # at most `top` rows an item reach the driver; an item with fewer rows admits whatever has a score
    lowest = _highest(scored(first), top).groupBy("number").agg(F.count("*").alias("n"), F.min("score").alias("least")).toLocalIterator()
    limits = spark.sparkContext.broadcast({r.number: r.least for r in lowest if r.n == top})
    best = _highest(scored(bounded(limits)), top)
    return best.join(queries.select("number", "item"), "number").select("item", "rank", "key", "score")


def _highest(rows: DataFrame, top: int) -> DataFrame:
    """The `top` rows of each number by score, then key: first in each of many parts of a number, then over those."""
    over = lambda *by: F.expr(f"row_number() over (partition by {', '.join(by)} order by score desc, key)")
    parted = rows.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(64)))
    parted = parted.withColumn("rank", over("number", "part")).where(F.col("rank") <= top)
    return parted.withColumn("rank", over("number")).where(F.col("rank") <= top).drop("part")
