"""Fingerprints of improbable features.

A feature is a window of 64 bytes. The entropy of its byte counts puts it in one of 1,024 classes, and how seldom the
corpus has windows of a class is the class's rank. In every run of 64 neighbouring windows the lowest-ranked, leftmost
window scores; windows that score often enough are the text's features. Each sets 5 bits in a Bloom filter of 2,048; a
filter takes 160 features, then the next is begun. The likeness of two chains is the mean, over the filters of the
shorter chain, of the best overlap with the other's, beyond what chance gives and relative to what is possible.

Defined results: a text under 64 bytes is one feature, an empty or null one has none and is like another empty one only;
equal texts have equal fingerprints; one document alone is its own neighbour; null ids come last, and rows of one id
are ordered by hash of their text; an empty table gives an empty one; further columns are not looked at.
"""

import base64
import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import slices, text_bytes
from .neighbours import key_cuts, lined_up

WINDOW = 64
RUN = 64  # windows among which one scores
SCORE = 16  # of a feature, at least
CLASSES = 1024
FILTER_BITS, HASHES, FILTER_FEATURES = 2048, 5, 160
CUTOFF = 0.15  # share of the possible overlap beyond chance that counts as none
BLOCK = 1 << 18
BUCKET_BYTES = 8 << 20

_SCALE = 1 << 20
_LOGS = np.array([0, *[round(c * np.log2(c) * _SCALE) for c in range(1, WINDOW + 2)]], np.int64)
_STEPS = np.diff(_LOGS)  # what one more occurrence adds
_FULL = WINDOW * 6 * _SCALE  # 64 * log2(64)


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """The class of every window of at least 64 bytes.

    Sliding by a byte changes two counts. How often a byte occurs in the 63 places after it and before it is counted for
    all bytes together, in order of byte value and place; the sum of c log c is then carried along as whole numbers.
    """
    order, n = np.argsort(data, kind="stable"), data.size
    # value and place in one number: a difference under 64 is the same byte at most 63 places on
    line = data[order].astype(np.int32) << 20 | order.astype(np.int32)
    after, before = np.ones(n, np.int8), np.zeros(n, np.int8)
    for lag in range(1, WINDOW):
        near = line[lag:] - line[:-lag] < WINDOW
        if not near.any():
            break
        after[:-lag] += near
        before[lag:] += near
    ahead, behind = np.empty(n, np.int8), np.empty(n, np.int8)
    ahead[order], behind[order] = after, before
    # the byte at i leaves window i and is counted over i .. i + 63; the one at i + 64 joins those at i + 1 .. i + 63
    change = _STEPS[behind[WINDOW:]] - _STEPS[ahead[:n - WINDOW] - 1]
    first = int(_LOGS[np.bincount(data[:WINDOW], minlength=256)].sum())
    spread = np.concatenate([[first], first + np.cumsum(change)])
    return ((_FULL - spread) * (CLASSES - 1) // _FULL).astype(np.int16)


def classes_of(texts: Sequence[bytes]) -> Iterator[np.ndarray]:
    """Per text, the classes of its windows; the texts are laid end to end and taken in blocks."""
    whole = np.frombuffer(b"".join(texts), np.uint8)
    parts = [entropy_classes(whole[at:at + BLOCK + WINDOW - 1]) for at in range(0, max(whole.size - WINDOW + 1, 0), BLOCK)]
    found, at = np.concatenate(parts) if parts else np.zeros(0, np.int16), 0
    for text in texts:
        yield found[at:at + max(len(text) - WINDOW + 1, 0)]
        at += len(text)


def class_ranks(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Rank of each class by its number of windows in the whole corpus, the rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES, np.int64)
        for batch in slices(batches, text):
            for classes in classes_of(text_bytes(batch.column(text))):
                counts += np.bincount(classes, minlength=CLASSES)
        seen = np.flatnonzero(counts)
        yield pa.record_batch({"c": pa.array(seen.astype(np.int32)), "n": pa.array(counts[seen])})

    found = docs.select(text).mapInArrow(run, "c int, n bigint").groupBy("c").agg(F.sum("n").alias("n"))
    total = np.zeros(CLASSES, np.int64)
    for row in found.collect():  # one row per class
        total[row.c] = row.n
    ranks = np.empty(CLASSES, np.int64)
    ranks[np.lexsort((np.arange(CLASSES), total))] = np.arange(CLASSES)
    return ranks


def feature_places(classes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Where the features of a text with these windows begin."""
    n = classes.size
    if not n:
        return np.zeros(0, np.int64)
    line = ranks[classes] << 40 | np.arange(n)
    span = min(RUN, n)
    least, width = line, 1
    while width < span:
        step = min(width, span - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    score = np.bincount(least & (1 << 40) - 1, minlength=n)
    # a text of few windows has few runs
    return np.flatnonzero(score >= min(SCORE, least.size))


def filters(data: bytes, classes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The chain of filters of a text with these window classes, as rows of 256 bytes."""
    if len(data) < WINDOW:
        features = [data] if data else []
    else:
        features = [data[i:i + WINDOW] for i in feature_places(classes, ranks).tolist()]
    if not features:
        return np.zeros((0, FILTER_BITS // 8), np.uint8)
    features = list(dict.fromkeys(features))
    digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(f) for f in features), ">u2").reshape(len(features), 8)
    bits = np.zeros((-(-len(features) // FILTER_FEATURES), FILTER_BITS), np.uint8)
    chain = np.repeat(np.arange(len(features)) // FILTER_FEATURES, HASHES)
    bits[chain, (digests[:, :HASHES] % FILTER_BITS).ravel()] = 1
    return np.packbits(bits, axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return float(len(b) == 0)
    pa_, pb = np.bitwise_count(a).sum(1, dtype=np.int64), np.bitwise_count(b).sum(1, dtype=np.int64)
    total = 0.0
    for row, ones in zip(a, pa_, strict=True):
        both = np.bitwise_count(row & b).sum(1, dtype=np.int64)
        most = np.minimum(ones, pb).astype(float)
        floor = ones * pb / FILTER_BITS  # expected of independent filters
        floor = floor + CUTOFF * (most - floor)
        total += float(np.max(np.where(both == most, 1.0, np.clip((both - floor) / np.maximum(most - floor, 1e-9), 0, 1))))
    return total / len(a)


def shown(chain: np.ndarray) -> str:
    """The chain as text; most bits are zero, so it is packed first."""
    return base64.b64encode(zlib.compress(chain.tobytes(), 9)).decode()


def _head(data: bytes, count: int) -> bytes:
    """The first `count` code points, or all."""
    if data.isascii():
        return data[:count]
    starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return data if count >= starts.size else data[:starts[count]]


def _length(data: bytes) -> int:
    return len(data) if data.isascii() else int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def edited(data: bytes, following: bytes) -> bytes:
    """The text with its last half replaced by as many code points of the following one's beginning."""
    n = _length(data)
    return _head(data, n - n // 2) + _head(following, n // 2)


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def fingerprints(docs: DataFrame, text: str = "text", column: str = "fingerprint") -> DataFrame:
    """The input with the fingerprint of every text. No shuffle."""
    if column in docs.columns:
        raise ValueError(f"the input has a column {column} already")
    ranks, schema = class_ranks(docs, text), StructType([*docs.schema.fields, StructField(column, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts = text_bytes(batch.column(text))
            found = [shown(filters(data, classes, ranks)) for data, classes in zip(texts, classes_of(texts), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], schema.names)

    return docs.mapInArrow(run, schema)


def compared(docs: DataFrame, buckets: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and how like it is to that and to the next document's.

    Texts are moved once, into `buckets` stretches of descending id that hold about as many documents each.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    ranks = class_ranks(rows)
    cuts = key_cuts(rows, "doc_id", buckets)
    schema = pa.schema([(name, pa.int64() if i < 2 else pa.float64() if i > 4 else pa.string()) for i, name in enumerate(NAMES)])
    lined = lined_up(rows.withColumn("_h", F.xxhash64("text")), "doc_id", cuts, "_h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row before: bucket, id, text, classes, filters
        for batch in slices(batches, "text"):
            held, texts = [], text_bytes(batch.column("text"))
            places = [batch.column(c).to_pylist() for c in ("_bucket", "_tail", "doc_id")]
            for bucket, tail, key, data, classes in zip(*places, texts, classes_of(texts), strict=True):
                chain = filters(data, classes, ranks)
                if last is not None and last[0] == bucket:
                    held.append(_row(*last[1:], data, classes, chain, ranks))
                last = None if tail else (bucket, key, data, classes, chain)
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)

    return lined.mapInArrow(run, SCHEMA)


def _row(key, data: bytes, classes: np.ndarray, chain: np.ndarray, following: bytes, next_classes: np.ndarray,
         next_chain: np.ndarray, ranks: np.ndarray) -> dict:
    head = _head(data, _length(data) - _length(data) // 2)
    other = edited(data, following)
    # windows on either side of the seam are known; at most 63 cross it
    border = max(len(head) - WINDOW + 1, 0)
    across = next(classes_of([other[border:len(head) + WINDOW - 1]]))
    known = next_classes[:max(len(other) - len(head) - WINDOW + 1, 0)]
    other_chain = filters(other, np.concatenate([classes[:border], across, known]), ranks)
    return {"doc_id": key, "n_chars": _length(data), "edited_sha256": hashlib.sha256(other).hexdigest(),
            "fingerprint": shown(chain), "edited_fingerprint": shown(other_chain),
            "near_edited": likeness(chain, other_chain), "near_next": likeness(chain, next_chain)}
