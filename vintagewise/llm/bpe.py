"""Byte-pair encoding and decoding with a lexicon of the corpus's frequent words.

The unit is the run of bytes between ASCII blanks: no token crosses one, so a text's ids are those of its units in
turn. Units are counted over the whole corpus; the most frequent are encoded once and compiled into a transducer
(`lexicon`) that every task maps into memory. Other units are merged exactly, pair by pair in rank order, so the size
of the lexicon changes speed and never a result.

Defined results: a null or empty text has no ids, and its decoding is empty; repeated rows get equal ids; an empty
table gives an empty one; further columns are kept, and a column that has the output's name already is an error.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..session import stored
from .common import filesystem, shared_path, slices, text_bytes
from .lexicon import Lexicon, compile_lexicon

LEXICON_WORDS = 200_000  # bounds what the driver compiles and a task maps; not what can be encoded
COUNTED = 300_000  # distinct units a task holds before it hands their counts on
REMEMBERED = 100_000  # merged units a task remembers

# The tokenizer's splitting rule, as its file states it; the second form is the same for lower-case ASCII.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SPLIT_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in for each byte: itself where printable in Latin-1, else the next free code from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, merges and special tokens of a tokenizer file with NFC, lower case, word ends and byte letters."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        letters = _byte_letters()
        self.inner = [ids[letters[b]] for b in range(256)]
        self.last = [ids[letters[b] + end] for b in range(256)]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # pair of ids -> rank and merged id in one number, so the least is the next merge
        self.merges = {ids[a] << 20 | ids[b]: rank << 20 | ids[a + b] for rank, (a, b) in reversed(list(enumerate(pairs)))}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def _merge(self, piece: bytes) -> list[int]:
        inner, get, none = self.inner, self.merges.get, 1 << 62
        parts = [inner[b] for b in piece]
        parts[-1] = self.last[piece[-1]]
        while len(parts) > 1:
            ranks = [get(a << 20 | b, none) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == none:
                break
            merged, new, i, stop = [], best & 0xFFFFF, 0, len(ranks)
            while i < stop:
                if ranks[i] == best:
                    merged.append(new)
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            if i == stop:
                merged.append(parts[i])
            parts = merged
        return parts

    def encode(self, unit: bytes) -> list[int]:
        """The ids of any bytes, by the tokenizer's rules alone."""
        out: list[int] = []
        if unit.isascii() and b"<|" not in unit:
            for piece in SPLIT_ASCII.findall(unit.decode().lower()):
                out += self._merge(piece.encode())
            return out
        for i, part in enumerate(self.cut.split(unit.decode(errors="replace"))):
            if i % 2:
                out.append(self.special[part])
            elif part:
                # lower-casing goes letter by letter: no final form of sigma
                lower = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                for piece in SPLIT.findall(lower):
                    out += self._merge(piece.encode())
        return out


def units(text: bytes) -> list[bytes]:
    """A text cut at ASCII blanks; ASCII text in lower case, unless it may hold a special token."""
    return (text.lower() if text.isascii() and b"<|" not in text else text).split()


def unit_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows (unit, n) over the whole table; each task hands on sums, which Spark adds up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.record_batch({"unit": pa.array(counts.keys(), pa.binary()), "n": pa.array(counts.values(), pa.int64())})
            counts.clear()
            return out

        for batch in slices(batches, text):
            for data in text_bytes(batch.column(text)):
                counts.update(units(data))
            if len(counts) > COUNTED:
                yield flush()
        yield flush()

    return docs.select(text).mapInArrow(run, "unit binary, n bigint").groupBy("unit").agg(F.sum("n").alias("n"))


def frequent_units(counts: DataFrame, most: int = LEXICON_WORDS) -> DataFrame:
    """The units of at least some frequency, as low as leaves `most` units or fewer, and 2 at least."""
    levels = counts.groupBy("n").agg(F.count("*").alias("units")).where("n > 1")
    # frequencies are few; only the top ones, which together hold `most` units, are looked at
    top, held, floor = levels.orderBy(F.desc("n")).limit(most).toLocalIterator(), 0, None
    for row in top:
        held += row.units
        if held > most:
            break
        floor = row.n
    return counts.where(F.col("n") >= floor) if floor else counts.where(F.lit(False))


def build_lexicon(spark: SparkSession, docs: DataFrame, vocabulary: Vocabulary, text: str = "text",
                  most: int = LEXICON_WORDS) -> str:
    """Compiles the frequent units and hands the file to all executors; returns its name there."""
    counts = stored(unit_counts(docs, text), "units")
    rows = frequent_units(counts, most).select("unit").toArrow().column("unit").to_pylist()
    data = compile_lexicon((unit, vocabulary.encode(unit)) for unit in sorted(rows))
    path = shared_path(spark, "lexicon")
    store, place = filesystem(path)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    with store.open_output_stream(place) as out:
        out.write(data)
    spark.sparkContext.addFile(path)
    return path.rpartition("/")[2]


class _Encoder:
    """Encodes lists of texts; one per task."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.merged: dict[bytes, list[int]] = {}

    def _unseen(self, unit: bytes) -> list[int]:
        found = self.merged.get(unit)
        if found is None:
            if len(self.merged) >= REMEMBERED:
                self.merged.clear()
            found = self.merged[unit] = self.vocabulary.encode(unit)
        return found

    def __call__(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): text i has ids[offsets[i]:offsets[i + 1]]."""
        number: dict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        place, borders = [], [0]
        for text in texts:
            place.append(np.fromiter(map(number.__getitem__, units(text)), np.int64))
            borders.append(borders[-1] + place[-1].size)
        distinct = list(number)
        found = self.lexicon.find(distinct)
        missing = np.flatnonzero(found < 0)
        merged = [self._unseen(distinct[i]) for i in missing.tolist()]

        # ids of the lexicon first, those of the merged units behind them
        base = self.lexicon.ids.size
        sizes = np.fromiter(map(len, merged), np.int64, len(merged))
        pool = np.fromiter((i for codes in merged for i in codes), np.int32)
        start, size = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        known = np.flatnonzero(found >= 0)
        start[known] = self.lexicon.offsets[found[known]]
        size[known] = self.lexicon.offsets[found[known] + 1] - start[known]
        start[missing], size[missing] = base + np.cumsum(sizes) - sizes, sizes

        order = np.concatenate([*place, np.zeros(0, np.int64)])
        counts = size[order]
        ends = np.cumsum(counts)
        at = np.repeat(start[order] - ends + counts, counts) + np.arange(int(ends[-1]) if ends.size else 0)
        inside = at < base
        ids = np.empty(at.size, np.int32)
        ids[inside], ids[~inside] = self.lexicon.ids[at[inside]], pool[at[~inside] - base]
        return np.concatenate([[0], ends])[np.asarray(borders)], ids


def _fresh(docs: DataFrame, column: str, kind) -> StructType:
    if column in docs.columns:
        raise ValueError(f"the input has a column {column} already")
    return StructType([*docs.schema.fields, StructField(column, kind)])


def encode(docs: DataFrame, path: str, text: str = "text", column: str = "ids", lexicon_words: int = LEXICON_WORDS,
           drop_text: bool = False) -> DataFrame:
    """The input with the ids of its whole text, by the tokenizer file at `path` on the driver, no special ones added."""
    schema = _fresh(docs, column, ArrayType(IntegerType(), False))
    spark = docs.sparkSession
    vocabulary = Vocabulary(path)
    name = build_lexicon(spark, docs, vocabulary, text, lexicon_words)
    shared = spark.sparkContext.broadcast(vocabulary)  # bounded by the tokenizer file
    kept = [f.name for f in schema.fields[:-1] if not (drop_text and f.name == text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(shared.value, Lexicon(SparkFiles.get(name)))
        for batch in slices(batches, text):
            offsets, ids = encoder(text_bytes(batch.column(text)))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lists], [*kept, column])

    return docs.mapInArrow(run, StructType([f for f in schema.fields if f.name in (*kept, column)]))


def decode(df: DataFrame, path: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """The input with its ids as text: the tokens, special ones too, with a space between two."""
    schema = _fresh(df, column, StringType())
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(path).tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = np.array(shared.value, object)
        for batch in batches:
            lists = batch.column(ids)
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for start in range(0, len(lists), 500):
                stop = min(start + 500, len(lists))
                texts = [" ".join(tokens[values[a:b]].tolist())
                         for a, b in zip(offsets[start:stop], offsets[start + 1:stop + 1], strict=True)]
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], schema.names)

    return df.mapInArrow(run, schema)
