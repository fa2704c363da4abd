"""Token ids in Arrow files of equal-length sequences.

Documents are range-partitioned by id, encoded, and their ids laid end to end. A shard is an Arrow IPC file whose record
batches hold `length` ids per row as a fixed-size list, and a mask of the same shape that is false only behind the
shard's last id. Row k is in batch k // rows at a known place, so a reader maps the file and looks at any sequence
without copying. A second file beside it lists where each document begins.

A task writes files under new names; the manifest, a stored table, names those of the attempts that ended well.

Defined results: a null or empty text is its end id alone; rows that repeat an id stand next to each other, by hash of
their text; null ids come first; an empty table gives an empty manifest; further columns are not looked at.
"""

import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stored
from .bpe import SPLIT_ASCII
from .common import filesystem, shared_path, slices

LENGTH = 1024  # ids per sequence
ROWS = 256  # sequences per record batch
REMEMBERED = 500_000  # units whose ids a task remembers
JOINED = 2000  # units that the library encodes in one call
MANIFEST = "shard int, file string, docs_file string, n_docs bigint, n_tokens bigint"


class UnitEncoder:
    """The tokenizers library on the distinct units between blanks, which Arrow finds and numbers; a task remembers them.

    The ids of all remembered units lie in one array, unit k's at `starts[k]`; place 0 is the end id.
    """

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.end = end
        # a special token is cut out before anything else is looked at, so it keeps units apart in one call; one that takes
        # blanks with it, or is sought in normalised text, would not
        apart = [(i, t) for i, t in self.tokenizer.get_added_tokens_decoder().items()
                 if t.special and t.content.startswith("<|") and not (t.normalized or t.lstrip or t.rstrip or t.single_word)]
        self.border, self.border_text = (apart[0][0], apart[0][1].content) if apart else (None, "")
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.flat, self.sizes = np.array([self.end], self.kind), np.ones(1, np.int64)

    def _plain(self, unit: str) -> list[int]:
        """Pieces of printable ASCII are as the normaliser and splitter leave them, so the library's model takes them as they are."""
        lower = unit.lower()
        pieces = [lower] if lower.isalpha() else SPLIT_ASCII.findall(lower)
        return [token.id for piece in pieces for token in self.model.tokenize(piece)]

    def _apart(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each unit from calls that take many, or one call each where the file has no token to keep them apart."""
        if self.border is None:
            yield from (self.tokenizer.encode(u, add_special_tokens=False).ids for u in texts)
            return
        for at in range(0, len(texts), JOINED):
            part = texts[at:at + JOINED]
            ids = self.tokenizer.encode(self.border_text.join(part), add_special_tokens=False).ids
            ends = [*(i for i, code in enumerate(ids) if code == self.border), len(ids)]
            start = 0
            for stop in ends:
                yield ids[start:stop]
                start = stop + 1

    def _learn(self, fresh: pa.Array) -> None:
        texts = [u.decode(errors="replace") for u in fresh.cast(pa.large_binary()).to_pylist()]
        codes: list[list[int]] = [[]] * len(texts)
        others = []
        for i, text in enumerate(texts):
            if "<|" in text:
                codes[i] = self.tokenizer.encode(text, add_special_tokens=False).ids
            elif text.isascii() and text.isprintable():
                codes[i] = self._plain(text)
            else:
                others.append(i)
        for i, ids in zip(others, self._apart([texts[i] for i in others]), strict=True):
            codes[i] = ids
        self.known = pa.concat_arrays([self.known, fresh])
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, codes), np.int64, len(codes))])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(codes), self.kind)])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids per text, all ids), each text followed by the end id."""
        # not large_string: lower-casing a slice of one reads the wrong bytes (pyarrow 23)
        column = pc.fill_null(texts.cast(pa.string()), "")
        lower = pc.and_(pc.string_is_ascii(column), pc.invert(pc.match_substring(column, "<|")))
        cut = pc.ascii_split_whitespace(pc.if_else(lower, pc.ascii_lower(column), column))
        borders = cut.offsets.to_numpy()
        found = cut.values.dictionary_encode()
        distinct = found.dictionary
        if len(self.known) > REMEMBERED:
            self._forget()
        place = pc.index_in(distinct, value_set=self.known)
        fresh, held = distinct.filter(place.is_null()), len(self.known)
        place = place.fill_null(-1).to_numpy() + 1  # place 0 is the end id
        if len(fresh):
            place[place == 0] = held + 1 + np.arange(len(fresh))
            self._learn(fresh)

        order = np.insert(place[found.indices.to_numpy()], borders[1:] - borders[0], 0)
        counts = self.sizes[order]
        ends = np.cumsum(counts)
        starts = np.cumsum(self.sizes) - self.sizes
        ids = self.flat[np.repeat(starts[order] - ends + counts, counts) + np.arange(int(ends[-1]) if ends.size else 0)]
        last = borders[1:] - borders[0] + np.arange(len(column))
        return np.diff(ends[last], prepend=0), ids


class _Shard:
    """One shard being written."""

    def __init__(self, folder: str, kind, length: int, rows: int):
        self.store, place = filesystem(folder)
        self.store.create_dir(place, recursive=True)
        self.name = uuid.uuid4().hex
        self.length, self.rows, self.kind = length, rows, kind
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.docs_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.file = pa.ipc.new_file(self._open(f"{place}/{self.name}.arrow"), self.schema)
        self.docs = pa.ipc.new_file(self._open(f"{place}/{self.name}.docs.arrow"), self.docs_schema)
        self.rest = np.zeros(0, kind)
        self.n_docs = self.n_tokens = 0

    def _open(self, path: str):
        self.sinks = [*getattr(self, "sinks", []), self.store.open_output_stream(path)]
        return self.sinks[-1]

    def _put(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(ids.size) < real
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def add(self, doc_ids: pa.Array, counts: np.ndarray, ids: np.ndarray) -> None:
        starts = self.n_tokens + np.cumsum(counts) - counts
        self.docs.write_batch(pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), pa.array(counts)], schema=self.docs_schema))
        self.n_docs += counts.size
        self.n_tokens += ids.size
        held, step = np.concatenate([self.rest, ids]), self.length * self.rows
        whole = held.size // step * step
        for at in range(0, whole, step):
            self._put(held[at:at + step], step)
        self.rest = held[whole:]

    def close(self) -> None:
        if self.rest.size:
            full = -(-self.rest.size // self.length) * self.length
            self._put(np.concatenate([self.rest, np.zeros(full - self.rest.size, self.kind)]), self.rest.size)
        for part in (self.file, self.docs, *self.sinks):
            part.close()


def write_tokens(docs: DataFrame, path: str, end: int, folder: str | None = None, length: int = LENGTH, rows: int = ROWS,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the ids of all documents in ascending order of id; returns the manifest with `first`, the ids before a shard.

    `path`: the tokenizer file, at the same place on every machine.
    """
    folder = folder or shared_path(docs.sparkSession, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = encoder = None
        for batch in slices(batches, "text"):
            encoder = encoder or UnitEncoder(path, end)
            shard = shard or _Shard(folder, encoder.kind, length, rows)
            shard.add(batch.column("doc_id"), *encoder(batch.column("text")))
        if shard:
            shard.close()
            yield pa.record_batch({
                "shard": pa.array([TaskContext.get().partitionId()], pa.int32()), "file": [f"{folder}/{shard.name}.arrow"],
                "docs_file": [f"{folder}/{shard.name}.docs.arrow"], "n_docs": [shard.n_docs], "n_tokens": [shard.n_tokens]})

    rows_in = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("_h"))
    ordered = rows_in.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h").select("doc_id", "text")
    manifest = stored(ordered.mapInArrow(run, MANIFEST), "token-manifest")
    # one row per file: the only thing that is summed in one place
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    return manifest.withColumn("first", before)


class TokenFile:
    """A shard opened for reading; `sequence` and `mask` are views of the mapped file."""

    def __init__(self, path: str):
        store, place = filesystem(path)
        local = type(store).__name__ == "LocalFileSystem"
        self.reader = pa.ipc.open_file(pa.memory_map(place) if local else store.open_input_file(place))
        self.rows = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 0
        self.length = self.reader.schema.field("ids").type.list_size

    def _values(self, batch: int, column: str) -> pa.Array:
        part = self.reader.get_batch(batch).column(column)
        return part.values.slice(part.offset * self.length, len(part) * self.length)

    def sequence(self, k: int) -> np.ndarray:
        at = k % self.rows * self.length
        return self._values(k // self.rows, "ids").to_numpy()[at:at + self.length]

    def mask(self, k: int) -> np.ndarray:
        at = k % self.rows * self.length
        return self._values(k // self.rows, "mask").slice(at, self.length).to_numpy(zero_copy_only=False)

    def masked_in(self) -> int:
        return sum(self._values(b, "mask").true_count for b in range(self.reader.num_record_batches))

    def pieces(self, start: int, count: int) -> Iterator[np.ndarray]:
        """The ids from `start` on, as views, one per record batch."""
        step = self.rows * self.length
        while count:
            batch, at = divmod(start, step)
            part = self._values(batch, "ids").to_numpy()[at:at + count]
            yield part
            start, count = start + part.size, count - part.size


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian 32-bit numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens, store = TokenFile(row["file"]), filesystem(row["docs_file"])
                if tokens.masked_in() != row["n_tokens"]:
                    raise ValueError(f"{row['file']} does not hold {row['n_tokens']} ids")
                docs = pa.ipc.open_file(store[0].open_input_file(store[1]))
                for i in range(docs.num_record_batches):
                    part = docs.get_batch(i)
                    sums = []
                    for start, count in zip(part.column("start").to_pylist(), part.column("n_tokens").to_pylist(), strict=True):
                        crc = 0
                        for piece in tokens.pieces(start, count):
                            crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                        sums.append(crc)
                    starts = pa.array(part.column("start").to_numpy() + row["first"])
                    yield pa.record_batch([part.column("doc_id"), starts, part.column("n_tokens"), pa.array(sums, pa.int64())],
                                          ["doc_id", "start", "n_tokens", "ids_crc32"])

    shards = max(manifest.count(), 1)
    dealt = manifest.select("file", "docs_file", "n_tokens", "first").repartition(shards, "file")
    return dealt.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
