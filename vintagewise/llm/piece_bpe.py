"""SentencePiece encoding and decoding by vectorised merge rounds.

The unit is a run of spaces with what follows it. Units end where no piece of the vocabulary reaches across, which the
model's pieces decide, so a text's ids are those of its units in turn. A task numbers its distinct units and merges
new ones together: their characters lie in one flat array, every round finds the best pair of each unit (a segmented
minimum of ranks), merges it where it stands, leftmost first, and closes the gaps; units without a pair leave.

A unit may merge all places of its best rank in one round only if no piece made there can enter a pair of equal or
better rank; the vocabulary says for which pieces that holds. Else the leftmost place alone is merged, and units that
are still long take such a round symbol by symbol, with the same result.

Defined results: a null or empty text has the end id alone, and its decoding is empty; repeated rows get equal ids; an
empty table gives an empty one; further columns are kept, and a column that has the output's name already is an error.
"""

from __future__ import annotations

import codecs
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from sentencepiece import sentencepiece_model_pb2

from .common import slices, text_bytes

REMEMBERED_BYTES = 32 << 20  # of units and ids that a task remembers
LONG = 64  # symbols from which a round without simultaneous merges goes symbol by symbol
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NONE = np.int64(1) << 40  # rank of a pair that makes no piece

class Pieces:
    """Pairs, ranks and ids of a BPE model file with byte fallback and without normalisation."""

    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, trained = model.normalizer_spec, model.trainer_spec
        kinds = {p.type for p in model.pieces}
        if (trained.model_type != 2 or not trained.byte_fallback or trained.treat_whitespace_as_suffix or rules.precompiled_charsmap
                or rules.remove_extra_whitespaces or not (rules.add_dummy_prefix and rules.escape_whitespaces)
                or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError("only BPE models with byte fallback, a leading space and plain pieces are read")
        self.end = trained.eos_id
        self.size = len(model.pieces)
        ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        levels = {s: r for r, s in enumerate(sorted({p.score for p in model.pieces if p.type == NORMAL}, reverse=True))}
        rank = {w: levels[model.pieces[i].score] for w, i in ids.items()}
        self.bytes = np.array([next(i for i, p in enumerate(model.pieces) if p.type == BYTE and int(p.piece[1:-1], 16) == b)
                               for b in range(256)], np.int32)

        # a symbol is a piece's id, or beyond all ids a character that is no piece
        self.symbol_of = np.arange(0x110000, dtype=np.int64) + self.size
        for w, i in ids.items():
            if len(w) == 1:
                self.symbol_of[ord(w)] = i
        pairs, held_back = [], set()
        for w, i in ids.items():
            for k in range(1, len(w)):
                parts = w[:k], w[k:]
                if all(p in ids or len(p) == 1 for p in parts):
                    a, b = (ids[p] if p in ids else self.size + ord(p) for p in parts)
                    pairs.append((a << 32 | b, rank[w], i))
                    held_back |= {ids[p] for p in parts if len(p) > 1 and rank[w] <= rank[p]}
        found = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.made = found[:, 0].copy(), found[:, 1].copy(), found[:, 2].astype(np.int64)
        self.held_back = np.zeros(self.size, bool)
        self.held_back[list(held_back)] = True

        self.shown = [self._shown(p, trained.unk_surface) for p in model.pieces]
        self.leading = [p.type == NORMAL and p.piece.startswith(SPACE) for p in model.pieces]
        self.cut = re.compile(self._cutting([w for w in ids if len(w) > 1]))

    @staticmethod
    def _shown(piece, unknown: str) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[1:-1], 16)])
        return b"" if piece.type == CONTROL else unknown.encode() if piece.type == UNKNOWN else piece.piece.replace(SPACE, " ").encode()

    @staticmethod
    def _cutting(pieces: Sequence[str]) -> bytes:
        """The pattern of a unit: it ends before a space, a line end or a stop after a letter, if no piece reaches across."""
        if any(SPACE in w.lstrip(SPACE) for w in pieces):
            return rb"(?s).+"
        inside = {c for w in pieces for c in w}
        after = {b for w in pieces for a, b in zip(w, w[1:], strict=False) if a.isascii() and a.isalpha()}
        alone = "\n" if "\n" not in inside else ""
        stops = "".join(c for c in ".,;:!?" if c not in after)
        rest = rf" *[^ {alone}]+| +" + (f"|{alone}" if alone else "")
        return (rf" *+[A-Za-z\x80-\xff]++(?<=[A-Za-z])(?=[{stops}])|{rest}" if stops else rest).encode("latin-1")

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair; NONE where there is none."""
        if not self.keys.size:
            return np.full(left.size, NONE), np.zeros(left.size, np.int64)
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), self.keys.size - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE), self.made[at]

    def _pair(self, a: int, b: int) -> tuple[int, int]:
        rank, made = self.look_up(np.array([a]), np.array([b]))
        return int(rank[0]), int(made[0])

    def _settle(self, symbols: list[int], level: int) -> list[int]:
        """One unit after all merges of rank `level` or better, in the order of single merges, leftmost first."""
        done, known = [], {}

        def pair(a: int, b: int) -> tuple[int, int]:
            if (a, b) not in known:
                known[a, b] = self._pair(a, b)
            return known[a, b]

        rest = symbols[::-1]
        while rest:
            done.append(rest.pop())
            while True:
                # what stands to the left was brought below the level; only the pairs around the last symbol can merge
                before = pair(done[-2], done[-1]) if len(done) > 1 else (NONE, 0)
                behind = pair(done[-1], rest[-1]) if rest else (NONE, 0)
                if min(before[0], behind[0]) > level:
                    break
                if before[0] <= behind[0]:
                    done[-2:] = [before[1]]
                else:
                    done[-1] = behind[1]
                    rest.pop()
        return done

    def merge(self, units: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of distinct units, all merged together."""
        texts = [u.decode(errors="replace").replace(" ", SPACE) for u in units]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        symbol, unit = self.symbol_of[points], np.repeat(np.arange(len(texts)), sizes)
        place = np.arange(symbol.size)  # keeps the order of what leaves in different rounds
        rank, made = self._ranks(symbol, unit)
        gone: list[tuple[np.ndarray, ...]] = []
        while symbol.size:
            starts = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
            least = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, symbol.size))
            live = np.repeat(least < NONE, lengths)
            if not live.all():
                gone.append((place[~live], symbol[~live], unit[~live]))
                symbol, unit, place, rank, made = symbol[live], unit[live], place[live], rank[live], made[live]
                lengths, least = lengths[least < NONE], least[least < NONE]
                if not symbol.size:
                    break
                starts = np.cumsum(lengths) - lengths
            best = rank == np.repeat(least, lengths)
            # of overlapping places the first, third, fifth are merged
            at = np.arange(best.size)
            begun = best & ~np.concatenate([[False], best[:-1]])
            chosen = best & (((at - np.maximum.accumulate(np.where(begun, at, 0))) & 1) == 0)
            number = np.repeat(np.arange(starts.size), lengths)
            places = np.flatnonzero(chosen)
            many = np.bincount(number[places], minlength=starts.size) > 1
            careful = np.zeros(starts.size, bool)
            careful[number[places[self.held_back[made[places]]]]] = True
            careful &= many
            if careful.any():
                first = np.zeros(best.size, bool)
                first[places[np.unique(number[places], return_index=True)[1]]] = True
                chosen &= first | ~careful[number]
                scanned = np.flatnonzero(careful & (lengths > LONG))
                if scanned.size:
                    chosen &= ~np.isin(number, scanned)
            else:
                scanned = np.zeros(0, np.int64)
            places = np.flatnonzero(chosen)
            symbol[places] = made[places]
            keep = np.ones(best.size, bool)
            keep[places + 1] = False
            fresh = chosen.copy()  # pairs to look up again: those of a merged symbol and of the one before it
            fresh[places[places > 0] - 1] = True
            # where the symbol before was itself merged into its predecessor, that one's pair changes too
            fresh[places[places > 1] - 2] |= ~keep[places[places > 1] - 1]
            for u in scanned.tolist():
                a, b = starts[u], starts[u] + lengths[u]
                left = self._settle(symbol[a:b].tolist(), int(least[u]))
                symbol[a:a + len(left)], keep[a + len(left):b], fresh[a:a + len(left)] = left, False, True
            symbol, unit, place, rank, made, fresh = symbol[keep], unit[keep], place[keep], rank[keep], made[keep], fresh[keep]
            self._renew(symbol, unit, rank, made, np.flatnonzero(fresh))
        return self._collected(gone, len(texts))

    def _ranks(self, symbol: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, made = np.full(symbol.size, NONE), np.zeros(symbol.size, np.int64)
        self._renew(symbol, unit, rank, made, np.arange(symbol.size))
        return rank, made

    def _renew(self, symbol: np.ndarray, unit: np.ndarray, rank: np.ndarray, made: np.ndarray, at: np.ndarray) -> None:
        """Looks up the pairs that begin at the given places."""
        rank[at] = NONE
        at = at[at < symbol.size - 1]
        at = at[unit[at] == unit[at + 1]]
        rank[at], made[at] = self.look_up(symbol[at], symbol[at + 1])

    def _collected(self, gone: list[tuple[np.ndarray, ...]], count: int) -> tuple[np.ndarray, np.ndarray]:
        place, symbol, unit = (np.concatenate([*[g[i] for g in gone], np.zeros(0, np.int64)]) for i in range(3))
        order = np.argsort(place, kind="stable")
        symbol, unit = symbol[order], unit[order]
        strange = np.flatnonzero(symbol >= self.size)
        if strange.size:  # a character without a piece is written as its bytes
            spelled = [chr(p).encode() for p in (symbol[strange] - self.size).tolist()]
            times = np.ones(symbol.size, np.int64)
            times[strange] = [len(s) for s in spelled]
            ends = np.cumsum(times)
            ids, unit = np.repeat(symbol, times), np.repeat(unit, times)
            inside = np.repeat(symbol >= self.size, times)
            ids[inside] = self.bytes[np.frombuffer(b"".join(spelled), np.uint8)]
            assert ends[-1] == ids.size
            symbol = ids
        return np.concatenate([[0], np.cumsum(np.bincount(unit, minlength=count))]), symbol.astype(np.int32)


class _Encoder:
    """Encodes lists of texts; one per task. Remembers units up to a number of bytes."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.offsets, self.ids, self.held = np.zeros(1, np.int64), np.zeros(0, np.int32), 0

    def __call__(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): text i has ids[offsets[i]:offsets[i + 1]], the end id last."""
        if self.held > REMEMBERED_BYTES:
            self._forget()
        known, place, borders, find, get = len(self.number), [], [0], self.pieces.cut.findall, self.number.__getitem__
        for text in texts:
            found = find(b" " + text.replace(SPACE.encode(), b" ")) if text else []
            place.append(np.fromiter(map(get, found), np.int64, len(found)))
            borders.append(borders[-1] + len(found))
        if len(self.number) > known:
            # a dictionary keeps the order in which its keys came
            fresh = list(self.number)[known:]
            offsets, ids = self.pieces.merge(fresh)
            self.offsets = np.concatenate([self.offsets, offsets[1:] + self.offsets[-1]])
            self.ids = np.concatenate([self.ids, ids])
            self.held += sum(map(len, fresh)) + 60 * len(fresh)
        order = np.concatenate([*place, np.zeros(0, np.int64)])
        start = self.offsets[order]
        size = self.offsets[order + 1] - start
        total = np.concatenate([[0], np.cumsum(size)])
        # each text's ids lie behind the end ids of the texts before it
        text_of = np.repeat(np.arange(len(texts)), np.diff(borders))
        to = total[:-1] + text_of
        ends = total[np.asarray(borders)] + np.arange(len(texts) + 1)
        out = np.full(int(ends[-1]), self.pieces.end, np.int32)
        within = np.arange(int(total[-1])) - np.repeat(total[:-1], size)
        out[np.repeat(to, size) + within] = self.ids[np.repeat(start, size) + within]
        return ends, out


def _fresh(docs: DataFrame, column: str, kind) -> StructType:
    if column in docs.columns:
        raise ValueError(f"the input has a column {column} already")
    return StructType([*docs.schema.fields, StructField(column, kind)])


def encode(docs: DataFrame, path: str, text: str = "text", column: str = "ids", drop_text: bool = False) -> DataFrame:
    """The input with the ids of its whole text and the end id, by the model file at `path` on the driver."""
    schema = _fresh(docs, column, ArrayType(IntegerType(), False))
    pieces = Pieces(path)  # travels with the task's function, bounded by the model file
    kept = [f.name for f in schema.fields[:-1] if not (drop_text and f.name == text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(pieces)
        for batch in slices(batches, text):
            offsets, ids = encoder(text_bytes(batch.column(text)))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lists], [*kept, column])

    return docs.mapInArrow(run, StructType([f for f in schema.fields if f.name in (*kept, column)]))


def decode(df: DataFrame, path: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """The input with its ids as text. One space is taken off the front; bytes that are no UTF-8 give U+FFFD each."""
    schema = _fresh(df, column, StringType())
    pieces = Pieces(path)
    shown, leading = pieces.shown, pieces.leading

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codecs.register_error("each byte", lambda error: ("�", error.start + 1))
        table = np.array(shown, object)
        empty = np.array([not s for s in shown])

        def text(codes: np.ndarray) -> str:
            data = b"".join(table[codes].tolist())
            first = next((i for i in codes[:16].tolist() if not empty[i]), None)
            if first is None:
                first = next((i for i in codes.tolist() if not empty[i]), None)
            if first is not None and leading[first]:
                data = data[1:]
            return data.decode(errors="each byte")

        for batch in batches:
            lists = batch.column(ids)
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for start in range(0, len(lists), 500):
                stop = min(start + 500, len(lists))
                texts = [text(values[a:b]) for a, b in zip(offsets[start:stop], offsets[start + 1:stop + 1], strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.slice(start, stop - start).columns, pa.array(texts, pa.string())], schema.names)

    return df.mapInArrow(run, schema)
