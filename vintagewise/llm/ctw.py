"""Scoring by context-tree weighting over binary-decomposed bytes.

A text is its words in lower case with a space between two and a line end behind the last, so that its probability is
that of its words and its end. Each byte is eight binary decisions, one context tree per decision node. A tree branches by
whole bytes, the nearest first, five bytes back. Every node estimates by Krichevsky and Trofimov, and a node's probability
is half its own and half the product of its children's, so that the prediction mixes all six depths by how well each has
told the training texts. A node that the training texts never reach has probability one, and tells a half.

The tree grows with the corpus: Spark counts every string of five bytes and the byte behind it, over all texts (in texts held out
these count nothing, they are rows for the look-up). Subtrees below the nearest three bytes are dealt to groups whose number grows
with the rows. A group weighs its subtrees from the leaves up; the top three levels follow per decision node, whose weights go back to
the groups and down to the leaves, where the eight decisions of a byte become one log probability.

Scoring looks up each byte of a text by its string. For the most frequent strings, a table of fixed size lies in a file that tasks
map into memory; all others are looked up by a join.

Beside the model stands an add-half unigram score of the words. Counts of the most frequent words, a bounded table, go to
every task; rarer words are looked up by a join on their hash.

Defined results: a null or empty text is its end alone; a null id counts as empty text when it is dealt to a fold;
repeated rows each count; an empty table gives an empty result; further columns are not looked at.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import stored
from .common import filesystem, shared_path, slices, text_bytes
from .shingles import word_hashes

DEPTH = 5  # bytes of context
SPLIT = 3  # of these, the nearest that deal subtrees to groups
GROUP = 1 << 16  # strings that a group of subtrees aims at
STRINGS = 1 << 20  # strings whose log probabilities every task holds
TURNS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], np.uint64)
SLICE = 1 << 20  # bytes of text counted or scored at once
WORD, BYTE = 0, 1  # kinds of counts
FREQUENT = 1 << 18  # words whose counts every task holds
HELD = {WORD: 300_000, BYTE: 1_500_000}  # distinct words and strings a task counts before it hands them on
END = -1  # stands for the end among word hashes


def spelled(text: bytes) -> bytes:
    return b" ".join(text.lower().split()) + b"\n"


def cells(texts: list[bytes]) -> np.ndarray:
    """For every byte of the spelled texts, laid end to end, the bytes before it, nearest first, and itself as one number.

    Each text begins as after line ends.
    """
    if not texts:
        return np.zeros(0, np.int64)
    data = np.frombuffer((b"\n" * DEPTH).join([b"", *texts]), np.uint8)
    found = data[DEPTH:].astype(np.int64)
    for back in range(1, DEPTH + 1):
        found |= data[DEPTH - back:data.size - back].astype(np.int64) << 8 * (DEPTH + 1 - back)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + DEPTH) - sizes - DEPTH
    real = np.ones(found.size, bool)
    real[(starts[1:, None] - np.arange(1, DEPTH + 1)).ravel()] = False
    return found[real]


def counts(docs: DataFrame, text: str = "text", held_out: str = "held_out") -> DataFrame:
    """Rows (kind, key, n): words by hash, with one END per text, and strings of bytes, counted over the texts not held out.

    Strings that only the texts held out have are rows with n = 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {WORD: [], BYTE: []}

        def fold(kind: int) -> tuple[np.ndarray, np.ndarray]:
            keys, n = (np.concatenate(x) for x in zip(*held[kind], strict=True))
            order = np.argsort(keys)
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:keys.size])
            held[kind] = [(keys[first], np.add.reduceat(n, first) if first.size else n)]
            return held[kind][0]

        def flush(kind: int) -> pa.RecordBatch:
            keys, n = fold(kind)
            held[kind] = []
            return pa.record_batch({"kind": pa.array(np.full(keys.size, kind, np.int32)), "key": pa.array(keys), "n": pa.array(n)})

        for batch in slices(batches, text, SLICE):
            texts, out = text_bytes(batch.column(text)), batch.column(held_out).to_pylist()
            learnt, told = [t for t, o in zip(texts, out, strict=True) if o is False], [
                t for t, o in zip(texts, out, strict=True) if o is not False]
            words = np.concatenate([*word_hashes(learnt), np.full(len(learnt), END).view(np.uint64)]).view(np.int64)
            held[WORD].append(np.unique(words, return_counts=True))
            held[BYTE].append(np.unique(cells([spelled(t) for t in learnt]), return_counts=True))
            unseen = np.unique(cells([spelled(t) for t in told]))
            held[BYTE].append((unseen, np.zeros(unseen.size, np.int64)))
            for kind in held:
                if sum(len(keys) for keys, _ in held[kind]) > 2 * HELD[kind] and len(fold(kind)[0]) > HELD[kind]:
                    yield flush(kind)
        for kind in held:
            if held[kind]:
                yield flush(kind)

    return docs.select(text, held_out).mapInArrow(run, "kind int, key bigint, n bigint").groupBy("kind", "key").agg(
        F.sum("n").alias("n"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series, moved up by 8."""
    low = np.log(reduce(np.multiply, [x + i for i in range(8)]))
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - low


def _estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of a sequence with these counts, by Krichevsky and Trofimov."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - np.log(np.pi)


def _decisions(cell: np.ndarray, n: np.ndarray, level: int) -> tuple[np.ndarray, ...]:
    """One of the eight decisions of ascending strings: contexts << 8 | decision node, their zeros and ones, and of each
    string its place there and its own decision."""
    byte = cell & 255
    bit = byte >> 7 - level & 1
    code = cell >> 8 << 8 | 1 << level | byte >> 8 - level
    new = np.concatenate([[True], code[1:] != code[:-1]])
    first = np.flatnonzero(new)
    zeros, ones = (np.add.reduceat(np.where(bit == b, n, 0), first).astype(float) for b in (0, 1))
    return code[first], zeros, ones, np.cumsum(new) - 1, bit


def climb(code: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weighted: np.ndarray, rounds: int) -> tuple:
    """Weighs nodes from their children, `rounds` levels up, dropping the farthest byte at each.

    Returns the nodes reached (code, zeros, ones, weighted) and per level what `descend` needs.
    """
    levels = []
    for _ in range(rounds):
        code, above = np.unique(code >> 16 << 8 | code & 255, return_inverse=True)
        zeros, ones, below = (np.bincount(above, x, code.size) for x in (zeros, ones, weighted))
        own = _estimate(zeros, ones)
        weighted = np.logaddexp(own, below) - np.log(2)
        levels.append((np.exp(own - np.log(2) - weighted), (ones + 0.5) / (zeros + ones + 1), above))
    return code, zeros, ones, weighted, levels


def descend(levels: list, going: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Takes the weight not yet spent and the probability of a one gathered so far down to the nodes `climb` began at."""
    for stop, share, above in reversed(levels):
        found, going = found + going * stop * share, going * (1 - stop)
        found, going = found[above], going[above]
    return going, found


def _ascending(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    cell, n = part.column("key").to_numpy(), part.column("n").to_numpy()
    order = np.argsort(cell)
    return cell[order], n[order]


def _slot(cell: np.ndarray, turn: int, bits: int) -> np.ndarray:
    return (cell.view(np.uint64) * TURNS[turn] >> np.uint64(64 - bits)).view(np.int64)


def placed(cell: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash table of strings in order of frequency, half full at most: each lies at the first of its places that is free."""
    bits = max(1, (2 * cell.size - 1).bit_length())
    keys, values = np.full(1 << bits, -1), np.zeros(1 << bits)
    for turn in range(len(TURNS)):
        slot, first = np.unique(_slot(cell, turn, bits), return_index=True)
        first = first[keys[slot] < 0]
        slot = _slot(cell[first], turn, bits)
        keys[slot], values[slot] = cell[first], logs[first]
        cell, logs = np.delete(cell, first), np.delete(logs, first)
    return keys, values


def found_in(keys: np.ndarray, values: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every string its log probability, 0 if it is not in the table, and the places of those that are not."""
    bits = keys.size.bit_length() - 1
    slot = _slot(cell, 0, bits)
    logs = values[slot]
    left = np.flatnonzero(keys[slot] != cell)
    for turn in range(1, len(TURNS)):
        slot = _slot(cell[left], turn, bits)
        logs[left] = values[slot]
        left = left[keys[slot] != cell[left]]
    logs[left] = 0
    return logs, left


def _below(part: pa.Table) -> pa.Table:
    """Weighs the subtrees of a group."""
    cell, n = _ascending(part)
    out = []
    for level in range(8):
        code, zeros, ones, _, _ = _decisions(cell, n, level)
        out.append(climb(code, zeros, ones, _estimate(zeros, ones), DEPTH - SPLIT)[:4])
    code, zeros, ones, weighted = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.table({"node": pa.array(code & 255, pa.int32()), "code": pa.array(code), "zeros": pa.array(zeros),
                     "ones": pa.array(ones), "weighted": pa.array(weighted)})


def _top(part: pa.Table) -> pa.Table:
    """The top levels of one decision node's tree, weighed up and taken down again."""
    order = np.argsort(part.column("code").to_numpy())
    code, zeros, ones, weighted = (part.column(c).to_numpy()[order] for c in ("code", "zeros", "ones", "weighted"))
    levels = climb(code, zeros, ones, weighted, SPLIT)[4]
    going, found = descend(levels, np.ones(1), np.zeros(1))
    return pa.table({"code": pa.array(code), "going": pa.array(going), "found": pa.array(found)})


def _leaves(part: pa.Table, tops: pa.Table) -> pa.Table:
    """The log10 probability of every string's last byte behind the others, from the weights that reach a group's subtrees."""
    cell, n = _ascending(part)
    order = np.argsort(tops.column("code").to_numpy())
    known, going, found = (tops.column(c).to_numpy()[order] for c in ("code", "going", "found"))
    logs = np.zeros(cell.size)
    for level in range(8):
        code, zeros, ones, place, bit = _decisions(cell, n, level)
        roots, _, _, _, levels = climb(code, zeros, ones, _estimate(zeros, ones), DEPTH - SPLIT)
        at = np.searchsorted(known, roots)
        left, share = descend(levels, going[at], found[at])
        share = (share + left * (ones + 0.5) / (zeros + ones + 1))[place]
        logs += np.log10(np.where(bit == 1, share, 1 - share))
    return pa.table({"key": pa.array(cell), "n": pa.array(n), "log": pa.array(logs)})


def fit(counted: DataFrame, group: int = GROUP) -> DataFrame:
    """Rows (key, n, log): the log10 probability of the last byte of every string, from rows of kind BYTE."""
    strings = counted.where(F.col("kind") == BYTE).select("key", "n")
    groups = max(1, -(-strings.count() // group))
    dealt = lambda column, bits: F.pmod(F.hash(F.shiftright(column, bits)), F.lit(groups)).alias("group")
    strings = strings.select("key", "n", dealt("key", 8 * (1 + DEPTH - SPLIT)))
    below = strings.groupBy("group").applyInArrow(_below, "node int, code bigint, zeros double, ones double, weighted double")
    tops = below.groupBy("node").applyInArrow(_top, "code bigint, going double, found double")
    return strings.groupBy("group").cogroup(tops.select("*", dealt("code", 8)).groupBy("group")).applyInArrow(
        _leaves, "key bigint, n bigint, log double")


def _handed_out(spark: SparkSession, fitted: DataFrame, most: int) -> str:
    """The most frequent strings and their log probabilities, in a file that tasks map into memory."""
    best = _frequent(fitted, most, "log")
    order = np.lexsort((best[0], -best[1]))
    keys, logs = placed(best[0][order], best[2][order])
    path = shared_path(spark, "byte-model")
    store, place = filesystem(path)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    with store.open_output_stream(place, compression=None) as out:
        out.write(keys.tobytes())
        out.write(logs.tobytes())
    spark.sparkContext.addFile(path)
    return path.rpartition("/")[2]


def _frequent(rows: DataFrame, most: int, *more: str) -> list[np.ndarray]:
    """Keys, ascending, counts and further columns of the rows from some count on, `most` at the most."""
    held, floor = 0, None
    levels = rows.groupBy("n").agg(F.count("*").alias("rows"))
    for row in levels.orderBy(F.desc("n")).limit(most).toLocalIterator():
        held += row.rows
        if held > most:
            break
        floor = row.n
    found = rows.where(F.lit(False) if floor is None else F.col("n") >= floor).select("key", "n", *more).toArrow()
    columns = [found.column(c).to_numpy() for c in ("key", "n", *more)]
    order = np.argsort(columns[0])
    return [c[order] for c in columns]


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", strings: int = STRINGS,
          group: int = GROUP) -> DataFrame:
    """Scores every text, learning from those that are not held out.

    Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"))
    counted = stored(counts(rows), "counts")
    words = counted.where(F.col("kind") == WORD).select("key", "n")
    whole = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, below = whole.n, whole.n + 0.5 * (whole.v + 1)
    frequent = spark.sparkContext.broadcast(_frequent(words, FREQUENT))
    fitted = stored(fit(counted, group), "strings")
    name = _handed_out(spark, fitted, strings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = np.asarray(np.memmap(SparkFiles.get(name), np.int64, "r"))
        held, held_logs = model[:model.size // 2], model[model.size // 2:].view(np.float64)
        keys, n = frequent.value
        logs = np.log10((n + 0.5) / below)
        for batch in slices(batches, "text", SLICE):
            texts = text_bytes(batch.column("text"))
            lines = [np.append(h.view(np.int64), END) for h in word_hashes(texts)]
            sizes = np.fromiter(map(len, lines), np.int64, len(lines))
            tokens, owner = np.concatenate(lines), np.repeat(np.arange(len(lines)), sizes)
            at = np.minimum(np.searchsorted(keys, tokens), max(keys.size - 1, 0))
            known = keys[at] == tokens if keys.size else np.zeros(tokens.size, bool)
            base = np.bincount(owner[known], logs[at[known]], len(lines))
            rare = np.concatenate([[0], np.cumsum(np.bincount(owner[~known], minlength=len(lines)))])
            spellings = [spelled(t) for t in texts]
            lengths = np.fromiter(map(len, spellings), np.int64, len(texts))
            starts = np.cumsum(lengths) - lengths
            seen = cells(spellings)
            parts, missed = found_in(held, held_logs, seen)
            left = np.searchsorted(missed, np.append(starts, seen.size))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "n_tokens": pa.array(sizes),
                "frequent": pa.array(np.bincount(owner[known], minlength=len(lines)).astype(np.int64)), "base": pa.array(base),
                "score": pa.array(np.add.reduceat(parts, starts)), "n_bytes": pa.array(lengths),
                "rare": pa.ListArray.from_arrays(pa.array(rare, pa.int32()), pa.array(tokens[~known])),
                "strange": pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(seen[missed]))})

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens bigint, frequent bigint, base double, score double, "
                                  "n_bytes bigint, rare array<bigint>, strange array<bigint>")
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    n = F.coalesce("n", F.lit(0))
    times = lambda keys: scored.select("row", F.explode(keys).alias("key")).groupBy("row", "key").agg(
        F.count("*").alias("times"))
    of_words = times("rare").join(words, "key", "left").select(
        "row", (F.col("times") * F.log10((n + 0.5) / below)).alias("base"), F.when(n > 0, F.col("times")).otherwise(0).alias("known"),
        F.lit(0.0).alias("log"))
    of_strings = times("strange").join(fitted.select("key", "log"), "key").select(
        "row", F.lit(0.0).alias("base"), F.lit(0).cast("bigint").alias("known"), (F.col("times") * F.col("log")).alias("log"))
    looked_up = of_words.unionAll(of_strings).groupBy("row").agg(
        F.sum("base").alias("rare_base"), F.sum("known").alias("rare_known"), F.sum("log").alias("rare_log"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    score = F.col("score") + zero("rare_log")
    return scored.join(looked_up, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("frequent") + zero("rare_known")).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"), (F.col("base") + zero("rare_base")).alias("base_score"), score.alias("score"),
        "n_bytes", (-score / F.col("n_bytes") / float(np.log10(2))).alias("bits_per_byte"))


def fold(doc_id: str | Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo `folds`."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds
