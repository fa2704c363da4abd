"""Secrets found by one automaton over all rules.

The rules are compiled once into a combined deterministic automaton (`automaton.Scanner`); every text is read once, from
its end, and only where a match begins is a single rule followed to the match's end. Some rules put a further
condition on a match; one that fails it is dropped and its bytes are not searched again.

Defined results: a null or empty text has no spans; repeated rows have equal spans; an empty table gives an empty
table; further columns are kept. Spans count code points, the end exclusive, ordered by start, then by rule.
"""

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructField, StructType

from .automaton import Scanner
from .common import slices, text_bytes

BLOCK = 1 << 16


def _assigned(match: bytes) -> bool:
    """Whether the assigned value has 6 or more characters."""
    sign = min(i for i in (match.find(b"="), match.find(b":")) if i >= 0)
    return len(match[sign + 1:].lstrip(b" ").lstrip(b"\"'")) >= 6


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    holds: Callable[[bytes], bool] | None = None


# Order decides between spans that start together. The first three are the base rules.
RULES: tuple[Rule, ...] = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", _assigned),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: len(m) >= 20),
    # runs of 24 at least: a shorter run is a failing match and can hold no other
    Rule("hex", r"[0-9a-f]{24}[0-9a-f]*"),
    Rule("private_key", r"-----BEGIN (RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY( BLOCK)?-----"),
    Rule("code_host", r"(gh[pousr]_|github_pat_|glpat-)[A-Za-z0-9_-]+", lambda m: len(m) >= 24),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", lambda m: len(m) >= 15),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
BASE = ("assign", "access", "hex")
SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def _points(data: bytes, offset: int, block: list[int]) -> int:
    """Code points before a byte offset, counted from the nearest block border below it."""
    whole = offset // BLOCK
    while len(block) <= whole:
        piece = data[(len(block) - 1) * BLOCK:len(block) * BLOCK]
        block.append(block[-1] + len(piece) - sum(1 for b in piece if 128 <= b < 192))
    rest = data[whole * BLOCK:offset]
    return block[whole] + (len(rest) if rest.isascii() else sum(1 for b in rest if not 128 <= b < 192))


def find(scanner: Scanner, rules: Sequence[Rule], data: bytes) -> list[tuple[int, int, int]]:
    """(byte start, byte end, rule) of every secret, by start, then rule."""
    found = []
    for i, spans in enumerate(scanner.spans(data)):
        holds = rules[i].holds
        found.extend((a, b, i) for a, b in spans if holds is None or holds(data[a:b]))
    return sorted(found, key=lambda x: (x[0], x[2]))


def secret_spans(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, column: str = "secrets") -> DataFrame:
    """The input with an array of (kind, start, end). No shuffle; each text is scanned where it is read."""
    rules = tuple(rules)
    scanner = Scanner([r.pattern for r in rules])

    def spans_of(data: bytes) -> list[dict]:
        found, block = find(scanner, rules, data), [0]
        if data.isascii():
            return [{"kind": rules[i].kind, "start": a, "end": b} for a, b, i in found]
        return [{"kind": rules[i].kind, "start": _points(data, a, block), "end": _points(data, b, block)} for a, b, i in found]

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            spans = [spans_of(data) for data in text_bytes(batch.column(text))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], [*batch.schema.names, column])

    if column in docs.columns:
        raise ValueError(f"the input has a column {column} already")
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(column, DataType.fromDDL(SPAN))]))


def masked(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, length: str | None = "n_chars") -> DataFrame:
    """The input with secrets replaced in its text, and `length`, if it is a column, set anew where the text changed."""
    rules = tuple(rules)
    scanner = Scanner([r.pattern for r in rules])
    names = docs.columns
    counts = names.index(length) if length in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text)
        for batch in slices(batches, text):
            texts, columns = batch.column(at).to_pylist(), list(batch.columns)
            sizes = columns[counts].to_pylist() if counts is not None else None
            for i, data in enumerate(text_bytes(batch.column(at))):
                if found := find(scanner, rules, data):
                    kept, last = [], 0
                    for a, b, _ in found:
                        if a > last or not kept:
                            kept += [data[last:a], b"[SECRET]"]
                        last = max(last, b)
                    texts[i] = b"".join([*kept, data[last:]]).decode()
                    if sizes is not None:
                        sizes[i] = len(texts[i])
            columns[at] = pa.array(texts, columns[at].type)
            if sizes is not None:
                columns[counts] = pa.array(sizes, columns[counts].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
