"""A minimal acyclic transducer from words to id sequences, in one file that tasks map into memory.

Words are added in byte order; once a branch is left it is closed, and a closed state equal to an earlier one is
replaced by it, so that common endings are stored once. Every edge carries how many words its smaller neighbours lead
to; the sum along a path numbers the words, and the number finds the word's ids.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterable, Sequence

import numpy as np

_PARTS = [("keys", np.uint64), ("skips", np.int64), ("offsets", np.int64), ("targets", np.int32), ("ids", np.int32),
          ("final", np.uint8)]


def compile_lexicon(entries: Iterable[tuple[bytes, Sequence[int]]]) -> bytes:
    """The file's bytes. `entries`: distinct words with their ids, ascending by bytes."""
    register: dict[tuple, int] = {}
    edges: list[tuple] = []
    final: list[int] = []
    reach: list[int] = []
    path: list[list] = [[0, []]]  # unfinished states: ends a word, edges so far
    labels: list[int] = []
    offsets, ids, last = [0], [], None

    def close(depth: int) -> None:
        while len(path) > depth:
            ends, out = path.pop()
            key = (ends, tuple(out))
            state = register.get(key)
            if state is None:
                state = register[key] = len(edges)
                edges.append(key[1])
                final.append(ends)
                reach.append(ends + sum(reach[t] for _, t in out))
            if path:
                path[-1][1].append((labels.pop(), state))

    for word, codes in entries:
        if last is not None and word <= last:
            raise ValueError("words must be distinct and ascending")
        shared = 0
        for a, b in zip(word, last or b"", strict=False):
            if a != b:
                break
            shared += 1
        close(shared + 1)
        for byte in word[shared:]:
            labels.append(byte)
            path.append([0, []])
        path[-1][0] = 1
        last = word
        ids.extend(codes)
        offsets.append(len(ids))
    close(0)

    keys, targets, skips = [], [], []
    for state, out in enumerate(edges):
        before = final[state]
        for label, target in out:
            keys.append(state << 8 | label)
            targets.append(target)
            skips.append(before)
            before += reach[target]
    found = {"keys": keys, "skips": skips, "offsets": offsets, "targets": targets, "ids": ids, "final": final}
    arrays = [np.asarray(found[name], kind) for name, kind in _PARTS]
    return np.array([a.size for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """The compiled file, mapped into memory. The last state is where words begin."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        sizes, at = np.frombuffer(data, np.int64, len(_PARTS)), 8 * len(_PARTS)
        for (name, kind), size in zip(_PARTS, sizes.tolist(), strict=True):
            setattr(self, name, np.frombuffer(data, kind, size, at))
            at += size * np.dtype(kind).itemsize

    def find(self, words: Sequence[bytes]) -> np.ndarray:
        """Each word's number, or -1. All words take their next byte together."""
        out = np.full(len(words), -1, np.int64)
        if not len(words) or not self.keys.size:
            return out
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        if self.final[-1]:
            out[lengths == 0] = 0
        live = np.flatnonzero(lengths)
        state = np.full(live.size, self.final.size - 1, np.int64)
        number = np.zeros(live.size, np.int64)
        step = 0
        while live.size:
            keys = state.astype(np.uint64) << np.uint64(8) | data[starts[live] + step].astype(np.uint64)
            edge = np.minimum(np.searchsorted(self.keys, keys), self.keys.size - 1)
            known = self.keys[edge] == keys
            live, edge = live[known], edge[known]
            state, number = self.targets[edge].astype(np.int64), number[known] + self.skips[edge]
            step += 1
            ended = lengths[live] == step
            whole = ended & (self.final[state] == 1)
            out[live[whole]] = number[whole]
            live, state, number = live[~ended], state[~ended], number[~ended]
        return out
