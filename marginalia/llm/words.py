"""Words of many texts at once: their bounds, hashes and shingle sets, with NumPy on the bytes.

A word's hash is a polynomial of its bytes' random 64-bit values, read off running sums, so there
is no Python object for a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

ODD = np.uint64(0x9E3779B97F4A7C13)
SECOND = np.uint64(0xD1342543DE82EF95)
CHUNK_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
VALUES = np.random.Generator(np.random.Philox(key=[5, 11])).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = VALUES.copy()
LOWER[65:91] = VALUES[97:123]
_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64, kept for the usual chunk."""
    size = 1 << max(n, CHUNK_BYTES + (1 << 16)).bit_length()
    key = (int(base), size)
    if key not in _POWERS:
        with np.errstate(over="ignore"):
            out = np.full(size, base)
            out[0] = 1
            np.multiply.accumulate(out, out=out)
        if size > 1 << 22:  # a very long word: not kept
            return out[:n]
        _POWERS[key] = out
    return _POWERS[key][:n]


def forget() -> None:
    """Drops the powers that were kept."""
    _POWERS.clear()


def _inverse(x: np.uint64) -> np.uint64:
    return np.uint64(pow(int(x), -1, 1 << 64))


DOWN = _inverse(ODD)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte after it."""
    space = SPACE[np.frombuffer(data, np.uint8)]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(space) and not space[0]:
        edge = np.concatenate([[0], edge])
    if len(edge) % 2:
        edge = np.append(edge, len(space))
    return edge[0::2], edge[1::2]


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = VALUES) -> np.ndarray:
    """64-bit hashes of the words of a text; long texts go in pieces that end between words."""
    raw, out, at = np.frombuffer(data, np.uint8), [], 0
    while at < len(starts):
        begin = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, begin + CHUNK_BYTES, "right")))
        a, b = starts[at:stop] - begin, ends[at:stop] - begin
        n = int(b[-1])
        with np.errstate(over="ignore"):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(values[raw[begin : begin + n]] * _powers(DOWN, n), out=total[1:])
            out.append(mix((total[b] - total[a]) * _powers(ODD, n)[a]))
        at = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def runs(hashes: np.ndarray, width: int, factor: np.uint64 = ODD) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` consecutive words, put together from runs of
    powers of two."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, piece, size = np.zeros(n, np.uint64), 0, hashes, 1
    with np.errstate(over="ignore"):
        while True:
            power = np.uint64(pow(int(factor), size, 1 << 64))
            if width & size:
                out *= power
                out += piece[done : done + n]
                done += size
            if done == width:
                return mix(out)
            piece = piece[:-size] * power + piece[size:]
            size *= 2


class Frequent:
    """Weights of frequent hashes: the bit length of their counts, 0 for all others."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys = keys[order]
        self.weight = np.array([int(n).bit_length() for n in counts], np.uint8)[order]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(keys & np.uint64(0x3FFFFF)).astype(np.int64)] = True

    def weights(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int64)
        at = np.flatnonzero(self.maybe[(hashes & np.uint64(0x3FFFFF)).astype(np.int64)])
        if len(at):
            place = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
            out[at] = np.where(self.keys[place] == hashes[at], self.weight[place], 0)
        return out


@dataclass
class Chunk:
    """Some rows: ids, texts as bytes, their words' bounds in ``data`` and hashes; the words of
    text i are numbers first[i] to first[i + 1]."""

    ids: list
    texts: list[bytes]
    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def chunks(batches: Iterator[pa.RecordBatch], values: np.ndarray = VALUES, id_at: int | None = 0, text_at: int = 1) -> Iterator[Chunk]:
    """The rows of batches in pieces of about CHUNK_BYTES of text; a null text has no words."""
    for batch in batches:
        ids, column, at = [None] * batch.num_rows if id_at is None else batch.column(id_at).to_pylist(), batch.column(text_at), 0
        while at < len(ids):
            texts, size, begin = [], 0, at
            while at < len(ids) and (not texts or size < CHUNK_BYTES):
                texts.append(column[at].as_py() or b"")
                size += len(texts[-1]) + 1
                at += 1
            data = b" ".join(texts)
            starts, ends = word_bounds(data)
            offsets = np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts])])
            yield Chunk(ids[begin:at], texts, data, starts, ends, word_hashes(data, starts, ends, values), np.searchsorted(starts, offsets))


def shingle_sets(chunk: Chunk, width: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles; a shorter text is
    one shingle, a text without words has none."""
    all_runs = runs(chunk.hashes, width)
    for a, b in zip(chunk.first[:-1].tolist(), chunk.first[1:].tolist()):
        if b - a >= width:
            s = np.sort(all_runs[a : b - width + 1])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        else:
            yield mix(runs(chunk.hashes[a:b], b - a), b - a) if b > a else np.zeros(0, np.uint64)
