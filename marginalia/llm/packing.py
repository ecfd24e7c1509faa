"""Packing by minimum bin slack.

Documents become token ids; whole windows of ``capacity`` leave at once and the rest of each
document waits in a pool of bounded size. Each window is seeded with the longest waiting piece,
then a bitset subset-sum over the multiset of waiting lengths finds the sum closest to the room
left; stored layers are walked back to learn how many pieces of each length to take. Should slack
remain, one piece is cut to fill it. What remains at the end of a partition is cut at powers of
two, which need no padding.

The work is map-only: each input partition packs its own documents, there is no shuffle, and a
partition that is run again after a lost executor gives the same rows.

Defined cases: a null or empty text is a document of the end identifier alone; rows that repeat
are packed as often as they occur; a null doc_id is kept; an empty table gives no rows; further
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_arrow, table
from .tokens import CACHE_WORDS, word_ids

CAPACITY = 4096
END = 2
POOL_WINDOWS = 256
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def closest_fill(lengths: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length to take so that their sum is as close to ``room`` as can be.

    ``lengths`` maps a length to the number of pieces that have it. Bit s of ``reach`` says that
    the sum s can be made; a layer is stored for each power of two of a length's count.
    """
    full, reach, layers = 1 << room, 1, []
    mask = (full << 1) - 1
    for length in sorted((x for x in lengths if x <= room), reverse=True):
        left, step = min(lengths[length], room // length), 1
        while left:
            step = min(step, left)
            after = (reach | reach << (length * step)) & mask
            if after != reach:
                layers.append((length, step, reach))
                reach = after
                if reach & full:
                    break
            left -= step
            step *= 2
        if reach & full:
            break
    at, take = reach.bit_length() - 1, {}
    for length, step, before in reversed(layers):
        if not before >> at & 1:
            take[length] = take.get(length, 0) + step
            at -= length * step
    return take


class Packer:
    """Packs the documents of one partition; ``rows`` collects the finished pieces."""

    def __init__(self, capacity: int, first: int) -> None:
        self.capacity, self.sequence, self.waiting = capacity, first, 0
        self.pool: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def _put(self, piece: tuple) -> None:
        length = len(piece[2]) // 4
        self.pool.setdefault(length, []).append(piece)
        self.waiting += length

    def _take(self, length: int) -> tuple:
        pieces = self.pool[length]
        piece = pieces.pop()
        if not pieces:
            del self.pool[length]
        self.waiting -= length
        return piece

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids) // 4, ids, total, self.sequence, offset))
            offset += len(ids) // 4
        self.sequence += 1

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, step = len(ids) // 4, 4 * self.capacity
        whole = len(ids) // step * step
        for i in range(0, whole, step):
            self._emit([(doc_id, i // 4, ids[i : i + step], total)])
        if whole < len(ids):
            self._put((doc_id, whole // 4, ids[whole:], total))
            if self.waiting > 2 * POOL_WINDOWS * self.capacity:
                self.fill(POOL_WINDOWS * self.capacity)

    def fill(self, keep: int) -> None:
        """Fills windows while at least one can be filled and more than ``keep`` tokens wait."""
        while self.waiting > keep and self.waiting >= self.capacity:
            window = [self._take(max(self.pool))]
            room = self.capacity - len(window[0][2]) // 4
            if room:
                counts = {length: len(pieces) for length, pieces in self.pool.items()}
                for length, n in closest_fill(counts, room).items():
                    window += [self._take(length) for _ in range(n)]
                    room -= n * length
            if room:
                doc_id, start, ids, total = self._take(min((x for x in self.pool if x > room), default=max(self.pool)))
                window.append((doc_id, start, ids[: 4 * room], total))
                self._put((doc_id, start + room, ids[4 * room :], total))
            self._emit(window)

    def finish(self) -> None:
        self.fill(0)
        pieces = [p for length in sorted(self.pool, reverse=True) for p in self.pool[length]]
        self.pool, left, self.waiting = {}, self.waiting, 0
        while left:
            size = 1 << left.bit_length() - 1
            window, left = [], left - size
            while size:
                doc_id, start, ids, total = pieces.pop(0)
                n = min(size, len(ids) // 4)
                window.append((doc_id, start, ids[: 4 * n], total))
                if 4 * n < len(ids):
                    pieces.insert(0, (doc_id, start + n, ids[4 * n :], total))
                size -= n
            self._emit(window)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end: int = END, capacity: int = CAPACITY, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Pieces of sequences: doc_id, start, length, ids (unsigned 32-bit, little-endian), doc_tokens,
    sequence_id, offset. ``tokenizer`` is the path of a vocabulary file (default: word_bpe_49k).
    ``cache_words`` trades a worker's memory for time and changes no result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, tail = word_ids(tokenizer, words=cache_words), end.to_bytes(4, "little")
        packer = Packer(capacity, TaskContext.get().partitionId() << 33)
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc_id, got := ids.encode(text.as_py()) + tail)
                size += len(got)
                if size > 8 << 20 and packer.rows:
                    yield _batch(packer.rows)
                    packer.rows, size = [], 0
        packer.finish()
        if packer.rows:
            yield _batch(packer.rows)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary")).transform(in_arrow, run, SCHEMA)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packing of all documents, with a digest in place of the ids."""
    packed = pack(table(spark, sf_dir, "documents"), cache_words=4 * CACHE_WORDS)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
