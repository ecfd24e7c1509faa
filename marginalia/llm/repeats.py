"""Substring dedup over super-k-mers.

A window is ``WINDOW`` consecutive words of a document; every word that lies in a window whose
words also start earlier (smaller doc_id, or earlier in the same document) is removed. Each window
is dealt out by its minimiser, the least of its ``MINI``-word runs; consecutive windows that share
one travel together as one packed string. In its bucket the windows of all strings are sorted and
every occurrence but the first is reported.

The order of minimisers puts runs that are frequent in the corpus last, so windows at the edge of a
common passage are dealt by a rare run and those inside it pack into the same strings in all
documents. A task ships equal strings once and reports all but the earliest of them itself, so a
common passage costs a bucket one string for each flush of a task and not one for each document.
Where even the rarest run of a window is very frequent, its bucket is split: such windows travel one
by one and are dealt by their own hash, too, over as many buckets as the run's count asks for.

Defined cases: a null or empty text has no words; documents under ``WINDOW`` words lose nothing; a
null doc_id comes before all others; rows with equal doc_id and text get the same result, and of
rows that share only a doc_id the one with the smaller checksum comes first; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import buckets, cut, in_arrow, most_frequent, release, table
from .words import SECOND, Frequent, chunks, mix, runs, word_bounds, word_hashes

WINDOW, MINI = 20, 3
FLUSH_BYTES = 16 << 20
HOT_KEYS, HOT_BLOCK, HOT_LEAST = 262_144, 1_000_000, 8
SPLIT_BITS = 16  # windows whose minimiser occurs 2**SPLIT_BITS times or more are dealt one by one
NO_ID = -(1 << 63)
REMOVED = "doc_id long, sum long, first long, end long"


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block: list[np.ndarray] = []
    size = 0

    def flush() -> pa.RecordBatch:
        nonlocal block, size
        keys, counts = np.unique(np.concatenate(block) if block else np.zeros(0, np.uint64), return_counts=True)
        hot = counts >= HOT_LEAST
        block, size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(keys[hot].view(np.int64)), pa.array(counts[hot].astype(np.int64))], ["key", "n"])

    for chunk in chunks(batches):
        block.append(runs(chunk.hashes, MINI))
        size += len(block[-1])
        if size > HOT_BLOCK:
            yield flush()
    yield flush()


def super_k_mers(hashes: np.ndarray, first: np.ndarray, hot: Frequent) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, end window (exclusive), minimiser and text of each maximal row of windows of
    one text that share a minimiser; windows are numbered by their first word."""
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    run = runs(hashes, MINI)
    least = run >> np.uint64(6) | hot.weights(run).astype(np.uint64) << np.uint64(58)
    size, wide = 1, WINDOW - MINI + 1
    while 2 * size <= wide:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:n], least[wide - size : wide - size + n])
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]
    inside = np.arange(n) + WINDOW <= first[1:][owner]
    change = np.ones(n, bool)
    change[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]
    begin = np.flatnonzero(inside & change)
    stop = np.ones(n, bool)
    stop[:-1] = change[1:] | ~inside[1:]
    return begin, np.flatnonzero(inside & stop) + 1, least[begin], owner[begin]


def _merge(gone: list[tuple]) -> np.ndarray:
    """Intervals (doc_id, sum, first, end), those of one text that touch made one."""
    x = np.array(gone, np.int64)
    x = x[np.lexsort((x[:, 2], x[:, 1], x[:, 0]))]
    group = np.cumsum(np.concatenate([[0], (x[1:, :2] != x[:-1, :2]).any(axis=1)]))
    wide = int(x[:, 3].max()) + 1
    reach = np.maximum.accumulate(x[:, 3] + group * wide) - group * wide
    new = np.ones(len(x), bool)
    new[1:] = (group[1:] != group[:-1]) | (x[1:, 2] > reach[:-1])
    at = np.flatnonzero(new)
    out = x[at]
    out[:, 3] = reach[np.append(at[1:], len(x)) - 1]
    return out


def _pack(hot: Frequent, n_buckets: int, split_bits: int = SPLIT_BITS):
    """Rows (bucket, removed, data): packed strings of a bucket, or intervals known to go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple] = {}
        gone: list[tuple] = []
        squeeze = zstandard.ZstdCompressor(level=3)
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, gone, size
            rows = []
            texts = list(held)
            if texts:
                order = list(held.values())
                where = np.array([x[4] for x in order], np.int64)
                ids, starts = np.array([x[0] for x in order], np.int64), np.array([x[1] for x in order], np.int64)
                sums, counts = np.array([x[2] for x in order], np.uint32), np.array([x[3] for x in order], np.int32)
                by = np.argsort(where, kind="stable")
                edges = np.flatnonzero(np.concatenate([[True], where[by][1:] != where[by][:-1], [True]]))
                for a, b in zip(edges[:-1], edges[1:]):
                    own = by[a:b]
                    head = len(own).to_bytes(8, "little") + ids[own].tobytes() + starts[own].astype(np.int32).tobytes() + sums[own].tobytes() + counts[own].tobytes()
                    rows.append((int(where[own[0]]), False, squeeze.compress(head + b" ".join([texts[i] for i in own.tolist()]))))
            if gone:
                some = _merge(gone)
                rows += [((int(some[a, 0]) + a) % n_buckets, True, some[a : a + 8192].tobytes()) for a in range(0, len(some), 8192)]
            held, gone, size = {}, [], 0
            columns = list(zip(*rows)) or [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.binary())], ["bucket", "removed", "data"])

        for chunk in chunks(batches):
            begin, end, least, owner = super_k_mers(chunk.hashes, chunk.first, hot)
            bits = (least >> np.uint64(58)).astype(np.int64)
            if (bits > split_bits).any():
                n = np.where(bits > split_bits, end - begin, 1)
                whole = np.repeat(bits <= split_bits, n)
                begin = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                end = np.where(whole, np.repeat(end, n), begin + 1)
                least, owner, bits = np.repeat(least, n), np.repeat(owner, n), np.repeat(bits, n)
                ways = (np.uint64(1) << np.maximum(bits - split_bits, 0).astype(np.uint64)) - np.uint64(1)
                least = np.where(whole, least, mix(least, 6) + (mix(runs(chunk.hashes, WINDOW)[begin], 7) & ways))
            where = (mix(least, 5) >> np.uint64(1)).astype(np.int64) % n_buckets
            lo, hi = chunk.starts[begin].tolist(), chunk.ends[end + WINDOW - 2].tolist()
            place, words = (begin - chunk.first[owner]).tolist(), (end - begin + WINDOW - 1).tolist()
            checksums, data = [zlib.crc32(x) for x in chunk.texts], chunk.data
            for a, b, i, at, n, bucket in zip(lo, hi, owner.tolist(), place, words, where.tolist()):
                string, new = data[a:b], (chunk.ids[i], at, checksums[i], n, bucket)
                old = held.setdefault(string, new)
                if old is not new and old[:3] != new[:3]:
                    if new[:3] < old[:3]:
                        held[string], new = new, old
                    gone.append((new[0], new[2], new[1], new[1] + n))
            size += len(data)
            if size > FLUSH_BYTES:
                yield flush()
        yield flush()

    return run


def _intervals(ids: np.ndarray, sums: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """Windows that go, as intervals of words; windows of adjoining starts are one interval."""
    order = np.lexsort((starts, sums, ids))
    ids, sums, starts = ids[order], sums[order], starts[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (sums[1:] != sums[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(ids)) - 1
    return _removed(ids[first], sums[first].astype(np.int64), starts[first], starts[last] + WINDOW)


def _removed(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in REMOVED.split(", ")])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets come sorted; intervals of all windows but the first of each content."""
    squeeze = zstandard.ZstdDecompressor()
    now, parts = None, []

    def close() -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        h1, h2, ids, sums, starts = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(h1)
        again = np.concatenate([[False], h1[order][1:] == h1[order][:-1]])
        again[:-1] |= again[1:]
        some = order[again]  # windows whose first hash is not unique
        if len(some):
            some = some[np.lexsort((sums[some], starts[some], ids[some], h2[some], h1[some]))]
            same = (h1[some][1:] == h1[some][:-1]) & (h2[some][1:] == h2[some][:-1])
            head = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(some)), 0))
            later = some[(ids[some] != ids[some[head]]) | (starts[some] != starts[some[head]]) | (sums[some] != sums[some[head]])]
            if len(later):
                yield _intervals(ids[later], sums[later], starts[later])

    for batch in batches:
        for bucket, removed, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if removed:
                yield _removed(*np.frombuffer(data.as_py(), np.int64).reshape(-1, 4).T)
                continue
            if bucket != now:
                yield from close()
                now, parts = bucket, []
            raw = squeeze.decompress(data.as_py())
            n = int.from_bytes(raw[:8], "little")
            ids, starts = np.frombuffer(raw, np.int64, n, 8), np.frombuffer(raw, np.int32, n, 8 + 8 * n).astype(np.int64)
            sums, counts = np.frombuffer(raw, np.uint32, n, 8 + 12 * n), np.frombuffer(raw, np.int32, n, 8 + 16 * n).astype(np.int64)
            text = raw[8 + 20 * n :]
            h = word_hashes(text, *word_bounds(text))
            edge = np.cumsum(counts) - counts
            windows = counts - WINDOW + 1
            inside = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
            at = np.repeat(edge, windows) + inside
            parts.append((runs(h, WINDOW)[at], runs(h, WINDOW, SECOND)[at], np.repeat(ids, windows), np.repeat(sums, windows), np.repeat(starts, windows) + inside))
    yield from close()


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(1), batch.column(2).to_pylist()):
            words = (text.as_py() or b"").split()
            if spans:
                stay = np.ones(len(words), bool)
                for s in spans:
                    stay[s["first"] : s["end"]] = False
                kept = [w for w, k in zip(words, stay.tolist()) if k]
            else:
                kept = words
            out.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
        columns = list(zip(*out)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["doc_id", "n_words", "n_removed", "kept"])


def removed_intervals(docs: DataFrame, parts: int, split_bits: int = SPLIT_BITS) -> DataFrame:
    """doc_id (NO_ID for null), checksum of the text, and an interval of words that go.
    ``split_bits`` sets from which count on a minimiser's windows are split; it changes no result."""
    spark = docs.sparkSession
    counts = docs.transform(in_arrow, _frequent, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    hot = Frequent(*most_frequent(counts, HOT_KEYS))
    packed = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text").transform(in_arrow, _pack(hot, 4 * parts, split_bits), "bucket int, removed boolean, data binary")
    gone = cut(packed.repartition(parts, "bucket").sortWithinPartitions("bucket").transform(in_arrow, _count, REMOVED), "gone")
    del packed
    release(spark)
    return gone


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", split_bits: int = SPLIT_BITS) -> DataFrame:
    """doc_id, n_words, n_removed, kept: the words that stay, joined by one blank."""
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    spans = removed_intervals(whole, buckets(whole, "text", 16 << 20), split_bits).groupBy(F.col("doc_id").alias("id"), F.col("sum")).agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    here = whole.withColumns({"id": F.coalesce("doc_id", F.lit(NO_ID)), "sum": F.coalesce(F.crc32("text"), F.lit(0))})
    joined = here.join(spans, ["id", "sum"], "left").select("doc_id", "text", "spans")
    return joined.transform(in_arrow, _keep, "doc_id long, n_words long, n_removed long, kept string")


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of earlier windows, as a digest."""
    kept = drop_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w WHERE len(w) >= 20)),
g AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM v) WHERE k > 1),
o AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 20)))) AS gone FROM g GROUP BY doc_id),
k AS (SELECT w.doc_id, w, coalesce(gone, []) AS gone, CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END AS kept FROM w LEFT JOIN o USING (doc_id))
SELECT doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""
