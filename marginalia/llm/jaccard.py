"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct 5-word shingles; two documents link at a Jaccard similarity
of 0.75 or more. Sets of one size band share a sketch shape: shingles are dealt to parts by a hash
and XOR-ed within their part, so a shingle that only one of two sets has can spoil one part only,
and the number of differing parts bounds the symmetric difference from below. Linked sets A and B
differ in at most d = (|A| + |B|) / 7 shingles; if A fills more than d parts, some filled part is
the same in B, and in any common order of parts it is among the first d + 1 of both. So d + 1
parts of each document and band are joined, those with the rarest shingles first. Candidates whose
bit sketches (parities of all shingles, four to eight bits for each) are further apart than d
are dropped; the others are verified on the whole sets.

Copies (equal sets) are one node. Documents that share a part are first compared with one of them
only. Where they are still in different components, the sketches of all members are compared
between components, and of each two components the nearest pairs that may link are verified, more
in each round, until every pair that shares a part is in one component, ruled out by its
sketches, or verified. Nothing is capped. Groups are cut into blocks by their size, and each two
blocks meet in a task of their own, so a passage that very many documents share, linked or not, is
spread over tasks however its documents fall into components.

Defined cases: null texts and texts without words are empty sets, linked with nothing, component
their own id; fewer than 5 words are one shingle; rows that share a doc_id are one node, also with
different texts, and have one component; a null doc_id takes the component of its copies and is
null without them; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import buckets, cut, drop, in_arrow, most_frequent, release, table
from .graph import components
from .words import LOWER, ODD, Frequent, chunks, mix, shingle_sets

HOT_KEYS = 1 << 20  # shingles that are ordered by frequency; the bound of what is broadcast
HOT_BLOCK, HOT_LEAST = 2_000_000, 3
FLUSH = 500_000
SPARSE_PARTS = 1 << 20
SKETCH_BITS = 1 << 24
CHUNK = 256
SPLIT = 4096  # rows of a block
SALT_BITS = 22
PAIRS = 256  # of two components in the first round
WITHIN = 2  # the side of rows whose pairs within a block are compared


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, np.ndarray]]:
    for chunk in chunks(batches, LOWER):
        yield from zip(chunk.ids, shingle_sets(chunk))


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        return int(mix(s, 1).sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mix(s, 2)).view(np.int64)) if len(s) else 0


def sketch(s: np.ndarray) -> bytes:
    """The parity of the number of shingles at each of a power of two of bits, over 4 |s|: sparse
    enough that few differences cancel out."""
    bits = min(max(64, 1 << (4 * len(s)).bit_length()), SKETCH_BITS)
    counts = np.bincount((mix(s, 11) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def distance(x: bytes, y: bytes) -> int:
    """Hamming distance of two sketches, the longer one folded: a lower bound of |A ^ B|."""
    u, v = (np.frombuffer(z, np.uint64) for z in sorted((x, y), key=len))
    while len(v) > len(u):
        v = v[: len(v) // 2] ^ v[len(v) // 2 :]
    return int(np.bitwise_count(u ^ v).sum())


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (hot, a, b, c, d, sketch): doc_id, set size and fingerprint; or: shingle and count."""
    rows: list[tuple] = []
    block: list[np.ndarray] = []
    size = 0

    def flush() -> pa.RecordBatch:
        nonlocal rows, block, size
        if block:
            keys, counts = np.unique(np.concatenate(block), return_counts=True)
            hot = counts >= HOT_LEAST
            rows += [(True, int(k), int(n), None, None, None) for k, n in zip(keys[hot].view(np.int64), counts[hot])]
        columns = list(zip(*rows)) or [[]] * 6
        kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["hot", "a", "b", "c", "d", "sketch"])
        rows, block, size = [], [], 0
        return out

    for doc_id, s in _texts(batches):
        rows.append((False, doc_id, len(s), *_fingerprint(s), sketch(s)))
        block.append(s)
        size += len(s)
        if size > HOT_BLOCK:
            yield flush()
    yield flush()


def bands_of(n: int) -> list[int]:
    """Bands b, sizes [2**b, 2**(b+1)), in which a set of n shingles can be in a linked pair whose
    larger set lies there."""
    own = n.bit_length() - 1
    return [own, own + 1] if 4 * n >= 3 << own + 1 else [own]


def parts_of(band: int, spread: int = 1) -> int:
    return SPARSE_PARTS * spread if band < 8 else (2 if band < 10 else 1) * spread << band


def signatures(s: np.ndarray, hot: Frequent, spread: int = 1) -> tuple[list[tuple[np.ndarray, np.ndarray]], bool]:
    """The d + 1 rarest parts for each band of a set with the weight of their rarest shingle, and
    whether each band had more than d parts."""
    out, full, n = [], True, len(s)
    weight = hot.weights(s)
    common = weight.any()
    for band in bands_of(n):
        most = min((2 << band) - 1, 4 * n // 3)
        d = (n + most) // 7
        part = mix(s, 3 + band) % np.uint64(parts_of(band, spread))
        order = np.argsort(part)
        part = part[order]
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        full &= len(first) > d
        with np.errstate(over="ignore"):
            sig = mix(np.bitwise_xor.reduceat(s[order], first) + part[first] * ODD, 100 + band)
        if common:
            rare = np.minimum.reduceat(weight[order], first)
            take = np.lexsort((sig, rare))[: d + 1]
        else:
            rare = np.zeros(len(sig), np.int64)
            take = np.argpartition(sig, d)[: d + 1] if len(sig) > d + 1 else slice(None)
        out.append((sig[take], rare[take]))
    return out, full


def _signature_blobs(hot: Frequent, n_buckets: int, spread: int, salt_bits: int):
    """Rows (bucket, salted, sigs, ids): packed signatures and the document of each. Signatures that
    2**salt_bits or more documents may share are dealt out by document, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        rare: list[np.ndarray] = []
        seen: set = set()
        size, short = 0, False

        def flush() -> pa.RecordBatch:
            nonlocal sigs, ids, rare, size
            rows = []
            if sigs:
                s, i, w = np.concatenate(sigs), np.concatenate(ids), np.concatenate(rare)
                bucket = (s >> np.uint64(33)).astype(np.int64) % n_buckets
                salted = w > salt_bits
                if salted.any():
                    salt = mix(i[salted].view(np.uint64), 13) & ((np.uint64(1) << (w[salted] - salt_bits).astype(np.uint64)) - np.uint64(1))
                    bucket[salted] = (mix(s[salted] + salt, 17) >> np.uint64(33)).astype(np.int64) % n_buckets
                order = np.lexsort((salted, bucket))
                s, i, bucket, salted = s[order], i[order], bucket[order], salted[order]
                edges = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (salted[1:] != salted[:-1]), [True]]))
                rows = [(int(bucket[a]), bool(salted[a]), s[a:b].tobytes(), i[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:])]
            if short:
                rows.append((-1, False, b"", b""))
            sigs, ids, rare, size = [], [], [], 0
            columns = list(zip(*rows)) or [[]] * 4
            kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["bucket", "salted", "sigs", "ids"])

        for doc_id, s in _texts(batches):
            if doc_id is None or not len(s) or (f := _fingerprint(s)) in seen:
                continue
            if len(seen) > 200_000:
                seen.clear()
            seen.add(f)
            got, full = signatures(s, hot, spread)
            short |= not full
            for x, w in got:
                sigs.append(x)
                rare.append(w)
                ids.append(np.full(len(x), doc_id, np.int64))
                size += len(x)
            if size > FLUSH:
                yield flush()
        yield flush()

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets come sorted. Rows: a, b, null for a candidate pair (the smallest id of those that
    share a signature, another one); key, chunk, members for sets of three or more; nulls where a
    document filled too few parts. Of a salted signature all members are named, with the signature
    as their key, so that those of other buckets meet them there."""
    now, sigs, ids = (None, False), [], []

    def close() -> Iterator[pa.RecordBatch]:
        if now[0] == -1:
            yield _rows([None], [None], [None])
        elif sigs:
            s = np.frombuffer(b"".join(sigs), np.uint64)
            i = np.frombuffer(b"".join(ids), np.int64)
            order = np.lexsort((i, s))
            s, i = s[order], i[order]
            keep = np.concatenate([[True], (s[1:] != s[:-1]) | (i[1:] != i[:-1])])
            s, i = s[keep], i[keep]
            first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            length = np.diff(np.concatenate([first, [len(s)]]))
            pivot = np.repeat(i[first], length)
            other = np.ones(len(s), bool)
            other[first] = False
            pairs = np.unique(np.stack([pivot[other], i[other]], axis=1), axis=0)
            if len(pairs):
                yield _rows(pairs[:, 0], pairs[:, 1], [None] * len(pairs))
            with np.errstate(over="ignore"):
                key = np.add.reduceat(mix(i.view(np.uint64), 7), first).view(np.int64)
            if now[1]:
                key = s[first].view(np.int64)
            big = np.flatnonzero(length >= (1 if now[1] else 3))
            _, pick = np.unique(key[big], return_index=True)
            out: list[tuple] = []
            for r in big[pick]:
                members = i[first[r] : first[r] + length[r]]
                out += [(int(key[r]), c, members[c : c + CHUNK]) for c in range(0, len(members), CHUNK)]
                if len(out) > 2000:
                    yield _rows(*zip(*out))
                    out = []
            if out:
                yield _rows(*zip(*out))

    for batch in batches:
        for bucket, salted, s, i in zip(*(c.to_pylist() for c in batch.columns)):
            if (bucket, salted) != now:
                yield from close()
                now, sigs, ids = (bucket, salted), [], []
            sigs.append(s)
            ids.append(i)
    yield from close()


def _rows(a, b, members) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(members, pa.list_(pa.int64()))], ["a", "b", "members"])


def _verify_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
            u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.concatenate([u, v])
            both.sort()
            inter = int((both[1:] == both[:-1]).sum())
            linked.append(100 * inter >= 75 * (len(u) + len(v) - inter))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [s for _, s in _texts(iter([batch]))]
        c, d = zip(*map(_fingerprint, got)) if got else ((), ())
        columns = [pa.array([len(s) for s in got], pa.int64()), pa.array(c, pa.int64()), pa.array(d, pa.int64()), pa.array([s.tobytes() for s in got], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["n", "c", "d", "s"])


def _near_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sizes and sketches allow a link."""
    for batch in batches:
        keep = []
        for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "ka", "kb"))):
            keep.append(100 * min(n, m) >= 75 * max(n, m) and distance(x, y) <= (n + m) // 7)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _class() -> Column:
    """The id of a set, from its size and fingerprint."""
    return F.xxhash64("n", "c", "d")


def verify(docs: DataFrame, pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b, linked) for pairs of classes that their sketches do not rule out, on the whole sets."""
    side = lambda x: reps.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"k{x}"))
    near = cut(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ka", "kb").transform(in_arrow, _near_rows, "a long, b long"), "near")
    if near.isEmpty():
        return near.withColumn("linked", F.lit(False))
    ids = cut(near.select(F.col("a").alias("rep")).union(near.select("b")).distinct().join(reps.select("rep", "doc_id"), "rep"), "ids")
    sets = docs.join(ids.select("doc_id").distinct(), "doc_id", "left_semi").transform(in_arrow, _set_rows, "n long, c long, d long, s binary")
    sets = cut(sets.select(_class().alias("rep"), "s").dropDuplicates(["rep"]), "sets")
    joined = near.join(sets.select(F.col("rep").alias("b"), F.col("s").alias("sb")), "b").join(sets.select(F.col("rep").alias("a"), F.col("s").alias("sa")), "a")
    checked = cut(joined.select("a", "b", "sa", "sb").transform(in_arrow, _verify_rows, "a long, b long, linked boolean"), "checked")
    drop(near, ids, sets)
    del joined
    release(docs.sparkSession)
    return checked


def _near_pairs(rows: list[tuple]) -> list[tuple[int, int, int]]:
    """(distance, i, j) of rows (rep, component, size, sketch, side) in different components, and of
    different sides where they have one, that sizes and sketches let through; all sketches of one
    length are compared in NumPy, block by block."""
    by: dict[int, list[int]] = {}
    for i, r in enumerate(rows):
        by.setdefault(len(r[3]), []).append(i)
    comp, size, side = (np.array([r[k] for r in rows]) for k in (1, 2, 4))
    table = {k: (np.array(v), np.frombuffer(b"".join(rows[i][3] for i in v), np.uint64).reshape(len(v), -1)) for k, v in by.items()}
    out = []
    for k, (mine, x) in table.items():
        for wide in (k, 2 * k):
            if wide not in table:
                continue
            other, y = table[wide]
            if wide > k:  # sets that may link differ by less than twice: fold once
                half = y.shape[1] // 2
                y = y[:, :half] ^ y[:, half:]
            step = max(1, 2_000_000 // max(1, y.size))
            for at in range(0, len(mine), step):
                i = mine[at : at + step]
                n, m = size[i][:, None], size[other][None]
                may = (comp[i][:, None] != comp[other][None]) & (100 * np.minimum(n, m) >= 75 * np.maximum(n, m))
                may &= (side[i][:, None] != side[other][None]) | (side[i][:, None] == WITHIN)
                if wide == k:
                    may &= i[:, None] < other[None]
                u, v = np.nonzero(may)
                for lo in range(0, len(u), 1 << 16):
                    a, b = u[lo : lo + (1 << 16)], v[lo : lo + (1 << 16)]
                    h = np.bitwise_count(x[at + a] ^ y[b]).sum(axis=1, dtype=np.int64)
                    ok = h <= (size[i[a]] + size[other[b]]) // 7
                    out += list(zip(h[ok].tolist(), i[a[ok]].tolist(), other[b[ok]].tolist()))
    return out


def _cross_rows(most: int):
    """Rows come sorted by part, then sketches (key null), then members by key and cell. Of each two
    components of a cell up to ``most`` pairs that sizes and sketches let through, those of the
    least distance first; nulls where there were more."""

    def close(rows: list[tuple]) -> list[tuple]:
        taken: dict[tuple, int] = {}
        out = []
        for _, i, j in sorted(_near_pairs(rows)):
            pair = (min(rows[i][0], rows[j][0]), max(rows[i][0], rows[j][0]))
            between = (min(rows[i][1], rows[j][1]), max(rows[i][1], rows[j][1]))
            taken[between] = taken.get(between, 0) + 1
            out.append(pair if taken[between] <= most else (None, None))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, sketches, rows = None, None, {}, []
        for batch in batches:
            out: list[tuple] = []
            for at, key, cell, rep, c, side, n, x in zip(*(col.to_pylist() for col in batch.columns)):
                if (at, key, cell) != (part, *(now or (None, None))):
                    out += close(rows)
                    rows = []
                    if at != part:
                        part, sketches = at, {}
                    now = (key, cell)
                if key is not None:
                    rows.append((rep, c, *sketches[rep], side))
                else:
                    sketches[rep] = (n, x)
            yield _two(sorted(set(out), key=str))
        yield _two(close(rows))

    return run


def _two(pairs: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*pairs)) or [[], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64())], ["a", "b"])


def _cells() -> Column:
    """The cells (cell, side) of a member: a group's largest component is cut into ``wide`` blocks,
    all others together into ``high`` ones. Each block of the one meets each of the others, and of
    the others each two blocks and each block itself."""
    wide, high = F.col("wide"), F.col("high")
    entry = lambda cell, side: F.struct(cell.cast("bigint").alias("cell"), side.cast("int").alias("side"))
    block = lambda n: F.pmod(F.xxhash64("rep"), n)
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
    j = block(high)
    large = F.transform(upto(high), lambda t: entry(block(wide) * high + t, F.lit(0)))
    facing = F.transform(upto(wide), lambda t: entry(t * high + j, F.lit(1)))
    among = F.transform(upto(high), lambda t: entry(wide * high + F.least(j, t) * high + F.greatest(j, t), F.when(t == j, WITHIN).when(j < t, 0).otherwise(1)))
    return F.when(F.col("c") == F.col("big"), large).otherwise(F.concat(facing, among))


def _between(members: DataFrame, reps: DataFrame, tried: DataFrame, parts: int, most: int) -> DataFrame:
    """Untried pairs (a, b) between components of (key, rep, c). Groups are cut into cells of two
    blocks. Cells with the same place of groups with the same least member go to one part, to which
    a sketch travels once, or to as many as their rows need. Tried pairs do not travel, as a set may
    have many and be in many parts: they count among the ``most`` and leave the result."""
    sizes = members.groupBy("key", "c").agg(F.count(F.lit(1)).alias("k"), F.min("rep").alias("least"))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / SPLIT)).cast("bigint")
    groups = sizes.groupBy("key").agg(F.max_by("c", F.struct("k", "c")).alias("big"), F.max("k").alias("most"), F.min("least").alias("least"), F.sum("k").alias("size"))
    groups = groups.withColumns({"wide": blocks(F.col("most")), "high": blocks(F.col("size") - F.col("most"))})
    spread = groups.groupBy("least").agg(F.ceil(F.sum("size") / SPLIT).alias("spread"))
    groups = groups.join(spread, "least")
    rows = members.join(groups, "key").withColumn("x", F.explode(_cells())).select("*", "x.cell", "x.side")
    rows = cut(rows.select(F.pmod(F.xxhash64("least", "cell", F.pmod(F.xxhash64("key"), F.col("spread"))), F.lit(16 * parts)).cast("int").alias("part"), "key", "cell", "rep", "c", "side"), "dealt")
    here = cut(rows.select("part", "rep").distinct(), "here")
    columns = (("key", "bigint"), ("cell", "bigint"), ("rep", "bigint"), ("c", "bigint"), ("side", "int"), ("n", "bigint"), ("sketch", "binary"))
    typed = lambda df, **more: df.select("part", *[more.get(c, F.lit(None)).cast(t).alias(c) for c, t in columns])
    col = F.col
    sketches = typed(here.join(reps, "rep"), rep=col("rep"), n=col("n"), sketch=col("sketch"))
    placed = typed(rows, key=col("key"), cell=col("cell"), rep=col("rep"), c=col("c"), side=col("side"))
    dealt = sketches.unionByName(placed).repartition(parts, "part").sortWithinPartitions("part", "key", "cell")
    return dealt.transform(in_arrow, _cross_rows(most), "a long, b long").distinct().join(tried, ["a", "b"], "left_anti")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salt_bits: int = SALT_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row. ``salt_bits`` sets from which count on a
    signature is split over tasks; it changes no result."""
    spark, spread = docs.sparkSession, 1
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    parts = buckets(docs, "text", 32 << 20)
    profile = cut(docs.transform(in_arrow, _profile, "hot boolean, a long, b long, c long, d long, sketch binary"), "profile")
    counts = profile.where("hot").groupBy(F.col("a").alias("key")).agg(F.sum("b").alias("n"))
    hot = Frequent(*most_frequent(counts, HOT_KEYS))

    rows = profile.where("NOT hot").select(F.col("a").alias("doc_id"), F.col("b").alias("n"), "c", "d", "sketch")
    sized = rows.where("n > 0").select("doc_id", "n", _class().alias("rep"), "sketch")
    reps = cut(sized.groupBy("rep", "n").agg(F.min("doc_id").alias("doc_id"), F.min("sketch").alias("sketch")).where("doc_id IS NOT NULL"), "classes")
    nodes = cut(rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, _class()).alias("rep")), "nodes")
    named = nodes.where("doc_id IS NOT NULL AND n_shingles > 0").select("doc_id", "rep", F.col("n_shingles").alias("n")).distinct()
    twice = named.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z")
    same_id = cut(named.join(twice, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b")).distinct(), "same")

    while True:
        blobs = docs.transform(in_arrow, _signature_blobs(hot, 4 * parts, spread, salt_bits), "bucket int, salted boolean, sigs binary, ids binary")
        met = cut(blobs.repartition(parts, "bucket").sortWithinPartitions("bucket", "salted").transform(in_arrow, _meet, "a long, b long, members array<long>"), "met")
        if met.where("a IS NULL").isEmpty():
            break
        spread *= 4  # some set filled too few parts: more parts for all
    del blobs
    release(spark)

    side = lambda x: named.select(F.col("doc_id").alias(x), F.col("rep").alias(f"rep_{x}"), F.col("n").alias(f"n{x}"))
    pairs = met.where("members IS NULL").select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b")
    pairs = pairs.where("100 * least(na, nb) >= 75 * greatest(na, nb)")
    pairs = cut(_ordered(pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))), "pairs")
    shared = met.where("members IS NOT NULL").select(F.col("a").alias("key"), F.explode("members").alias("doc_id"))
    shared = cut(shared.join(named.select("doc_id", "rep"), "doc_id").select("key", "rep").distinct(), "shared")
    drop(met)
    checked, tried = verify(docs, pairs, reps), pairs
    edges = lambda: checked.where("linked").select("a", "b").unionByName(same_id)
    labels = cut(components(edges()), "labels")

    most, more = PAIRS, True
    while more:
        now = shared.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("c"))
        split = now.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x <> y").select("key")
        found = cut(_between(cut(now.join(split, "key"), "shared"), reps, tried, parts, most), "pairs")
        fresh, more = found.where("a IS NOT NULL"), not found.where("a IS NULL").isEmpty()
        latest = verify(docs, fresh, reps)
        tried, checked, most = tried.unionByName(fresh), checked.unionByName(latest), 8 * most
        if not latest.where("linked").isEmpty():
            labels = cut(components(edges()), "labels")
    found = nodes.where("rep IS NOT NULL").join(labels, F.col("rep") == F.col("node"), "left").select("rep", "doc_id", "n_shingles", F.coalesce("component", "rep").alias("c"))
    least = found.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    empty = nodes.where("rep IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.join(least, "c").select("doc_id", "n_shingles", "component_id").unionByName(empty)


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return link(table(spark, sf_dir, "documents"))


#: Shingles are numbered; documents of equal sets are one class; classes meet by the rarest quarter of
#: their shingles (one of which linked sets share) and are then compared whole.
OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM w),
c AS MATERIALIZED (SELECT min(doc_id) AS id, md5(array_to_string(s, chr(10))) AS h, len(s) AS n, any_value(s) AS s FROM s WHERE len(s) > 0 GROUP BY 2, 3),
x AS MATERIALIZED (SELECT id, n, unnest(s) AS g FROM c),
f AS (SELECT g, count(*) AS k FROM x GROUP BY g HAVING count(*) > 1),
r AS MATERIALIZED (SELECT x.id, x.n, x.g, row_number() OVER (PARTITION BY x.id ORDER BY coalesce(k, 1), x.g) AS place FROM x LEFT JOIN f USING (g)),
p AS MATERIALIZED (
  SELECT DISTINCT a.id AS a, b.id AS b, a.n AS na, b.n AS nb FROM r a JOIN r b ON a.g = b.g AND a.id < b.id
  WHERE a.place <= a.n - ceil(0.75 * a.n) + 1 AND b.place <= b.n - ceil(0.75 * b.n) + 1 AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)),
l AS MATERIALIZED (
  SELECT a, b FROM (SELECT p.a, p.b, p.na, p.nb, len(list_intersect(ca.s, cb.s)) AS k FROM p JOIN c ca ON ca.id = p.a JOIN c cb ON cb.id = p.b) WHERE 100 * k >= 75 * (na + nb - k)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
t(id, least) AS (SELECT id, id FROM c UNION SELECT e.b, t.least FROM t JOIN e ON e.a = t.id WHERE t.least < e.b),
m AS (SELECT id, min(least) AS component FROM t GROUP BY id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(m.component, s.doc_id) AS component_id
FROM s LEFT JOIN c ON len(s.s) > 0 AND c.h = md5(array_to_string(s.s, chr(10))) AND c.n = len(s.s) LEFT JOIN m ON m.id = c.id
"""
