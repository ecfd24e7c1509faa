"""Media columns: motion-JPEG in AVI.

``store_text`` writes a text's bytes losslessly into the quantised coefficients of baseline JPEG
frames and wraps them in an AVI file; ``read_avi`` parses the RIFF index of any motion-JPEG AVI,
decodes its intra frames and finds shots where the histogram difference of successive frames
leaves the running range of the differences before it. Both are map-only.

Coding of the payload: a row of 192 bytes is one restart interval of four 8x8 blocks; byte b is
the coefficient 256 + b at zigzag places 1 to 48, DC is 0. Rows of empty blocks fill the last frame.

Defined cases: a null text is empty; an empty payload is one row of blanks; equal texts give equal
files; rows that repeat give repeated rows; a damaged medium, or one whose frames are not
baseline JPEG, gives null payload, no clips and an ``error`` that says why; a null medium gives null
payload, no frames and no clips; an empty table gives no rows; further columns of the input are
ignored. Files without an index, with ``rec`` lists or with further RIFF parts are walked; frames
without Huffman tables take those of the standard.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jpeg
from .common import in_arrow, table

ROW = 192
ROWS = 16  # of a frame
FPS = 25
BATCH = 1 << 19
EMPTY_ROW = b"\x49\x2f"  # four times DC 0, end of block; then ones
BINS = 16


def pad(text: bytes) -> bytes:
    """Blanks up to a positive multiple of 192."""
    return text + b" " * (-len(text) % ROW or (0 if text else ROW))


def _frame_head(rows: int) -> bytes:
    seg = lambda marker, body: bytes((255, marker)) + struct.pack(">H", len(body) + 2) + body
    table_of = lambda kind, bits, symbols: bytes((kind, *bits, *[0] * (16 - len(bits)))) + symbols
    return b"".join((
        b"\xff\xd8",
        seg(0xDB, bytes((0, *[1] * 64))),
        seg(0xC0, struct.pack(">BHHB", 8, 8 * rows, 32, 1) + b"\x01\x11\x00"),
        seg(0xC4, table_of(0x00, (1,), b"\x00")),
        seg(0xC4, table_of(0x10, (1, 1), b"\x09\x00")),
        seg(0xDD, struct.pack(">H", 4)),
        seg(0xDA, b"\x01\x01\x00\x00\x3f\x00"),
    ))


def _code_rows(payload: bytes) -> list[bytes]:
    """The entropy-coded bytes of each row, byte stuffing included."""
    data = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    out: list[bytes] = []
    for at in range(0, len(data), jpeg.LANES):
        part = data[at : at + jpeg.LANES]
        bits = np.zeros((len(part), 4, 483), np.uint8)
        ac = bits[:, :, 1:481].reshape(len(part), 4, 48, 10)
        ac[..., 1] = 1
        ac[..., 2:] = np.unpackbits(part, axis=1).reshape(len(part), 4, 48, 8)
        bits[:, :, 1:481] = ac.reshape(len(part), 4, 480)
        bits[:, :, 481] = 1
        coded = np.packbits(np.concatenate([bits.reshape(len(part), -1), np.ones((len(part), 4), np.uint8)], axis=1), axis=1)
        raw, n = coded.tobytes(), coded.shape[1]
        rows = [raw[i : i + n] for i in range(0, len(raw), n)]
        out += [x.replace(b"\xff", b"\xff\x00") for x in rows] if b"\xff" in raw else rows
    return out


def avi(frames: list[bytes], width: int, height: int, fps: int = FPS) -> bytes:
    """An AVI file with one motion-JPEG stream and an index."""
    chunk = lambda name, body: name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)
    most = max(map(len, frames), default=0)
    head = chunk(b"avih", struct.pack("<14I", 1_000_000 // fps, 0, 0, 0x10, len(frames), 0, 1, most, width, height, 0, 0, 0, 0))
    stream = chunk(b"strh", struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, 1, fps, 0, len(frames), most, 0xFFFFFFFF, 0, 0, 0, width, height))
    stream += chunk(b"strf", struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 24, b"MJPG", width * height * 3, 0, 0, 0, 0))
    movi, index, at = [b"movi"], [], 4
    for x in frames:
        movi.append(chunk(b"00dc", x))
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(x)))
        at += len(movi[-1])
    body = chunk(b"LIST", b"hdrl" + head + chunk(b"LIST", b"strl" + stream)) + chunk(b"LIST", b"".join(movi)) + chunk(b"idx1", b"".join(index))
    return chunk(b"RIFF", b"AVI " + body)


def encode(payloads: list[bytes]) -> list[bytes]:
    """AVI files of payloads whose lengths are positive multiples of 192."""
    rows, at, out = _code_rows(b"".join(payloads)), 0, []
    for p in payloads:
        n = len(p) // ROW
        high = min(n, ROWS)
        head, frames = _frame_head(high), []
        for i in range(0, n, high):
            own = rows[at + i : at + min(i + high, n)]
            own += [EMPTY_ROW] * (high - len(own))
            body = b"".join(x + bytes((255, 0xD0 + k % 8)) for k, x in enumerate(own))
            frames.append(head + body[:-2] + b"\xff\xd9")
        out.append(avi(frames, 32, 8 * high))
        at += n
    return out


def _chunks(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """Name, first byte and end of the chunks between two places."""
    while at + 8 <= end:
        size = struct.unpack_from("<I", data, at + 4)[0]
        yield data[at : at + 4], at + 8, min(at + 8 + size, end)
        at += 8 + size + (size & 1)


def _walked(data: bytes, at: int, end: int, tags: tuple[bytes, ...]) -> Iterator[bytes]:
    """The frames between two places, those in ``rec`` lists included."""
    for name, a, b in _chunks(data, at, end):
        if name == b"LIST":
            yield from _walked(data, a + 4, b, tags)
        elif name in tags:
            yield data[a:b]


def parse_avi(data: bytes) -> tuple[list[bytes], float]:
    """The frames of the first video stream, found by the index (or by walking ``movi`` where
    there is none, or one for the first of several parts only), and the seconds that a frame lasts."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    seconds, movi, index, stream, streams = 1 / FPS, [], None, None, 0
    todo = [(a + 4, b) for name, a, b in _chunks(data, 0, len(data)) if name == b"RIFF" and data[a : a + 4] in (b"AVI ", b"AVIX")]
    for at, end in todo:
        for name, a, b in _chunks(data, at, end):
            if name == b"LIST" and data[a : a + 4] == b"movi":
                movi.append((a, b))
            elif name == b"LIST" and data[a : a + 4] in (b"hdrl", b"strl"):
                todo.append((a + 4, b))
            elif name == b"strh":
                if data[a : a + 4] == b"vids" and stream is None:
                    scale, rate = struct.unpack_from("<II", data, a + 20)
                    stream, seconds = streams, scale / rate if rate else seconds
                streams += 1
            elif name == b"idx1":
                index = data[a:b]
    tags = (b"%02ddc" % (stream or 0), b"%02ddb" % (stream or 0))
    if not index or len(movi) != 1:
        return [f for a, b in movi for f in _walked(data, a + 4, b, tags)], seconds
    frames = []
    entries = [x for x in struct.iter_unpack("<4sIII", index[: len(index) // 16 * 16]) if x[0] in tags]
    base = 0 if entries and data[entries[0][2] : entries[0][2] + 4] in tags else movi[0][0]  # offsets from the file's start, or from movi
    for name, _, offset, size in entries:
        at = base + offset
        if data[at : at + 4] != name:
            raise ValueError("damaged AVI index")
        frames.append(data[at + 8 : at + 8 + size])
    return frames, seconds


def shots(histograms: np.ndarray, window: int = 12, factor: float = 3.0, least: float = 0.05) -> list[int]:
    """First frames of the shots. A cut lies where the difference of two histograms is over the
    mean of the up to ``window`` differences before it (for the first one, after it) plus
    ``factor`` deviations, and ``least``."""
    if not len(histograms):
        return []
    total = np.maximum(histograms.sum(axis=1), 1)[:, None]
    diff = np.abs(np.diff(histograms / total, axis=0)).sum(axis=1) / 2
    firsts = [0]
    for i, d in enumerate(diff):
        near = diff[max(0, i - window) : i] if i else diff[1 : 1 + window]
        if d > max(least, near.mean() + factor * near.std() if len(near) else 0.0):
            firsts.append(i + 1)
    return firsts


def decode(files: list[bytes]) -> list[dict]:
    """For each file: coefficients of its frames, luma histograms, first frames of shots, timing."""
    parsed = [parse_avi(x) for x in files]
    images = jpeg.decode_frames([f for frames, _ in parsed for f in frames])
    sizes = np.array([len(c) for _, c in images], np.int64)
    grams = np.zeros((len(images), BINS), np.int64)
    begin = 0
    while begin < len(images):
        end = begin + 1
        while end < len(images) and images[end][0].quant == images[begin][0].quant and images[end][0].blocks == images[begin][0].blocks and sizes[begin : end + 1].sum() < 8_192:
            end += 1
        header = images[begin][0]
        values = jpeg.luma(header, np.concatenate([c for _, c in images[begin:end]])) >> 4
        share = sum(b[0] == 0 for b in header.blocks)
        who = np.repeat(np.arange(end - begin), sizes[begin:end] // len(header.blocks) * share * 64)
        grams[begin:end] = np.bincount(who * BINS + values.ravel(), minlength=(end - begin) * BINS).reshape(-1, BINS)
        begin = end
    out, at = [], 0
    for frames, seconds in parsed:
        own = slice(at, at + len(frames))
        out.append({"coefficients": [c for _, c in images[own]], "histograms": grams[own], "firsts": shots(grams[own]), "seconds": seconds})
        at += len(frames)
    return out


def decode_each(files: list[bytes]) -> list[tuple[dict | None, str | None]]:
    """For each file what ``decode`` finds, or why it cannot be decoded."""
    try:
        return [(got, None) for got in decode(files)]
    except DAMAGE as e:
        if len(files) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
        return [x for f in files for x in decode_each([f])]


def payload_of(coefficients: list[np.ndarray]) -> bytes:
    """The bytes that ``encode`` put in; rows of empty blocks are not part of them."""
    if not coefficients:
        return b""
    rows = np.concatenate(coefficients).reshape(-1, 4, 64)[:, :, 1:49].reshape(-1, ROW)
    return (rows[rows[:, 0] >= 256] - 256).astype(np.uint8).tobytes()


def feature_of(got: dict) -> str:
    total = got["histograms"].sum(axis=0)
    return f"frames={len(got['histograms'])};shots={','.join(map(str, got['firsts']))};luma={','.join(map(str, total))}"


def _in_parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Slices of batches of about BATCH bytes, a longer row alone."""
    for batch in batches:
        sizes = np.fromiter(((x.as_buffer().size if x.is_valid else 0) for x in batch.column(column)), np.int64, batch.num_rows)
        at = 0
        while at < batch.num_rows:
            n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), BATCH, "right")))
            yield batch.slice(at, n)
            at += n


def store_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes of the text, media: the AVI file that holds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _in_parts(batches, 1):
            texts = [x or b"" for x in part.column(1).to_pylist()]
            media = encode([pad(x) for x in texts])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, texts), pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary")).transform(in_arrow, run, "doc_id long, n_bytes long, media binary")


DAMAGE = (ValueError, IndexError, KeyError, TypeError, struct.error, OverflowError)
CLIPS = "array<struct<clip:int,first_frame:int,end_frame:int,start_s:double,end_s:double>>"


def read_avi(media: DataFrame, with_payload: bool = True) -> DataFrame:
    """Adds payload, feature, clips (timed shots, end exclusive) and error to (doc_id, n_bytes, media)."""
    clip = pa.list_(pa.struct([("clip", pa.int32()), ("first_frame", pa.int32()), ("end_frame", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _in_parts(batches, 2):
            files = part.column(2).to_pylist()
            found = iter(decode_each([x for x in files if x is not None]))
            payloads, features, clips, errors = [], [], [], []
            for x in files:
                got, error = next(found) if x is not None else (None, None)
                errors.append(error)
                payloads.append(payload_of(got["coefficients"]) if got and with_payload else None)
                features.append(feature_of(got) if got else None)
                ends = [*got["firsts"][1:], len(got["histograms"])] if got else []
                clips.append([(i, a, b, a * got["seconds"], b * got["seconds"]) for i, (a, b) in enumerate(zip(got["firsts"], ends))] if got else [])
            rows = [[dict(zip(("clip", "first_frame", "end_frame", "start_s", "end_s"), c)) for c in x] for x in clips]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(payloads, pa.binary()), pa.array(features, pa.string()), pa.array(rows, clip), pa.array(errors, pa.string())], ["doc_id", "n_bytes", "media", "payload", "feature", "clips", "error"])

    return media.select("doc_id", "n_bytes", "media").transform(in_arrow, run, f"doc_id long, n_bytes long, media binary, payload binary, feature string, clips {CLIPS}, error string")


def clip_rows(media: DataFrame) -> DataFrame:
    """One row for each shot: doc_id, clip, first_frame, end_frame, start_s, end_s."""
    return read_avi(media, with_payload=False).select("doc_id", F.explode("clips").alias("c")).select("doc_id", "c.*")


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as AVI and read back, as digests."""
    back = read_avi(store_text(table(spark, sf_dir, "documents")))
    return back.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -16, 16)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        F.size("clips").cast("long").alias("n_clips"),
    )
