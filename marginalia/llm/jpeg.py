"""Baseline JPEG with restart intervals, decoded in lockstep.

Every restart interval is a lane with its own bit position; one NumPy step decodes the next symbol
of all lanes of many frames at once, so there is no Python work for each symbol.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

LANES = 4_096  # decoded or encoded at once; bounds memory

# The order in which JPEG stores the 64 coefficients of a block (zigzag).
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))


@lru_cache(1)
def basis() -> np.ndarray:
    """Inverse DCT as integers over 2**13; integer sums in doubles are exact in any order."""
    x = np.arange(8)
    c = np.where(x == 0, 1 / np.sqrt(2), 1.0)
    one = c[:, None] * np.cos((2 * x[None, :] + 1) * x[:, None] * np.pi / 16) / 2
    return np.rint(np.einsum("ux,vy->uvxy", one, one).reshape(64, 64) * 8192)


# The Huffman tables of the standard (annex K), which motion-JPEG frames usually leave
# out: how many codes of each length, and the symbols in the order of their codes.
DC_LUMA = bytes((0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0)), bytes(range(12))
DC_CHROMA = bytes((0, 3, 1, 1, 1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0)), bytes(range(12))
AC_LUMA_FIRST = "01 02 03 00 04 11 05 12 21 31 41 06 13 51 61 07 22 71 14 32 81 91 a1 08 23 42 b1 c1 15 52 d1 f0 24 33 62 72 82"
AC_CHROMA_FIRST = "00 01 02 03 11 04 05 21 31 06 12 41 51 07 61 71 13 22 32 81 08 14 42 91 a1 b1 c1 09 23 33 52 f0 15 62 72 d1 0a 16 24 34 e1 25 f1"


def _with_rest(first: str) -> bytes:
    """The symbols given, then all others that a block may hold, in rising order."""
    head = bytes.fromhex(first)
    every = [run << 4 | size for run in range(16) for size in range(1, 11)]
    return head + bytes(x for x in every if x not in head)


AC_LUMA = bytes((0, 2, 1, 3, 3, 2, 4, 3, 5, 5, 4, 4, 0, 0, 1, 125)), _with_rest(AC_LUMA_FIRST)
AC_CHROMA = bytes((0, 2, 1, 2, 4, 4, 3, 4, 7, 5, 4, 4, 0, 1, 2, 119)), _with_rest(AC_CHROMA_FIRST)


@dataclass(frozen=True)
class Header:
    width: int
    height: int
    blocks: tuple  # of an MCU: (component, DC table, AC table)
    quant: tuple  # quantisation table of each component, zigzag order
    dc: tuple
    ac: tuple
    interval: int
    sampling: tuple  # (h, v) of each component

    @property
    def mcus(self) -> int:
        h, v = max(x[0] for x in self.sampling), max(x[1] for x in self.sampling)
        if len(self.sampling) == 1:
            h = v = 1
        return -(-self.width // (8 * h)) * -(-self.height // (8 * v))


@lru_cache(64)
def _lut(bits: bytes, symbols: bytes) -> np.ndarray:
    """For each 16-bit window: code length << 8 | symbol; 0 where no code begins."""
    if len(symbols) < sum(bits):
        raise ValueError("damaged JPEG tables")
    lut, code, at = np.zeros(65536, np.int64), 0, 0
    for n in range(1, 17):
        for _ in range(bits[n - 1]):
            lut[code << 16 - n : code + 1 << 16 - n] = n << 8 | symbols[at]
            code, at = code + 1, at + 1
        code <<= 1
    return lut


@lru_cache(256)
def parse_header(head: bytes) -> Header:
    """Reads all segments from SOI to the start of the entropy-coded data."""
    quant, interval, frame, scan, at = {}, 0, None, None, 2
    dc = {0: _lut(*DC_LUMA), 1: _lut(*DC_CHROMA)}
    ac = {0: _lut(*AC_LUMA), 1: _lut(*AC_CHROMA)}
    if head[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG image")
    while at < len(head):
        marker, size = head[at + 1], struct.unpack_from(">H", head, at + 2)[0]
        body, at = head[at + 4 : at + 2 + size], at + 2 + size
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                n = 128 if wide else 64
                quant[body[0] & 15] = tuple(struct.unpack(">64H" if wide else ">64B", body[1 : 1 + n]))
                body = body[1 + n :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                (ac if body[0] >> 4 else dc)[body[0] & 15] = _lut(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker in (0xC0, 0xC1):
            frame = body
        elif 0xC2 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise ValueError("only baseline JPEG is decoded")
        elif marker == 0xDD:
            interval = struct.unpack(">H", body[:2])[0]
        elif marker == 0xDA:
            scan = body
    if frame is None or scan is None:
        raise ValueError("no image in a frame")
    height, width, n = struct.unpack(">HHB", frame[1:6])
    parts = [frame[6 + 3 * i : 9 + 3 * i] for i in range(n)]
    tables = {scan[1 + 2 * i]: scan[2 + 2 * i] for i in range(scan[0])}
    sampling = tuple((p[1] >> 4, p[1] & 15) for p in parts)
    blocks = []
    for i, p in enumerate(parts):
        blocks += [(i, tables[p[0]] >> 4, tables[p[0]] & 15)] * (sampling[i][0] * sampling[i][1] if n > 1 else 1)
    order = lambda d: tuple(d.get(i) for i in range(4))
    return Header(width, height, tuple(blocks), tuple(quant[p[2]] for p in parts), order(dc), order(ac), interval, sampling)


def split_frame(data: bytes) -> tuple[Header, list[bytes]]:
    """The header of an image and the bytes of its restart intervals, stuffing removed."""
    at = 2
    while data[at + 1] != 0xDA:
        at += 2 + struct.unpack_from(">H", data, at + 2)[0]
    start = at + 2 + struct.unpack_from(">H", data, at + 2)[0]
    end = data.rfind(b"\xff\xd9")
    body = data[start : end if end > 0 else len(data)]
    lanes = re.split(rb"\xff[\xd0-\xd7]", body)
    if b"\xff\x00" in body:
        lanes = [x.replace(b"\xff\x00", b"\xff") for x in lanes]
    return parse_header(data[:start]), lanes


def decode_lanes(header: Header, lanes: list[bytes], mcus: np.ndarray) -> np.ndarray:
    """Coefficients (zigzag order) as (lane, block, 64); ``mcus``: how many each lane holds."""
    sizes = np.fromiter(map(len, lanes), np.int64, len(lanes)) + 2
    raw = np.frombuffer(b"\xff\xff".join(lanes) + b"\xff" * 10, np.uint8).astype(np.uint64)
    n = len(raw) - 8
    window = np.zeros(n, np.uint64)
    for i in range(8):
        window |= raw[i : i + n] << np.uint64(56 - 8 * i)
    pos = (np.cumsum(sizes) - sizes) * 8
    per, most = len(header.blocks), int(mcus.max())
    out = np.zeros((len(lanes), most * per, 64), np.int16)
    pred = np.zeros((len(lanes), len(header.sampling)), np.int64)

    def symbol(lut: np.ndarray, who: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray]:
        p = pos[who]
        w = window[np.minimum(p >> 3, n - 1)] << (p & 7).astype(np.uint64)
        e = lut[(w >> np.uint64(48)).astype(np.int64)]
        length, s = e >> 8, e & 15
        if not length.all():
            raise ValueError("damaged JPEG data")
        v = ((w << length.astype(np.uint64)) >> np.uint64(1) >> (63 - s).astype(np.uint64)).astype(np.int64)
        v = np.where((s > 0) & (v < (1 << s >> 1)), v - (1 << s) + 1, v)
        pos[who] = p + length + s
        return e & 255, v

    for m in range(most):
        live: np.ndarray | slice = slice(None) if (mcus > m).all() else np.flatnonzero(mcus > m)
        for b, (part, dc, ac) in enumerate(header.blocks):
            _, diff = symbol(header.dc[dc], live)
            pred[live, part] += diff
            out[live, m * per + b, 0] = pred[live, part]
            who = np.arange(len(lanes))[live]
            k = np.ones(len(who), np.int64)
            while len(who):
                sym, v = symbol(header.ac[ac], who)
                s = sym & 15
                k += sym >> 4
                put = s > 0
                if put.all():
                    out[who, m * per + b, np.minimum(k, 63)] = v
                else:
                    out[who[put], m * per + b, np.minimum(k[put], 63)] = v[put]
                k += 1
                stay = (k < 64) & (put | (sym == 0xF0))
                if not stay.all():
                    who, k = who[stay], k[stay]
    return out


def decode_frames(frames: list[bytes]) -> list[tuple[Header, np.ndarray]]:
    """For each image its header and its coefficients as (block, 64), blocks in scan order."""
    split = [split_frame(x) for x in frames]
    groups: dict[tuple, list[int]] = {}
    for i, (header, _) in enumerate(split):  # frames that differ in their number of lanes only are decoded together
        groups.setdefault((header.interval or header.mcus, header.blocks, header.sampling, *map(id, header.dc), *map(id, header.ac)), []).append(i)
    out: list = [None] * len(frames)
    for members in groups.values():
        at = 0
        while at < len(members):
            some, n = [], 0
            while at < len(members) and (not some or n + len(split[members[at]][1]) <= LANES):
                n += len(split[members[at]][1])
                some.append(members[at])
                at += 1
            lanes, mcus = [], []
            for i in some:
                header, own = split[i]
                per_lane = header.interval or header.mcus
                lanes += own
                mcus.append(np.clip(header.mcus - per_lane * np.arange(len(own)), 0, per_lane))
            got, begin = decode_lanes(split[some[0]][0], lanes, np.concatenate(mcus)), 0
            for i in some:
                header, k = split[i][0], len(split[i][1])
                per_lane = min(header.interval or header.mcus, got.shape[1] // len(header.blocks))
                own = got[begin : begin + k, : per_lane * len(header.blocks)]
                out[i] = (header, own.reshape(-1, 64)[: header.mcus * len(header.blocks)])
                begin += k
    return out


def luma(header: Header, coefficients: np.ndarray) -> np.ndarray:
    """Samples 0 to 255 of the first component, as (block, 64)."""
    own = np.array([b[0] for b in header.blocks]) == 0
    blocks = coefficients.reshape(-1, len(header.blocks), 64)[:, own].reshape(-1, 64)
    natural = np.zeros(blocks.shape, np.float64)
    natural[:, ZIGZAG] = blocks * np.array(header.quant[0])
    return np.clip(np.floor((natural @ basis() + 4096) / 8192) + 128, 0, 255).astype(np.uint8)
