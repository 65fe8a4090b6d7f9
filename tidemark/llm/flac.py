"""Media columns: texts' bytes as FLAC streams, and a FLAC reader, both over many frames at once."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import lean, text_of

SIZE = 576  #: samples of a frame
RATE = 8000
ORDER, PRECISION, SHIFT = 4, 8, 5  #: of the linear predictor that the writer tries
FRAMES = 3072  #: frames coded at once
BLOCK = 16  #: frames of a PCM block
MB = 1 << 20

#: Fixed predictors of the FLAC format by order, newest sample first.
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))


class CorruptMedia(ValueError):
    """A stream that breaks the format or fails a checksum."""


@cache
def _crc_table(width: int, poly: int, length: int) -> np.ndarray:
    """table[d, b]: the checksum of byte b with d zero bytes behind it; a message's is the XOR over its bytes."""
    step = np.arange(256, dtype=np.uint32) << (width - 8)
    for _ in range(8):
        step = np.where(step & (1 << width - 1), step << 1 ^ poly, step << 1) & ((1 << width) - 1)
    out = np.empty((length, 256), np.uint16)
    out[0] = row = step
    for d in range(1, length):
        row = (row << 8 & ((1 << width) - 1)) ^ step[row >> (width - 8)]
        out[d] = row
    return out


def _crc(width: int, poly: int, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums of the byte runs at ``starts`` (none empty)."""
    table = _crc_table(width, poly, 1 << int(lengths.max()).bit_length())
    first = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    return np.bitwise_xor.reduceat(table[np.repeat(lengths, lengths) - 1 - inside, data[np.repeat(starts, lengths) + inside]], first)


def crc16(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return _crc(16, 0x8005, data, starts, lengths)


def crc8(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return _crc(8, 0x07, data, starts, lengths)


def _frame_number(n: int) -> bytes:
    """The format's extension of UTF-8 to 31 bits."""
    if n < 0x80:
        return bytes([n])
    tail = []
    size = next(k for k in range(2, 7) if n < 1 << 5 * k + 1)
    for _ in range(size - 1):
        tail.append(0x80 | n & 0x3F)
        n >>= 6
    return bytes([0xFF00 >> size & 0xFF | n, *reversed(tail)])


# ---------------------------------------------------------------- writing


def _predictors(x: np.ndarray) -> np.ndarray:
    """Quantised coefficients (frames x ORDER) by Levinson and Durbin, from exact integer autocorrelations."""
    r = np.stack([(x[:, : SIZE - k] * x[:, k:]).sum(1, dtype=np.int64) for k in range(ORDER + 1)], 1).astype(float)
    a, error = np.zeros((len(x), ORDER)), np.maximum(r[:, 0] * 1.0001, 1.0)
    for i in range(ORDER):
        k = (r[:, i + 1] - (a[:, :i] * r[:, i:0:-1]).sum(1)) / error
        a[:, :i], a[:, i] = a[:, :i] - k[:, None] * a[:, :i][:, ::-1], k
        error = np.maximum(error * (1 - k * k), 1.0)
    top = (1 << PRECISION - 1) - 1
    return np.clip(np.rint(a * (1 << SHIFT)), -top - 1, top).astype(np.int32)


def _residual(x: np.ndarray, coefficients: np.ndarray, shift: int) -> np.ndarray:
    order = coefficients.shape[1]
    if not order:
        return x
    guess = sum(coefficients[:, i : i + 1] * x[:, order - 1 - i : SIZE - 1 - i] for i in range(order))
    return x[:, order:] - (guess >> shift)


def _rice(residual: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Zigzag values, parameter and bits of each frame."""
    u = (residual << 1) ^ (residual >> 31)
    total, n = u.sum(1, dtype=np.int64), u.shape[1]
    k = np.zeros(len(u), np.int32)
    for p in range(1, 15):
        k[total > n << p] = p
    bits = (u >> k[:, None]).sum(1, dtype=np.int64) + n * (k + 1)
    return u, k, bits


def _write_group(heads: list[bytes], sub: np.ndarray, warm: np.ndarray, extra: list[tuple[np.ndarray, int]], u: np.ndarray | None, k: np.ndarray | None) -> list[bytes]:
    """Frames of one kind: header bytes, subframe byte, warm-up samples, further fields, Rice codes, CRC-16."""
    n, head = len(heads), len(heads[0])
    fixed = np.concatenate([np.frombuffer(b"".join(heads), np.uint8).reshape(n, head), sub[:, None], (warm & 0xFF)], 1).astype(np.int32)
    value, width = [fixed], [np.full(fixed.shape, 8, np.int32)]
    for v, w in extra:
        value.append(v.reshape(n, -1) & (1 << w) - 1)
        width.append(np.full(value[-1].shape, w, np.int32))
    tops = [np.full(v.shape, w[0, 0], np.int32) for v, w in zip(value, width, strict=True)]
    if u is not None:
        kk = k[:, None]
        value.append(u & (1 << kk) - 1 | 1 << kk)
        width.append((u >> kk) + kk + 1)
        tops.append(np.broadcast_to(kk + 1, u.shape))
    value, width, top = np.concatenate(value, 1), np.concatenate(width, 1), np.concatenate(tops, 1)
    ends = np.cumsum(width, 1)
    size = ends[:, -1] + 7 >> 3
    base = np.concatenate([[0], np.cumsum(size + 2)])
    ends += (8 * base[:-1])[:, None]
    bits = np.zeros(8 * int(base[-1]), np.uint8)
    for b in range(int(top.max())):
        on = (value >> b & 1).astype(bool)
        bits[ends[on] - 1 - b] = 1
    data = np.packbits(bits)
    check = crc16(data, base[:-1], size)
    data[base[1:] - 2], data[base[1:] - 1] = check >> 8, check & 0xFF
    raw = data.tobytes()
    return [raw[base[i] : base[i + 1]] for i in range(n)]


def _write_frames(x: np.ndarray, numbers: list[int]) -> list[bytes]:
    """Frames (int32 samples of 8 bits, one row each) in the smallest of the forms tried."""
    heads = [b"\xff\xf8\x20\x02" + _frame_number(i) for i in numbers]
    lengths = np.array([len(h) for h in heads])
    flat = np.frombuffer(b"".join(heads), np.uint8)
    sums = crc8(flat, np.cumsum(lengths) - lengths, lengths)
    heads = [h + bytes([s]) for h, s in zip(heads, sums.tolist(), strict=True)]

    n = len(x)
    kinds, coded = [("fixed", o) for o in range(3)] + [("lpc", ORDER)], []
    own = _predictors(x)
    cost = np.empty((n, len(kinds) + 2), np.int64)
    for i, (kind, order) in enumerate(kinds):
        c = own if kind == "lpc" else np.broadcast_to(np.array(FIXED[order], np.int32), (n, order))
        u, k, bits = _rice(_residual(x, c, SHIFT if kind == "lpc" else 0))
        coded.append((u, k))
        cost[:, i] = bits + 10 + 8 * order + (9 + PRECISION * order if kind == "lpc" else 0)
    cost[:, -2] = 8 * SIZE
    cost[:, -1] = np.where((x == x[:, :1]).all(1), 0, 1 << 40)
    best = cost.argmin(1)
    out: list[bytes] = [b""] * n
    for kind in range(len(kinds) + 2):
        for size in np.unique(lengths[best == kind]).tolist():
            rows = np.flatnonzero((best == kind) & (lengths == size))
            own_heads, xs = [heads[r] for r in rows], x[rows]
            if kind == len(kinds):
                made = _write_group(own_heads, np.full(len(rows), 0x02), xs, [], None, None)
            elif kind > len(kinds):
                made = _write_group(own_heads, np.zeros(len(rows), int), xs[:, :1], [], None, None)
            else:
                name, order = kinds[kind]
                u, k = coded[kind][0][rows], coded[kind][1][rows]
                sub = (32 | order - 1 if name == "lpc" else 8 | order) << 1
                extra = [(k, 10)]  # coding method 0, partition order 0, parameter
                if name == "lpc":
                    extra = [(np.full(len(rows), PRECISION - 1), 4), (np.full(len(rows), SHIFT), 5), (own[rows], PRECISION), *extra]
                made = _write_group(own_heads, np.full(len(rows), sub), xs[:, :order], extra, u, k)
            for r, m in zip(rows.tolist(), made, strict=True):
                out[r] = m
    return out


def write_streams(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream (mono, 8 bits, frames of SIZE samples, a seek point a frame) of each payload.

    A payload's length is a positive multiple of SIZE; byte b is the sample b - 128.
    """
    x = np.frombuffer(b"".join(payloads), np.uint8).astype(np.int32).reshape(-1, SIZE) - 128
    numbers = [i for p in payloads for i in range(len(p) // SIZE)]
    frames = [f for at in range(0, len(x), FRAMES) for f in _write_frames(x[at : at + FRAMES], numbers[at : at + FRAMES])]
    out, at = [], 0
    for p in payloads:
        own = frames[at : at + len(p) // SIZE]
        at += len(own)
        sizes = [len(f) for f in own]
        pcm = np.frombuffer(p, np.uint8) ^ 0x80
        packed = RATE << 44 | 0 << 41 | 7 << 36 | len(p)
        info = struct.pack(">HH", SIZE, SIZE) + min(sizes).to_bytes(3) + max(sizes).to_bytes(3) + packed.to_bytes(8) + hashlib.md5(pcm.tobytes()).digest()
        seek, offset = [], 0
        for i, s in enumerate(sizes):
            seek.append(struct.pack(">QQH", i * SIZE, offset, SIZE))
            offset += s
        tables = [seek[i : i + 900_000] for i in range(0, len(seek), 900_000)]  # a block's length has 24 bits
        blocks = [b"\x00" + len(info).to_bytes(3) + info]
        blocks += [bytes([3 | (128 if i == len(tables) - 1 else 0)]) + (18 * len(t)).to_bytes(3) + b"".join(t) for i, t in enumerate(tables)]
        out.append(b"".join([b"fLaC", *blocks, *own]))
    return out


# ---------------------------------------------------------------- reading

_ZEROS = np.array([16, *(16 - int(i).bit_length() for i in range(1, 1 << 16))], np.uint64)  #: leading zeros of 16 bits


class _Bits:
    """64-bit windows at any bit of a byte array."""

    def __init__(self, data: np.ndarray) -> None:
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        w = np.zeros(len(padded) - 8, np.uint64)
        for j in range(8):
            w = w << np.uint64(8) | padded[j : len(w) + j]
        self.words = w

    def at(self, pos: np.ndarray) -> np.ndarray:
        """At least 57 bits from each position, at the top."""
        return self.words[pos >> 3] << (pos & 7).astype(np.uint64)

    def field(self, pos: np.ndarray, width: int) -> np.ndarray:
        return (self.at(pos) >> np.uint64(64 - width)).astype(np.int64)

    def signed(self, pos: np.ndarray, width: int) -> np.ndarray:
        v = self.field(pos, width)
        return v - ((v >> width - 1) << width)


def _unpack(bits: _Bits, pos: np.ndarray, order: int, end: np.ndarray) -> np.ndarray:
    """Rice residuals (SIZE - order rows, a column a frame); partitions of any order, one word of position a frame."""
    method = bits.field(pos, 2)
    if (method > 1).any():
        raise CorruptMedia("a reserved coding of residuals")
    wide = (4 + method).astype(np.uint64)  # bits of a parameter, of which all ones escape to plain numbers
    parts = bits.field(pos + 2, 4)
    if (SIZE % (1 << parts)).any() or (SIZE >> parts < order).any():
        raise CorruptMedia("partitions that don't fit the frame")
    pos = pos + 6
    span = SIZE >> parts
    changes = {j for s in np.unique(span).tolist() for j in [order, *range(s, SIZE, s)]}
    out = np.empty((SIZE - order, len(pos)), np.uint64)
    k = np.zeros(len(pos), np.uint64)
    plain = np.full(len(pos), -1)  # bits of escaped numbers
    one, top = np.uint64(1), np.uint64(63)
    for j in range(order, SIZE):
        if j in changes:
            new = np.ones(len(pos), bool) if j == order else j % span == 0
            k = np.where(new, (bits.at(pos) >> np.uint64(64) - wide).astype(np.int64), k).astype(np.uint64)
            pos = pos + wide.astype(np.int64) * new
            escaped = new & (k == (one << wide) - one)
            plain = np.where(new, -1, plain)
            if escaped.any():
                plain = np.where(escaped, bits.field(pos, 5), plain)
                pos = pos + 5 * escaped
            k = np.where(plain >= 0, 0, k).astype(np.uint64)
            rest = top - k
            step = (k + one).astype(np.int64)
            raw = np.flatnonzero(plain >= 0)
        if len(raw):  # these rows are read apart, the others as if these weren't there
            out[j - order], pos = _mixed(bits, pos, plain, k, end)
            continue
        w = bits.at(pos)
        q = _ZEROS[w >> np.uint64(48)]
        if q.max() < 16:
            w = w << (q + one)
        else:  # a long run of zeros: count on, 16 at a time
            more = q == 16
            while more.any():
                pos = pos + 16 * more
                if (pos > end).any():
                    raise CorruptMedia("a code runs beyond its frame")
                w = bits.at(pos)
                z = _ZEROS[w >> np.uint64(48)]
                q = np.where(more, q + z, q)
                more &= z == 16
            zeros = _ZEROS[w >> np.uint64(48)]
            w = w << (zeros + one)
            pos = pos + zeros.astype(np.int64)
            out[j - order] = q << k | w >> one >> rest
            pos = pos + step
            continue
        out[j - order] = q << k | w >> one >> rest
        pos = pos + q.astype(np.int64) + step
    if (pos > end).any():
        raise CorruptMedia("residuals run beyond their frame")
    u = out.astype(np.int64)
    return u >> 1 ^ -(u & 1)


def _mixed(bits: _Bits, pos: np.ndarray, plain: np.ndarray, k: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One residual of each frame, of which some are in escaped partitions: zigzag values and positions behind."""
    u, pos = np.zeros(len(pos), np.uint64), pos.copy()
    for n in np.unique(plain[plain >= 0]).tolist():
        rows = np.flatnonzero(plain == n)
        v = bits.signed(pos[rows], n) if n else np.zeros(len(rows), np.int64)
        u[rows] = ((v << 1) ^ (v >> 63)).astype(np.uint64)
        pos[rows] += n
    rows = np.flatnonzero(plain < 0)
    q, on = np.zeros(len(rows), np.int64), np.ones(len(rows), bool)
    while on.any():
        z = _ZEROS[bits.at(pos[rows]) >> np.uint64(48)].astype(np.int64)
        q, pos[rows] = np.where(on, q + z, q), pos[rows] + np.where(on, z, 0)
        on &= z == 16
        if (pos[rows] > end[rows]).any():
            raise CorruptMedia("a code runs beyond its frame")
    low = np.where(k[rows] > 0, (bits.at(pos[rows] + 1) >> np.minimum(np.uint64(64) - k[rows], np.uint64(63))).astype(np.int64), 0)
    u[rows] = q.astype(np.uint64) << k[rows] | low.astype(np.uint64)
    pos[rows] += 1 + k[rows].astype(np.int64)
    return u, pos


def _subframes(bits: _Bits, kind: int, depth: int, pos: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Samples of ``depth`` bits of subframes of one kind, the fields of which begin at ``pos``."""
    if kind == 0:
        return bits.signed(pos, depth)[:, None]
    if kind == 1:
        if (pos + depth * SIZE > end).any():
            raise CorruptMedia("samples run beyond their frame")
        return bits.signed(pos[:, None] + depth * np.arange(SIZE), depth)
    if not (8 <= kind <= 12 or kind >= 32):
        raise CorruptMedia("a reserved kind of subframe")
    order = kind - 31 if kind >= 32 else kind - 8
    y = np.empty((SIZE, len(pos)), np.int64)
    for i in range(order):
        y[i] = bits.signed(pos + depth * i, depth)
    pos = pos + depth * order
    if kind >= 32:
        precision, shift = bits.field(pos, 4) + 1, bits.signed(pos + 4, 5)
        if (precision > 15).any() or (shift < 0).any():
            raise CorruptMedia("a reserved precision, or a negative shift")
        c = np.empty((order, len(pos)), np.int64)
        for w in np.unique(precision).tolist():
            own = np.flatnonzero(precision == w)
            for i in range(order):
                c[i, own] = bits.signed(pos[own] + 9 + w * i, w)
        pos = pos + 9 + precision * order
    else:
        c, shift = [np.int64(v) for v in FIXED[order]], np.zeros(len(pos), np.int64)
    y[order:] = _unpack(bits, pos, order, end)
    if order:
        for j in range(order, SIZE):
            guess = c[0] * y[j - 1]
            for i in range(1, order):
                guess = guess + c[i] * y[j - 1 - i]
            y[j] += guess >> shift
    return y.T


def read_frames(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Samples (a row a frame) of the frames data[start:end]; every checksum and frame number is verified."""
    lengths = ends - starts
    if (lengths < 9).any() or (crc16(data, starts, lengths - 2) != (data[ends - 2].astype(np.uint16) << 8 | data[ends - 1])).any():
        raise CorruptMedia("CRC-16 of a frame")
    if (data[starts[:, None] + np.arange(4)] != (0xFF, 0xF8, 0x20, 0x02)).any():
        raise CorruptMedia("a frame is not mono, 8 bits, 576 samples")
    lead = data[starts + 4]
    size = np.where(lead < 0x80, 1, 8 - np.array([(255 - int(b)).bit_length() for b in range(256)])[lead])
    coded = [_frame_number(i) for i in numbers.tolist()]
    expected = np.frombuffer(b"".join(coded), np.uint8)
    own = np.array([len(c) for c in coded])
    inside = np.arange(len(expected)) - np.repeat(np.cumsum(own) - own, own)
    if (own != size).any() or (data[np.repeat(starts + 4, own) + inside] != expected).any():
        raise CorruptMedia("a frame's number")
    if (crc8(data, starts, 4 + size) != data[starts + 4 + size]).any():
        raise CorruptMedia("CRC-8 of a frame's header")
    bits = _Bits(data)
    at = starts + 5 + size
    kind = data[at].astype(np.int64)
    if (kind & 0x80).any():
        raise CorruptMedia("a subframe's first bit")
    first = 8 * (at + 1)
    wasted = np.where(kind & 1, _ZEROS[bits.at(first) >> np.uint64(48)].astype(np.int64) + 1, 0)
    if (wasted > 7).any():
        raise CorruptMedia("all bits are wasted")
    kind >>= 1
    x = np.empty((len(starts), SIZE), np.int64)
    for t, waste in sorted(set(zip(kind.tolist(), wasted.tolist(), strict=True))):
        rows = np.flatnonzero((kind == t) & (wasted == waste))
        x[rows] = _subframes(bits, t, 8 - waste, first[rows] + waste, 8 * (ends[rows] - 2)) << waste
    return x


def read_streams(streams: list[bytes]) -> list[bytes]:
    """Payloads of FLAC streams as write_streams makes them; frames are found by the seek points."""
    starts, ends, numbers, infos, at = [], [], [], [], 0
    for s in streams:
        if s[:4] != b"fLaC":
            raise CorruptMedia("not a FLAC stream")
        p, last, points, info = 4, False, [], b""
        while not last:
            last, what, n = bool(s[p] & 128), s[p] & 127, int.from_bytes(s[p + 1 : p + 4])
            body = s[p + 4 : p + 4 + n]
            p += 4 + n
            if what == 0:
                info = body
            elif what == 3:
                points.append(np.frombuffer(body, np.dtype([("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")])))
        points = np.concatenate(points)
        samples = int.from_bytes(info[10:18]) & (1 << 36) - 1
        if len(points) * SIZE != samples or (points["sample"] != np.arange(len(points)) * SIZE).any():
            raise CorruptMedia("seek points don't cover the stream")
        begin = points["offset"].astype(np.int64) + p + at
        starts.append(begin)
        ends.append(np.append(begin[1:], at + len(s)))
        numbers.append(np.arange(len(begin)))
        infos.append((len(begin), info[18:34]))
        at += len(s)
    data = np.frombuffer(b"".join(streams), np.uint8)
    starts, ends, numbers = np.concatenate(starts), np.concatenate(ends), np.concatenate(numbers)
    parts = []
    for i in range(0, len(starts), FRAMES):
        a, b = starts[i : i + FRAMES], ends[i : i + FRAMES]
        x = read_frames(data[a[0] : b[-1]], a - a[0], b - a[0], numbers[i : i + FRAMES])
        parts.append((x + 128).astype(np.uint8))
    pcm, out, at = np.concatenate(parts), [], 0
    for n, md5 in infos:
        own = pcm[at : at + n].reshape(-1)
        at += n
        if hashlib.md5((own ^ 0x80).tobytes()).digest() != md5:
            raise CorruptMedia("MD5 of the samples")
        out.append(own.tobytes())
    return out


# ---------------------------------------------------------------- columns


def _runs(sizes: list[int], limit: int = 2 * MB) -> Iterator[slice]:
    i = total = 0
    for j, n in enumerate(sizes):
        if total and total + n > limit:
            yield slice(i, j)
            i, total = j, 0
        total += n
    if i < len(sizes):
        yield slice(i, len(sizes))


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and media: each text's UTF-8 bytes, filled up with 255 to a positive multiple of SIZE, as FLAC.

    Null and empty texts give one frame. Long texts have as many frames as they need. Null ids and
    repeated rows each give a row; an empty table none; other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = batch.column(1).cast(pa.binary())
            for part in _runs(pc.binary_length(texts).to_pylist()):
                own = texts[part.start : part.stop].to_pylist()
                media = write_streams([t + b"\xff" * (-len(t) % SIZE or (0 if t else SIZE)) for t in own])
                yield pa.RecordBatch.from_arrays([batch.column(0)[part.start : part.stop], pa.array([len(t) for t in own], pa.int64()), pa.array(media, pa.binary())], schema=schema)

    return lean(docs).select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def blocks_of(pcm: bytes, frames: int) -> Iterator[tuple[int, bytes]]:
    """A stream's samples in blocks of ``frames`` frames, each with its sample offset, by which it can be sought."""
    return ((at, pcm[at : at + frames * SIZE]) for at in range(0, len(pcm), frames * SIZE))


def pcm_blocks(media: DataFrame, frames: int = BLOCK) -> DataFrame:
    """doc_id, sample_offset, n_samples and pcm of blocks of ``frames`` frames, read from a media column; a null media has none."""
    schema = pa.schema([("doc_id", pa.int64()), ("sample_offset", pa.int64()), ("n_samples", pa.int64()), ("pcm", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, streams = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in _runs([len(s) for s in streams]):
                rows = [(d, at, len(b), b) for d, p in zip(ids[part], read_streams(streams[part]), strict=True) for at, b in blocks_of(p, frames)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return media.where("media is not null").select("doc_id", "media").mapInArrow(run, "doc_id long, sample_offset long, n_samples long, pcm binary")


def features(payload: bytes) -> str:
    """Integers of the signal: samples, least, greatest, sum, energy, zero crossings."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    return f"n={len(x)};min={x.min()};max={x.max()};sum={x.sum()};energy={(x * x).sum()};crossings={np.count_nonzero((x[1:] < 0) != (x[:-1] < 0))}"


def media_digest(media: DataFrame, frames: int = BLOCK) -> DataFrame:
    """Digests and features of the stored streams and of what is read back from them, and of its PCM blocks.

    n_blocks counts the blocks, blocks_crc32 is the CRC-32 of their sample offsets and numbers of
    samples (little-endian, 64 bits each), one block after the other. A null media has null in all
    columns but doc_id and n_bytes; a stream that fails a checksum raises. Other columns are not read.
    """
    names = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_blocks long, blocks_crc32 long"
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in names.split(", ")])

    def digest(doc: int | None, n: int | None, stream: bytes, pcm: bytes) -> tuple:
        places = [struct.pack("<QQ", at, len(b)) for at, b in blocks_of(pcm, frames)]
        return doc, n, len(pcm), hashlib.sha256(pcm).hexdigest(), zlib.crc32(pcm[-32:]), len(stream), hashlib.sha256(stream).hexdigest(), features(pcm), len(places), zlib.crc32(b"".join(places))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, sizes, streams = (c.to_pylist() for c in batch.columns)
            for part in _runs([len(s or b"") for s in streams]):
                there = [s for s in streams[part] if s is not None]
                pcm = iter(read_streams(there) if there else [])
                rows = [(d, n, *[None] * 8) if s is None else digest(d, n, s, next(pcm)) for d, n, s in zip(ids[part], sizes[part], streams[part], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, names)


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digest(to_media(spark.read.parquet(f"{sf_dir}/documents.parquet")))
