"""PNG images in binary columns: text payloads stored as 8-bit grey samples, read back and hashed.

Encoding and decoding are written out here: chunks with CRC-32 tests, zlib streams, and the five row filters,
which numpy undoes a row at a time (Up and Sub) or a diagonal of samples at a time (Average and Paeth). The feature
is a perceptual hash: the signs of the low-frequency cosine-transform coefficients against their median.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, texts

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Payloads are padded with 255 to a positive multiple of this; an image is WIDTH samples wide.
UNIT, WIDTH = 576, 576
TAIL = 32
GRID, LOW = 32, 8


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(samples: np.ndarray, level: int = 1, filters: tuple[int, ...] = (0, 2)) -> bytes:
    """An 8-bit grey PNG of a two-dimensional uint8 array.

    Each row gets the filter type among filters (0 None, 1 Sub, 2 Up) whose signed residuals have the least
    absolute sum; the first of equals.
    """
    height, width = samples.shape
    tried = {0: samples}
    if 1 in filters:
        tried[1] = samples.copy()
        tried[1][:, 1:] -= samples[:, :-1]
    if 2 in filters:
        tried[2] = samples.copy()
        tried[2][1:] -= samples[:-1]
    cost = np.stack([np.abs(tried[k].view(np.int8).astype(np.int16)).sum(axis=1, dtype=np.int64) for k in filters])
    best = np.array(filters, np.uint8)[cost.argmin(axis=0)]
    rows = np.empty((height, width + 1), np.uint8)
    rows[:, 0] = best
    for k in filters:
        rows[best == k, 1:] = tried[k][best == k]
    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + chunk(b"IEND", b"")


def unfilter(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The samples (height x width, one byte each) of filtered rows."""
    if kinds.size and kinds.max() > 4:
        raise ValueError(f"unknown filter type {int(kinds.max())}")
    out = np.empty_like(rows)
    above = np.zeros(rows.shape[1], np.uint8)
    y = 0
    while y < len(kinds):
        kind = int(kinds[y])
        if kind in (3, 4):
            last = y + 1  # a run of rows with these filters is undone together
            while last < len(kinds) and kinds[last] in (3, 4):
                last += 1
            out[y:last] = unfilter_diagonals(kinds[y:last], rows[y:last], above)
            y, above = last, out[last - 1]
            continue
        if kind == 0:
            out[y] = rows[y]
        elif kind == 1:
            out[y] = np.add.accumulate(rows[y], dtype=np.uint8)
        else:
            out[y] = rows[y] + above
        y, above = y + 1, out[y]
    return out


def unfilter_diagonals(kinds: np.ndarray, rows: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Rows with the filters Average (3) and Paeth (4). A sample needs those to its left, above it and between them, so all
    samples of a diagonal from lower left to upper right are undone at once."""
    height, width = rows.shape
    full = np.zeros((height + 1, width + 1), np.int16)  # with the row above and a column of zeros
    full[0, 1:] = above
    average = kinds == 3
    for d in range(height + width - 1):
        y = np.arange(max(0, d - width + 1), min(height, d + 1))
        x = d - y
        left, up, corner = full[y + 1, x], full[y, x + 1], full[y, x]
        to_left, to_up, to_corner = np.abs(up - corner), np.abs(left - corner), np.abs(left + up - 2 * corner)
        paeth = np.where((to_left <= to_up) & (to_left <= to_corner), left, np.where(to_up <= to_corner, up, corner))
        guess = np.where(average[y], (left + up) >> 1, paeth)
        full[y + 1, x + 1] = (rows[y, x] + guess) & 255
    return full[1:, 1:].astype(np.uint8)


def decode_png(data: bytes) -> np.ndarray:
    """The samples of an 8-bit grey PNG without interlacing. Raises ValueError for damaged or other files."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, head, body, ended = 8, None, [], False
    while at + 12 <= len(data) and not ended:
        (size,) = struct.unpack_from(">I", data, at)
        kind, content = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
        if len(content) != size or at + 12 + size > len(data):
            raise ValueError("a chunk is cut short")
        if struct.unpack_from(">I", data, at + 8 + size)[0] != zlib.crc32(data[at + 4 : at + 8 + size]):
            raise ValueError(f"checksum of {kind!r} does not match")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", content)
        elif kind == b"IDAT":
            body.append(content)
        elif kind == b"IEND":
            ended = True
        elif kind[0] & 32 == 0:
            raise ValueError(f"unknown critical chunk {kind!r}")
        at += 12 + size
    if head is None or not ended:
        raise ValueError("IHDR or IEND is missing")
    width, height, depth, colour, *rest = head
    if (depth, colour, *rest) != (8, 0, 0, 0, 0):
        raise ValueError("only 8-bit grey images without interlacing are read")
    raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8)
    if raw.size != height * (width + 1):
        raise ValueError("the image data have the wrong size")
    rows = raw.reshape(height, width + 1)
    return unfilter(rows[:, 0], rows[:, 1:])


def _basis() -> np.ndarray:
    k, x = np.arange(LOW)[:, None], np.arange(GRID)[None, :]
    return np.cos(np.pi * k * (2 * x + 1) / (2 * GRID)).round(12)


BASIS = _basis()


def cosine_hash(samples: np.ndarray) -> str:
    """64 bits as 16 hex digits: the image averaged to GRID x GRID, its LOW x LOW lowest cosine coefficients
    against their median without the first. The mean of an empty cell is that of its nearest row."""
    height, width = samples.shape
    rows = np.minimum(np.arange(GRID + 1) * height // GRID, height)
    cols = np.minimum(np.arange(GRID + 1) * width // GRID, width)
    total = np.zeros((height + 1, GRID), np.int64)
    np.cumsum(np.add.reduceat(samples, cols[:-1], axis=1, dtype=np.int64), axis=0, out=total[1:])
    low = np.minimum(rows[:-1], height - 1)
    high = np.maximum(rows[1:], low + 1)
    means = (total[high] - total[low]) / ((high - low)[:, None] * np.diff(cols)[None, :])
    flat = (BASIS @ means.round(6) @ BASIS.T).round(6).ravel()
    bits = flat > np.median(flat[1:])
    return f"{int(np.packbits(bits).view('>u8')[0]):016x}"


def to_samples(raw: bytes) -> np.ndarray:
    """UTF-8 bytes, padded with 255 to a positive multiple of UNIT, as rows of WIDTH samples."""
    size = max(1, -(-len(raw) // UNIT)) * UNIT
    return np.frombuffer(raw.ljust(size, b"\xff"), np.uint8).reshape(-1, WIDTH)


SCHEMA = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long,"
    " media_sha256 string, feature string"
)


def media_columns(docs: DataFrame, keep_media: bool = True) -> DataFrame:
    """Stores each text of docs(doc_id, text) as a PNG, reads it back and describes what was read.

    Returns one row per input row: doc_id, n_bytes (UTF-8, unpadded), payload_bytes, payload_sha256 and
    tail_crc32 (of the bytes read back; of their last 32), media_bytes, media_sha256, feature (cosine hash) and,
    with keep_media, the PNG in the binary column media. Equal texts have equal values.

    A null text is empty: one row of padding. A null doc_id and repeated rows are kept as they are. Other
    columns are ignored. An empty table gives no rows. A text is held whole, with its image, by one task.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out: list[list] = [[] for _ in range(8)]
            for text in batch.column(1).to_pylist():
                raw = text.encode()
                media = encode_png(to_samples(raw))
                samples = decode_png(media)
                payload = samples.tobytes()
                row = (
                    len(raw),
                    len(payload),
                    hashlib.sha256(payload).hexdigest(),
                    zlib.crc32(payload[-TAIL:]),
                    len(media),
                    hashlib.sha256(media).hexdigest(),
                    cosine_hash(samples),
                    media,
                )
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            arrays = [pa.array(x, k) for x, k in zip(out, kinds, strict=True)][: 8 if keep_media else 7]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    schema = SCHEMA + ", media binary" * keep_media
    names = [x.split()[0] for x in schema.split(",")]
    return texts(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(store, schema)
