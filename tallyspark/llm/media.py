"""Media columns: texts as greyscale PNG samples in a binary column, and cosine-transform hashes.

``write_media`` stores each text's UTF-8 bytes, filled up with bytes 255 to a positive multiple of 576,
as an 8-bit greyscale PNG of 576 columns whose rows take the filter that leaves the least sum of absolute
differences. ``features`` decodes any 8-bit greyscale PNG: chunk checksums are tested, filters 0 to 4 undone
in numpy for all images of a batch together, and the low frequencies of a 32 x 32 reduction hashed.

Null and empty texts give one row of 255. Equal texts give equal values. Rows are independent, so
repeated rows, null ids, very long texts and empty tables need no special case; other columns are left out.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

WIDTH, FILL, SIDE, LOW = 576, b"\xff", 32, 8
#: Rows that are filtered at once.
BAND = 2048
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def filtered(pixels: np.ndarray, kinds: np.ndarray | None = None) -> np.ndarray:
    """Rows with their filter byte in front. Row r takes filter kinds[r], or else the one that leaves the least
    sum of absolute differences, the lowest of equal ones."""
    out = np.empty((len(pixels), pixels.shape[1] + 1), np.uint8)
    for a in range(0, len(pixels), BAND):
        x = pixels[a : a + BAND].astype(np.int16)
        above = pixels[a - 1 : a].astype(np.int16) if a else np.zeros((1, x.shape[1]), np.int16)
        up = np.concatenate([above, x[:-1]])
        left, corner = np.pad(x, ((0, 0), (1, 0)))[:, :-1], np.pad(up, ((0, 0), (1, 0)))[:, :-1]
        rests = np.stack([x, x - left, x - up, x - (left + up) // 2, x - _paeth(left, up, corner)]).astype(np.uint8)
        if kinds is None:
            best = np.minimum(rests, -rests).sum(axis=2, dtype=np.int64).argmin(axis=0)
        else:
            best = kinds[a : a + BAND]
        out[a : a + BAND, 0] = best
        out[a : a + BAND, 1:] = rests[best, np.arange(len(x))]
    return out


def _paeth(left: np.ndarray, up: np.ndarray, corner: np.ndarray) -> np.ndarray:
    by_left, by_up, by_corner = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
    return np.where((by_left <= by_up) & (by_left <= by_corner), left, np.where(by_up <= by_corner, up, corner))


def unfiltered(rows: np.ndarray, heights: list[int] | None = None) -> np.ndarray:
    """The pixels of filtered rows of one image, or of images of ``heights`` one below another.

    Column c of an image's row r is undone in step r + c, so what it depends on (left, above, above left)
    is known from the two steps before; a step handles the rows of all images at once.
    """
    kinds, raw = rows[:, 0], np.ascontiguousarray(rows[:, 1:])
    if kinds.size and kinds.max() > 4:
        raise ValueError("unknown PNG filter")
    n, width = raw.shape
    heights = np.array([n] if heights is None else heights, np.int64)
    local = np.arange(n) - np.repeat(np.cumsum(heights) - heights, heights)
    order = np.argsort(local, kind="stable")  # rows that are at work in a step lie together
    local, kinds = local[order], kinds[order]
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    above = np.where(local > 0, place[order - 1], n)  # place n stays 0
    own, flat, out = order * width - local, raw.ravel(), np.zeros(raw.size, np.uint8)
    used = np.flatnonzero(np.bincount(kinds, minlength=5)).tolist()
    last, before = np.zeros(n + 1, np.int16), np.zeros(n + 1, np.int16)
    steps = np.arange(width + int(heights.max(initial=0)) - 1) if n else []
    firsts, ends = np.searchsorted(local, steps - np.int64(width), "right") if n else [], np.searchsorted(local, steps, "right") if n else []
    for d, a, b in zip(steps, firsts, ends, strict=True):
        left, up, guess = last[a:b], last[above[a:b]], np.zeros(b - a, np.int16)
        for kind in used[used[0] == 0 :]:
            if kind == 1:
                this = left
            elif kind == 2:
                this = up
            elif kind == 3:
                this = (left + up) >> 1
            else:
                this = _paeth(left, up, before[above[a:b]])
            guess = np.where(kinds[a:b] == kind, this, guess)
        at = own[a:b] + d
        value = (flat[at] + guess) & 255
        out[at] = value
        before, last = last, before
        last[a:b] = value  # others of this step are over, or have not begun and stay 0
    return out.reshape(n, width)


def encode_png(samples: bytes, width: int = WIDTH, kinds: np.ndarray | None = None, level: int = 6) -> bytes:
    """An 8-bit greyscale PNG; ``kinds`` are the rows' filters, chosen for each row where not given."""
    pixels = np.frombuffer(samples, np.uint8).reshape(-1, width)
    head = struct.pack(">IIBBBBB", width, len(pixels), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(filtered(pixels, kinds).tobytes(), level)) + _chunk(b"IEND", b"")


def inflated(data: bytes) -> np.ndarray:
    """Filtered rows of an 8-bit greyscale PNG; ValueError where a checksum, a length or the kind is wrong."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, head, packed, ended = 8, None, [], False
    while at < len(data) and not ended:
        (n,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if len(body) != n or data[at + 8 + n : at + 12 + n] != struct.pack(">I", zlib.crc32(kind + body)):
            raise ValueError(f"PNG chunk {kind!r} fails its checksum")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
        ended, at = kind == b"IEND", at + 12 + n
    if not ended or head is None or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not a whole 8-bit greyscale PNG")
    width, height = head[:2]
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8)
    if raw.size != height * (width + 1):
        raise ValueError("a PNG has another size than its header says")
    return raw.reshape(height, width + 1)


def decode_png(*images: bytes) -> list[np.ndarray]:
    """Pixels of 8-bit greyscale PNGs; images of one width are undone together."""
    rows, out = list(map(inflated, images)), [np.zeros((0, 0), np.uint8)] * len(images)
    for width in {r.shape[1] for r in rows}:
        own = [k for k, r in enumerate(rows) if r.shape[1] == width]
        heights = [len(rows[k]) for k in own]
        pixels = unfiltered(np.concatenate([rows[k] for k in own]), heights)
        for k, part in zip(own, np.split(pixels, np.cumsum(heights)[:-1]), strict=True):
            out[k] = part
    return out


@functools.lru_cache(4096)
def _low(n: int) -> np.ndarray:
    """LOW x n: area-averages n samples to SIDE and takes the first LOW cosine coefficients."""
    edges = np.linspace(0, n, SIDE + 1)
    place = np.arange(n)
    cover = np.clip(np.minimum(edges[1:, None], place + 1) - np.maximum(edges[:-1, None], place), 0, None)
    k = np.arange(LOW)[:, None]
    return np.cos(np.pi * k * (2 * np.arange(SIDE) + 1) / (2 * SIDE)) @ (cover / cover.sum(axis=1, keepdims=True))


def cosine_hash(pixels: np.ndarray) -> bytes:
    """64 bits: which of the 8 x 8 lowest frequencies lie above their median (the mean's own bit is 0)."""
    low = np.round(_low(pixels.shape[0]) @ (pixels @ _low(pixels.shape[1]).T), 6)
    flat = low.ravel()[1:]
    return np.packbits(np.concatenate([[False], flat > np.median(flat)])).tobytes()


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
        media = [encode_png(t + FILL * (-len(t) % WIDTH or (0 if t else WIDTH))) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])


def write_media(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Parquet of doc_id, n_bytes (before filling) and media (PNG); PNG bytes don't compress again."""
    docs = common.keyed(docs, id_col, text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs.mapInArrow(_store, f"doc_id {kind}, n_bytes bigint, media binary").write.option("compression", "none").parquet(path)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        rows = []
        stored = batch.column("media").to_pylist()
        for n, media, pixels in zip(batch.column("n_bytes").to_pylist(), stored, decode_png(*stored), strict=True):
            payload = pixels.tobytes()
            low = cosine_hash(pixels)
            rows.append((n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), low.hex(), low))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
        names = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "feature_bits")
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns, kinds)], ["doc_id", *names])


def features(media: DataFrame) -> DataFrame:
    """Decode the stored media and describe each: sizes, digests, the hash as hex and as 8 bytes."""
    kind = media.schema["doc_id"].dataType.simpleString()
    return media.mapInArrow(_features, f"doc_id {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, feature_bits binary")
