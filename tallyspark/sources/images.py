"""Page images in one form: PNG whose longer side has at most so many pixels.

PNG is decoded and written with numpy; larger images are made smaller with separable Lanczos weights of three lobes, widened by
the scale. Other formats need an optional image library, and are left as they are without it, as is what can't be decoded.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Samples of a pixel by the colour types of PNG; 3 is a palette.
_SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def png_pixels(raw: bytes) -> np.ndarray | None:
    """Rows, columns and samples (grey, grey and alpha, colours, colours and alpha) of 8 bits; None for an image
    that isn't a PNG or is interlaced."""
    if not raw.startswith(SIGNATURE):
        return None
    at, data, palette, clear, head = 8, [], None, b"", None
    while at + 8 <= len(raw):
        size, kind = struct.unpack(">I4s", raw[at : at + 8])
        body = raw[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack(">I", raw[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("a PNG chunk doesn't match its checksum")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"tRNS":
            clear = body
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + size
    width, height, depth, colour, _, _, interlaced = head
    if interlaced:
        return None
    samples = _SAMPLES[colour]
    stride, step = (width * samples * depth + 7) // 8, max(1, samples * depth // 8)
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, stride + 1)
    rows = _unfiltered(lines, step)
    if depth == 16:
        pixels = rows.reshape(height, width, samples, 2)[..., 0]
    elif depth == 8:
        pixels = rows.reshape(height, width, samples)
    else:
        bits = np.unpackbits(rows, axis=1).reshape(height, -1, depth)[:, : width * samples]
        pixels = (bits << np.arange(depth - 1, -1, -1, dtype=np.uint8)).sum(2, dtype=np.uint8).reshape(height, width, samples)
        if colour != 3:
            pixels = pixels * np.uint8(255 // (2**depth - 1))
    if colour == 3:
        alpha = np.full(len(palette), 255, np.uint8)
        alpha[: len(clear)] = np.frombuffer(clear, np.uint8)
        pixels = np.concatenate([palette, alpha[:, None]], 1)[pixels[..., 0]]
        pixels = pixels if clear else pixels[..., :3]
    return pixels


def _unfiltered(lines: np.ndarray, step: int) -> np.ndarray:
    """Rows without their filters. Filters 0 to 2 are undone a row at a time; a run of rows with filters 3 and 4 along
    diagonals, on which no pixel depends on another."""
    kinds, raw = lines[:, 0], lines[:, 1:]
    if len(kinds) and kinds.max() > 4:
        raise ValueError("unknown PNG filter")
    out, above, k = np.empty_like(raw), np.zeros(raw.shape[1], np.uint8), 0
    while k < len(kinds):
        until = k + 1
        if kinds[k] < 3:
            line = raw[k]
            out[k] = np.cumsum(line.reshape(-1, step), 0, dtype=np.uint8).ravel() if kinds[k] == 1 else line + above if kinds[k] == 2 else line
        else:
            while until < len(kinds) and kinds[until] > 2:
                until += 1
            out[k:until] = _by_diagonals(raw[k:until], kinds[k:until] == 3, above, step)
        k, above = until, out[until - 1]
    return out


def _by_diagonals(raw: np.ndarray, averaged: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    rows, columns = len(raw), raw.shape[1] // step
    known = np.zeros((rows + 1, columns + 1, step), np.int16)  # with a border of zeros at the left
    known[0, 1:] = above.reshape(columns, step)
    given = raw.reshape(rows, columns, step)
    for d in range(rows + columns - 1):
        r = np.arange(max(0, d - columns + 1), min(rows, d + 1))
        c = d - r
        left, up, corner = known[r + 1, c], known[r, c + 1], known[r, c]
        to_left, to_up, to_corner = np.abs(up - corner), np.abs(left - corner), np.abs(left + up - 2 * corner)
        paeth = np.where((to_left <= to_up) & (to_left <= to_corner), left, np.where(to_up <= to_corner, up, corner))
        known[r + 1, c + 1] = (given[r, c] + np.where(averaged[r, None], (left + up) >> 1, paeth)) & 255
    return known[1:, 1:].astype(np.uint8).reshape(rows, -1)


def png_bytes(pixels: np.ndarray) -> bytes:
    """Each row is stored as its difference from the row above."""
    height, width, samples = pixels.shape
    flat = pixels.reshape(height, -1)
    lines = np.empty((height, flat.shape[1] + 1), np.uint8)
    lines[:, 0] = 2
    lines[0, 1:], lines[1:, 1:] = flat[0], flat[1:] - flat[:-1]
    colour = {v: k for k, v in _SAMPLES.items() if k != 3}[samples]
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def _weights(old: int, new: int) -> tuple[np.ndarray, np.ndarray]:
    """For each new pixel, which old ones it is made of, and their shares."""
    scale = max(old / new, 1.0)
    centre = (np.arange(new) + 0.5) * old / new
    first = np.floor(centre - 3 * scale).astype(int)
    at = first[:, None] + np.arange(int(np.ceil(6 * scale)) + 1)
    far = (at + 0.5 - centre[:, None]) / scale
    share = np.where(np.abs(far) < 3, np.sinc(far) * np.sinc(far / 3), 0)
    share[(at < 0) | (at >= old)] = 0
    return at.clip(0, old - 1), share / share.sum(1, keepdims=True)


def resampled(pixels: np.ndarray, width: int, height: int) -> np.ndarray:
    """The image at another size: columns first, then rows."""
    out = pixels.astype(np.float32)
    for axis, new in ((1, width), (0, height)):
        at, share = _weights(out.shape[axis], new)
        shape = [1, 1, 1]
        shape[axis] = new
        out = sum(np.take(out, at[:, k], axis) * share[:, k].reshape(shape).astype(np.float32) for k in range(at.shape[1]))
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def bounded(width: int, height: int, largest: int) -> tuple[int, int]:
    """Width and height with the longer side at most ``largest``, in the same ratio."""
    longer = max(width, height)
    return (width, height) if longer <= largest else (max(1, width * largest // longer), max(1, height * largest // longer))


def normalized(raw: bytes, largest: int) -> tuple[bytes, str | None]:
    """The image as PNG of bounded size and its media type; None as the type where it was left as it is."""
    pixels = png_pixels(raw)
    if pixels is None:
        try:
            import io

            from PIL import Image  # optional

            with Image.open(io.BytesIO(raw)) as image:
                pixels = np.asarray(image.convert("RGB"))
        except (ImportError, OSError):
            return raw, None
    height, width = pixels.shape[:2]
    size = bounded(width, height, largest)
    if size == (width, height) and raw.startswith(SIGNATURE):
        return raw, "image/png"
    return png_bytes(pixels if size == (width, height) else resampled(pixels, *size)), "image/png"
