"""Media columns: PNG decoding by hand and low-frequency cosine-transform hashes.

The decoder walks the chunks, tests every checksum, joins and inflates the data chunks with zlib and
undoes the line filters in numpy, along anti-diagonals, for images of a batch with the same shape at once. The hash
averages an image to 32 x 32 greys, takes the lowest 8 x 8 coefficients of its cosine transform and
keeps a bit for each: whether it lies above their median. Images that look alike differ in few bits.

Defined results: null and empty values, wrong signatures, wrong checksums, cut data and unsupported
kinds (interlaced, more than MAX_PIXELS pixels, or a bit depth other than 8 and 16 where there are
several channels) give a row with ``status`` and null hashes; vectors may have any length, and nulls in them
are 0; no vector gives no image; repeated rows give repeated results; other columns stay out.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
SIDE, LOW = 32, 8
HASHES = "media_id bigint, status string, width int, height int, grey_mean double, cosine_hash binary"
#: Values of an image beyond this are refused rather than inflated (a file may claim any size).
MAX_PIXELS = 1 << 28
#: Lines undone at once, and bytes of inflated images that wait for others of their shape; they bound memory, not results.
BAND = 256
HELD_BYTES = 32 << 20


class Broken(ValueError):
    """The file isn't a PNG that can be decoded."""


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def chunks(raw: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Kind and data of each chunk, its checksum tested."""
    if raw[:8] != SIGNATURE:
        raise Broken("signature")
    at = 8
    while at < len(raw):
        if at + 12 > len(raw):
            raise Broken("cut")
        (size,) = struct.unpack_from(">I", raw, at)
        if at + 12 + size > len(raw):
            raise Broken("cut")
        kind, data = raw[at + 4 : at + 8], raw[at + 8 : at + 8 + size]
        if zlib.crc32(data, zlib.crc32(kind)) != struct.unpack_from(">I", raw, at + 8 + size)[0]:
            raise Broken("checksum")
        yield kind, data
        if kind == b"IEND":
            return
        at += 12 + size
    raise Broken("cut")


def opened(raw: bytes | None) -> tuple[tuple[int, int, int, int], np.ndarray, np.ndarray | None]:
    """(width, height, depth, colour), the filtered lines and the palette."""
    if not raw:
        raise Broken("empty")
    head, palette, data = None, None, []
    for kind, body in chunks(bytes(raw)):
        if kind == b"IHDR" and len(body) == 13:
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body[: len(body) // 3 * 3], np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            data.append(body)
    if head is None:
        raise Broken("header")
    w, h, depth, colour, packing, filtering, interlace = head
    if colour not in CHANNELS or packing or filtering or interlace or not w or not h or w * h > MAX_PIXELS or depth not in ((1, 2, 4, 8, 16) if colour == 0 else (1, 2, 4, 8) if colour == 3 else (8, 16)):
        raise Broken("unsupported")
    stride = (w * CHANNELS[colour] * depth + 7) // 8
    try:
        lines = zlib.decompressobj().decompress(b"".join(data), h * (stride + 1))
    except zlib.error as e:
        raise Broken("data") from e
    if len(lines) != h * (stride + 1):
        raise Broken("cut")
    grid = np.frombuffer(lines, np.uint8).reshape(h, stride + 1)
    if grid[:, 0].max() > 4:
        raise Broken("filter")
    if colour == 3 and palette is None:
        raise Broken("palette")
    return (w, h, depth, colour), grid, palette


def unfiltered(grids: np.ndarray, step: int) -> np.ndarray:
    """Raw lines of images of one shape (images x lines x (1 + bytes)); ``step`` bytes a pixel.

    Lines are undone in bands of BAND. A pixel needs the ones before, above and before that, so all
    pixels of an anti-diagonal are undone at once; they lie side by side in an array by diagonal and line.
    """
    n, h, size = grids.shape
    w = (size - 1) // step
    out = np.zeros((n, h, size - 1), np.uint8)
    last = np.zeros((n, w, step), np.uint8)
    for top in range(0, h, BAND):
        part = grids[:, top : top + BAND]
        m = part.shape[1]
        # diagonal (1 + pixel + line), line (the one above the band first), image, byte
        skewed = np.zeros((w + m + 1, m + 1, n, step), np.uint8)
        skewed[1 : w + 1, 0] = last.transpose(1, 0, 2)
        for y in range(m):
            skewed[y + 2 : y + 2 + w, y + 1] = part[:, y, 1:].reshape(n, w, step).transpose(1, 0, 2)
        kinds = np.zeros((m + 1, n, 1), np.uint8)
        kinds[1:, :, 0] = part[:, :, 0].T
        is_left, is_up, is_mean, is_paeth = (kinds == k for k in range(1, 5))
        for d in range(2, w + m + 1):
            lo, hi = max(1, d - w), min(m, d - 1) + 1
            left, up = skewed[d - 1, lo:hi].astype(np.int16), skewed[d - 1, lo - 1 : hi - 1].astype(np.int16)
            corner = skewed[d - 2, lo - 1 : hi - 1].astype(np.int16)
            by_left, by_up = abs(up - corner), abs(left - corner)
            by_corner = abs(left + up - 2 * corner)
            paeth = np.where((by_left <= by_up) & (by_left <= by_corner), left, np.where(by_up <= by_corner, up, corner))
            add = left * is_left[lo:hi] + up * is_up[lo:hi] + ((left + up) >> 1) * is_mean[lo:hi] + paeth * is_paeth[lo:hi]
            skewed[d, lo:hi] += add.astype(np.uint8)
        for y in range(m):
            out[:, top + y] = skewed[y + 2 : y + 2 + w, y + 1].transpose(1, 0, 2).reshape(n, size - 1)
        last = out[:, top + m - 1].reshape(n, w, step)
    return out


def greys(lines: np.ndarray, shape: tuple[int, int, int, int], palettes: list[np.ndarray | None]) -> np.ndarray:
    """Grey values 0 to 255 (images x height x width)."""
    w, h, depth, colour = shape
    n, c = len(lines), CHANNELS[colour]
    if depth < 8:
        bits = np.unpackbits(lines, axis=2).reshape(n, h, -1, depth)
        v = (bits * (1 << np.arange(depth - 1, -1, -1))).sum(3)[:, :, :w].astype(np.float64)
        v = v[..., None] if colour == 3 else v[..., None] * (255 / ((1 << depth) - 1))
    elif depth == 16:
        pair = lines.reshape(n, h, w, c, 2).astype(np.float64)
        v = (pair[..., 0] * 256 + pair[..., 1]) / 257
    else:
        v = lines.reshape(n, h, w, c).astype(np.float64)
    if colour == 3:
        v = np.stack([np.asarray(p, np.float64)[np.minimum(x[..., 0].astype(int), len(p) - 1)] for x, p in zip(v, palettes, strict=True)])
    if v.shape[3] >= 3:
        return v[..., 0] * 0.299 + v[..., 1] * 0.587 + v[..., 2] * 0.114
    return v[..., 0]


def averaged(size: int) -> np.ndarray:
    """Weights that average ``size`` values to SIDE ones, by overlap."""
    edges = np.arange(SIDE + 1) * size / SIDE
    at = np.arange(size)
    m = np.clip(np.minimum(edges[1:, None], at + 1) - np.maximum(edges[:-1, None], at), 0, None)
    return m / m.sum(1, keepdims=True)


_k, _x = np.arange(LOW)[:, None], np.arange(SIDE)[None, :]
COSINES = np.cos(np.pi * _k * (2 * _x + 1) / (2 * SIDE))


def cosine_hashes(grey: np.ndarray) -> np.ndarray:
    """8 bytes an image."""
    small = averaged(grey.shape[1]) @ grey @ averaged(grey.shape[2]).T
    low = np.round(COSINES @ small @ COSINES.T, 6).reshape(len(grey), -1)
    return np.packbits(low > np.median(low[:, 1:], axis=1, keepdims=True), axis=1)


def hashed_batch(ids: list, images: Iterable) -> list[tuple]:
    """A row of HASHES for each image; inflated images wait for others of their shape up to HELD_BYTES."""
    rows: list[tuple] = [()] * len(ids)
    alike: dict[tuple, list] = defaultdict(list)
    held = 0

    def flush() -> None:
        for (w, h, depth, colour), group in alike.items():
            most = max(1, (1 << 22) // (w * h))  # bounds memory
            for at in range(0, len(group), most):
                part = group[at : at + most]
                lines = unfiltered(np.stack([g for _, g, _ in part]), max(1, CHANNELS[colour] * depth // 8))
                grey = greys(lines, (w, h, depth, colour), [p for _, _, p in part])
                for (i, _, _), bits, mean in zip(part, cosine_hashes(grey), grey.mean(axis=(1, 2)), strict=True):
                    rows[i] = (ids[i], "ok", w, h, float(mean), bits.tobytes())
        alike.clear()

    for i, raw in enumerate(images):
        try:
            shape, grid, palette = opened(raw)
        except Broken as e:
            rows[i] = (ids[i], str(e), None, None, None, None)
            continue
        alike[shape].append((i, grid, palette))
        held += grid.size
        if held > HELD_BYTES:
            flush()
            held = 0
    flush()
    return rows


def hashed(media: DataFrame) -> DataFrame:
    """From columns media_id and image to a row of status, size and hash each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.binary()]
        for batch in batches:
            rows = hashed_batch(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[x.split()[0] for x in HASHES.split(", ")])

    return media.select("media_id", "image").mapInArrow(run, HASHES)


def filtered(lines: np.ndarray, kinds: list[int], step: int) -> np.ndarray:
    """Lines of images (images x lines x bytes) under the given filters, each after its filter's number, for writing."""
    row = lines.astype(np.int16)
    left, up, corner = np.zeros_like(row), np.zeros_like(row), np.zeros_like(row)
    left[:, :, step:], up[:, 1:], corner[:, 1:, step:] = row[:, :, :-step], row[:, :-1], row[:, :-1, :-step]
    out = np.zeros((*lines.shape[:2], lines.shape[2] + 1), np.uint8)
    out[:, :, 0] = kinds
    for k in set(kinds):
        y = np.flatnonzero(np.asarray(kinds) == k)
        a, b, c = left[:, y], up[:, y], corner[:, y]
        da, db, dc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
        guess = [0, a, b, (a + b) >> 1, np.where((da <= db) & (da <= dc), a, np.where(db <= dc, b, c))][k]
        out[:, y, 1:] = (row[:, y] - guess) & 255
    return out


def file_of(grid: np.ndarray, width: int, depth: int, colour: int, palette: bytes = b"") -> bytes:
    """A PNG of filtered lines."""
    body = zlib.compress(grid.tobytes(), 6)
    half = len(body) // 2
    return b"".join([SIGNATURE, chunk(b"IHDR", struct.pack(">IIBBBBB", width, len(grid), depth, colour, 0, 0, 0)), chunk(b"PLTE", palette) if palette else b"", chunk(b"IDAT", body[:half]), chunk(b"IDAT", body[half:]), chunk(b"IEND", b"")])


def png(lines: np.ndarray, width: int, depth: int = 8, colour: int = 0, kinds: list[int] | None = None, palette: bytes = b"") -> bytes:
    """A PNG of raw lines (height x bytes)."""
    step = max(1, CHANNELS[colour] * depth // 8)
    return file_of(filtered(lines[None], kinds or [y % 5 for y in range(len(lines))], step)[0], width, depth, colour, palette)


def pictures(embeddings: DataFrame) -> DataFrame:
    """Each vector as a grey PNG, a square of 4 x 4 tiles of its values (8 x 8 tiles at least): media_id and image."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            images: list[bytes | None] = [None] * b.num_rows
            sides = defaultdict(list)
            for i, v in enumerate(b.column(1)):
                if v.is_valid and len(v):
                    sides[max(8, math.isqrt(len(v) - 1) + 1)].append(i)
            for side, rows in sides.items():
                step = max(1, (1 << 20) // side**2)
                for at in range(0, len(rows), step):
                    part = rows[at : at + step]
                    x = np.zeros((len(part), side * side))
                    for k, i in enumerate(part):
                        v = b.column(1)[i].values
                        x[k, : len(v)] = v.to_numpy(zero_copy_only=False)
                    grey = np.clip(np.round(128 + 256 * np.nan_to_num(x)), 0, 255).astype(np.uint8).reshape(-1, side, side)
                    grids = filtered(grey.repeat(4, axis=1).repeat(4, axis=2), [y % 5 for y in range(4 * side)], 1)
                    for i, grid in zip(part, grids, strict=True):
                        images[i] = file_of(grid, 4 * side, 8, 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(images, pa.binary())], names=["media_id", "image"])

    return embeddings.selectExpr("vec_id AS media_id", "embedding").mapInArrow(run, "media_id bigint, image binary")
