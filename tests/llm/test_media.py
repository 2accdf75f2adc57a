import random
import zlib

import numpy as np
import pytest

from paperloom.llm import media


def slow(lines, step):
    """Filters undone one byte at a time."""
    out = []
    for row in lines:
        kind, x, prev = int(row[0]), [int(v) for v in row[1:]], out[-1] if out else [0] * (len(row) - 1)
        for i in range(len(x)):
            a = x[i - step] if i >= step else 0
            b, c = prev[i], prev[i - step] if i >= step else 0
            p = a + b - c
            paeth = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - c) else b if abs(p - b) <= abs(p - c) else c
            x[i] = (x[i] + [0, a, b, (a + b) // 2, paeth][kind]) & 255
        out.append(x)
    return out


@pytest.mark.parametrize(("colour", "depth"), [(0, 8), (0, 16), (0, 1), (0, 4), (2, 8), (2, 16), (3, 8), (3, 2), (4, 8), (6, 8), (6, 16)])
def test_unfilter(colour, depth):
    rng = np.random.default_rng(colour * 20 + depth)
    w, h = 21, 17
    size = (w * media.CHANNELS[colour] * depth + 7) // 8
    lines = rng.integers(0, 256, (h, size), dtype=np.uint8)
    kinds = [random.Random(y).randint(0, 4) for y in range(h)]
    raw = media.png(lines, w, depth, colour, kinds, palette=bytes(range(256)) * 3 if colour == 3 else b"")
    shape, grid, palette = media.opened(raw)
    step = max(1, media.CHANNELS[colour] * depth // 8)
    assert media.unfiltered(grid[None], step)[0].tolist() == lines.tolist() == slow(grid.tolist(), step)
    assert media.hashed_batch([1], [raw])[0][1:4] == ("ok", w, h)


@pytest.mark.parametrize(("w", "h"), [(1, 1), (1, 300), (300, 1), (5, 600), (40, 257)])
def test_bands(w, h):
    lines = np.random.default_rng(w).integers(0, 256, (2, h, 3 * w), dtype=np.uint8)
    grids = media.filtered(lines, [(y * 7 + 3) % 5 for y in range(h)], 3)
    assert media.unfiltered(grids, 3).tolist() == lines.tolist() == [slow(g.tolist(), 3) for g in grids]


def test_resize_equals_single_values():
    for size in (7, 32, 50):
        v = np.random.default_rng(size).random(size)
        fine = np.repeat(v, 32)  # each value in 32 parts, of which a mean takes ``size``
        assert np.allclose(media.averaged(size) @ v, fine.reshape(32, size).mean(1))


def test_long_vectors_and_kinds(spark):
    rng = np.random.default_rng(4)
    v = [float(x) for x in rng.normal(0, 0.2, 100)]
    e = spark.createDataFrame([(1, v), (2, v[:64]), (3, v[:99] + [None]), (None, v)], "vec_id bigint, embedding array<double>")
    got = {r["media_id"]: r for r in media.hashed(media.pictures(e)).collect()}
    assert {k: (r["status"], r["width"]) for k, r in got.items()} == {1: ("ok", 40), 2: ("ok", 32), 3: ("ok", 40), None: ("ok", 40)}
    assert got[1]["cosine_hash"] == got[None]["cosine_hash"] and got[1]["grey_mean"] != got[3]["grey_mean"]
    interlaced = bytearray(media.png(np.zeros((8, 8), np.uint8), 8))
    interlaced[28] = 1
    interlaced[29:33] = zlib.crc32(interlaced[12:29]).to_bytes(4, "big")
    assert media.hashed_batch([1], [bytes(interlaced)])[0][1] == "unsupported"


def test_held(monkeypatch):
    monkeypatch.setattr(media, "HELD_BYTES", 100)
    images = [media.png(np.full((8, 8), i, np.uint8), 8) if i % 3 else None for i in range(20)]
    assert [(r[1], r[4]) for r in media.hashed_batch(list(range(20)), images)] == [("ok", float(i)) if i % 3 else ("empty", None) for i in range(20)]


def test_hash_equals_direct_sum():
    grey = np.random.default_rng(1).random((1, 32, 32)) * 255
    direct = np.array([[sum(grey[0, y, x] * np.cos(np.pi * u * (2 * y + 1) / 64) * np.cos(np.pi * v * (2 * x + 1) / 64) for y in range(32) for x in range(32)) for v in range(8)] for u in range(8)]).ravel()
    assert np.unpackbits(media.cosine_hashes(grey)[0]).tolist() == (direct > np.median(direct[1:])).astype(int).tolist()


def test_alike():
    rng = np.random.default_rng(2)
    base = np.kron(rng.integers(0, 256, (8, 8)), np.ones((8, 8)))
    near = np.clip(base + rng.normal(0, 3, base.shape), 0, 255)
    other = np.kron(rng.integers(0, 256, (8, 8)), np.ones((8, 8)))
    a, b, c = (np.unpackbits(media.cosine_hashes(x[None])[0]) for x in (base, near, other))
    assert (a != b).sum() <= 4 < 12 < (a != c).sum()


def test_broken_and_query(spark):
    good = media.png(np.arange(64, dtype=np.uint8).reshape(8, 8), 8)
    flipped = bytearray(good)
    flipped[-20] ^= 1
    cases = {"empty": None, "signature": b"not a png", "cut": good[:-3], "checksum": bytes(flipped)}
    huge = media.SIGNATURE + media.chunk(b"IHDR", bytes.fromhex("7fffffff7fffffff0800000000")) + media.chunk(b"IDAT", zlib.compress(b"x")) + media.chunk(b"IEND", b"")
    short = media.SIGNATURE + good[8:33] + media.chunk(b"IDAT", zlib.compress(b"\0" * 9)) + media.chunk(b"IEND", b"")
    cases |= {"unsupported": huge}
    rows = [(i, bytearray(v) if v is not None else None, "x") for i, v in enumerate([*cases.values(), good, good, short])]
    df = spark.createDataFrame(rows, "media_id bigint, image binary, status string")
    got = {r["media_id"]: (r["status"], r["cosine_hash"]) for r in media.hashed(df).collect()}
    assert [got[i][0] for i in range(8)] == [*cases, "ok", "ok", "cut"]
    assert got[5][1] == got[6][1] and len(got[5][1]) == 8 and got[0][1] is None
    assert media.hashed(df.filter("media_id > 99")).collect() == []
    e = spark.createDataFrame([(1, [0.1] * 64), (2, []), (3, None), (4, [0.5, None])], "vec_id bigint, embedding array<float>")
    assert {r["media_id"]: r["status"] for r in media.hashed(media.pictures(e)).collect()} == {1: "ok", 2: "empty", 3: "empty", 4: "ok"}
