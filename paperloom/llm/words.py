"""Vectorised word splitting for Arrow text columns.

Words are what whitespace separates in the lower-cased text, without punctuation at either end (a
word of punctuation alone stays as it is). Splitting, trimming and hashing are Arrow and numpy over
whole columns; Python touches only words of more than 32 bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash

TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
EDGES = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
EDGE = regex.compile(EDGES)
#: Punctuation that is tried before the pattern.
COMMON = ".,;:!?\"'()"
#: Bytes of text handled at once inside a task; bounds memory, not results.
SLICE_BYTES = 4 << 20


def release() -> None:
    """Gives freed memory back, as a worker keeps its process over many stages."""
    pa.default_memory_pool().release_unused()
    if TRIM is not None:
        TRIM(0)


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The column as strings with '' for null."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(name)).cast(pa.string()), "")


def slices(batch: pa.RecordBatch, name: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of about ``size`` bytes of text, one row at least."""
    n = batch.num_rows
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name))), 0)).astype(np.int64))
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
        yield batch.slice(at, to - at)
        at = to


def trimmed(word: str) -> str:
    if word.isalpha():
        return word
    core = word.strip(COMMON)
    return core if core.isalpha() else EDGE.sub("", word) or word


def words(text: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Offsets of each text's words, index of each word, and the distinct words."""
    parts = pc.utf8_split_whitespace(pc.utf8_lower(text))
    coded = parts.flatten().dictionary_encode()
    offsets = np.asarray(parts.offsets).astype(np.int64)
    offsets -= offsets[0]
    # Arrow leaves white space at the end of a text, as a piece or behind its last word
    raw, at = pc.utf8_trim_whitespace(coded.dictionary), np.asarray(coded.indices)
    blank = np.asarray(pc.equal(pc.binary_length(raw), 0))
    if blank.any():
        keep = ~blank[at]
        offsets, at = np.concatenate([[0], np.cumsum(keep)])[offsets], at[keep]
        to = np.cumsum(~blank) - 1
        at, raw = to[at], raw.filter(pa.array(~blank))
    core = pc.replace_substring_regex(raw, EDGES, "")
    distinct = pc.if_else(pc.equal(pc.binary_length(core), 0), raw, core).dictionary_encode()
    return offsets, np.asarray(distinct.indices).astype(np.int64)[at], distinct.dictionary


def hashes(distinct: pa.Array) -> np.ndarray:
    """64-bit hashes of the words."""
    n = len(distinct)
    if not n:
        return np.zeros(0, np.uint64)
    _, offsets, data = distinct.buffers()
    at = np.frombuffer(offsets, np.int32)[distinct.offset : distinct.offset + n + 1].astype(np.int64)
    size = np.diff(at)
    raw = np.concatenate([np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(raw, 8)
    out = mix(size.astype(np.uint64))
    for k in range(0, 32, 8):
        live = np.flatnonzero(size > k)
        part = np.ascontiguousarray(eight[at[live] + k]).view("<u8").ravel()
        rest = np.minimum(size[live] - k, 8).astype(np.uint64)
        part = part << (np.uint64(64) - rest * np.uint64(8))  # nothing of the next word
        out[live] = mix(out[live] * np.uint64(0x9E3779B97F4A7C15) + part)
    for i in np.flatnonzero(size > 32).tolist():
        out[i] = xxhash.xxh3_64_intdigest(raw[at[i] : at[i + 1]].tobytes())
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
