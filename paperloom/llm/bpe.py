"""BPE encoding and decoding without a merge loop.

An Aho-Corasick automaton gives the longest token that starts at each byte. The encoder takes it,
and accepts it only if the pair (previous token, it) is compatible: byte-pair merging would leave
just this border between the two. If not, it takes the next shorter prefix token, and if none is
left it goes back by one token; a bit a byte marks positions from which no encoding goes on, so each
is left at most once and the time is linear. Tokens that merging never forms take no part, so the
result equals exact merging in rank order. A vocabulary with a token that ranks before one it is
merged from is refused.
Decoding gathers bytes from one blob through a table of token offsets.

Texts are cut where the vocabulary's pattern cuts them. A cut always lies before a space that follows
no white space, so Arrow first splits on single spaces and only distinct pieces reach the encoder.

Defined results: a null or empty text has no tokens; any text, long or of invalid words, decodes to
exactly its own bytes; repeated rows get repeated results; other columns don't matter.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from .words import release, slices, text_column

#: Where the setting ``spark.paperloom.vocabulary`` and the parameter are absent.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space before a space: such a text isn't cut at its spaces but by the pattern as a whole.
RUN_OF_SPACES = "[\\t-\\r\\x{1c}-\\x{20}\\x{85}\\p{Z}] "
#: Distinct words whose tokens a worker remembers, in each of two generations.
CACHE = 250_000
#: Bytes of text decoded at once.
DECODE_BYTES = 1 << 20


class Bpe:
    """A byte-level vocabulary in rank order, read from a file of base64 tokens and ranks."""

    def __init__(self, tokens: list[bytes], pattern: str = PATTERN):
        self.tokens = tokens
        self.ids = {t: i for i, t in enumerate(tokens)}
        if len(self.ids) != len(tokens) or any(bytes([b]) not in self.ids for b in range(256)):
            raise ValueError("the vocabulary needs distinct tokens and all single bytes")
        self.length = [len(t) for t in tokens]
        self.findall = regex.compile(pattern).findall
        self.pairs: dict[tuple[int, int], int] = {}
        self.halves = [(i, i) for i in range(len(tokens))]
        self.known: dict[int, bool] = {}
        #: Whether merging can form the token at all; one that it can't is decoded, but never emitted.
        self.formed = [n == 1 for n in self.length]
        for i, t in enumerate(tokens):
            for k in range(len(t) - 1, 0, -1):
                a, b = self.ids.get(t[:k], -1), self.ids.get(t[k:], -1)
                if 0 <= a < i and 0 <= b < i and self.formed[a] and self.formed[b] and self.compatible(a, b):
                    self.pairs[a, b] = i
                    self.halves[i] = (a, b)
                    self.formed[i] = True
                    break
        if late := [t for i, t in enumerate(tokens) if not self.formed[i] and len(self.merged(t)) == 1]:
            raise ValueError(f"{late[0]!r} ranks before a token that it is merged from")
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            if self.formed[i]:
                self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        #: The longest formed token that is a proper prefix, or -1.
        self.shorter = [next((j for k in range(len(t) - 1, 0, -1) if (j := self.ids.get(t[:k], -1)) >= 0 and self.formed[j]), -1) for t in tokens]
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int64)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str = VOCABULARY, pattern: str = PATTERN) -> Bpe:
        with open(path, "rb") as f:
            ranked = sorted((int(b), base64.b64decode(a)) for a, b in map(bytes.split, f) if a)
        if [r for r, _ in ranked] != list(range(len(ranked))):
            raise ValueError("ranks must run from 0 without gaps")
        return cls([t for _, t in ranked], pattern)

    def merged(self, word: bytes) -> list[bytes]:
        """Plain merging, the lowest rank first; only for tests of a vocabulary."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            rank, k = min((self.ids.get(a + b, len(self.ids)), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == len(self.ids):
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging keeps the border between the two tokens, found by undoing their merges, latest first."""
        limit = 1 << 60
        halves, pairs = self.halves, self.pairs
        while True:
            if pairs.get((left, right), limit) < limit:
                return False
            if left > right:
                limit = left
                left = halves[left][1]
                if left == limit:
                    limit = right + 1
                    right = halves[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit = right + 1
                right = halves[right][0]
                if right + 1 == limit:
                    limit = left
                    left = halves[left][1]
                    if left == limit:
                        return True

    def encode_word(self, word: bytes) -> list[int]:
        """Tokens of one piece of the pattern."""
        whole = self.ids.get(word)
        if whole is not None and self.formed[whole]:
            return [whole]
        if not word:
            return []
        text = word.decode("latin-1")
        length, shorter, known = self.length, self.shorter, self.known
        # the longest matches one after the other, as long as each fits the one before
        out: list[int] = []
        last, at = -1, -1
        for end, token in self.automaton.iter_long(text):
            if end - length[token] != at:
                break
            if last >= 0:
                fits = known.get(last << 32 | token)
                if fits is None:
                    fits = known[last << 32 | token] = self.compatible(last, token)
                if not fits:
                    break
            out.append(token)
            last, at = token, end
        if at == len(word) - 1:
            return out
        longest: list[int] = [0] * len(word)
        for end, token in self.automaton.iter(text):
            longest[end + 1 - length[token]] = token  # ends rise, so the longest comes last
        out = []
        alive = bytearray(b"\x01") * (len(word) + 1)
        at, size, token = 0, len(word), longest[0]
        while at < size:
            last = out[-1] if out else -1
            while True:
                end = at + length[token]
                if alive[end]:
                    if last < 0:
                        break
                    fits = known.get(last << 32 | token)
                    if fits is None:
                        fits = known[last << 32 | token] = self.compatible(last, token)
                    if fits:
                        break
                token = shorter[token]
                if token < 0:
                    break
            if token >= 0:
                out.append(token)
                at = end
                if at < size:
                    token = longest[at]
            else:
                alive[at] = 0
                token = out.pop()
                at -= length[token]
        return out

    def packed(self, word: str) -> bytes:
        """The tokens of one piece of the pattern as 32-bit integers, remembered in two generations."""
        got = self.cache.get(word)
        if got is None:
            got = self.older.get(word)
            if got is None:
                got = array("i", self.encode_word(word.encode("utf-8", "surrogatepass"))).tobytes()
            if len(self.cache) >= CACHE:
                self.older, self.cache = self.cache, {}
                if len(self.known) >= 2 * CACHE:
                    self.known.clear()
            self.cache[word] = got
        return got

    def packed_after_space(self, piece: str) -> bytes:
        """The tokens of a space and what follows it up to the next space."""
        if piece.isalpha():
            return self.packed(" " + piece)
        core = piece[:-1]
        if core.isalpha():  # a word and one more character, which can't belong to it
            return self.packed(" " + core) + self.packed(piece[-1])
        return self.packed_text(" " + piece)

    def packed_text(self, text: str) -> bytes:
        return b"".join(map(self.packed, self.findall(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed_text(text), "<i4").tolist()

    def encode_column(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of a column of strings without nulls: offsets of each row and all ids."""
        n = len(text)
        odd = np.flatnonzero(np.asarray(pc.match_substring_regex(text, RUN_OF_SPACES)))
        own = {int(i): self.packed_text(text[int(i)].as_py()) for i in odd}
        if own:
            mask = np.zeros(n, bool)
            mask[odd] = True
            text = pc.if_else(pa.array(mask), "", text)
        parts = pc.split_pattern(text, " ")
        flat = parts.flatten()
        first = np.asarray(parts.offsets).astype(np.int64)
        first -= first[0]
        coded = flat.dictionary_encode()
        known = list(map(self.packed_after_space, coded.dictionary.to_pylist()))
        which = np.asarray(coded.indices).astype(np.int64)
        starts = first[:-1]  # splitting gives one piece at least
        which[starts] = len(known) + np.arange(n)
        known += [own.get(i) if i in own else self.packed_text(p) for i, p in enumerate(flat.take(pa.array(starts)).to_pylist())]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        pool = np.frombuffer(b"".join(known), "<i4")
        begins = np.cumsum(sizes) - sizes
        count = sizes[which]
        ends = np.cumsum(count)
        ids = pool[np.repeat(begins[which] - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)]
        return np.concatenate([[0], ends])[first] if n else np.zeros(1, np.int64), ids

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens."""
        ids = np.asarray(ids, np.int64)
        count = self.starts[ids + 1] - self.starts[ids]
        ends = np.cumsum(count)
        return self.blob[np.repeat(self.starts[ids] - (ends - count), count) + np.arange(int(ends[-1]) if len(ids) else 0)]


def vocabulary(spark: SparkSession) -> str:
    """The vocabulary's path: the setting ``spark.paperloom.vocabulary``, or VOCABULARY. All executors read it."""
    return spark.conf.get("spark.paperloom.vocabulary", VOCABULARY) or VOCABULARY


_LOADED: dict[str, Bpe] = {}


def loaded(path: str = VOCABULARY) -> Bpe:
    """The worker's vocabulary of this path."""
    if path not in _LOADED:
        _LOADED[path] = Bpe.load(path)
    return _LOADED[path]


def same_bytes(bpe: Bpe, text: pa.Array, offsets: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row whether its tokens decode to its text."""
    n = len(text)
    buffers = text.buffers()
    at = np.frombuffer(buffers[1], np.int32)[text.offset : text.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    ok = np.ones(n, bool)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + DECODE_BYTES, side="right")) - 1)
        got = bpe.decode(ids[offsets[i] : offsets[j]])
        if not np.array_equal(got, raw[at[i] : at[j]]):
            for k in range(i, j):
                ok[k] = np.array_equal(bpe.decode(ids[offsets[k] : offsets[k + 1]]), raw[at[k] : at[k + 1]])
        i = j
    return ok


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, token_ids, n_tokens and whether the tokens decode to the text's own bytes."""
    path = path or vocabulary(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            for part in slices(batch):
                text = text_column(part)
                offsets, ids = bpe.encode_column(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)), pa.array(np.diff(offsets)), pa.array(same_bytes(bpe, text, offsets, ids))],
                    names=["doc_id", "token_ids", "n_tokens", "exact"],
                )
            release()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, token_ids array<int>, n_tokens bigint, exact boolean")
