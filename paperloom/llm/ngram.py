"""LM scoring with an Elias-Fano n-gram trie.

A trigram model with interpolated absolute discounting is counted over the whole corpus and laid out
as tries of three levels in memory-mapped files. Each level stores its word ids as one Elias-Fano
sequence, made monotone by adding, in each context's range, the last value of the range before; an
Elias-Fano sequence of pointers gives the ranges. A word is found inside its context by a successor
search relative to the context's base. Probabilities and back-off weights are quantised to a byte
each. All bigrams and trigrams are kept, those seen once as well.

    p(w | u v) = q3(u v w) + g2(u v) (q2(v w) + g1(v) p1(w))

Word ids are 32-bit hashes, so no vocabulary is gathered anywhere (V words share an id with a chance
of about V / 2**32). Tries are sharded by the hash of (u, v), so that contexts of frequent words
spread; level 1 is sharded by the word. Every slice of text counts its trigrams before they are
shuffled, so copies and frequent contexts cost once a slice. The numbers of shards follow the bytes of text, so a shard, and
the one task that sorts it, stay of one size however large the corpus is. Counting shuffles compressed
blocks of trigrams, one for each shard and slice of text, rather than rows; where there are more than
MAX_BLOCKS shards, first for groups of shards, which are then split. Only a row a shard of words
reaches the driver.

Files lie in the shared folder and appear under their name when whole; lost tasks rewrite the same.

Defined results: null and empty texts are scored for their end alone (n_tokens 1); repeated rows
count each and score alike; an empty table has an empty result; other columns stay out.
"""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .eliasfano import EliasFano, read, write
from .words import hashes, mix, release, slices, text_column, words

BOS, EOS, PAD, FIRST = 0, 1, 2, 3
DISCOUNT = 0.75
#: Steps a bit of the quantised probabilities and back-off weights; 255 is the least.
STEPS_P, STEPS_G = 8, 16
SLICE = 16 << 20
#: Bytes of text for each shard of the trie (some 6,000,000 trigrams), and of the words.
SHARD_BYTES, WORD_SHARD_BYTES = 40 << 20, 128 << 20
#: Most shards for which a slice of text is cut into a block each.
MAX_BLOCKS = 1024
#: Trigrams gathered before a group of shards is split.
SPLIT = 2_000_000
SCORES = "doc_id bigint, n_tokens bigint, log2_probability double, perplexity double"
U64 = np.uint64


def quantised(p: np.ndarray, steps: int) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.minimum(np.round(-np.log2(np.minimum(p, 1.0)) * steps), 255).astype(np.uint8)


def valued(codes: np.ndarray, steps: int) -> np.ndarray:
    return np.exp2(-np.arange(256) / steps)[codes]


def word_ids(distinct: pa.Array) -> np.ndarray:
    h = (hashes(distinct) >> U64(32)).astype(np.uint32)
    return np.where(h < FIRST, h + FIRST, h).astype(np.uint32)


@dataclass
class Sequences:
    """Words of a slice of texts with a start, an end and a filler around each text."""

    codes: np.ndarray  # of all places
    ids: np.ndarray  # id of each code
    starts: np.ndarray  # place of each text's start

    @classmethod
    def of(cls, text: pa.Array) -> Sequences:
        offsets, at, distinct = words(text)
        n = len(offsets) - 1
        starts = offsets + 3 * np.arange(n + 1)
        codes = np.empty(int(starts[-1]), np.int32)
        codes[np.arange(len(at)) + 1 + 3 * np.repeat(np.arange(n), np.diff(offsets))] = at + FIRST
        codes[starts[:-1]], codes[starts[1:] - 2], codes[starts[1:] - 1] = BOS, EOS, PAD
        return cls(codes, np.concatenate([np.array([BOS, EOS, PAD], np.uint32), word_ids(distinct)]), starts)

    def firsts(self) -> np.ndarray:
        """Places at which a trigram begins."""
        ok = np.ones(len(self.codes), bool)
        ok[self.starts[1:] - 1] = False
        ok[self.starts[1:] - 2] = False
        return np.flatnonzero(ok)


    def trigrams(self) -> list[np.ndarray]:
        """The codes of the distinct trigrams, and how often each occurs."""
        at = self.firsts()
        three = [self.codes[at + k] for k in range(3)]
        if len(self.ids) <= 1 << 21:
            x = (three[0].astype(np.uint64) << U64(42)) | (three[1].astype(np.uint64) << U64(21)) | three[2].astype(np.uint64)
            x.sort()
            begin = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
            x, mask = x[begin], U64((1 << 21) - 1)
            out = [x >> U64(42), x >> U64(21) & mask, x & mask]
        else:
            order = np.lexsort(three[::-1])
            three = [c[order] for c in three]
            begin = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in three])]))
            out = [c[begin] for c in three]
        return [*(c.astype(np.int64) for c in out), np.diff(np.concatenate([begin, [len(at)]])).astype(np.uint32)]


def planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.dtype.itemsize).T).tobytes()


def unplanes(raw: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block, byte planes apart."""
    body = b"".join(planes(a) for a in arrays)
    head = np.array([len(arrays), *[n for a in arrays for n in (a.dtype.itemsize, len(a))]], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + body)


def unpacked(block: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head = np.frombuffer(raw, "<i8", 2 * n, 8)
    at, out = 8 + 16 * n, []
    for size, length in head.reshape(-1, 2):
        out.append(unplanes(raw[at : at + size * length], f"<u{size}"))
        at += size * length
    return out


def sharded(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys) % U64(shards)).astype(np.uint32)


def by_shard(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of each shard that has any."""
    order = np.argsort(shard, kind="stable") if shards > 1 << 16 else np.argsort(shard.astype(np.uint16), kind="stable")
    size = np.bincount(shard, minlength=shards)
    ends = np.cumsum(size)
    for k in np.flatnonzero(size).tolist():
        yield k, order[ends[k] - size[k] : ends[k]]


def blocks(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], names=["shard", "block"])


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their summed weights."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    begin = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[begin], np.add.reduceat(weights[order], begin) if len(begin) else weights[:0]


@dataclass(frozen=True)
class Model:
    """A built model: its folder, numbers of shards and totals."""

    folder: str
    word_shards: int
    shards: int
    total: int
    vocabulary: int

    @property
    def unknown(self) -> float:
        return DISCOUNT * self.vocabulary / max(self.total, 1) / (self.vocabulary + 1)


def count_words(docs: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                s = Sequences.of(text_column(part))
                ids, n = summed(s.ids, np.bincount(s.codes, minlength=len(s.ids)).astype(np.uint64))
                yield blocks([(k, packed(ids[i], n[i])) for k, i in by_shard(sharded(ids, shards), shards)])

    return docs.select("text").mapInArrow(run, "shard int, block binary")


def gathered(fn: Callable[[int, list[bytes]], pa.RecordBatch], most: int = 0) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``fn`` over the blocks of each shard, which lie together; with ``most`` over so many bytes of them at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, size = None, [], 0
        for batch in batches:
            for k, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (k != shard or most and size > most):
                    yield fn(shard, held)
                    held, size = [], 0
                shard = k
                held.append(block)
                size += len(block or b"")
        if held:
            yield fn(shard, held)
            held.clear()
            release()

    return run


def by_id(rows: DataFrame, shards: int) -> DataFrame:
    """Each shard's blocks in one partition, which holds no other unless the engine joins small ones."""
    return rows.repartitionById(shards, "shard").sortWithinPartitions("shard")


def count_trigrams(docs: DataFrame, shards: int) -> DataFrame:
    """Blocks (distinct ids, and three codes and a count a distinct trigram) of each shard, in any number."""
    fan = -(-shards // MAX_BLOCKS)
    groups = -(-shards // fan)

    def split(group: int, held: list[bytes]) -> pa.RecordBatch:
        *three, n = [np.concatenate(x) for x in zip(*(trigrams(b) for b in held), strict=True)]
        shard = sharded((three[0].astype(np.uint64) << U64(32)) | three[1], shards)
        rows = []
        for k, i in by_shard(shard - np.uint32(group * fan), fan):
            ids, codes = np.unique(np.concatenate([x[i] for x in three]), return_inverse=True)
            rows.append((group * fan + k, packed(ids, *codes.astype(np.uint32).reshape(3, -1), n[i])))
        return blocks(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                s = Sequences.of(text_column(part))
                *every, n = s.trigrams()
                shard = sharded((s.ids[every[0]].astype(np.uint64) << U64(32)) | s.ids[every[1]], shards)
                rows = []
                for k, i in by_shard(shard // np.uint32(fan), groups):
                    used = np.zeros(len(s.ids), bool)
                    three = [c[i] for c in every]
                    for c in three:
                        used[c] = True
                    own = np.cumsum(used, dtype=np.int32) - 1  # codes in order of appearance, frequent ones low
                    rows.append((k, packed(s.ids[used], *[own[c].astype(np.uint32) for c in three], n[i])))
                yield blocks(rows)

    found = docs.select("text").mapInArrow(run, "shard int, block binary")
    return found if fan == 1 else by_id(found, groups).mapInArrow(gathered(split, 4 * SPLIT), "shard int, block binary")


def trigrams(block: bytes) -> list[np.ndarray]:
    """Three ids and the count of each trigram of a block."""
    ids, *codes, n = unpacked(block)
    return [*(ids[c] for c in codes), n]


def write_words(folder: str, shard: int, held: list[bytes]) -> pa.RecordBatch:
    """Level 1 of a shard: ids and counts."""
    parts = [unpacked(b) for b in held]
    ids, n = summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    write(os.path.join(folder, f"counts-{shard}"), EliasFano.build(ids, 1 << 32).parts("ids") | {"n": n})
    real = (ids != BOS) & (ids != PAD)
    return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "vocabulary": pa.array([int(real.sum())], pa.int64()), "total": pa.array([int(n[real].sum())], pa.int64())})


@functools.lru_cache(maxsize=20_000)
def mapped(path: str) -> dict[str, np.ndarray]:
    return read(path)


@functools.lru_cache(maxsize=100_000)
def sequence(path: str, name: str) -> EliasFano:
    return EliasFano.of(mapped(path), name)


def context_counts(folder: str, word_shards: int, ids: np.ndarray) -> np.ndarray:
    """Exact counts of words that all occur."""
    out = np.zeros(len(ids), np.float64)
    for k, i in by_shard(sharded(ids, word_shards), word_shards):
        arrays = mapped(os.path.join(folder, f"counts-{k}"))
        out[i] = arrays["n"][EliasFano.of(arrays, "ids").find(ids[i])]
    return out


def relative(last_of: np.ndarray, begin: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Ids made monotone: in each range, those of ``ids`` plus one more than the last value before."""
    step = np.zeros(len(begin), np.uint64)
    step[1:] = np.cumsum(last_of[:-1].astype(np.uint64) + U64(1))
    sizes = np.diff(np.concatenate([begin, [len(ids)]]))
    return np.repeat(step, sizes) + ids.astype(np.uint64)


def write_trie(folder: str, word_shards: int, shard: int, held: list[bytes]) -> pa.RecordBatch:
    """Levels 2 and 3 of a shard; gives the number of different words after each word."""
    a, b, c, n = zip(*map(trigrams, held), strict=True)
    held.clear()
    key = (np.concatenate(a).astype(np.uint64) << U64(32)) | np.concatenate(b)
    third, n = np.concatenate(c), np.concatenate(n).astype(np.int64)
    del a, b, c
    order = np.lexsort((third, key))
    key, third, n = key[order], third[order], n[order]
    del order
    new2 = np.concatenate([[True], key[1:] != key[:-1]])
    new3 = new2 | np.concatenate([[True], third[1:] != third[:-1]])
    at3 = np.flatnonzero(new3)
    n3 = np.add.reduceat(n, at3)
    key3, third3 = key[at3], third[at3]
    at2 = np.flatnonzero(new2)
    n2 = np.add.reduceat(n, at2)
    key2 = key[at2]
    group3 = np.cumsum(new2[at3]) - 1  # bigram of each trigram
    del key, third, n, new2, new3, at2, at3
    followed = n2 - np.bincount(group3, weights=np.where(third3 == PAD, n3, 0), minlength=len(key2))
    keep3 = third3 != PAD
    parent3, third3 = group3[keep3], third3[keep3]
    q3 = (n3[keep3] - DISCOUNT) / followed[parent3]
    g2 = 1.0 - np.bincount(parent3, weights=q3, minlength=len(key2))
    first, second = (key2 >> U64(32)).astype(np.uint32), (key2 & U64(0xFFFFFFFF)).astype(np.uint32)
    begin2 = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(first) else np.zeros(0, np.int64)
    contexts = first[begin2]
    end2 = np.concatenate([begin2[1:], [len(first)]])[: len(begin2)]
    sizes2 = end2 - begin2
    q2 = (n2 - DISCOUNT) / np.repeat(context_counts(folder, word_shards, contexts), sizes2)
    # an empty range (a bigram without trigrams) adds nothing to the values after it
    begin3 = np.searchsorted(parent3, np.arange(len(key2) + 1))
    full = np.flatnonzero(np.diff(begin3))
    arrays: dict[str, np.ndarray] = {}
    for name, values, universe in (
        ("contexts", contexts, 1 << 32),
        ("pointers2", np.concatenate([begin2, [len(key2)]]), len(key2) + 1),
        ("words2", relative(second[end2 - 1], begin2, second), None),
        ("pointers3", begin3, len(parent3) + 1),
        ("words3", relative(third3[begin3[full + 1] - 1], begin3[full], third3), None),
    ):
        arrays |= EliasFano.build(np.asarray(values, np.uint64), universe).parts(name)
    write(os.path.join(folder, f"trie-{shard}"), arrays | {"q2": quantised(q2, STEPS_P), "g2": quantised(g2, STEPS_G), "q3": quantised(q3, STEPS_P)})
    return blocks([(k, packed(contexts[i], sizes2[i].astype(np.uint32))) for k, i in by_shard(sharded(contexts, word_shards), word_shards)])


def write_unigrams(folder: str, total: int, unknown: float, shard: int, held: list[bytes]) -> pa.RecordBatch:
    """Probabilities and back-off weights of level 1 of a shard."""
    arrays = mapped(os.path.join(folder, f"counts-{shard}"))
    ids, n = EliasFano.of(arrays, "ids"), arrays["n"].astype(np.float64)
    parts = [unpacked(b) for b in held if b is not None]
    followers = np.zeros(len(n))
    if parts:
        np.add.at(followers, ids.find(np.concatenate([p[0] for p in parts])), np.concatenate([p[1] for p in parts]))
    # whatever its bigrams' counts, each loses DISCOUNT
    left = np.where(followers > 0, DISCOUNT * followers / n, 1.0)
    p1 = np.maximum(n - DISCOUNT, 0) / max(total, 1) + unknown
    write(os.path.join(folder, f"words-{shard}"), ids.parts("ids") | {"p1": quantised(p1, STEPS_P), "g1": quantised(np.maximum(left, 2.0**-15), STEPS_G)})
    return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32())})


def trained(docs: DataFrame) -> Model:
    """Counts the corpus and writes the model in a few jobs, each of which survives lost executors."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    shards, word_shards = -(-size // SHARD_BYTES) or 1, -(-size // WORD_SHARD_BYTES) or 1
    folder = os.path.join(shared_path(spark), f"ngrams-{uuid.uuid4().hex}")
    os.makedirs(folder)
    write = lambda fn, *args: gathered(functools.partial(fn, folder, *args))
    counted = by_id(count_words(docs, word_shards), word_shards).mapInArrow(write(write_words), "shard int, vocabulary bigint, total bigint").collect()
    model = Model(folder, word_shards, shards, sum(r["total"] for r in counted), sum(r["vocabulary"] for r in counted))
    if counted:
        followers = by_id(count_trigrams(docs, shards), shards).mapInArrow(write(write_trie, word_shards), "shard int, block binary")
        every = spark.range(word_shards).selectExpr("int(id) AS shard", "CAST(NULL AS BINARY) AS block")
        every = every.filter(every["shard"].isin([r["shard"] for r in counted]))
        by_id(followers.unionByName(every), word_shards).mapInArrow(write(write_unigrams, model.total, model.unknown), "shard int").collect()
    return model


class Scorer:
    """Looks words, bigrams and trigrams up in a model's files."""

    def __init__(self, model: Model):
        self.m = model

    def unigrams(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p, g = np.full(len(ids), self.m.unknown), np.ones(len(ids))
        for k, i in by_shard(sharded(ids, self.m.word_shards), self.m.word_shards):
            path = os.path.join(self.m.folder, f"words-{k}")
            if not os.path.exists(path):
                continue
            arrays = mapped(path)
            at = EliasFano.of(arrays, "ids").find(ids[i])
            hit = at >= 0
            p[i[hit]] = valued(arrays["p1"][at[hit]], STEPS_P)
            g[i[hit]] = valued(arrays["g1"][at[hit]], STEPS_G)
        return p, g

    @staticmethod
    def bases(words: EliasFano, begin: np.ndarray) -> np.ndarray:
        """What each range that starts at ``begin`` adds to its ids: one more than the value before it."""
        base = np.zeros(len(begin), np.uint64)
        later = begin > 0
        base[later] = words.access(begin[later] - 1) + U64(1)
        return base

    @staticmethod
    def within(words: EliasFano, base: np.ndarray, begin: np.ndarray, end: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Place of each id in its context's range, or -1."""
        at = words.find(base + ids.astype(np.uint64))
        return np.where((at >= begin) & (at < end), at, -1)

    def sequences(self, s: Sequences) -> np.ndarray:
        """log2 probability of each place that is predicted, 0 elsewhere."""
        p1, g1 = self.unigrams(s.ids)
        # a code pair is a bigram; each distinct one is looked up once
        at = s.firsts()
        pairs = s.codes[at].astype(np.uint64) << U64(32) | s.codes[at + 1].astype(np.uint64)
        order = np.argsort(pairs, kind="stable")
        ranked = pairs[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, bool)
        which = np.empty(len(pairs), np.int64)
        which[order] = np.cumsum(new) - 1
        pairs = ranked[new]
        del order, ranked
        first, second = s.ids[(pairs >> U64(32)).astype(np.int64)], s.ids[(pairs & U64(0xFFFFFFFF)).astype(np.int64)]
        n = len(pairs)
        q2, g2 = np.zeros(n), np.ones(n)
        begin, end, base = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.uint64)
        shard = sharded((first.astype(np.uint64) << U64(32)) | second, self.m.shards)
        for k, i in by_shard(shard, self.m.shards):
            path = os.path.join(self.m.folder, f"trie-{k}")
            if not os.path.exists(path):
                continue
            arrays = mapped(path)
            # pairs are in order of their first code: each context is looked up once
            code = pairs[i] >> U64(32)
            fresh = np.concatenate([[True], code[1:] != code[:-1]])
            context = sequence(path, "contexts").find(first[i[fresh]])
            known = context >= 0
            span = np.zeros((3, len(context)), np.int64)
            pointers, level2 = sequence(path, "pointers2"), sequence(path, "words2")
            span[0, known] = pointers.access(context[known]).astype(np.int64)
            span[1, known] = pointers.access(context[known] + 1).astype(np.int64)
            span[2, known] = self.bases(level2, span[0, known]).astype(np.int64)
            run = np.cumsum(fresh) - 1
            some = known[run]
            i, (b2, e2, base2) = i[some], span[:, run[some]]
            node = self.within(level2, base2.astype(np.uint64), b2, e2, second[i])
            i, node = i[node >= 0], node[node >= 0]
            q2[i], g2[i] = valued(arrays["q2"][node], STEPS_P), valued(arrays["g2"][node], STEPS_G)
            pointers = sequence(path, "pointers3")
            begin[i], end[i] = pointers.access(node).astype(np.int64), pointers.access(node + 1).astype(np.int64)
            i = i[end[i] > begin[i]]
            base[i] = self.bases(sequence(path, "words3"), begin[i])
        # the place after a bigram's first word is predicted from it
        low = q2 + g1[(pairs >> U64(32)).astype(np.int64)] * p1[(pairs & U64(0xFFFFFFFF)).astype(np.int64)]
        p = np.ones(len(s.codes))
        p[at + 1] = low[which]
        # ... and from the bigram before, where there is one in the same text
        inner = np.flatnonzero(s.codes[at] != BOS)
        before = which[inner - 1]
        place = at[inner] + 1
        p[place] *= g2[before]
        deep = np.flatnonzero(end[before] > begin[before])
        before, place = before[deep], place[deep]
        for k, i in by_shard(shard[before], self.m.shards):
            path = os.path.join(self.m.folder, f"trie-{k}")
            arrays = mapped(path)
            b = before[i]
            node = self.within(sequence(path, "words3"), base[b], begin[b], end[b], s.ids[s.codes[place[i]]])
            hit = node >= 0
            p[place[i[hit]]] += valued(arrays["q3"][node[hit]], STEPS_P)
        return np.log2(p)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """A row a document: its number of predicted tokens, log2 probability and perplexity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                s = Sequences.of(text_column(part))
                sums = np.add.reduceat(scorer.sequences(s), s.starts[:-1])
                n = np.diff(s.starts) - 2
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(sums), pa.array(np.exp2(-sums / n))], names=["doc_id", "n_tokens", "log2_probability", "perplexity"])

    return docs.select("doc_id", "text").mapInArrow(run, SCORES)
