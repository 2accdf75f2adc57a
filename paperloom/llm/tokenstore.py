"""Token ids in binary shards with Elias-Fano document boundaries.

Each input partition becomes one shard in a shared folder: ``shard-N.bin`` has the ids of all its
documents without gaps, 16 bits each while the vocabulary allows it, and ``shard-N.ef`` the
boundaries (documents + 1 values) as an Elias-Fano sequence. Document i spans
``select(i) .. select(i + 1)``; no table of 64-bit offsets exists. Both files can be memory-mapped.

Shards are written as the partition streams by, under another name until whole; a lost executor's
tasks write the same bytes again. Nothing is shuffled and nothing reaches the driver.

Defined results: a null or empty text is a document without tokens; documents with a null id and
repeated rows each have a place of their own; an empty table writes no shard; other columns stay out.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_path
from .bpe import loaded, vocabulary
from .eliasfano import EliasFano, read, write
from .words import release, slices, text_column

#: Bytes of text encoded at once: the more, the fewer words are met again.
SLICE = 16 << 20
SCHEMA = "doc_id bigint, shard int, place bigint, first_token bigint, n_tokens bigint, id_sum bigint"


class Shard:
    """A shard opened for reading."""

    def __init__(self, folder: str, shard: int):
        arrays = read(os.path.join(folder, f"shard-{shard}.ef"))
        self.bounds = EliasFano.of(arrays, "bounds")
        size = int(arrays["id_bytes"][0])
        path = os.path.join(folder, f"shard-{shard}.bin")
        self.ids = np.memmap(path, f"<u{size}", "r") if os.path.getsize(path) else np.zeros(0, f"<u{size}")

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def span(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First token and the one after the last of each document."""
        p = np.asarray(places, np.int64)
        return self.bounds.access(p).astype(np.int64), self.bounds.access(p + 1).astype(np.int64)

    def __getitem__(self, place: int) -> np.ndarray:
        a, b = self.span(np.array([place]))
        return self.ids[a[0] : b[0]]


def new_folder(spark: SparkSession) -> str:
    folder = os.path.join(shared_path(spark), f"tokens-{uuid.uuid4().hex}")
    os.makedirs(folder)
    return folder


def written(docs: DataFrame, folder: str | None = None, path: str | None = None) -> DataFrame:
    """Writes the shards as it runs; a row a document, read back from the shard by select.

    id_sum is the sum of the ids that the shard holds for the document.
    """
    folder = folder or new_folder(docs.sparkSession)
    path = path or vocabulary(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        size = 2 if len(bpe.tokens) <= 1 << 16 else 4
        shard = TaskContext.get().partitionId()
        whole = os.path.join(folder, f"shard-{shard}.bin")
        other = f"{whole}.{uuid.uuid4().hex}"
        owners, sizes = [], []
        with open(other, "wb") as f:
            for batch in batches:
                for part in slices(batch, "text", SLICE):
                    offsets, ids = bpe.encode_column(text_column(part))
                    f.write(ids.astype(f"<u{size}").tobytes())
                    owners.append(part.column(0))
                    sizes.append(np.diff(offsets))
                release()
        if not owners:
            os.remove(other)
            return
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        os.replace(other, whole)
        write(os.path.join(folder, f"shard-{shard}.ef"), EliasFano.build(ends, int(ends[-1]) + 1).parts("bounds") | {"id_bytes": np.array([size])})
        back = Shard(folder, shard)
        at = 0
        for ids in owners:
            places = np.arange(at, at + len(ids))
            a, b = back.span(places)
            sums = np.concatenate([[0], np.cumsum(back.ids[a[0] : b[-1]], dtype=np.int64)])
            at += len(ids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.full(len(ids), shard, np.int32)), pa.array(places), pa.array(a), pa.array(b - a), pa.array(sums[b - a[0]] - sums[a - a[0]])], names=["doc_id", "shard", "place", "first_token", "n_tokens", "id_sum"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
