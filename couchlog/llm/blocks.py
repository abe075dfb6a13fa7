"""Documents packed into blocks of a few MB, for operators that go over whole texts several times.

A block is one row: a number and its compressed documents. Blocks are stored bucketed by their
number, so that what other blocks have answered (a few bits per position) can be joined to them
without moving text again. A document is never split; a very long one is a block of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couchlog.llm.common import schema, shared_folder
from couchlog.llm.words import utf8

BLOCK_BYTES = 4 << 20


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string."""
    parts = [np.ascontiguousarray(a) for a in arrays]
    sizes = np.array([len(p) for p in parts], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(sizes.tobytes() + b"".join(p.tobytes() for p in parts))


def unsqueeze(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    out, at = [], 8 * len(kinds)
    for n, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out


class Block:
    """Ids, offsets (one more than documents) and bytes of a block's documents."""

    def __init__(self, payload: bytes):
        self.ids, self.offsets, self.data = unsqueeze(payload, "<i8", "<i8", "u1")

    def owner(self, places: np.ndarray) -> np.ndarray:
        """Index of the document that holds each byte position."""
        return np.searchsorted(self.offsets, places, "right") - 1


def _pack(block_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, texts, held = [], [], 0

        def block() -> pa.RecordBatch:
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            payload = squeeze(np.array(ids, "<i8"), offsets.astype("<i8"), np.frombuffer(b"".join(texts), np.uint8))
            return pa.record_batch([pa.array([number]), pa.array([payload], pa.binary())], ["block", "payload"])

        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, s, e in zip(batch.column("id").to_pylist(), offsets.tolist(), offsets[1:].tolist()):
                if texts and held + e - s > block_bytes:
                    yield block()
                    ids, texts, held, number = [], [], 0, number + 1
                ids.append(i)
                texts.append(data[s:e].tobytes())
                held += e - s
        if texts:
            yield block()

    return pack


class Blocks:
    """The staged blocks of a table with id and text."""

    def __init__(self, rows: DataFrame, block_bytes: int = BLOCK_BYTES):
        spark = rows.sparkSession
        self.bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = min(max(8, -(-self.bytes // (4 * block_bytes))), 50_000)
        name = f"blocks_{uuid.uuid4().hex}"
        packed = rows.select("id", "text").mapInArrow(_pack(block_bytes), schema("block bigint, payload binary"))
        packed.write.bucketBy(buckets, "block").option("path", shared_folder(spark)).option("compression", "none").saveAsTable(name)
        self.table = spark.table(name)
        self.table.schema  # resolved: only the files are needed from here on
        spark.sql(f"DROP TABLE {name}")

    def map(self, each: Callable[[int, Block], Iterator[pa.RecordBatch]], out: str) -> DataFrame:
        """`each` on every block."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                    yield from each(number, Block(payload.as_py()))

        return self.table.select("block", "payload").mapInArrow(run, schema(out))

    def map_with(self, replies: list[DataFrame], each: Callable[..., Iterator[pa.RecordBatch]], out: str) -> DataFrame:
        """`each` on every block and its row of each of `replies` (block and one column), None where there is none."""
        joined = self.table.select("block", "payload")
        for k, reply in enumerate(replies):
            joined = joined.join(reply.toDF("block", f"reply{k}"), "block", "left")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    number, payload, *rest = (c[row] for c in batch.columns)
                    yield from each(number.as_py(), Block(payload.as_py()), *[r if r.is_valid else None for r in rest])

        return joined.mapInArrow(run, schema(out))


def sliding(op: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """op (minimum or maximum) over every `width` consecutive values."""
    if len(x) < width:
        return x[:0]
    done = 1
    while 2 * done <= width:
        x = op(x[: len(x) - done], x[done:])
        done *= 2
    rest = width - done
    return op(x[: len(x) - rest], x[rest:]) if rest else x


def minimizers(grams: np.ndarray, inside: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of grams that are the least of some window, and each window's least gram.

    A window is `width` consecutive grams; `inside` says of each whether it lies in one document.
    Equal windows choose equal grams, so two windows can only be equal if their least grams are.
    """
    least = np.where(inside, sliding(np.minimum, grams, width), np.uint64(0))
    pad = np.zeros(width - 1, np.uint64)
    most = sliding(np.maximum, np.concatenate([pad, least, pad]), width)
    return np.flatnonzero((grams == most) & (grams != 0)), least
