"""Blocks ask parts and get answers, in a number of rows that grows with the blocks and not with blocks x parts.

With one row for each block and part, both of which grow with the corpus, rows grow with its square.
Here a row goes to at most `FAN` lanes. A lane is a range of FAN^k parts; its runs travel together
until a relay, which holds the rows of some FAN blocks (a cell), deals them to the FAN narrower lanes
inside. After as many hops as the number of parts has digits to the base FAN every lane is one part.
Answers go the same way back. Each hop moves at most FAN rows for each block and each part.

A load is a compressed set of runs: its blocks, the size of the run of each block for each part of
the lane, and the runs. A cell holds about as many bytes at each hop as a block sends. An empty run
is not sent and gets no answer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couchlog.llm.blocks import squeeze, unsqueeze
from couchlog.llm.words import mix

FAN = 64
ROWS = "lane bigint, cell bigint, load binary"


def flat(*arrays: np.ndarray) -> bytes:
    """Arrays as one string, not compressed."""
    parts = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return np.array([len(p) for p in parts], "<u4").tobytes() + b"".join(parts)


def unflat(data: bytes, *kinds: str) -> list[np.ndarray]:
    out, at = [], 4 * len(kinds)
    for n, kind in zip(np.frombuffer(data, "<u4", len(kinds)).tolist(), kinds):
        out.append(np.frombuffer(data, kind, n // np.dtype(kind).itemsize, at))
        at += n
    return out


class _Load:
    """Runs of several blocks (rows of `sizes`) for the parts of a lane (its columns), one after another in `data`."""

    def __init__(self, packed: bytes):
        self.blocks, sizes, data = unsqueeze(packed, "<i8", "<u4", "u1")
        self.sizes = sizes.reshape(len(self.blocks), -1)
        self.data = data.tobytes()
        self.ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    def runs(self, member: int, first: int, last: int) -> bytes:
        """The runs of a block for the parts first to last - 1 of the lane."""
        at = member * self.sizes.shape[1]
        return self.data[self.ends[at + first] : self.ends[at + last]]


def _packed(blocks: np.ndarray, sizes: np.ndarray, runs: list[bytes]) -> bytes:
    return squeeze(blocks.astype("<i8"), sizes.astype("<u4").ravel(), np.frombuffer(b"".join(runs), np.uint8))


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    lane, cell, load = zip(*rows) if rows else ((), (), ())
    return pa.table({"lane": pa.array(lane, pa.int64()), "cell": pa.array(cell, pa.int64()), "load": pa.array(load, pa.binary())})


class Exchange:
    """Ways between about `blocks` blocks and `parts` parts."""

    def __init__(self, blocks: int, parts: int, fan: int = FAN):
        self.blocks, self.parts, self.fan = max(1, blocks), parts, fan
        self.hops = 1
        while fan**self.hops < parts:
            self.hops += 1

    def width(self, hop: int) -> int:
        """Parts of a lane after so many hops."""
        return self.fan ** (self.hops - hop)

    def cells(self, blocks: np.ndarray, hop: int) -> np.ndarray:
        """The cell of each block after so many hops: itself, then groups of FAN, FAN^2, ... blocks."""
        if not hop:
            return blocks
        return (mix(blocks.astype(np.uint64)) % np.uint64(self.blocks)).astype(np.int64) // self.fan**hop

    # --- to the parts ---

    def send(self, block: int, bounds: np.ndarray, pack: Callable[[int, int], bytes]) -> Iterator[pa.RecordBatch]:
        """The rows of a block: `pack` makes a part's run of the range that `bounds` gives it."""
        width, rows, me = self.width(1), [], np.array([block], np.int64)
        for lane, first in enumerate(range(0, self.parts, width)):
            ends = bounds[first : first + width + 1].tolist()
            runs = [pack(s, e) if e > s else b"" for s, e in zip(ends, ends[1:])]
            if any(runs):
                sizes = np.zeros((1, width), np.int64)
                sizes[0, : len(runs)] = [len(r) for r in runs]
                rows.append((lane, int(self.cells(me, 1)[0]), _packed(me, sizes, runs)))
        yield from _batch(rows).to_batches()

    def deal(self, rows: DataFrame, hop: int) -> DataFrame:
        """Rows after `hop` hops, one hop further."""
        fan, width, cells = self.fan, self.width(hop + 1), self.cells

        def relay(table: pa.Table) -> pa.Table:
            lane, out = table["lane"][0].as_py(), []
            loads = [_Load(x.as_py()) for x in table["load"]]
            blocks = np.concatenate([x.blocks for x in loads])
            cell = int(cells(blocks[:1], hop + 1)[0])
            for digit in range(fan):
                first, last = digit * width, (digit + 1) * width
                sizes = np.concatenate([x.sizes[:, first:last] for x in loads])
                some = sizes.any(1)
                if some.any():
                    runs = [x.runs(m, first, last) for x in loads for m in range(len(x.blocks))]
                    out.append((lane * fan + digit, cell, _packed(blocks[some], sizes[some], runs)))
            return _batch(out)

        return rows.groupBy("lane", "cell").applyInArrow(relay, ROWS)

    # --- in a part, and back ---

    def answer(self, rows: DataFrame, each: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
        """`each` on all runs of a part, which gives one answer for each run; the answers go back to the cells."""
        hops, cells = self.hops, self.cells

        def answered(table: pa.Table) -> pa.Table:
            loads = [_Load(x.as_py()) for x in table["load"]]
            answers = iter(each([x.runs(m, 0, 1) for x in loads for m in range(len(x.blocks))]))
            out = []
            for x in loads:
                bits = [next(answers) for _ in x.blocks]
                sizes = np.array([[len(b)] for b in bits])
                out.append((table["lane"][0].as_py(), int(cells(x.blocks[:1], hops - 1)[0]), _packed(x.blocks, sizes, bits)))
            return _batch(out)

        return rows.groupBy("lane").applyInArrow(answered, ROWS)

    def gather(self, rows: DataFrame, hop: int) -> DataFrame:
        """Answers of lanes after `hop` + 1 hops, for the wider lanes after `hop`, one row for each cell after `hop` - 1."""
        fan, width, inner, cells = self.fan, self.width(hop), self.width(hop + 1), self.cells

        def relay(table: pa.Table) -> pa.Table:
            lane = table["lane"][0].as_py() // fan
            loads = [(x.as_py() % fan, _Load(y.as_py())) for x, y in zip(table["lane"], table["load"])]
            blocks = np.unique(np.concatenate([x.blocks for _, x in loads]))
            sizes = np.zeros((len(blocks), width), np.int64)
            runs: list[dict[int, bytes]] = [{} for _ in blocks]
            for digit, x in loads:
                places = np.searchsorted(blocks, x.blocks)
                sizes[places, digit * inner : (digit + 1) * inner] = x.sizes
                for m, place in enumerate(places.tolist()):
                    runs[place][digit] = x.runs(m, 0, inner)
            out, home = [], cells(blocks, hop - 1)
            for cell in np.unique(home).tolist():
                mine = np.flatnonzero(home == cell)
                bits = [runs[b][digit] for b in mine.tolist() for digit in sorted(runs[b])]
                out.append((lane, cell, _packed(blocks[mine], sizes[mine], bits)))
            return _batch(out)

        up = rows.withColumn("up", F.expr(f"lane div {fan}"))
        return up.groupBy("up", "cell").applyInArrow(relay, ROWS)

    def asked(self, sent: DataFrame, each: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
        """What the parts answer to the rows that `send` made: one row for each block (cell, array of lane and load)."""
        rows = sent
        for hop in range(1, self.hops):
            rows = self.deal(rows, hop)
        rows = self.answer(rows, each)
        for hop in range(self.hops - 1, 0, -1):
            rows = self.gather(rows, hop)
        return rows.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("lane", "load"))).alias("reply"))

    def received(self, reply: pa.Scalar | None) -> Iterator[tuple[int, bytes]]:
        """The answers that a block got: part and answer."""
        width = self.width(1)
        for row in [] if reply is None else reply.values.to_pylist():
            load = _Load(row["load"])
            for k in np.flatnonzero(load.sizes[0]).tolist():
                yield row["lane"] * width + k, load.runs(0, k, k + 1)
