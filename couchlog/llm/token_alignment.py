"""Alignment of two tokenizers over a corpus: which tokens cover the same bytes, and how common each pair is.

Both tokenizers see space + text. Where tokens of both end at one byte, the text is cut into groups;
tokens whose bytes overlap are linked. The count of a pair of ids is the number of documents in which it
is linked.

Counting is external. Each task writes, per block of documents, a record for every pair and document, in
the order of the pairs, and the block's own count of each pair as a run: ascending keys with the id of A
in front, in zstd frames of `FRAME` entries, one run for each radix part of A's ids (`PARTS` of them, fixed,
so rows grow with the bytes and no faster). Runs of a part are merged `FAN` at a time by a heap over the
frames' last keys: all entries up to the least of them are in memory and are added up. Merges form a
tree, so no task takes all runs of a frequent id. In the last merge all pairs of one id of A pass one
after the other, which gives the largest count of that id. Counts and maxima then go down the same tree
to the blocks, which add them up per document.

Defined cases: a null or empty text, and one whose tokens do not give back its bytes, has no tokens; null
ids and repeated rows are documents of their own, and count so; ties for the largest count are all best;
a very long text is a block of its own, in memory at some 100 bytes per byte; other columns are kept,
also those with names used here; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from couchlog.llm.blocks import squeeze, unsqueeze
from couchlog.llm.common import boxed, documents, schema, stage
from couchlog.llm.packing import Encoder, odd_texts
from couchlog.llm.words import utf8, word_hashes

BLOCK_BYTES = 4 << 20
PARTS = 64
FAN = 64
FRAME = 1 << 14
_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of one of each distinct value, and which of them each value is."""
    order = np.argsort(values, kind="stable")
    new = np.diff(values[order], prepend=values[order[:1]]) != 0
    number = np.cumsum(new)
    new[:1] = True
    which = np.empty(len(values), np.int64)
    which[order] = number
    return order[new], which


# --- tokens ---------------------------------------------------------------------------------------


class PieceEncoder:
    """Ids and bytes of SentencePiece tokens; each distinct run of spaces with what follows is encoded once per call.

    No piece of the vocabulary has a space behind another character, so no token goes across the start of a
    run of spaces; checked when the model is read.
    """

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        if any("▁" in name.lstrip("▁") for name in names):
            raise ValueError("the vocabulary has pieces that go across words")
        self.bytes = [
            bytes([int(name[3:5], 16)]) if self._model.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)
        ]
        self._width = np.array([len(b) for b in self.bytes], np.int64)
        self._lone = [self._model.piece_to_id("▁")]

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For texts that begin with a space: all ids, the index of each text's first id, and which texts come back whole."""
        low, high = int(offsets[0]), int(offsets[-1])
        space = data[low:high] == 0x20
        starts = space.copy()
        starts[1:] &= ~space[:-1]
        starts[(offsets[:-1] - low)[offsets[:-1] < offsets[1:]]] = True
        starts = np.flatnonzero(starts) + low
        ends = np.append(starts[1:], high)[: len(starts)]
        rep, which = _distinct(word_hashes(data, starts, ends))
        text = data[low:high].tobytes()
        own = [text[s:e] for s, e in zip((starts[rep] - low).tolist(), (ends[rep] - low).tolist())]
        lists = self._model.encode([b[1:].decode() for b in own], num_threads=1)
        lists = [ids or self._lone for ids in lists]  # an empty string gets no space in front
        whole = np.array([b"".join([self.bytes[i] for i in ids]) == b for b, ids in zip(own, lists)], bool)
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.int32, int(size.sum()))
        at = np.cumsum(size) - size
        n = size[which]
        out_at = np.concatenate([[0], np.cumsum(n)])
        take = np.arange(out_at[-1]) + np.repeat(at[which] - out_at[:-1], n)
        first = np.searchsorted(starts, offsets)
        bad = np.concatenate([[0], np.cumsum(~whole[which])])
        return flat[take], out_at[first], bad[first[1:]] == bad[first[:-1]]

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self._width[ids])


@lru_cache(maxsize=2)
def _coders(a_path: str, b_path: str) -> tuple[Encoder, PieceEncoder]:
    return Encoder(a_path), PieceEncoder(b_path)


def _decimals(top: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of all numbers below `top`, one row each with room for a mark behind, and their lengths."""
    numbers = [str(i).encode() for i in range(top)]
    width = max(map(len, numbers)) + 1
    table = np.frombuffer(b"".join(n.ljust(width) for n in numbers), np.uint8).reshape(top, width)
    return table, np.array([len(n) for n in numbers])


_DIGITS, _LENGTHS = _decimals(1 << 16)


def _of_texts(ids: np.ndarray, at: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the kept texts alone, and each text's number of them."""
    count = np.diff(at)
    return ids[np.repeat(keep, count)], np.where(keep, count, 0)


class Aligned:
    """Tokens of a block's texts side by side: `a`, `b`, their groups, and linked pairs."""

    def __init__(self, texts: pa.Array, a_path: str, b_path: str):
        coder, pieces = _coders(a_path, b_path)
        data, offsets = utf8(pc.binary_join_element_wise(pa.scalar(" "), pc.fill_null(texts, ""), pa.scalar("")))
        b, b_at, keep = pieces(data, offsets)
        keep &= np.diff(offsets) > 1
        a, a_at = coder(data, offsets)
        odd = odd_texts(data, offsets)
        if odd:
            lists = {k: np.array(coder.plain(data[offsets[k] : offsets[k + 1]].tobytes().decode()), a.dtype) for k in odd}
            parts = [lists.get(k, a[a_at[k] : a_at[k + 1]]) for k in range(len(texts))]
            a, a_at = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        n_texts = len(texts)
        self.a, self.n_a = _of_texts(a, a_at, keep)
        self.b, self.n_b = _of_texts(b, b_at, keep)
        a_ends, b_ends = coder.ends(self.a), pieces.ends(self.b)
        if (a_ends[-1] if len(a_ends) else 0) != (b_ends[-1] if len(b_ends) else 0):
            raise ValueError("the tokens of A do not give back the texts")
        self.owner = np.repeat(np.arange(n_texts), self.n_a)  # text of each token of A
        # one link per place where a token ends: of the tokens of A and B that hold the bytes before it
        place = np.sort(np.concatenate([a_ends << 1, b_ends << 1 | 1]), kind="stable")
        change = np.diff(place >> 1) != 0
        has_a = place[np.concatenate([[True], change])[: len(place)]] & 1 == 0
        has_b = place[np.concatenate([change, [True]])[: len(place)]] & 1 == 1
        self.link_a, self.link_b = np.cumsum(has_a) - has_a, np.cumsum(has_b) - has_b
        shared = has_a & has_b
        self.group_a, self.group_b = self.link_a[shared], self.link_b[shared]  # last tokens of groups
        self.n_links = np.bincount(self.owner[self.link_a], minlength=n_texts)
        self.n_groups = np.bincount(self.owner[self.group_a], minlength=n_texts)

    def groups(self) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` of every text."""
        n_a, n_b = len(self.a), len(self.b)
        # tokens of A stand before those of B of their group
        in_a, in_b = np.diff(self.group_a, prepend=-1), np.diff(self.group_b, prepend=-1)
        at_a = np.arange(n_a) + np.repeat(np.cumsum(in_b) - in_b, in_a)
        at_b = np.arange(n_b) + np.repeat(np.cumsum(in_a), in_b)
        ids, marks = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
        ids[at_a], ids[at_b] = self.a, self.b
        marks[at_a[self.group_a]], marks[at_b[self.group_b]] = ord("|"), ord(";")
        size = _LENGTHS[ids]
        cells = _DIGITS[ids]
        cells[np.arange(len(ids)), size] = marks
        flat = cells[np.arange(cells.shape[1]) <= size[:, None]].tobytes()
        ends = np.concatenate([[0], np.cumsum(size + 1)])[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])].tolist()
        return [flat[s : max(s, e - 1)] for s, e in zip(ends, ends[1:])]

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pair (A's id, B's id in 16 bits each), text and number of links, by radix part, pair and text."""
        a, b = self.a[self.link_a].astype(np.uint64), self.b[self.link_b].astype(np.uint64)
        bits = np.uint64(max(1, int(len(self.n_a)).bit_length()))
        text = self.owner[self.link_a].astype(np.uint64)
        pair = (a % np.uint64(PARTS)) << np.uint64(32) | (a << np.uint64(16)) | b
        keys, times = np.unique(pair << bits | text, return_counts=True)
        pair = keys >> bits
        return pair, (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), times


# --- runs -----------------------------------------------------------------------------------------


def write_run(pairs: np.ndarray, *columns: np.ndarray) -> list[bytes]:
    """Frames of ascending pairs (32 bits) and their columns."""
    return [
        squeeze(np.diff(pairs[i : i + FRAME].astype("<u4"), prepend=np.uint32(0)), *[c[i : i + FRAME] for c in columns])
        for i in range(0, len(pairs), FRAME)
    ]


def read_run(frames: list[bytes], *kinds: str) -> Iterator[list[np.ndarray]]:
    for frame in frames:
        steps, *columns = unsqueeze(frame, "<u4", *kinds)
        yield [np.cumsum(steps, dtype=np.uint32), *columns]


def merge(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs in ascending order with the sum of their counts over all runs; one frame of each run is in memory."""
    readers = [read_run(run, "<u4") for run in runs]
    held: dict[int, list[np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def load(k: int) -> None:
        frame = next(readers[k], None)
        if frame is not None:
            held[k] = frame
            heapq.heappush(heap, (int(frame[0][-1]), k))

    for k in range(len(runs)):
        load(k)
    while heap:
        bound = heap[0][0]
        ready = []
        for k, (pairs, counts) in held.items():
            cut = int(np.searchsorted(pairs, bound, "right"))
            ready.append((pairs[:cut], counts[:cut]))
            held[k] = [pairs[cut:], counts[cut:]]
        while heap and heap[0][0] == bound:
            k = heapq.heappop(heap)[1]
            del held[k]
            load(k)
        pairs, which = np.unique(np.concatenate([p for p, _ in ready]), return_inverse=True)
        yield pairs, np.bincount(which, np.concatenate([c for _, c in ready]), len(pairs)).astype("<i8")


def with_best(merged: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The merged pairs, and whether each has the largest count of its id of A. The id that may go on is held back."""
    pairs, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def marked(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = np.flatnonzero(np.diff(pairs >> np.uint32(16), prepend=np.uint32(1 << 31)))
        most = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(pairs))))
        return pairs, counts, counts == most

    for more_pairs, more_counts in merged:
        pairs, counts = np.concatenate([pairs, more_pairs]), np.concatenate([counts, more_counts])
        cut = int(np.searchsorted(pairs, pairs[-1] >> np.uint32(16) << np.uint32(16)))
        if cut:
            yield marked(pairs[:cut], counts[:cut])
            pairs, counts = pairs[cut:], counts[cut:]
    if len(pairs):
        yield marked(pairs, counts)


def _frames(chunks: Iterator[tuple[np.ndarray, ...]]) -> list[bytes]:
    """Chunks of a run as frames of full size."""
    out, held, n = [], [], 0
    for chunk in chunks:
        held.append(chunk)
        n += len(chunk[0])
        if n >= FRAME:
            columns = [np.concatenate(c) for c in zip(*held)]
            full = n - n % FRAME
            out += write_run(*[c[:full] for c in columns])
            held, n = [tuple(c[full:] for c in columns)], n - full
    return out + (write_run(*[np.concatenate(c) for c in zip(*held)]) if n else [])


# --- jobs -----------------------------------------------------------------------------------------

_BLOCK = "block bigint, docs binary, records binary, runs array<struct<part: int, run: array<binary>>>"


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())


def _unipc(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_next_batch()


def _encode(a_path: str, b_path: str, groups: bool, block_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def block(number: int, rows: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        aligned = Aligned(texts, a_path, b_path)
        strings = aligned.groups()
        columns = [rows, *[pa.array(getattr(aligned, name), pa.int64()) for name in _NUMBERS]]
        columns.append(pa.array([hashlib.sha256(s).hexdigest() if s else "" for s in strings]))
        names = ["row", *_NUMBERS, "groups_sha256"]
        if groups:
            columns, names = [*columns, pa.array([s.decode() for s in strings], pa.large_string())], [*names, "groups"]
        docs = _ipc(pa.RecordBatch.from_arrays(columns, names=names))
        pair, text, times = aligned.records()
        first = np.flatnonzero(np.diff(pair, prepend=np.uint64((1 << 64) - 1)))
        counts = np.diff(np.append(first, len(pair)))
        key = pair[first]
        part = (key >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(part, np.arange(PARTS + 1))
        runs = [
            {"part": p, "run": write_run(key[s:e].astype(np.uint32), counts[s:e].astype("<u4"))}
            for p, (s, e) in enumerate(zip(cuts.tolist(), cuts[1:].tolist()))
            if s < e
        ]
        records = squeeze(cuts.astype("<i8"), counts.astype("<u4"), text.astype("<u4"), times.astype("<u4"))
        kind = pa.list_(pa.struct([("part", pa.int32()), ("run", pa.list_(pa.binary()))]))
        return pa.record_batch(
            [pa.array([number]), pa.array([docs], pa.binary()), pa.array([records], pa.binary()), pa.array([runs], kind)],
            ["block", "docs", "records", "runs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            texts = batch.column("_text")
            widths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            i = 0
            for k, width in enumerate(widths):
                if size and size + width > block_bytes:
                    held.append(batch.slice(i, k - i))
                    yield block(number, *_joined(held))
                    held, size, i, number = [], 0, k, number + 1
                size += width
            held.append(batch.slice(i))
        if sum(b.num_rows for b in held):
            yield block(number, *_joined(held))

    return run


def _joined(batches: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    return tuple(pa.concat_arrays([b.column(name) for b in batches]) for name in ("row", "_text"))


def _up(best: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (part, parent, node, run), sorted, to one merged run per part and parent; with `best`, to its answer."""

    def merged(part: int, parent: int, runs: list[list[bytes]]) -> pa.RecordBatch:
        chunks = merge(runs)
        if best:
            chunks = with_best(chunks)
        else:
            chunks = ((p, c.astype("<u4")) for p, c in chunks)
        return pa.record_batch(
            [pa.array([part], pa.int32()), pa.array([parent], pa.int64()), pa.array([_frames(chunks)], pa.list_(pa.binary()))],
            ["part", "node", "run"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, runs = None, []
        for batch in batches:
            for part, parent, frames in zip(batch.column("part").to_pylist(), batch.column("parent").to_pylist(), batch.column("run")):
                if (part, parent) != key and runs:
                    yield merged(*key, runs)
                    runs = []
                key = part, parent
                runs.append(frames.as_py())
        if runs:
            yield merged(*key, runs)

    return run


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, parent, node, run), each parent's answer (node null) first, to an answer for every node's run."""
    answer: list[list[np.ndarray]] = []
    for batch in batches:
        for part, node, frames in zip(batch.column("part").to_pylist(), batch.column("node").to_pylist(), batch.column("run")):
            if node is None:
                answer = list(read_run(frames.as_py(), "<i8", "?"))
                lasts = np.array([f[0][-1] for f in answer])
                continue

            def found(pairs: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
                while len(pairs):  # a frame of the node's run meets the frames of the answer in order
                    known, counts, best = answer[int(np.searchsorted(lasts, pairs[0]))]
                    cut = int(np.searchsorted(pairs, known[-1], "right"))
                    at = np.searchsorted(known, pairs[:cut])
                    yield pairs[:cut], counts[at], best[at]
                    pairs = pairs[cut:]

            chunks = (chunk for pairs, _ in read_run(frames.as_py(), "<u4") for chunk in found(pairs))
            yield pa.record_batch(
                [pa.array([part], pa.int32()), pa.array([node], pa.int64()), pa.array([_frames(chunks)], pa.list_(pa.binary()))],
                ["part", "node", "run"],
            )


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, part, docs, records, run) sorted by block and part, the documents first, to rows of documents."""
    docs = None

    def done() -> Iterator[pa.RecordBatch]:
        if docs is not None:
            columns = [*docs.columns, pa.array(best_links, pa.int64()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*docs.schema.names, "n_best", "count_sum"])

    for batch in batches:
        for row in range(batch.num_rows):
            part, data, records, run = (batch.column(name)[row] for name in ("part", "docs", "records", "run"))
            if part.as_py() < 0:
                yield from done()
                docs = _unipc(data.as_py())
                cuts, counts, text, times = unsqueeze(records.as_py(), "<i8", "<u4", "<u4", "<u4")
                best_links, sums = np.zeros(docs.num_rows, np.int64), np.zeros(docs.num_rows, np.int64)
                at = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                continue
            s, e = cuts[part.as_py()], cuts[part.as_py() + 1]
            frames = list(read_run(run.as_py(), "<i8", "?"))
            corpus, best = np.concatenate([f[1] for f in frames]), np.concatenate([f[2] for f in frames])
            n, own = counts[s:e], slice(at[s], at[e])
            np.add.at(sums, text[own], times[own] * np.repeat(corpus, n))
            np.add.at(best_links, text[own], times[own] * np.repeat(best, n))
    yield from done()


def align(
    docs: DataFrame,
    text_col: str = "text",
    a_path: str | None = None,
    b_path: str | None = None,
    groups: bool = False,
    block_bytes: int = BLOCK_BYTES,
    fan: int = FAN,
) -> DataFrame:
    """All columns but the text as the struct `row`, with n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256; with `groups` also the groups themselves, as text.

    `a_path` is the rank file of a byte-level BPE, `b_path` a SentencePiece model; both of up to 65,536 ids.
    """
    a_path = a_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    b_path = b_path or public_tokenizers.path("piece_bpe_32k.model")
    rows = docs.select(boxed(docs, (text_col,)).alias("row"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    blocks = stage(rows.mapInArrow(_encode(a_path, b_path, groups, block_bytes), schema(_BLOCK)))

    run = "part int, node bigint, run array<binary>"
    order = ["part", "parent", "node"]
    # the tree: a task's blocks, then `fan` tasks, and so on
    levels = [blocks.select(F.col("block").alias("node"), F.inline("runs"))]
    parents = [F.shiftright("node", 32)]
    top = blocks.agg(F.max(F.shiftright("block", 32))).first()[0] or 0
    while top:
        top //= fan
        parents.append(F.floor(F.col("node") / fan).cast("bigint"))
    for k, parent in enumerate(parents):
        children = levels[-1].withColumn("parent", parent).repartition("part", "parent").sortWithinPartitions(*order)
        levels.append(stage(children.select(*order, "run").mapInArrow(_up(k + 1 == len(parents)), schema(run))))
    answer = levels.pop()
    while levels:
        children = levels.pop().withColumn("parent", parents.pop()).select(*order, "run")
        above = answer.select("part", F.col("node").alias("parent"), F.lit(None).cast("bigint").alias("node"), "run")
        both = above.unionByName(children).repartition("part", "parent").sortWithinPartitions(*order)
        answer = both.mapInArrow(_down, schema(run))
        answer = stage(answer) if levels else answer

    nothing = F.lit(None)
    ours = blocks.select("block", F.lit(-1).alias("part"), "docs", "records", nothing.cast("array<binary>").alias("run"))
    replies = answer.select(F.col("node").alias("block"), "part", nothing.cast("binary").alias("docs"), nothing.cast("binary").alias("records"), "run")
    both = ours.unionByName(replies).repartition("block").sortWithinPartitions("block", "part")
    out = [f"row {rows.schema['row'].dataType.simpleString()}", *[f"{n} bigint" for n in _NUMBERS], "groups_sha256 string"]
    out += [*(["groups string"] if groups else []), "n_best bigint", "count_sum bigint"]
    return both.mapInArrow(_add_up, schema(", ".join(out)))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(documents(spark, sf_dir).select("doc_id", "text"))
    return aligned.select(
        F.col("row.doc_id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
