"""Exact substring dedup by a distributed merge sort of suffixes.

Every byte that lies in a string of `WINDOW` bytes which also starts in a document with a smaller id
is removed. Four steps, in which only bits come back to the texts:

1. Sampling. Of each window the least of its `GRAM`-byte strings (by hash) is its anchor; equal
   windows have equal anchors, so about a tenth of all suffixes stand for all of them.
2. Prefix doubling. Blocks send the sorted hashes of their anchors' grams, then of those that occur
   elsewhere the hash of the whole context a window around the anchor can have. A suffix whose gram
   occurs nowhere else, or whose context occurs in a smaller document, is decided.
3. Merge sort. The rest are sorted in their block and exchanged as front-coded runs (length of the
   prefix shared with the previous suffix, and the remaining bytes). A loser tree merges the runs; it
   knows of every suffix how much it shares with the last one taken and compares only what lies
   beyond. The shared lengths of the merged order then tell for every offset of the window around
   the anchor which documents hold the same bytes, and which of them is the smallest.
4. The answers go back to the blocks, which cut the texts.

A string that a large part of all documents hold is sent at most once per block and step. Suffixes
with the same gram but different surroundings meet in one task; grams found in more than
`HOT_BLOCKS` blocks are sent window by window instead, which spreads them. What blocks send and
what comes back takes the ways of `exchange`, so its rows grow with the bytes.

Defined cases: a null or empty text is 0 bytes; texts shorter than a window stay; a null id sorts
after all others; rows with equal id never remove from each other; every row gives a result; other
columns play no part; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from couchlog.llm.blocks import BLOCK_BYTES, Block, Blocks, minimizers
from couchlog.llm.common import documents, id_back, inputs, stage
from couchlog.llm.exchange import FAN, ROWS, Exchange, flat, unflat
from couchlog.llm.words import _BYTE, mix, rolling

WINDOW = 50
GRAM = 32
SIDE = WINDOW - GRAM
HOT_BLOCKS = 4096
PART_BYTES = 16 << 20
_PIECE = 1 << 20
_BIT = [np.uint32(1 << k) for k in range(SIDE + 1)]


# --- anchors -------------------------------------------------------------------------------------


def anchors(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions of a block's anchors, and the hash of the gram at each.

    Grams are chosen for a low hash, so it is mixed once more: parts are equal ranges of what is returned.
    """
    at, grams = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    n = len(block.data)
    for first in range(0, n - GRAM + 1, _PIECE):
        low, high = max(0, first - SIDE), min(n, first + _PIECE + SIDE + GRAM)
        gram = rolling(_BYTE[block.data[low:high]], GRAM)
        start = np.arange(low, low + len(gram) - SIDE)
        if not len(start):
            continue
        inside = start + WINDOW <= block.offsets[np.searchsorted(block.offsets, start, "right")]
        found, _ = minimizers(gram, inside, SIDE + 1)
        found = found[(found + low >= first) & (found + low < first + _PIECE)]
        at.append(found + low)
        grams.append(mix(gram[found]))
    return np.concatenate(at), np.concatenate(grams)


def _least(values: np.ndarray, which: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(out, which, values)
    return out


class _Grams:
    """A block's anchors by gram: distinct grams, and which of them several of its documents hold."""

    def __init__(self, block: Block):
        self.at, gram = anchors(block)
        self.ids = block.ids[block.owner(self.at)]
        self.gram, self.which = np.unique(gram, return_inverse=True)
        self.shared = _least(self.ids, self.which, len(self.gram)) < ~_least(~self.ids, self.which, len(self.gram))


# --- what travels --------------------------------------------------------------------------------


def _parts(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each of `parts` equal ranges begins in sorted hashes (one more than parts)."""
    edges = np.arange(1, parts, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // parts)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]]).astype(np.int64)


def _answers(ways: Exchange, reply: pa.Scalar | None, bounds: np.ndarray, layers: int) -> np.ndarray:
    """The bits of all parts in the order of what was sent, one row per layer."""
    out = np.zeros((layers, int(bounds[-1])), bool)
    for part, answer in ways.received(reply):
        s, e = bounds[part], bounds[part + 1]
        bits = np.frombuffer(answer, np.uint8).reshape(layers, -1)
        out[:, s:e] = np.unpackbits(bits, axis=1)[:, : e - s]
    return out


def _deltas(x: np.ndarray) -> np.ndarray:
    """Differences of sorted values by byte plane, so that their leading zeros compress."""
    return np.diff(x, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.ravel()


def _sums(planes: np.ndarray) -> np.ndarray:
    return np.cumsum(planes.reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


# --- steps 1 and 2: grams and contexts that occur elsewhere ------------------------------------------


def _send_grams(ways: Exchange):
    def send(number: int, block: Block) -> Iterator[pa.RecordBatch]:
        gram = _Grams(block).gram
        yield from ways.send(number, _parts(gram, ways.parts), lambda s, e: flat(_deltas(gram[s:e])))

    return send


def _answer_grams(hot_blocks: int):
    """Per gram: whether another block has it; whether more than `hot_blocks` have it."""

    def answer(sent: list[bytes]) -> list[bytes]:
        runs = [_sums(*unflat(r, "u1")) for r in sent]
        every, count = np.unique(np.concatenate(runs), return_counts=True)
        counts = [count[np.searchsorted(every, run)] for run in runs]
        return [np.packbits(np.stack([c > 1, c > hot_blocks]), axis=1).tobytes() for c in counts]

    return answer


_TABLE = mix(np.arange(1, 258, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_PLACE = mix(np.arange(1, GRAM + 2 * SIDE + 1, dtype=np.uint64)) | np.uint64(1)


class _Contexts:
    """Anchors whose gram occurs elsewhere, and the distinct contexts among them.

    `text` has the bytes from SIDE before the gram to SIDE behind it, 256 where the document does
    not reach. A class is a (gram, context); the block speaks for it with its smallest id.
    """

    def __init__(self, block: Block, ways: Exchange, reply: pa.Scalar | None):
        grams = _Grams(block)
        elsewhere, hot = _answers(ways, reply, _parts(grams.gram, ways.parts), 2)
        live = (elsewhere | grams.shared)[grams.which]
        self.at, self.ids = grams.at[live], grams.ids[live]
        gram, self.hot = grams.gram[grams.which[live]], hot[grams.which[live]]
        owner = block.owner(self.at)
        self.la = np.minimum(self.at - block.offsets[owner], SIDE)
        self.ra = np.minimum(block.offsets[owner + 1] - self.at - GRAM, SIDE)
        self.text = np.empty((len(self.at), GRAM + 2 * SIDE), np.uint16)
        context = np.empty(len(self.at), np.uint64)
        span = np.arange(-SIDE, WINDOW)
        for i in range(0, len(self.at), 1 << 15):
            k = slice(i, i + (1 << 15))
            place = self.at[k, None] + span
            real = (span >= -self.la[k, None]) & (span < GRAM + self.ra[k, None])
            bytes_there = block.data[np.clip(place, 0, len(block.data) - 1)].astype(np.uint16)
            self.text[k] = np.where(real, bytes_there, np.uint16(256))
            context[k] = mix((_TABLE[self.text[k]] * _PLACE).sum(1, dtype=np.uint64))
        cold = np.flatnonzero(~self.hot)
        order = cold[np.lexsort((self.ids[cold], context[cold], gram[cold]))]
        g, c = gram[order], context[order]
        begins = np.ones(len(order), bool)
        begins[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
        self.first = order[begins]  # of each class, the occurrence with the smallest id
        self.gram, self.context, self.class_id = g[begins], c[begins], self.ids[self.first]
        self.cls = np.full(len(self.at), -1)
        self.cls[order] = np.cumsum(begins) - 1


def _send_contexts(ways: Exchange):
    def send(number: int, block: Block, reply: pa.Scalar | None) -> Iterator[pa.RecordBatch]:
        x = _Contexts(block, ways, reply)
        pack = lambda s, e: flat(_deltas(x.gram[s:e]), x.context[s:e], x.class_id[s:e])
        yield from ways.send(number, _parts(x.gram, ways.parts), pack)

    return send


def _answer_contexts(sent: list[bytes]) -> list[bytes]:
    """Per class: whether a smaller document has it; whether it is the first of one of several contexts of its gram."""
    runs = [unflat(r, "u1", "<u8", "<i8") for r in sent]
    gram, context, ids = (np.concatenate(x) for x in zip(*[(_sums(g), c, i) for g, c, i in runs]))
    order = np.lexsort((ids, context, gram))
    g, c, i = gram[order], context[order], ids[order]
    new_gram, new_class = np.ones(len(g), bool), np.ones(len(g), bool)
    new_gram[1:] = g[1:] != g[:-1]
    new_class[1:] = new_gram[1:] | (c[1:] != c[:-1])
    first_id = i[np.flatnonzero(new_class)][np.cumsum(new_class) - 1]
    classes = np.add.reduceat(new_class.astype(int), np.flatnonzero(new_gram))[np.cumsum(new_gram) - 1]
    covered, contested = np.empty(len(g), bool), np.empty(len(g), bool)
    covered[order] = i > first_id
    contested[order] = (i == first_id) & (classes > 1)
    cuts = np.cumsum([len(r[1]) for r in runs])[:-1]
    answers = zip(np.split(covered, cuts), np.split(contested, cuts))
    return [np.packbits(np.stack(x), axis=1).tobytes() for x in answers]


# --- step 3: runs of suffixes, merged ---------------------------------------------------------------


class _Suffixes:
    """What a block sends to the merge: suffixes at contested anchors, and the windows of hot grams.

    Sorted by part and then by their WINDOW bytes. `left` are the SIDE bytes before; `la` and `ra`
    say how much of the context around a gram is in the document.
    """

    def __init__(self, x: _Contexts, block: Block, contested: np.ndarray, parts: int):
        self.classes = np.flatnonzero(contested)
        one = x.first[self.classes]
        plain = np.where(x.text[one] == 256, 0, x.text[one]).astype(np.uint8)
        text, left, key = plain[:, SIDE:], plain[:, :SIDE], x.gram[self.classes]
        la, ra, ids = x.la[one], x.ra[one], x.class_id[self.classes]
        # windows around hot grams: occurrence, start, and which distinct window that is
        hot = np.flatnonzero(x.hot)
        offset = np.arange(SIDE + 1)
        holds = (offset <= x.la[hot, None]) & (offset >= SIDE - x.ra[hot, None])
        occurrence, back = np.nonzero(holds)
        self.starts = x.at[hot][occurrence] - back
        self.start_ids = x.ids[hot][occurrence]
        windows = np.ascontiguousarray(block.data[self.starts[:, None] + np.arange(WINDOW)]).view(f"S{WINDOW}").ravel()
        distinct, self.window = np.unique(windows, return_inverse=True)
        self.window_id = _least(self.start_ids, self.window, len(distinct))
        rows = np.frombuffer(distinct.tobytes(), np.uint8).reshape(-1, WINDOW)
        text = np.concatenate([text, rows])
        left = np.concatenate([left, np.zeros((len(rows), SIDE), np.uint8)])
        key = np.concatenate([key, mix((_TABLE[rows] * _PLACE[:WINDOW]).sum(1, dtype=np.uint64))])
        la, ra = np.append(la, np.zeros(len(rows), int)), np.append(ra, np.full(len(rows), SIDE))
        ids = np.append(ids, self.window_id)
        part = np.searchsorted(_parts(np.sort(key), parts)[1:-1], np.argsort(np.argsort(key, kind="stable")), "right")
        by_text = np.argsort(np.ascontiguousarray(text).view(f"S{WINDOW}").ravel(), kind="stable")
        self.order = by_text[np.argsort(part[by_text], kind="stable")]
        self.bounds = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])
        self.text, self.left = text[self.order], left[self.order]
        self.la, self.ra, self.ids = (v[self.order] for v in (la, ra, ids))

    def front_coded(self, s: int, e: int) -> bytes:
        text = self.text[s:e]
        differ = text[1:] != text[:-1]
        shared = np.concatenate([[0], np.where(differ.any(1), differ.argmax(1), WINDOW)]).astype(np.uint8)
        rest = text[np.arange(WINDOW) >= shared[:, None]]
        small = (self.left[s:e].ravel(), self.la[s:e].astype(np.uint8), self.ra[s:e].astype(np.uint8), self.ids[s:e])
        return flat(shared, rest, *small)

    def masks(self, ways: Exchange, reply: pa.Scalar | None) -> tuple[np.ndarray, np.ndarray]:
        """The merge's answers, per contested class and per distinct window of hot grams."""
        found = np.zeros(len(self.order), np.uint32)
        for part, bits in ways.received(reply):
            found[self.bounds[part] : self.bounds[part + 1]] = np.frombuffer(bits, "<u4")
        out = np.zeros(len(self.order), np.uint32)
        out[self.order] = found
        return out[: len(self.classes)], out[len(self.classes) :]


def _send_suffixes(ways: Exchange):
    def send(number: int, block: Block, reply1: pa.Scalar | None, reply2: pa.Scalar | None) -> Iterator[pa.RecordBatch]:
        x = _Contexts(block, ways, reply1)
        _, contested = _answers(ways, reply2, _parts(x.gram, ways.parts), 2)
        y = _Suffixes(x, block, contested, ways.parts)
        yield from ways.send(number, y.bounds, y.front_coded)

    return send


def _decoded(shared: np.ndarray, rest: np.ndarray) -> list[bytes]:
    """The strings of a front-coded run."""
    out, last, at, data = [], b"", 0, rest.tobytes()
    for n in shared.tolist():
        last = last[:n] + data[at : at + WINDOW - n]
        at += WINDOW - n
        out.append(last)
    return out


def _differ(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which `known` bytes are common already."""
    while known < WINDOW and a[known] == b[known]:
        known += 1
    return known


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int]]:
    """Loser tree over front-coded runs: the run of each taken string, and what it shares with the one before.

    A player is the head of a run with the length it shares with the string taken last. Of two
    players the one that shares more is smaller; only if both share the same are bytes compared, from
    there on, and the loser keeps the length it shares with the winner.
    """
    k = 1
    while k < len(runs):
        k *= 2
    place = [0] * len(runs)
    shares = [0] * k
    heads: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (k - len(runs))

    def loses(a: int, b: int) -> bool:
        """Whether player a loses to player b; sets what the loser shares with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return x is None
        if shares[a] != shares[b]:
            return shares[a] < shares[b]
        n = _differ(x, y, shares[a])
        lost = n < WINDOW and x[n] > y[n] or n == WINDOW and a > b
        shares[a if lost else b] = n
        return lost

    tree = [0] * k  # losers; the winner is kept apart

    def play(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        if loses(a, b):
            a, b = b, a
        tree[node] = b
        return a

    winner = play(1) if k > 1 else 0
    taken, common = [], []
    while heads[winner] is not None:
        taken.append(winner)
        common.append(shares[winner])
        strings, shared = runs[winner]
        place[winner] += 1
        if place[winner] < len(strings):
            heads[winner], shares[winner] = strings[place[winner]], shared[place[winner]]
        else:
            heads[winner] = None
        node = (winner + k) // 2
        while node:
            if loses(winner, tree[node]):
                winner, tree[node] = tree[node], winner
            node //= 2
    return taken, common


def _answer_suffixes(sent: list[bytes]) -> list[bytes]:
    """Per suffix a bit for each offset: whether the window that begins so far before it starts in a smaller document."""
    packed = [unflat(r, "u1", "u1", "u1", "u1", "u1", "<i8") for r in sent]
    runs = [(_decoded(shared, rest), shared.tolist()) for shared, rest, *_ in packed]
    taken, common = merge_runs(runs)
    del runs
    sizes = np.array([len(p[0]) for p in packed])
    base = np.cumsum(sizes) - sizes
    taken = np.array(taken, np.int64)
    by_run = np.argsort(taken, kind="stable")
    order = np.empty(len(taken), np.int64)
    order[by_run] = np.arange(len(taken))  # merged place -> place in the runs one after another
    merged_of = by_run  # place in the runs -> merged place
    left = np.concatenate([p[2].reshape(-1, SIDE) for p in packed])[order]
    la, ra = (np.concatenate([p[k] for p in packed])[order].astype(int) for k in (3, 4))
    ids = np.concatenate([p[5] for p in packed])[order]
    common = np.array(common, np.int64)
    before, mask = np.zeros(len(ids), np.uint64), np.zeros(len(ids), np.uint32)
    for back in range(SIDE + 1):
        group = np.cumsum(common < WINDOW - back)
        held = np.flatnonzero((back <= la) & (ra >= SIDE - back))
        sort = held[np.lexsort((ids[held], before[held], group[held]))]
        new = np.ones(len(sort), bool)
        new[1:] = (group[sort][1:] != group[sort][:-1]) | (before[sort][1:] != before[sort][:-1])
        first = ids[sort][np.flatnonzero(new)][np.cumsum(new) - 1] if len(sort) else ids[sort]
        mask[sort[ids[sort] > first]] |= _BIT[back]
        if back < SIDE:
            before = mix(before * np.uint64(0x9FB21C651E98DF25) + _TABLE[left[:, SIDE - 1 - back]])
    answer = mask[merged_of].astype("<u4")
    return [answer[b : b + n].tobytes() for b, n in zip(base.tolist(), sizes.tolist())]


# --- step 4: the cut ---------------------------------------------------------------------------------

_CUT = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cut(ways: Exchange):
    def cut(number: int, block: Block, *replies: pa.Scalar | None) -> Iterator[pa.RecordBatch]:
        x = _Contexts(block, ways, replies[0])
        covered, contested = _answers(ways, replies[1], _parts(x.gram, ways.parts), 2)
        y = _Suffixes(x, block, contested, ways.parts)
        class_mask, window_mask = y.masks(ways, replies[2])
        change = np.zeros(len(block.data) + 1, np.int32)
        cold = np.flatnonzero(x.cls >= 0)
        cls = x.cls[cold]
        later = x.ids[cold] > x.class_id[cls]
        whole = cold[covered[cls] | later]
        np.add.at(change, x.at[whole] - x.la[whole], 1)
        np.add.at(change, x.at[whole] - (SIDE - x.ra[whole]) + WINDOW, -1)
        masks = np.zeros(len(x.gram), np.uint32)
        masks[y.classes] = class_mask
        rest = cold[~(covered[cls] | later)]
        own = masks[x.cls[rest]]
        starts = [x.at[rest[(own & _BIT[back]) > 0]] - back for back in range(SIDE + 1)]
        gone = (y.start_ids > y.window_id[y.window]) | (window_mask[y.window] > 0)
        starts = np.concatenate([*starts, y.starts[gone]])
        np.add.at(change, starts, 1)
        np.add.at(change, starts + WINDOW, -1)
        removed = np.cumsum(change[:-1]) > 0
        yield from _kept(block, removed)

    return cut


def _kept(block: Block, removed: np.ndarray) -> Iterator[pa.RecordBatch]:
    rows = []
    for i, s, e in zip(block.ids.tolist(), block.offsets.tolist(), block.offsets[1:].tolist()):
        gone = removed[s:e]
        spans, kept = [], block.data[s:e]
        if gone.any():
            edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).tolist()
            spans = [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])]
            kept = kept[~gone]
        rows.append((i, e - s, e - s - len(kept), len(spans), spans, kept.tobytes()))
    for k in range(0, len(rows), 2000):
        ids, n, r, c, spans, kept = zip(*rows[k : k + 2000])
        numbers = [pa.array(v, pa.int64()) for v in (ids, n, r, c)]
        yield pa.record_batch(
            [*numbers, pa.array(spans, _SPAN), pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept"]
        )


def remove_repeated_bytes(
    docs: DataFrame,
    block_bytes: int = BLOCK_BYTES,
    part_bytes: int = PART_BYTES,
    hot_blocks: int = HOT_BLOCKS,
    fan: int = FAN,
) -> DataFrame:
    """Per document of `docs` (doc_id, text): id, n_bytes, n_removed, n_spans, the removed spans, and the kept bytes."""
    blocks = Blocks(inputs(docs), block_bytes)
    ways = Exchange(-(-blocks.bytes // block_bytes), max(1, -(-blocks.bytes // part_bytes)), fan)
    known = stage(ways.asked(blocks.map(_send_grams(ways), ROWS), _answer_grams(hot_blocks)))
    decided = stage(ways.asked(blocks.map_with([known], _send_contexts(ways), ROWS), _answer_contexts))
    merged = stage(ways.asked(blocks.map_with([known, decided], _send_suffixes(ways), ROWS), _answer_suffixes))
    return blocks.map_with([known, decided, merged], _cut(ways), _CUT)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_bytes(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select(
        id_back("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
