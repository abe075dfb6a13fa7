"""Periodic runs of words, found by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q whose length reaches `MIN_LENGTH` and
`MIN_EXPONENT` * q and which no neighbouring word extends. Words are appended to a suffix automaton
one by one. The suffixes of the text so far are the path from the newest state to the root along
suffix links; accessing it gives every state on the path the new end as its last occurrence. What the
path showed before are segments, each of one earlier end: a segment that reaches to suffixes of length
L and was seen `distance` words ago says that the last L words also end there. Where distance <= L the
two overlap or touch, that is a square of that period, and L + distance words up to here have it. The
run is the stretch that the squares of one period and start reach.

The path's segments are kept as in a link-cut tree by preferred paths, here on the heavy paths of the
finished link tree: on each heavy path the accessed parts are a stack from the top down, and an access
pops what it covers, so segments are paid for when they are made.

The automaton needs about 0.6 KB a word and is only built over the stretches that may hold a run. In a
run every word but the first q occurs again within q words. So for each power of two t, stretches of
words whose previous occurrence is at most t back are found for whole batches at once, and those long
enough for a period in (t / 2, t] are kept, with the t words before them. No run is lost, and a run lies
within one stretch, see `candidates`.

Defined cases: a null or empty text has no words and no runs; null ids, repeated rows and ties need
nothing (rows are independent); a very long text is one row, memory grows with it; other columns
are kept, also those with names used here; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from couchlog.llm.common import boxed, documents, schema
from couchlog.llm.words import mix, utf8, word_bounds, word_hashes

MIN_LENGTH = 6
MIN_EXPONENT = 4
_PIECE = 8 << 20

#: What to read in place of a text's words: (id, number of words) -> their numbers, or None for all in order.
Reorder = Callable[[int | None, int], np.ndarray | None]


def candidates(words: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> list[tuple[int, int]]:
    """Stretches [begin, end) of `words`, none across texts, that together hold every run whole.

    For a period q in (t / 2, t] the words of a run behind its first q have their previous occurrence at
    most t back, and they are max(min_length, exponent * q) - q words or more.
    """
    n = len(words)
    if not n:
        return []
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    key = mix(words ^ (owner.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    back = np.full(n, n + 1, np.int64)
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    longest = int(np.diff(first).max())
    found, t = [], 1
    while exponent * (t // 2 + 1) <= longest:
        turn = -(-min_length // exponent)  # the period from which on the exponent decides
        periods = {t // 2 + 1, t, *[q for q in (turn - 1, turn) if t // 2 < q <= t]}
        need = min(max(min_length, exponent * q) - q for q in periods)
        near = np.concatenate([[False], back <= t, [False]])
        starts = np.flatnonzero(near[1:] & ~near[:-1])
        ends = np.flatnonzero(near[:-1] & ~near[1:])
        kept = ends - starts >= need  # no stretch goes across texts: a first word has no previous occurrence
        starts, ends = starts[kept], ends[kept]
        if len(starts):
            found.append(np.stack([np.maximum(starts - t, first[owner[starts]]), ends], 1))
        t *= 2
    if not found:
        return []
    pairs = np.concatenate(found)
    merged: list[list[int]] = []
    for begin, end in pairs[np.argsort(pairs[:, 0], kind="stable")].tolist():
        if merged and begin < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([begin, end])
    return [(b, e) for b, e in merged]


class SuffixAutomaton:
    """States of all prefixes of a word sequence: longest length, suffix link, and each prefix's state."""

    def __init__(self, words: list[int]):
        length, link, steps, prefix = [0], [-1], [{}], []
        last = 0
        for word in words:
            now = len(length)
            length.append(length[last] + 1)
            link.append(0)
            steps.append({})
            at = last
            while at >= 0 and word not in steps[at]:
                steps[at][word] = now
                at = link[at]
            if at >= 0:
                to = steps[at][word]
                if length[at] + 1 == length[to]:
                    link[now] = to
                else:
                    clone = len(length)
                    length.append(length[at] + 1)
                    link.append(link[to])
                    steps.append(steps[to].copy())
                    while at >= 0 and steps[at].get(word) == to:
                        steps[at][word] = clone
                        at = link[at]
                    link[to] = link[now] = clone
            last = now
            prefix.append(now)
        self.length, self.link, self.prefix = length, link, prefix


def heavy_tops(length: list[int], link: list[int]) -> list[int]:
    """The topmost state of the heavy path that each state of the link tree lies on."""
    n = len(length)
    order = np.argsort(np.array(length), kind="stable").tolist()  # parents before children
    weight = [1] * n
    for v in reversed(order[1:]):
        weight[link[v]] += weight[v]
    heavy = [-1] * n
    for v in order[1:]:
        u = link[v]
        if heavy[u] < 0 or weight[v] > weight[heavy[u]]:
            heavy[u] = v
    top = [0] * n
    for v in order[1:]:
        u = link[v]
        top[v] = top[u] if heavy[u] == v else v
    return top


def squares(words: list[int]) -> dict[tuple[int, int], int]:
    """(period, start) -> end of every maximal repetition of exponent 2 and more."""
    automaton = SuffixAutomaton(words)
    length, link = automaton.length, automaton.link
    top = heavy_tops(length, link)
    recent: dict[int, list[tuple[int, int]]] = {}  # heavy path -> (length down to which, last end), longest first
    ends: dict[tuple[int, int], int] = {}
    for now, state in enumerate(automaton.prefix):
        v, below = state, -1
        while v > 0:  # access: the path's parts on each heavy path, from the bottom up
            head, reach = top[v], length[v]
            stack = recent.get(head)
            if stack is None:
                recent[head] = [(reach, now)]
            else:
                covered, newest = 0, stack[-1][1]
                while stack and covered < reach:
                    deep, seen = stack[-1]
                    distance, common = now - seen, min(deep, reach)
                    if seen != below and distance <= common:  # else the segment goes on below, where it is longer
                        ends[distance, now - common - distance + 1] = now + 1
                    if deep > reach:
                        break
                    covered = deep
                    stack.pop()
                stack.append((reach, now))
                below = newest
            v = link[head]
    return ends


def runs_of(words: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one sequence, by start and then period."""
    ids = np.unique(words, return_inverse=True)[1].tolist()
    return sorted((s, e - s, q) for (q, s), e in squares(ids).items() if e - s >= max(min_length, exponent * q))


def _find(reorder: Reorder | None, min_length: int, exponent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def piece(ids: list, data: np.ndarray, offsets: np.ndarray) -> tuple[list, list, list]:
        starts, ends, first = word_bounds(data, offsets)
        order, at = [], [0]  # numbers of the words that are read, over all texts
        changed = []
        for k, i in enumerate(ids):
            n = int(first[k + 1] - first[k])
            other = reorder(i, n) if reorder else None
            changed.append(other is not None)
            order.append(first[k] + (np.arange(n) if other is None else other))
            at.append(at[-1] + len(order[-1]))
        take, at = np.concatenate([np.zeros(0, np.int64), *order]), np.array(at)
        words = word_hashes(data, starts, ends)[take]
        found: list[list[tuple[int, int, int]]] = [[] for _ in ids]
        for begin, end in candidates(words, at, min_length, exponent):
            k = int(np.searchsorted(at, begin, "right")) - 1
            found[k] += [(begin - int(at[k]) + s, n, q) for s, n, q in runs_of(words[begin:end], min_length, exponent)]
        texts = []
        for k, runs in enumerate(found):
            text = data[offsets[k] : offsets[k + 1]].tobytes()
            pieces = text.split()  # the same white space as `word_bounds`
            if changed[k]:
                pieces = [pieces[j] for j in (order[k] - first[k]).tolist()]
            if runs:
                drop = np.zeros(len(pieces) + 1, np.int64)
                for s, n, q in runs:
                    drop[s + q] += 1
                    drop[s + n] -= 1
                pieces = [pieces[j] for j in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]
            texts.append(b" ".join(pieces))
        return np.diff(at).tolist(), found, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            data, offsets = utf8(batch.column("_text"))
            ids = batch.column("_id").to_pylist()
            i = 0
            while i < len(ids):
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _PIECE)) - 1)
                counts, found, texts = piece(ids[i:j], data, offsets[i : j + 1])
                rows = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
                yield pa.record_batch(
                    [batch.column("row").slice(i, j - i), pa.array(counts, pa.int64()), pa.array(rows, kind),
                     pa.array(texts, pa.binary()).cast(pa.string())],
                    ["row", "n_words", "runs", "collapsed"],
                )
                i = j

    return run


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    reorder: Reorder | None = None,
    min_length: int = MIN_LENGTH,
    exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """All columns but the text as the struct `row`, with n_words, `runs` (start, length, period; by start, then
    period) and `collapsed`, the words that no run repeats (each run keeps its first period), joined by a space.

    `reorder` may replace the words of a text by others of the same text. Rows do not move: no shuffle.
    """
    if exponent < 2 or min_length < exponent:
        raise ValueError("runs need an exponent of 2 or more, and a length of at least the exponent")
    rows = docs.select(boxed(docs, (text_col,)).alias("row"), F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    out = f"row {rows.schema['row'].dataType.simpleString()}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return rows.mapInArrow(_find(reorder, min_length, exponent), schema(out))


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Every tenth document, by a hash of its id, repeats a part of itself from some word on."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    words = np.arange(n)
    return np.where(words < a, words, a + (words - a) % p)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(documents(spark, sf_dir).select("doc_id", "text"), reorder=planted)
    # the division is correctly rounded: it orders fractions as they are for texts below some 10^7 words
    order = lambda r: F.struct((-r["length"] / r["period"]).alias("order"), r["start"], r["period"], r["length"])
    best = F.array_min(F.transform("runs", order))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
