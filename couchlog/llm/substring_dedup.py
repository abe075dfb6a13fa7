"""Substring dedup on words by compaction of a sparse De Bruijn graph.

Every word that lies in a run of `WINDOW` words which also starts in a document with a smaller id is
removed. The graph's nodes are token k-mers (`GRAM` words), sampled so that every window holds one:
the least by hash, equal in equal windows. Its edges are the words from one sampled k-mer of a
document to the next.

1. Nodes are counted over all documents, with the edges that enter and leave them. Nodes in one
   document only are dropped. A node that all its occurrences leave by the same edge, to a node that
   all enter by that edge, is joined to it.
2. These nonbranching paths are compacted by pointer jumping: every node learns the head of its path
   in a number of Spark joins that is logarithmic in the path's length. A path occurs as a whole or
   not at all, so its head's occurrences tell where, and its smallest document is the source.
3. Source coordinates verify the paths: the words of every occurrence have to have the same 128-bit
   digest as those at the source, else the path is taken apart into its nodes.
4. What a path settles needs no more work. Windows that reach beyond a path, where the graph branches,
   are compared as a whole: per window the smallest document that holds it.

Blocks speak for their documents: a passage or window is sent once per block, with its smallest id,
so one that a third of all documents hold is spread and pre-aggregated.

Defined cases: a null or empty text has no words; texts shorter than a window stay; a null id sorts
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
from couchlog.llm.common import documents, drop_staged, id_back, inputs, stage
from couchlog.llm.words import _BASE, mix, powers, rolling, word_bounds, word_hashes

WINDOW = 50
GRAM = 16
_WIDTH = WINDOW - GRAM + 1
_BASE2 = np.uint64(0xAF251AF3B0F025B5)
_NODE = ["gram", "low", "high", "prev_min", "prev_max", "next_min", "next_max", "next_gram", "gap"]


class _Words:
    """The words of a block: bounds, hashes, documents, sampled k-mers and each window's least k-mer."""

    def __init__(self, block: Block):
        self.starts, self.ends, self.first = word_bounds(block.data, block.offsets)
        self.hash = word_hashes(block.data, self.starts, self.ends)
        count = np.diff(self.first)
        self.ids = np.repeat(block.ids, count)
        self.end_of = np.repeat(self.first[1:], count)  # of the word's document
        grams = rolling(self.hash, GRAM)
        n = max(len(self.hash) - WINDOW + 1, 0)
        self.whole = np.arange(n) + WINDOW <= self.end_of[:n]
        if n:
            self.at, self.least = minimizers(grams, self.whole, _WIDTH)
        else:
            self.at, self.least = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        self.gram = grams[self.at]

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
        """Hash of the words [start, end) of each span."""
        weight = powers(len(self.hash) + 1, base)
        inverse = powers(len(self.hash) + 1, np.uint64(pow(int(base), -1, 1 << 64)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hash * weight[: len(self.hash)], dtype=np.uint64)])
        return mix((sums[ends] - sums[starts]) * inverse[starts] ^ (ends - starts).astype(np.uint64))


def _longs(names: list[str]) -> str:
    return ", ".join(f"{n} bigint" for n in names)


def _batch(names: list[str], columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.ascontiguousarray(c).view(np.int64)) for c in columns], names)


def _per(which: np.ndarray, n: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each of n groups."""
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(low, which, values)
    np.maximum.at(high, which, values)
    return low, high


def _nodes(number: int, block: Block) -> Iterator[pa.RecordBatch]:
    """One row per distinct k-mer of the block; 0 stands for the begin or end of a document."""
    w = _Words(block)
    if not len(w.at):
        return
    linked = w.at[1:] < w.end_of[w.at[:-1]]
    edge = w.span_hashes(w.at[:-1], np.minimum(w.at[1:] + GRAM, len(w.hash)), _BASE).view(np.int64)
    edge = np.where(linked, edge | 1, 0)
    prev, following = np.append(0, edge), np.append(edge, 0)
    next_gram = np.where(np.append(linked, False), np.append(w.gram[1:], np.uint64(0)).view(np.int64), 0)
    gap = np.where(np.append(linked, False), np.append(np.diff(w.at), 0), 0)
    grams, which = np.unique(w.gram, return_inverse=True)
    n = len(grams)
    columns = [grams, *_per(which, n, w.ids[w.at]), *_per(which, n, prev), *_per(which, n, following)]
    yield _batch(_NODE, [*columns, _per(which, n, next_gram)[1], _per(which, n, gap)[1]])


def _grams(number: int, block: Block) -> Iterator[pa.RecordBatch]:
    grams = np.unique(_Words(block).gram)
    yield _batch(["gram", "block"], [grams, np.full(len(grams), number)])


def graph(blocks: Blocks) -> DataFrame:
    """Nodes in several documents: gram, low (smallest id), before and gap of the one that leads to it alone."""
    ends = {n: F.min if n in ("low", "prev_min", "next_min") else F.max for n in _NODE[1:]}
    nodes = blocks.map(_nodes, _longs(_NODE)).groupBy("gram").agg(*[f(n).alias(n) for n, f in ends.items()])
    only = lambda k: F.when((F.col(f"{k}_min") == F.col(f"{k}_max")) & (F.col(f"{k}_min") != 0), F.col(f"{k}_min"))
    nodes = stage(nodes.filter("low < high").select("gram", "low", only("prev").alias("enter"), only("next").alias("leave"), "next_gram", "gap"))
    links = nodes.filter("leave IS NOT NULL").select(F.col("gram").alias("before"), "leave", "next_gram", F.col("gap").alias("step"))
    met = (F.col("gram") == F.col("next_gram")) & (F.col("enter") == F.col("leave"))
    joined = nodes.select("gram", "low", "enter").join(links, met, "left")
    return stage(joined.select("gram", "low", "before", F.coalesce("step", F.lit(0)).alias("step")))


def paths(nodes: DataFrame) -> DataFrame:
    """gram, head of its path, dist (words from the head), low: pointer jumping over `before`."""
    now = stage(nodes.select("gram", "low", F.coalesce("before", "gram").alias("head"), F.col("step").alias("dist"), F.col("before").isNull().alias("done")))
    while not now.filter("NOT done").isEmpty():
        ahead = now.select(F.col("gram").alias("head"), F.col("head").alias("far"), F.col("dist").alias("more"), F.col("done").alias("there"))
        jumped = now.filter("NOT done").join(ahead, "head")
        # the head of a path points at itself, at distance 0
        after = jumped.select("gram", "low", F.col("far").alias("head"), (F.col("dist") + F.col("more")).alias("dist"), F.col("there").alias("done"))
        after = stage(after.unionByName(now.filter("done")))
        drop_staged(now)
        now = after
    return now.drop("done")


class _Known:
    """What a block was told of its k-mers, sorted by k-mer."""

    def __init__(self, reply: pa.Scalar | None):
        kinds = ["gram", "head", "dist", "length", "low"]
        cols = [np.zeros(0, np.int64)] * 5 if reply is None else [reply.values.field(k).to_numpy() for k in kinds]
        order = np.argsort(cols[0].view(np.uint64))
        self.gram, self.head, self.dist, self.length, self.low = (c[order] for c in cols)
        self.gram = self.gram.view(np.uint64)

    def find(self, grams: np.ndarray) -> np.ndarray:
        """Row of each k-mer, -1 where it occurs in one document only."""
        if not len(self.gram):
            return np.full(len(grams), -1)
        at = np.minimum(np.searchsorted(self.gram, grams), len(self.gram) - 1)
        return np.where(self.gram[at] == grams, at, -1)


def _occurrences(w: _Words, known: _Known) -> tuple[np.ndarray, np.ndarray]:
    """Start word of every path that is as long as a window, and its row in `known`."""
    row = known.find(w.gram)
    head = (row >= 0) & (known.dist[row] == 0) & (known.length[row] >= WINDOW) if len(known.gram) else np.zeros(len(row), bool)
    return w.at[head], row[head]


def _digests(number: int, block: Block, reply: pa.Scalar | None) -> Iterator[pa.RecordBatch]:
    w, known = _Words(block), _Known(reply)
    start, row = _occurrences(w, known)
    if not len(start):
        return
    end = start + known.length[row]
    fits = end <= w.end_of[start]
    end = np.minimum(end, w.end_of[start])
    d1, d2 = (np.where(fits, w.span_hashes(start, end, b).view(np.int64), 0) for b in (_BASE, _BASE2))
    both = np.unique(np.stack([known.head[row], d1, d2]), axis=1)
    yield _batch(["head", "d1", "d2"], list(both))


class _Open:
    """Windows that no path settles although their k-mer occurs in several documents."""

    def __init__(self, w: _Words, known: _Known):
        n = len(w.least)
        settled = np.zeros(n + 1, np.int32)
        start, row = _occurrences(w, known)
        np.add.at(settled, start, 1)
        np.add.at(settled, start + known.length[row] - WINDOW + 1, -1)
        self.at = np.flatnonzero(w.whole & (np.cumsum(settled[:-1]) == 0) & (known.find(w.least) >= 0)) if n else np.zeros(0, np.int64)
        h1, h2 = (rolling(w.hash, WINDOW, b)[self.at].view(np.int64) for b in (_BASE, _BASE2))
        self.ids = w.ids[self.at]
        order = np.lexsort((self.ids, h2, h1))
        new = np.ones(len(order), bool)
        new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        first = order[new]
        self.h1, self.h2, self.low = h1[first], h2[first], self.ids[first]


def _open_windows(number: int, block: Block, reply: pa.Scalar | None) -> Iterator[pa.RecordBatch]:
    x = _Open(_Words(block), _Known(reply))
    if len(x.h1):
        yield _batch(["h1", "h2", "block", "low"], [x.h1, x.h2, np.full(len(x.h1), number), x.low])


_CUT = "id bigint, n_words bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept string"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cut(number: int, block: Block, nodes: pa.Scalar | None, found: pa.Scalar | None) -> Iterator[pa.RecordBatch]:
    w, known = _Words(block), _Known(nodes)
    x = _Open(w, known)
    change = np.zeros(len(w.hash) + 1, np.int32)
    start, row = _occurrences(w, known)
    later = known.low[row] < w.ids[start]
    np.add.at(change, start[later], 1)
    np.add.at(change, start[later] + known.length[row[later]], -1)
    seen = np.zeros(len(x.h1), bool)
    if found is not None:
        told = np.sort(np.rec.fromarrays([found.values.field(k).to_numpy() for k in ("h1", "h2")], names="h1,h2"))
        at = np.searchsorted(told, np.rec.fromarrays([x.h1, x.h2], dtype=told.dtype))
        at = np.minimum(at, len(told) - 1)
        seen = (told["h1"][at] == x.h1) & (told["h2"][at] == x.h2)
    gone = x.at[seen[x.which] | (x.ids > x.low[x.which])]
    np.add.at(change, gone, 1)
    np.add.at(change, gone + WINDOW, -1)
    removed = np.cumsum(change[:-1]) > 0
    rows = []
    for i, doc in enumerate(block.ids.tolist()):
        s, e = int(w.first[i]), int(w.first[i + 1])
        words = block.data[block.offsets[i] : block.offsets[i + 1]].tobytes().split()
        dead, spans = removed[s:e], []
        if dead.any():
            edges = np.flatnonzero(np.diff(dead, prepend=False, append=False)).tolist()
            spans = [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])]
            words = [x for x, d in zip(words, dead.tolist()) if not d]
        rows.append((doc, e - s, int(dead.sum()), spans, b" ".join(words).decode()))
    for k in range(0, len(rows), 2000):
        ids, n, gone_words, spans, kept = zip(*rows[k : k + 2000])
        numbers = [pa.array(v, pa.int64()) for v in (ids, n, gone_words)]
        yield pa.record_batch([*numbers, pa.array(spans, _SPAN), pa.array(kept, pa.string())], ["id", "n_words", "n_removed", "spans", "kept"])


def _told(blocks: Blocks, info: DataFrame) -> DataFrame:
    """Per block: what is known of its k-mers that occur in several documents."""
    asked = blocks.map(_grams, "gram bigint, block bigint")
    fields = F.struct("gram", "head", "dist", "length", "low")
    return stage(asked.join(info, "gram").groupBy("block").agg(F.collect_list(fields).alias("known")))


def remove_repeated_words(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document of `docs` (doc_id, text): id, n_words, n_removed, removed spans (in words), and the kept text."""
    blocks = Blocks(inputs(docs), block_bytes)
    placed = paths(graph(blocks))
    lengths = placed.groupBy("head").agg((F.max("dist") + GRAM).alias("length"))
    known = _told(blocks, placed.join(lengths, "head"))
    digests = blocks.map_with([known], _digests, _longs(["head", "d1", "d2"]))
    wrong = digests.groupBy("head").agg(F.min("d1"), F.max("d1"), F.min("d2"), F.max("d2")).toDF("head", "a", "b", "c", "d")
    wrong = stage(wrong.filter("a <> b OR c <> d OR a = 0").select("head", F.lit(True).alias("wrong")))
    if not wrong.isEmpty():  # such paths count as single nodes
        apart = placed.join(lengths, "head").join(wrong, "head", "left").withColumn("wrong", F.coalesce("wrong", F.lit(False)))
        apart = apart.select(
            "gram",
            F.when(F.col("wrong"), F.col("gram")).otherwise(F.col("head")).alias("head"),
            F.when(F.col("wrong"), F.lit(0)).otherwise(F.col("dist")).alias("dist"),
            F.when(F.col("wrong"), F.lit(GRAM)).otherwise(F.col("length")).alias("length"),
            "low",
        )
        known = _told(blocks, apart)
    windows = stage(blocks.map_with([known], _open_windows, _longs(["h1", "h2", "block", "low"])))
    least = windows.groupBy("h1", "h2").agg(F.min("low").alias("least"), F.max("low").alias("most")).filter("least < most").drop("most")
    found = windows.join(least, ["h1", "h2"]).filter("least < low").groupBy("block").agg(F.collect_list(F.struct("h1", "h2")).alias("found"))
    return blocks.map_with([known, stage(found)], _cut, _CUT)


def op2_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_words(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select(id_back("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# Words by position, one row per window; removed words are joined back by position.
OP2_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(doc_id, 9223372036854775807) AS id,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, id, p, array_to_string(w[p:p + 49], ' ') AS s
  FROM (SELECT r, id, w, unnest(range(1, len(w) - 48)) AS p FROM docs WHERE len(w) >= 50)),
firsts AS (SELECT s, min(id) AS first FROM windows GROUP BY s),
gone AS (
  SELECT DISTINCT r, unnest(range(p, p + 50)) AS k
  FROM (SELECT r, p FROM windows JOIN firsts USING (s) WHERE first < id)),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM docs),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY k) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (r, k) GROUP BY r)
SELECT CASE WHEN id < 9223372036854775807 THEN id END AS doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""
