"""Benchmark decontamination: rare word n-grams find passages, Smith-Waterman alignment judges them.

1. Seeds of a test item are four of its words in a row, or of five in a row all but one inside
   (`PATTERNS`); what counts are the four words, so an edit between them may be a replaced, a dropped
   or an added word. Items of 3 to 7 words have seeds of three words, shorter ones are their own seed.
   A bitmap of fixed size tells the scan of the corpus which places to look at; the number of
   documents that hold each seed is counted.
2. An item's rare seeds are those found in at most `SPREAD` times as many documents as the median of
   its seeds that occur at all (or in `FEW`). All others are frequent: phrases that are common anyway,
   or what is left of an item in many edited copies.
3. A second scan cuts out the passages around all seeds, joins them to the items by seed, and aligns
   the words of item and passage (match 1, mismatch and gap -1), once for all copies of a passage. The
   score is the best local alignment by the item's length; `LEAST_SCORE` makes a leak. Items are
   grouped by length (`LENGTHS`) and each group has passages of its own, as wide as its longest item:
   a very long item does not widen those of the others.
4. A passage and an item that share frequent seeds only are aligned too, unless they have too few
   words in common for the least score: a bound on the alignment, so no leak is lost by it.

Words are compared with A-Z in lower case. The items are a table like any other: nothing but the
bitmap is sent to all tasks.

Defined cases: null and empty texts are never part of a leak; an item of one or two words leaks
wherever its words stand in a row, so a caller whose test items are that short may want to leave them
out; a very long text is read in pieces of whole texts and costs some tens of bytes a word, a very
long item is a group of its own; items with equal text are reported each; rows with equal doc_id are
one document (the best alignment counts); a null doc_id is reported as null, a null item_id likewise;
other columns play no part and are kept by `drop_leaks`; an empty table on either side gives no leak.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from couchlog.llm.common import boxed, documents, id_back, inputs, schema, stage, text_of, unboxed
from couchlog.llm.words import mix, powers, utf8, word_bounds, word_hashes

# Places of a seed's words, by their number: in a row, and with one word left out.
PATTERNS = {
    1: [(0,)],
    2: [(0, 1)],
    3: [(0, 1, 2), (0, 1, 3), (0, 2, 3)],
    4: [(0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4)],
}
# Groups of items: longest item (the last has no limit), and how many words their seeds have.
LENGTHS = [(1, 1), (2, 2), (7, 3), (64, 4), (512, 4), (4096, 4), (None, 4)]
FEW = 8
SPREAD = 8
LEAST_SCORE = 0.5
BITMAP_BITS = 24
_PIECE = 4 << 20


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, word hashes, and first word of each text (one more than texts) of whole texts."""
    data, offsets = utf8(batch.column("text"))
    ids = batch.column("id").to_numpy()
    i = 0
    while i < len(ids):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _PIECE)) - 1)
        starts, ends, first = word_bounds(data, offsets[i : j + 1])
        yield ids[i:j], word_hashes(data, starts, ends, lower=True), first
        i = j


def _seeds(hashes: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each pattern of `size` words: how many words it reaches over, and the hash at each place."""
    weight = powers(size + 1)
    for pattern in PATTERNS[size]:
        n = len(hashes) - pattern[-1]
        if n > 0:
            yield pattern[-1] + 1, mix(sum(hashes[k : k + n] * weight[j] for j, k in enumerate(pattern)) + np.uint64(size))


def _group(words: int) -> int:
    return next(k for k, (longest, _) in enumerate(LENGTHS) if longest is None or words <= longest)


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    longs = pa.list_(pa.int64())
    for batch in batches:
        for ids, hashes, first in _pieces(batch):
            words = [hashes[s:e] for s, e in zip(first, first[1:])]
            groups = [_group(len(w)) for w in words]
            seeds = [np.unique(np.concatenate([g for _, g in _seeds(w, LENGTHS[k][1])] or [w])) for w, k in zip(words, groups)]
            views = [pa.array([x.view(np.int64) for x in column], longs) for column in (words, seeds)]
            yield pa.record_batch([pa.array(ids), pa.array(groups, pa.int32()), *views], ["item", "grp", "words", "grams"])


def _places(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a gram in the bitmap."""
    return gram >> np.uint64(64 - BITMAP_BITS), (gram >> np.uint64(64 - 2 * BITMAP_BITS)) & np.uint64((1 << BITMAP_BITS) - 1)


def _bitmap(grams: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size: of each value of a gram's bits, the groups (as bits) that have such a gram.

    At most 2^18 rows of 64 bits for each group come to the driver, whatever the number of grams.
    """
    mask = (1 << BITMAP_BITS) - 1
    both = F.array(*[F.shiftrightunsigned("gram", 64 - k * BITMAP_BITS).bitwiseAND(F.lit(mask)) for k in (1, 2)])
    bits = grams.select("grp", F.explode(both).alias("place"))
    bits = bits.select("grp", F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 AS int))").alias("bit"))
    rows = bits.groupBy("grp", "word").agg(F.bit_or("bit").alias("bits")).collect()
    out = np.zeros(1 << BITMAP_BITS, np.uint8)
    for group in {row["grp"] for row in rows}:
        words = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
        for row in rows:
            if row["grp"] == group:
                words[row["word"]] = row["bits"]
        out |= np.unpackbits(words.view(np.uint8), bitorder="little") << np.uint8(group)
    return out


def _hits(known: np.ndarray, groups: list[int], hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each number of words in a seed: places, texts and hashes of what may be a seed, and its groups."""
    for size in sorted({LENGTHS[g][1] for g in groups}):
        mine = np.uint8(sum(1 << g for g in groups if LENGTHS[g][1] == size))
        found = []
        for reach, seed in _seeds(hashes, size):
            at = np.flatnonzero(known[seed >> np.uint64(64 - BITMAP_BITS)] & mine)
            one, two = _places(seed[at])
            there = known[one] & known[two] & mine
            owner = np.searchsorted(first, at, "right") - 1
            inside = (there > 0) & (at + reach <= first[owner + 1])
            found.append((at[inside], owner[inside], seed[at[inside]], there[inside]))
        if found:
            yield tuple(np.concatenate(column) for column in zip(*found))


def _count(known: np.ndarray, groups: list[int]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, hashes, first in _pieces(batch):
                for _, owner, seed, _ in _hits(known, groups, hashes, first):
                    pairs = np.unique(np.stack([seed, owner.astype(np.uint64)]), axis=1)
                    gram, docs = np.unique(pairs[0], return_counts=True)
                    yield pa.record_batch([pa.array(gram.view(np.int64)), pa.array(docs.astype(np.int64))], ["gram", "docs"])

    return count


_LONGS = pa.list_(pa.int64())
_PASSAGES = "id bigint, grp int, at bigint, passage array<bigint>, grams array<bigint>"
_KINDS = [pa.int64(), pa.int32(), pa.int64(), _LONGS, _LONGS]


def _passages(known: np.ndarray, reaches: dict[int, int]):
    """Words around the seeds of a text, by group; seeds closer than the group's reach share a passage."""
    widest = max(p[-1] + 1 for patterns in PATTERNS.values() for p in patterns)

    def around(ids: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple]:
        for places, texts, seeds, there in _hits(known, list(reaches), hashes, first):
            for group, reach in reaches.items():
                mine = np.flatnonzero(there & np.uint8(1 << group))
                mine = mine[np.argsort(places[mine], kind="stable")]
                at, owner, seed = places[mine], texts[mine], seeds[mine]
                new = np.flatnonzero((owner[1:] != owner[:-1]) | (at[1:] - at[:-1] > reach)) + 1
                for s, e in zip([0, *new.tolist()], [*new.tolist(), len(at)]) if len(at) else ():
                    k = owner[s]
                    low, high = max(first[k], at[s] - reach), min(first[k + 1], at[e - 1] + widest + reach)
                    yield ids[k], group, low - first[k], hashes[low:high].view(np.int64), np.unique(seed[s:e]).view(np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch):
                found = around(*piece)
                while rows := list(islice(found, 1000)):
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], ["id", "grp", "at", "passage", "grams"])

    return cut


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Score and ends (in item and passage, exclusive) of the best local alignment of two word sequences."""
    along = np.arange(len(passage) + 1)
    above = np.zeros(len(passage) + 1, np.int64)
    best, end_item, end_passage = 0, 0, 0
    for i, word in enumerate(item):
        row = np.zeros_like(above)
        row[1:] = np.maximum(above[:-1] + np.where(passage == word, 1, -1), above[1:] - 1)
        row = np.maximum(row, 0)
        row = np.maximum(np.maximum.accumulate(row + along) - along, 0)  # gaps in the item
        k = int(row.argmax())
        if row[k] > best:
            best, end_item, end_passage = int(row[k]), i + 1, k
        above = row
    return best, end_item, end_passage


def in_common(item: np.ndarray, passage: np.ndarray) -> int:
    """Words that item and passage have in common, repeated ones as often as in both: no alignment scores more."""
    words, counts = np.unique(item, return_counts=True)
    at = np.minimum(np.searchsorted(words, passage), len(words) - 1)
    return int(np.minimum(counts, np.bincount(at[words[at] == passage], minlength=len(words))).sum())


def _aligned(least: float):
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p1, p2, item, rare, words, passage in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = np.array(words), np.array(passage)
                if not rare and in_common(a, b) / len(a) < least:
                    continue
                score, end_a, end_b = align(a, b)
                _, _, back = align(a[:end_a][::-1], b[:end_b][::-1])
                rows.append((p1, p2, item, len(a), score / len(a), end_b - back, end_b))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            names = ["p1", "p2", "item", "item_words", "score", "low", "high"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names)

    return aligned


def alignments(docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """Best alignment of each document and test item that share a seed; below `least_score`, not all of them.

    id, item (`NO_ID` for a missing one), item_words, score (0 to 1), first_word and end_word in the document.
    """
    rows = inputs(docs)
    kinds = schema("item bigint, grp int, words array<bigint>, grams array<bigint>")
    items = stage(inputs(benchmark, "item_id").mapInArrow(_item_words, kinds).filter(F.size("words") > 0))
    items = items.withColumn("text_no", F.xxhash64("words"))
    seeds = items.select("text_no", "grp", F.explode("grams").alias("gram")).distinct()
    reaches = {r["grp"]: r["n"] for r in items.groupBy("grp").agg(F.max(F.size("words")).alias("n")).collect()}
    found = rows.mapInArrow(_count(_bitmap(seeds), list(reaches)), schema("gram bigint, docs bigint"))
    counts = found.groupBy("gram").agg(F.sum("docs").alias("docs"))
    counted = seeds.join(counts, "gram")
    usual = counted.groupBy("text_no").agg(F.percentile("docs", F.lit(0.5)).alias("usual"))
    rare = F.col("docs") <= F.greatest(F.lit(FEW), SPREAD * F.col("usual"))
    found_seeds = stage(counted.join(usual, "text_no").select("text_no", "grp", "gram", rare.alias("rare")))
    passages = rows.mapInArrow(_passages(_bitmap(found_seeds), reaches), schema(_PASSAGES))
    # passages with the same seeds look up their items once, and equal ones are aligned once
    hashes = [F.xxhash64(*salt, "grp", c).alias(name) for c, n in (("grams", "s"), ("passage", "p")) for name, salt in ((f"{n}1", ()), (f"{n}2", (F.lit(1),)))]
    passages = stage(passages.select("id", "grp", "at", "passage", "grams", *hashes))
    lists = passages.select("s1", "s2", "grp", "grams").dropDuplicates(["s1", "s2"])
    matched = lists.select("s1", "s2", "grp", F.explode("grams").alias("gram")).join(found_seeds, ["grp", "gram"])
    matched = matched.groupBy("s1", "s2", "text_no").agg(F.max("rare").alias("rare"))
    texts = items.groupBy("text_no").agg(F.first("words").alias("words"))
    distinct = passages.select("p1", "p2", "s1", "s2", "passage").dropDuplicates(["p1", "p2"])
    pairs = distinct.join(matched, ["s1", "s2"]).join(texts, "text_no")
    judged = pairs.select("p1", "p2", F.col("text_no").alias("item"), "rare", "words", "passage").mapInArrow(
        _aligned(least_score), schema("p1 bigint, p2 bigint, item bigint, item_words bigint, score double, low bigint, high bigint")
    )
    placed = [(F.col("at") + F.col("low")).alias("first_word"), (F.col("at") + F.col("high")).alias("end_word")]
    found = passages.select("id", "at", "p1", "p2").join(judged, ["p1", "p2"]).select("id", "item", "item_words", "score", *placed)
    best = found.groupBy("id", "item").agg(F.max(F.struct("score", -F.col("first_word"), "end_word", "item_words", "first_word")).alias("m"))
    named = best.select("id", F.col("item").alias("text_no"), "m.item_words", "m.score", "m.first_word", "m.end_word")
    return named.join(items.select("item", "text_no").distinct(), "text_no").drop("text_no")


def leaks(docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    return alignments(docs, benchmark, least_score).filter(F.col("score") >= least_score)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows and columns of `docs` whose document holds no test item; rows without an id are judged by text."""
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64(text_of()))
    found = leaks(docs.select(key.alias("doc_id"), "text"), benchmark, least_score)
    keyed = docs.select(boxed(docs).alias("row"), key.alias("id"))
    return unboxed(keyed.join(stage(found.select("id").distinct()), "id", "left_anti"), docs.columns)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(id_back("id").alias("doc_id"), id_back("item").alias("item_id"), "item_words", "score", "first_word", "end_word")
