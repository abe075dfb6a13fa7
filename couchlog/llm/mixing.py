"""Mixing sources to target weights by pivotal dependent rounding.

Sources get targets in words; a document of a source is then wanted target / size times, which is a
whole number of copies and a share between 0 and 1. Shares are made whole by pivotal rounding: of two
parties, words move from one to the other, in a random direction with the odds that keep both
expectations, until one of the two has the share 0 or 1. Moves keep the number of words, so a source
ends within one document of its target, and each document's expected copies are its share.

The duels form a tree. Documents are dealt by a hash to leaves of about `FAN`. In a leaf, the
largest document meets the bundle of all smaller ones, whose common share changes; then the next
largest does. So a large document is settled while there is something to balance it, and what
a leaf leaves open, one document at most, is small. These residuals meet in pairs, in groups of `FAN`,
until one is left for each source, which is rounded at random.

All random numbers are hashes of the leaf, the level and the place in the order (size falling, id,
check), so reruns agree whatever the partitioning.

Defined cases: a null source is a source of its own, after all others; null and repeated ids are
documents like any other (rows that are equal in id, size and check are interchangeable); a null or
empty text has size 0, is taken 0 words, and counts for nothing; a very long text is one document,
and where it outweighs the rest of its source, that source misses its target by up to its size; a
source without words has the target 0; other columns are kept, also those with names used here; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from couchlog.llm.common import boxed, documents, drop_staged, id_of, schema, stage
from couchlog.llm.words import mix as spread

WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
MOST = 2
FAN = 512
_SALTS = 16


def n_words(text: Column) -> Column:
    """Words of a text, counted without a list of them."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\x20\\x09-\\x0D]+", "x")
    return F.char_length(F.translate(marks, " \t\n\x0b\x0c\r", "")).cast("bigint")


# --- targets --------------------------------------------------------------------------------------


def _numbered(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Sources in the order of their code points, null last, with number and weight.

    Ranges are numbered on their own and then moved by the rows before them, so no task sees all sources.
    """
    order = ["no_source", "source"]
    ranges = stage(sources.repartitionByRange(*order).select("*", F.spark_partition_id().alias("range")))
    counts = sorted((r["range"], r["n"]) for r in ranges.groupBy("range").agg(F.count("*").alias("n")).collect())
    before, at = {}, 0
    for key, n in counts:
        before[key], at = at, at + n
    own = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    moved = F.element_at(F.create_map(*[F.lit(v) for pair in before.items() for v in pair]), F.col("range")) if before else F.lit(0)
    numbered = ranges.withColumn("number", (own + moved).cast("bigint")).drop("range")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    return stage(numbered.withColumn("weight", weight.cast("bigint")))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, most: int = MOST) -> DataFrame:
    """no_source, source, words -> also number, weight, target.

    Sources share `share` of all words by weight; none gets more than `most` times its own. What is cut
    off is shared again by weight among the others, round after round, until none is above: per round
    one aggregate over the sources, in whole numbers, so the result does not depend on the order of sums.
    """
    if Fraction(share) > most:
        raise ValueError("the share of all words cannot exceed the most copies of a document")
    numbered = _numbered(sources, weights)
    # in decimals: words times the sum of all weights may leave bigint
    cap = F.expr(f"CAST(words AS decimal(20,0)) * {most}BD")

    def is_capped(level: Fraction) -> Column:
        return F.expr(f"CAST(words AS decimal(20,0)) * {most * level.denominator}BD <= CAST(weight AS decimal(10,0)) * {level.numerator}BD")

    total = numbered.agg(F.sum("words")).first()[0] or 0
    level, full = None, -1
    while True:  # the level is words per weight; sources at their cap stay there as it rises
        capped = F.lit(False) if level is None else is_capped(level)
        row = numbered.agg(
            F.count_if(capped), F.sum(F.when(capped, cap).otherwise(0)), F.sum(F.when(capped, 0).otherwise(F.col("weight")))
        ).first()
        if row[0] == full or not row[2]:
            break
        full = row[0]
        level = (Fraction(share) * total - int(row[1])) / row[2]
    if level is None:
        return numbered.withColumn("target", F.lit(0.0))
    wanted = F.col("weight").cast("double") * F.lit(level.numerator / level.denominator)
    return numbered.withColumn("target", F.when(is_capped(level), cap.cast("double")).otherwise(wanted))


# --- rounding -------------------------------------------------------------------------------------


def _draws(leaf: int, level: int, first: int, n: int) -> np.ndarray:
    """Numbers in [0, 1) of the places from `first` on."""
    with np.errstate(over="ignore"):
        seed = spread(np.array([leaf & (1 << 64) - 1], np.uint64) ^ spread(np.array([level + 1], np.uint64)))[0]
        mixed = spread(np.arange(first, first + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + seed)
    return (mixed >> np.uint64(11)).astype(np.float64) / 2.0**53


def duel(size: int, share: float, other: int, other_share: float, u: float) -> tuple[float, float]:
    """Shares of two parties after words moved between them; one of the two is 0 or 1."""
    a, b = size * share, other * other_share
    up, down = min(size - a, b), min(a, other - b)
    if u * (up + down) < down:  # odds down : up keep both expectations
        a_full, b_empty = size - a <= b, b <= size - a
        return (1.0 if a_full else share + up / size), (0.0 if b_empty else other_share - up / other)
    a_empty, b_full = a <= other - b, other - b <= a
    return (0.0 if a_empty else share - down / size), (1.0 if b_full else other_share + down / other)


def _leaves() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every document against the bundle of those behind it, along streams sorted by leaf and falling size.

    `copies` becomes the document's own, or stays null for the one that its leaf leaves open at `share`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, place, behind, common = None, 0, 0, 0.0
        for batch in batches:
            n = batch.num_rows
            leaves, sizes, totals, shares = (batch.column(c).to_pylist() for c in ("leaf", "size", "leaf_size", "share"))
            copies: list = [None] * n
            draws, drawn = np.zeros(0), 0
            for k in range(n):
                if leaves[k] != leaf:
                    leaf, place, behind, common = leaves[k], 0, totals[k], shares[k]
                    draws, drawn = np.zeros(0), 0
                if drawn == len(draws):
                    draws, drawn = _draws(leaf, 0, place, min(FAN, n - k)), 0
                own, size, u = common, sizes[k], float(draws[drawn])
                drawn, place, behind = drawn + 1, place + 1, behind - size
                if size == 0:
                    own = float(u < own)
                elif own not in (0, 1) and behind:
                    own, common = duel(size, own, behind, common, u)
                shares[k] = own
                if own in (0, 1):
                    copies[k] = int(own)
            columns = dict(zip(batch.schema.names, batch.columns))
            columns |= {"copies": pa.array(copies, pa.int64()), "share": pa.array(shares, pa.float64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


_OPEN = "key bigint, number bigint, node bigint, size bigint, share double"


def _pairs(level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Duels among the residuals of a node, of which there are `fan` at most; at most one stays open."""

    def settle(leaf: int, rows: list[tuple]) -> Iterator[tuple]:
        held = None
        for row, u in zip(rows, _draws(leaf, level, 0, len(rows)).tolist()):
            if held is None:
                held = row
                continue
            (*one, size, share), (*two, other, other_share) = held, row
            share, other_share = duel(size, share, other, other_share, u)
            held = None
            for who, s, p in ((one, size, share), (two, other, other_share)):
                if p in (0, 1):
                    yield *who, s, p, int(p)
                else:
                    held = (*who, s, p)
        if held is not None:
            yield *held, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, rows = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
                columns = [pa.array(c, kind) for c, kind in zip(zip(*settle(leaf, rows)), kinds)]
                yield pa.record_batch(columns, ["key", "number", "node", "size", "share", "copies"])

        for batch in batches:
            for of, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if of != leaf:
                    yield from done()
                    leaf, rows = of, []
                rows.append(tuple(row))
        yield from done()

    return run


def _resolve(rows: DataFrame, fan: int) -> DataFrame:
    """key, copies of the documents that their leaves left open (`_OPEN`)."""
    settled, level = [], 1
    while True:
        last = (rows.agg(F.max("node")).first()[0] or 0) == 0
        node = F.floor(F.col("node") / fan).cast("bigint")
        dealt = rows.select(F.xxhash64("number", node).alias("leaf"), "key", "number", node.alias("node"), "size", "share")
        sorted_rows = dealt.repartition("leaf").sortWithinPartitions("leaf", F.desc("size"), "key")
        done = stage(sorted_rows.mapInArrow(_pairs(level), schema(f"{_OPEN}, copies bigint")))
        if last:  # one of each source is open at most
            u = F.xxhash64("key", F.lit(level)).bitwiseAND((1 << 52) - 1) / F.lit(float(1 << 52))
            settled.append(done.select("key", F.coalesce("copies", (u < F.col("share")).cast("bigint")).alias("copies")))
            return reduce(DataFrame.unionByName, settled)
        settled.append(done.filter("copies IS NOT NULL").select("key", "copies"))
        rows = done.filter("copies IS NULL").drop("copies")
        level += 1


def mix(
    docs: DataFrame,
    size: str = "size",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: Fraction = SHARE,
    most: int = MOST,
    fan: int = FAN,
    order: list[Column] | None = None,
) -> DataFrame:
    """`docs` as the struct `row`, with size, source_size, target (of the source), copies and taken.

    `order` tells documents of one size apart; without it, all columns do. All columns travel in the
    shuffle of the duels: pass those that are needed, texts can be joined again by id.
    """
    check = F.xxhash64(*(order or [F.col(f"`{c}`").cast("string") for c in docs.columns]))
    source_of, size_of = F.col(f"`{source}`").cast("string"), F.coalesce(F.col(f"`{size}`").cast("bigint"), F.lit(0))
    rows = stage(
        docs.select(
            boxed(docs).alias("row"),
            source_of.isNull().alias("no_source"),
            F.coalesce(source_of, F.lit("")).alias("source"),
            size_of.alias("size"),
            check.alias("check"),
        )
    )
    counts = rows.groupBy("no_source", "source").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    wanted = targets(counts, weights, share, most)
    # salted: a source may hold a third of all rows, and there may be too many sources for a broadcast
    salted = wanted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    salt = F.pmod(F.col("check"), F.lit(_SALTS)).cast("int")
    ratio = F.when(F.col("words") > 0, F.least(F.col("target") / F.col("words"), F.lit(float(most)))).otherwise(0.0)
    node = F.pmod(F.xxhash64("check", F.lit(1)), F.ceil(F.col("n") / fan).cast("bigint"))
    dealt = (
        rows.withColumn("salt", salt)
        .join(salted, ["no_source", "source", "salt"])
        .withColumn("ratio", ratio)
        .select(
            "row", "size", "check", F.col("words").alias("source_size"), "target", "number", node.alias("node"),
            F.xxhash64("number", node).alias("leaf"), F.floor("ratio").cast("bigint").alias("whole"),
            (F.col("ratio") - F.floor("ratio")).alias("share"), F.lit(None).cast("bigint").alias("copies"),
        )
    )
    # the sum per leaf and the duels share one exchange; both sorts spill
    summed = dealt.repartition("leaf").withColumn("leaf_size", F.sum("size").over(Window.partitionBy("leaf")))
    streams = summed.sortWithinPartitions("leaf", F.desc("size"), "check")
    done = stage(streams.mapInArrow(_leaves(), streams.schema))
    left = done.filter("copies IS NULL")
    final = _resolve(left.select(F.col("leaf").alias("key"), "number", "node", "size", "share"), fan)
    decided = left.drop("copies").join(final, left["leaf"] == final["key"])
    columns = ["row", "size", "source_size", "target", (F.col("whole") + F.col("copies")).alias("copies")]
    out = done.filter("copies IS NOT NULL").select(*columns).unionByName(decided.select(*columns))
    drop_staged(rows)
    return out.withColumn("taken", F.col("size") * F.col("copies"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("check"))
    mixed = mix(sized, order=[id_of(), F.col("check")])
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")
