"""Near-duplicate documents by b-bit MinHash, confirmed on whole shingle sets.

1. Each document gets `HASHES` minima over its distinct 5-word shingles. Documents with the same set
   (by a 128-bit digest of it) form one class, which its smallest id stands for from here on.
2. Bands of `ROWS` minima name buckets. Of each minimum only the low `BITS` bits are kept, packed into
   64-bit words; equal lanes of two signatures are counted by xor and bit count, and the count,
   corrected for lanes that agree by chance, estimates the similarity.
3. In each bucket every class is paired with the bucket's smallest and largest id only. Pairs whose
   estimate can belong to a link are confirmed on the full sets, and give components.
4. Where a bucket still holds several components, its members outside the bucket's largest component
   are compared with all members of other components by a second signature of `LONG` one-bit lanes,
   which only members of such buckets get. Pairs that this sharper estimate admits are confirmed as
   well. No pair within a component is looked at, so a group of copies costs a multiple of its size,
   and a group of texts that are alike but not enough costs comparisons of bits, not rows.

A pair at the similarity of `PERCENT` shares no band with (1 - 0.75^3)^40, 3e-10, and fails an
estimate with less than 1e-6; everything after that is exact.

Defined cases: a null or empty text, or one without words, has no shingle and no link; fewer than
five words make one shingle of the whole sequence; a null id sorts after all others and is returned
as null; rows with equal id are one vertex but each is returned, with its own number of shingles;
other columns play no part in the links and are kept by `deduplicate`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from couchlog.llm.blocks import BLOCK_BYTES, Block, Blocks, squeeze, unsqueeze
from couchlog.llm.common import boxed, documents, id_back, id_of, inputs, schema, stage, text_of, unboxed
from couchlog.llm.components import components
from couchlog.llm.words import mix, shingles, word_bounds, word_hashes

SHINGLE = 5
PERCENT = 75
ROWS = 3
BANDS = 40
HASHES = ROWS * BANDS
BITS = 4
WORDS = HASHES * BITS // 64 + (HASHES * BITS % 64 > 0)
#: Lanes that have to agree: 7 standard deviations below the mean at PERCENT.
_SHARE = PERCENT / 100 + (1 - PERCENT / 100) / 2**BITS
LEAST_EQUAL = int(HASHES * _SHARE - 7 * (HASHES * _SHARE * (1 - _SHARE)) ** 0.5)

#: One-bit lanes of the second signature; those that may differ: 5 standard deviations above the mean at PERCENT.
LONG = 4096
_MISS = (1 - PERCENT / 100) / 2
MOST_DIFFERENT = int(LONG * _MISS + 5 * (LONG * _MISS * (1 - _MISS)) ** 0.5)

_LONG_SEEDS = mix(np.arange(1, LONG + 1, dtype=np.uint64) ^ np.uint64(0x2545F4914F6CDD1D)) | np.uint64(1)
_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_SIGNED = "id bigint, version bigint, block bigint, row int, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>, signature array<bigint>"


def _sets(block: Block) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted shingle hashes of each document of a block."""
    starts, ends, first = word_bounds(block.data, block.offsets)
    hashes = word_hashes(block.data, starts, ends, lower=True)
    for row, (s, e) in enumerate(zip(first.tolist(), first[1:].tolist())):
        yield row, shingles(hashes[s:e], SHINGLE)


def minima(values: np.ndarray, seeds: np.ndarray = _SEEDS) -> np.ndarray:
    """The least value of each of the hash functions over a set, without its last bits."""
    out = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(values), 128):
        np.minimum(out, (values[i : i + 128, None] * seeds).min(0), out=out)
    return out >> np.uint64(20)


def packed_lanes(low: np.ndarray) -> np.ndarray:
    """The low `BITS` bits of each minimum, side by side in 64-bit words."""
    per_word = 64 // BITS
    lanes = np.zeros(WORDS * per_word, np.uint64)
    lanes[: len(low)] = low & np.uint64((1 << BITS) - 1)
    shift = np.arange(per_word, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(lanes.reshape(WORDS, per_word) << shift, axis=1).view(np.int64)


def _sign(number: int, block: Block) -> Iterator[pa.RecordBatch]:
    rows = []
    for row, values in _sets(block):
        n, text = len(values), block.data[block.offsets[row] : block.offsets[row + 1]]
        version = np.uint64(xxhash.xxh64_intdigest(text.tobytes(), 42)).view(np.int64).item()  # as Spark's xxhash64
        if not n:
            rows.append((int(block.ids[row]), version, number, row, 0, 0, 0, None, None))
            continue
        least = minima(mix(values))
        band = mix((least.reshape(BANDS, ROWS) * _SEEDS[:ROWS]).sum(1, dtype=np.uint64) ^ mix(np.arange(BANDS, dtype=np.uint64)))
        d1 = int((values * mix(values)).sum(dtype=np.uint64).view(np.int64))
        d2 = int(mix(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64))
        rows.append((int(block.ids[row]), version, number, row, n, d1, d2, band.view(np.int64), packed_lanes(least)))
    for i in range(0, len(rows), 1000):
        ids, versions, numbers, at, n, d1, d2, bands, signature = zip(*rows[i : i + 1000])
        longs = pa.list_(pa.int64())
        yield pa.record_batch(
            [*[pa.array(v, pa.int64()) for v in (ids, versions, numbers)], pa.array(at, pa.int32()), *[pa.array(v, pa.int64()) for v in (n, d1, d2)],
             pa.array(bands, longs), pa.array(signature, longs)],
            ["id", "version", "block", "row", "n_shingles", "d1", "d2", "bands", "signature"],
        )


def equal_lanes(a: Column, b: Column) -> Column:
    """How many of the `HASHES` lanes of two signatures agree."""
    ones = F.lit(int("0001" * 16, 2))
    differ = F.lit(0)
    for k in range(WORDS):
        x = a[k].bitwiseXOR(b[k])
        any_bit = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseOR(F.shiftrightunsigned(x, 3))
        differ = differ + F.bit_count(any_bit.bitwiseAND(ones))
    return F.lit(HASHES) - differ


def estimate(a: Column, b: Column) -> Column:
    """Similarity from the share of equal lanes, less those that agree by chance."""
    chance = 2.0**-BITS
    return F.greatest(F.lit(0.0), (equal_lanes(a, b) / F.lit(float(HASHES)) - chance) / (1 - chance))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps the pairs of sets that share enough; consecutive rows often have the same first set."""
    last_key, last = None, None
    for batch in batches:
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        keep = np.zeros(len(a), bool)
        for i, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"))):
            if last_key != a[i]:
                last_key, last = a[i], unsqueeze(x.as_py(), "<u8")[0]
            other = unsqueeze(y.as_py(), "<u8")[0]
            small, large = (last, other) if len(last) < len(other) else (other, last)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            both = int((large[at] == small).sum())
            keep[i] = 100 * both >= PERCENT * (len(last) + len(other) - both)
        yield pa.record_batch([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])


class _Sets:
    """The shingle sets of classes, built again from the blocks for the ids that are asked for."""

    def __init__(self, blocks: Blocks, places: DataFrame):
        self.blocks, self.places = blocks, places

    def of(self, ids: DataFrame, describe: Callable[[np.ndarray], object], out: str, kind: pa.DataType) -> DataFrame:
        """`describe` of the set of each of the distinct `ids`, as the second column of `out`."""
        rows = self.places.join(ids, "id").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("row", "id"))).alias("rows"))
        names = [part.split()[0] for part in out.split(", ")]

        def sets(number: int, block: Block, rows: pa.Scalar | None) -> Iterator[pa.RecordBatch]:
            if rows is None:
                return
            starts, ends, first = word_bounds(block.data, block.offsets)
            found, values = [], []
            for asked in rows.as_py():
                s, e = int(first[asked["row"]]), int(first[asked["row"] + 1])
                found.append(asked["id"])
                values.append(describe(shingles(word_hashes(block.data, starts[s:e], ends[s:e], lower=True), SHINGLE)))
            yield pa.record_batch([pa.array(found, pa.int64()), pa.array(values, kind)], names)

        return self.blocks.map_with([rows], sets, out)

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs of class ids that are links."""
        pairs = stage(pairs)
        asked = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        found = self.of(asked, squeeze, "id bigint, set binary", pa.binary())
        left, right = found.toDF("a", "set_a"), found.toDF("b", "set_b")
        both = pairs.join(right, "b").join(left, "a").select("a", "b", "set_a", "set_b")
        return stage(both.mapInArrow(_confirm, schema("a bigint, b bigint")))

    def long_signatures(self, ids: DataFrame) -> DataFrame:
        return self.of(ids, _long_signature, "id bigint, long array<bigint>", pa.list_(pa.int64()))


def _long_signature(values: np.ndarray) -> np.ndarray:
    bits = (minima(mix(values), _LONG_SEEDS) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view(np.int64)


def different_bits(a: Column, b: Column) -> Column:
    """How many one-bit lanes of two long signatures differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def _pairs(df: DataFrame, signatures: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) whose estimate can belong to a link."""
    ordered = df.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    signed = ordered.join(signatures.toDF("a", "sig_a"), "a").join(signatures.toDF("b", "sig_b"), "b")
    return signed.filter(equal_lanes(F.col("sig_a"), F.col("sig_b")) >= LEAST_EQUAL).select("a", "b")


def near_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id (`NO_ID` for a missing one), version (hash of the text), n_shingles, group, component.

    `group` numbers the connected components and is null without shingles; `component` is the smallest id in it.
    """
    blocks = Blocks(inputs(docs, id_col, text_col), block_bytes)
    signed = stage(blocks.map(_sign, _SIGNED))
    digest = ["d1", "d2", "n_shingles"]
    # classes of equal sets, numbered; one of their rows stands for all
    found = signed.filter("n_shingles > 0").groupBy(*digest).agg(
        F.min("id").alias("least_id"), F.min(F.struct("block", "row", "bands", "signature")).alias("m")
    )
    classes = stage(found.select(F.monotonically_increasing_id().alias("id"), "least_id", *digest, "m.*"))
    buckets = classes.select(F.posexplode("bands").alias("band", "bucket"), "id")
    ends = buckets.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    shared = stage(buckets.join(ends, "bucket"))
    stars = shared.select(F.explode(F.array("low", "high")).alias("a"), F.col("id").alias("b"))
    signatures = classes.select("id", "signature")
    sets = _Sets(blocks, classes.select("id", "block", "row"))
    edges = sets.confirmed(_pairs(stars, signatures))
    reached = components(edges)
    more = sets.confirmed(_across(shared, reached, classes.select("id", "n_shingles", "bands", "signature"), sets))
    if not more.isEmpty():
        reached = components(edges.unionByName(more))
    named = classes.select("id", "least_id", *digest).join(reached, "id", "left").withColumn("component", F.coalesce("component", "id"))
    names = named.groupBy("component").agg(F.min("least_id").alias("name"))
    classed = named.join(names, "component").select(*digest, F.col("component").alias("group"), "name")
    rows = signed.select("id", "version", *digest).join(classed, digest, "left")
    return rows.select("id", "version", "n_shingles", "group", F.coalesce("name", "id").alias("component"))


def _across(shared: DataFrame, reached: DataFrame, signatures: DataFrame, sets: _Sets) -> DataFrame:
    """Admitted pairs between components in buckets that hold several.

    Members of a bucket outside its largest component are compared with all members of others: by
    their numbers of shingles, by their signatures, and then by their long signatures.
    """
    labelled = shared.select("bucket", "band", "id").join(reached, "id", "left").withColumn("component", F.coalesce("component", "id"))
    sizes = labelled.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.count("*").alias("k"))
    mixed = stage(labelled.join(main.filter("k > 1").drop("k"), "bucket"))
    known = stage(signatures.join(sets.long_signatures(mixed.select("id").distinct()), "id"))
    signed = mixed.join(known, "id").withColumn("x", F.struct("id", "n_shingles", "bands", "signature", "long"))
    rest = signed.filter("component <> main").select("bucket", "band", F.col("x").alias("a"), F.col("component").alias("of_a"))
    there = signed.select(F.col("bucket").alias("bucket_b"), F.col("x").alias("b"), F.col("component").alias("of_b"))
    sizes_fit = (100 * F.least("a.n_shingles", "b.n_shingles")) >= PERCENT * F.greatest("a.n_shingles", "b.n_shingles")
    near = equal_lanes(F.col("a.signature"), F.col("b.signature")) >= LEAST_EQUAL
    nearer = different_bits(F.col("a.long"), F.col("b.long")) <= MOST_DIFFERENT
    apart = F.col("of_a") != F.col("of_b")
    # of the buckets that hold both, the one of the first band gives the pair
    earlier = F.slice(F.zip_with("a.bands", "b.bands", lambda x, y: x == y), F.lit(1), F.col("band"))
    once = ~F.exists(earlier, lambda same: same)
    pairs = rest.join(there, (F.col("bucket") == F.col("bucket_b")) & apart & sizes_fit & near & nearer & once)
    return pairs.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows and columns of `docs` without near-duplicates: of each component the smallest id stays.

    Of several rows with that id the one with the smallest hash of its text stays, once; all rows
    without words stay.
    """
    found = stage(near_duplicates(docs))
    firsts = found.filter("group IS NOT NULL").groupBy("group").agg(F.min(F.struct("id", "version")).alias("m"))
    lone = found.filter("group IS NULL").select("id", "version").distinct()
    keep = firsts.select("m.*", F.lit(False).alias("lone")).unionByName(lone.withColumn("lone", F.lit(True)))
    keyed = docs.select(boxed(docs).alias("row"), id_of().alias("id"), F.xxhash64(text_of()).alias("version"))
    nth = F.row_number().over(Window.partitionBy("id", "version").orderBy("lone"))
    joined = keyed.join(keep, ["id", "version"]).withColumn("nth", nth)
    return unboxed(joined.filter("lone OR nth = 1"), docs.columns)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        id_back("id").alias("doc_id"),
        F.col("n_shingles").cast("bigint").alias("n_shingles"),
        id_back("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )
