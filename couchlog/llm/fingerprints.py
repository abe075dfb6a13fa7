"""Document fingerprints: one-permutation MinHash with optimal densification, packed low-order bits.

Every 5-word shingle is hashed once. The upper bits of the hash pick one of `BINS` bins, a bin keeps
its minimum. An empty bin looks at other bins in an order fixed by its own number and takes the
first one that is filled, so two texts fill their gaps from the same places. Of each minimum the low
`BITS` bits are stored. Two bins agree by chance with 2^-BITS, which `likeness` corrects for.
Everything is built-in column functions; one shuffle moves the texts to their neighbours.

Defined cases: a null or empty text, or one of white space only, has the fingerprint '' (likeness 1
to another such text, 0 to others); fewer than five words make one shingle; equal texts have equal
fingerprints, whatever their ids; a null id sorts as the largest; rows with equal id are ordered by
the hash of their text; a single row is its own next document; an empty table gives no row.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from couchlog.llm.common import NO_ID, SPACE, documents, id_back, inputs

SHINGLE = 5
BINS = 256
BITS = 8
PROBES = 24
ROWS_PER_BLOCK = 1024
MAX_BLOCKS = 65_536

_VALUE_BITS = 63 - (BINS.bit_length() - 1)
_EMPTY = (1 << _VALUE_BITS) - 1


def shingle_hashes(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add `out`: a non-negative hash for every run of five words (not distinct); one for fewer words.

    The words are a column of their own, so that a text is split once and not for each use.
    """
    df = df.withColumn("_words", F.array_remove(F.split(F.lower(text), f"{SPACE}+"), ""))
    n = F.size("_words")
    runs = F.arrays_zip(*[F.slice("_words", F.lit(k + 1), n - (SHINGLE - 1)) for k in range(SHINGLE)])
    hashed = F.transform(runs, lambda run: F.xxhash64(run).bitwiseAND(F.lit(NO_ID)))
    whole = F.array(F.xxhash64(F.array_join("_words", " ")).bitwiseAND(F.lit(NO_ID)))
    hashes = F.when(n >= SHINGLE, hashed).when(n > 0, whole).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(out, hashes).drop("_words")


def _bin(value: Column) -> Column:
    return F.shiftright(value, _VALUE_BITS)


def _bin_codes(df: DataFrame, hashes: str, out: str) -> DataFrame:
    """`out`: the low bits of each bin's minimum, null where the bin is empty.

    One mark per bin, larger than any of its hashes, goes into the sorted list; the first entry of
    each bin is then its minimum or, if it is empty, the mark.
    """
    marks = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.shiftleft(b.cast("bigint"), _VALUE_BITS) + F.lit(_EMPTY))
    df = df.withColumn("_sorted", F.sort_array(F.concat(hashes, marks)))
    first = F.filter("_sorted", lambda x, i: (i == 0) | (_bin(x) != _bin(F.get("_sorted", i - 1))))
    low = F.transform(
        first,
        lambda x: F.when(x.bitwiseAND(F.lit(_EMPTY)) != _EMPTY, x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("smallint")),
    )
    return df.withColumn(out, low).drop("_sorted")


def _densified(codes: str, filled: str) -> Column:
    """Each empty bin takes the code of the first filled bin in its own probing order."""

    def probe(j: Column, t: int) -> Column:
        return F.get(codes, F.pmod(F.xxhash64(j, F.lit(t)), F.lit(BINS)).cast("int"))

    def rest(j: Column) -> Column:  # beyond the probes, the filled bins in the order of a hash
        return F.array_min(F.transform(filled, lambda e: F.struct(F.xxhash64(j, e["at"]).alias("h"), e["code"].alias("code"))))["code"]

    return F.transform(codes, lambda c, j: F.coalesce(c, *[probe(j, t) for t in range(PROBES)], rest(j)))


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add `out`: `BINS` codes of `BITS` bits, or none for a text without words."""
    df = shingle_hashes(df, text, "_hashes")
    df = _bin_codes(df, "_hashes", "_codes")
    filled = F.filter(
        F.transform("_codes", lambda c, j: F.struct(j.alias("at"), c.alias("code"))), lambda e: e["code"].isNotNull()
    )
    df = df.withColumn("_filled", filled)
    empty = F.array().cast("array<smallint>")
    codes = F.when(F.size("_hashes") > 0, _densified("_codes", "_filled")).otherwise(empty)
    return df.withColumn(out, codes).drop("_hashes", "_codes", "_filled")


def packed(codes: Column) -> Column:
    """The codes as a hex string."""
    return F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c), BITS // 4, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Similarity (0 to 1) of the shingle sets: share of equal codes, less those equal by chance."""
    chance = 2.0**-BITS
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))
    corrected = F.greatest(F.lit(0.0), (equal / F.lit(float(BINS)) - chance) / (1 - chance))
    both_empty = (F.size(a) == 0) & (F.size(b) == 0)
    return F.when(both_empty, F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(corrected)


def _later() -> Column:
    """Place among rows of one id, ascending; the order of documents goes down by it."""
    return F.bitwise_not(F.xxhash64("text"))


def _above(ids: Column, places: Column, at: Column) -> Column:
    """Whether a row comes behind the cut number `at`, by id and then place."""
    cut = F.get(ids, at)
    return (cut < F.col("id")) | ((cut == F.col("id")) & (F.get(places, at) < _later()))


def _own(cuts: list[tuple[int, int]]) -> tuple[Column, Column, Column]:
    """The block of a row (the number of cuts before it), and the cuts as columns."""
    numbers = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>") if xs else F.array().cast("array<bigint>")
    ids, places = numbers([i for i, _ in cuts]), numbers([p for _, p in cuts])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, len(cuts).bit_length())))])

    def step(below: Column, s: Column) -> Column:
        return F.when((below + s <= len(cuts)) & _above(ids, places, below + s - 1), below + s).otherwise(below)

    return F.aggregate(steps, F.lit(0), step), ids, places


def _blocks(rows: DataFrame, rows_per_block: int, max_blocks: int) -> tuple[list[tuple[int, int]], tuple[int | None, int]]:
    """Where blocks end (at most `max_blocks`), ascending by id and place, and the last row of all.

    A cut is the id and place of a row; the place `NO_ID` is behind all rows of that id. An id that
    fills several blocks is cut evenly by place, at the last row that each of its blocks then has.
    """
    n = rows.count()
    count = min(max_blocks, -(-n // rows_per_block))
    steps = [i / count for i in range(1, count)]
    asked = [F.max("id").alias("top")]
    if steps:
        asked.append(F.percentile_approx("id", steps, max(10_000, 10 * count)).alias("ends"))
    found = rows.agg(*asked).first()
    top, times = found["top"], Counter(found["ends"] if steps else [])
    cuts = [(i, NO_ID) for i in times if i != top]
    hot = {i: m for i, m in times.items() if m > 1}
    if not hot:
        return sorted(cuts), (top, NO_ID)
    even = [(i, (j << 64) // m - (1 << 63)) for i, m in hot.items() for j in range(1, m)]
    number = _own(sorted({*cuts, *even, (top, NO_ID)}))[0]
    held = rows.filter(F.col("id").isin(list(hot))).groupBy("id", number.alias("own")).agg(F.max(_later()).alias("place"))
    ends = sorted((r["id"], r["place"]) for r in held.collect())
    last = ends.pop() if top in hot else (top, NO_ID)
    return sorted({*(c for c in cuts if c[0] not in hot), *ends}), last


def with_next(rows: DataFrame, columns: list[str], rows_per_block: int = ROWS_PER_BLOCK, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """Add `next_<column>`: the value in the next row by descending id, after the last the first.

    Rows are dealt to blocks of neighbouring ids; an id with many rows is several blocks. The row that
    heads a block is also sent to the end of the block before it in this order, so that every row
    meets its successor after one shuffle.
    """
    cuts, last = _blocks(rows, rows_per_block, max_blocks)
    own, ids, places = _own(cuts)

    def is_row(i: Column, place: Column) -> Column:
        return (i == F.col("id")) & ((place == NO_ID) | (place == _later()))

    heads = F.when(is_row(F.lit(last[0]), F.lit(last[1])), F.lit(0)).when(
        is_row(F.get(ids, F.col("_own")), F.get(places, F.col("_own"))), F.col("_own") + 1
    )
    dealt_to = F.filter(
        F.array(
            F.struct(F.col("_own").alias("block"), F.lit(False).alias("guest")),
            F.struct(heads.alias("block"), F.lit(True).alias("guest")),
        ),
        lambda p: p["block"].isNotNull(),
    )
    dealt = rows.withColumn("_own", own).withColumn("_place", F.explode(dealt_to))
    order = Window.partitionBy("_block").orderBy("_guest", F.col("id").desc(), F.xxhash64("text"))
    dealt = dealt.withColumn("_block", F.col("_place.block")).withColumn("_guest", F.col("_place.guest")).drop("_place", "_own")
    for c in columns:
        dealt = dealt.withColumn(f"next_{c}", F.lead(c).over(order))
    return dealt.filter(~F.col("_guest")).drop("_block", "_guest")


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited form and of the next document, with their likeness."""
    rows = with_fingerprint(inputs(docs), "text", "codes")
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    pairs = with_next(rows, ["text", "codes"])
    edited = pairs.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)))
    return with_fingerprint(edited.drop("next_text"), "edited", "edited_codes")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = compare_edits(documents(spark, sf_dir).select("doc_id", "text"))
    return rows.select(
        id_back("id").alias("doc_id"),
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        packed(F.col("codes")).alias("fingerprint"),
        packed(F.col("edited_codes")).alias("edited_fingerprint"),
        likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"),
        likeness(F.col("codes"), F.col("next_codes")).alias("near_next"),
    )
