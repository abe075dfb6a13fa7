"""Line dedup: of a line that several documents hold, only the first document keeps it.

A line's key is the line without white space at its ends, A-Z in lower case. Keys of at least
`min_chars` code points found in two or more documents lose all their lines, except in the
document with the smallest id. Key hashes are dealt by ranges of (hash, document, position), so a
line that a third of all documents hold is spread over many tasks, each of which streams its sorted
rows and keeps one row of state. The result is a compressed bitmap of kept lines per document; the
text itself is read again only to apply it.

Defined cases: a null or empty text is one empty line; a null id sorts after all others; rows with
equal id are one document (a line repeated only within them stays); repeated rows give repeated
results; other columns play no part and are carried along as a struct, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from couchlog.llm.common import boxed, documents, id_of, inputs, schema, stage, text_of

MIN_CHARS = 10
_WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DROPS = "pending boolean, h1 bigint, h2 bigint, id bigint, version bigint, line int, first bigint"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(_WHITE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """128-bit hash, document and position of every line that counts."""
    rows = docs.select("id", F.xxhash64("text").alias("version"), F.posexplode(_lines(F.col("text"))).alias("line", "raw"))
    keys = rows.select("id", "version", "line", line_key(F.col("raw")).alias("key"))
    return keys.filter(F.char_length("key") >= min_chars).select(
        F.xxhash64(F.lit(1), "key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"), "id", "version", "line"
    )


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines behind the first document of their hash, from rows sorted by (hash, document, position).

    A range may begin inside a hash. Rows of its first hash that lie in the first document seen
    here are `pending`; so is one row for the last hash. They name the first document seen here.
    """
    last, first_id, opening = None, 0, True
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, ids, version, line = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        begins = np.ones(len(h1), bool)
        begins[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        joins = last is not None and (h1[0], h2[0]) == last
        begins[0] = not joins
        group = np.cumsum(begins)
        firsts = np.concatenate([[first_id], ids[begins]])[group]
        # the partition's first hash: group 1 of its first rows, and group 0 as long as it goes on
        in_opening = group == 1 if last is None else (group == 0) & opening & joins
        drop = ids > firsts
        pending = in_opening & ~drop
        last, first_id = (h1[-1], h2[-1]), firsts[-1]
        opening = bool(in_opening[-1])
        out = drop | pending
        yield _rows(pending[out], h1[out], h2[out], ids[out], version[out], line[out], firsts[out])
    if last is not None and not opening:
        one = np.ones(1, np.int64)
        yield _rows(one > 0, one * last[0], one * last[1], one * first_id, one * 0, -np.ones(1, np.int32), one * first_id)


def _rows(*columns: np.ndarray) -> pa.RecordBatch:
    kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    names = ["pending", "h1", "h2", "id", "version", "line", "first"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, version, line) of every line to drop; `docs` has id and text."""
    order = ["h1", "h2", "id", "version", "line"]
    ranges = hashed_lines(docs, min_chars).repartitionByRange(*order).sortWithinPartitions(*order)
    found = stage(ranges.mapInArrow(_stream, schema(_DROPS)))
    pending = found.filter("pending")
    first = pending.groupBy("h1", "h2").agg(F.min("first").alias("true_first"))
    late = pending.filter("line >= 0").join(first, ["h1", "h2"]).filter(F.col("id") > F.col("true_first"))
    wanted = ["id", "version", "line"]
    return found.filter(~F.col("pending")).select(*wanted).unionByName(late.select(*wanted))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, version, n_lines, lines = batch.columns
        keep, dropped = [], []
        for n, out in zip(n_lines.to_pylist(), lines):
            bits = np.ones(n, np.uint8)
            if out.is_valid:
                bits[out.values.to_numpy(zero_copy_only=False)] = 0
            dropped.append(int(n - bits.sum()))
            keep.append(zlib.compress(np.packbits(bits).tobytes(), 1))
        yield pa.record_batch(
            [ids, version, n_lines, pa.array(dropped, pa.int64()), pa.array(keep, pa.binary())],
            ["id", "version", "n_lines", "n_dropped", "keep"],
        )


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, version (hash of the text), n_lines, n_dropped, keep (zlib of a bit per line)."""
    rows = inputs(docs, id_col, text_col)
    sizes = rows.select("id", F.xxhash64("text").alias("version"), F.size(_lines(F.col("text"))).cast("bigint").alias("n_lines"))
    lists = dropped_lines(rows, min_chars).groupBy("id", "version").agg(F.collect_set("line").alias("lines"))
    joined = sizes.dropDuplicates(["id", "version"]).join(lists, ["id", "version"], "left")
    return joined.select("id", "version", "n_lines", "lines").mapInArrow(
        _bitmaps, schema("id bigint, version bigint, n_lines bigint, n_dropped bigint, keep binary")
    )


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rest, texts, n_lines, dropped, keeps = batch.columns
        if dropped.to_numpy().any():
            new = texts.to_pylist()
            for i in np.flatnonzero(dropped.to_numpy()):
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keeps[i].as_py()), np.uint8))
                new[i] = "\n".join([line for line, keep in zip(new[i].split("\n"), bits) if keep])
            texts = pa.array(new, texts.type)
        yield pa.record_batch([rest, texts, n_lines, dropped], ["rest", "text", "n_lines", "n_dropped"])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """rest (struct of the other columns of `docs`), text (its kept lines), n_lines, n_dropped."""
    rows = docs.select(boxed(docs, (text_col,)).alias("rest"), id_of(id_col).alias("id"), text_of(text_col).alias("text"))
    joined = rows.withColumn("version", F.xxhash64("text")).join(bitmaps, ["id", "version"])
    rest = rows.schema["rest"].dataType.simpleString()
    return joined.select("rest", "text", "n_lines", "n_dropped", "keep").mapInArrow(
        _apply, schema(f"rest {rest}, text string, n_lines bigint, n_dropped bigint")
    )


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Documents after line dedup: rest (struct of the other columns), text, n_lines, n_dropped."""
    return apply_bitmaps(docs, stage(keep_bitmaps(docs, min_chars)))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("rest.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


# Keys as in `line_key`; the smallest holder of a key keeps its lines. Any null id sorts last.
OP8_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(doc_id, 9223372036854775807) AS id, coalesce(text, '') AS text
  FROM documents),
lines AS (
  SELECT r, id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM docs),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
firsts AS (SELECT key, min(id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT k.*, coalesce(k.id > f.first, false) AS gone FROM keyed k LEFT JOIN firsts f ON k.key = f.key AND length(k.key) >= 10)
SELECT CASE WHEN id < 9223372036854775807 THEN id END AS doc_id, count(*) AS n_lines,
  CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, id
"""
