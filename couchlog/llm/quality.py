"""Quality classifier: Bradley-Terry scores learnt from pairs of a preferred and another document.

A document is described by frequencies: of byte classes and pairs of them, of repeated words and
lines, of word lengths. From labelled rows, pairs (label 1, label 0) are drawn; the weights are
learnt by logistic loss on the difference of the two documents' features. The threshold is a quantile
of the labelled scores, the one at the share of label 0 among them; scores are scaled so that it
lies at `CUT`.

Training uses at most `max_rows` labelled rows of each label, those with the smallest hash of their
id. Scores and decisions cover all documents.

Defined cases: a null or empty text has all features 0 and gets the score of that; labels that are
null, or of documents that do not exist, are not used, nor is an id that has both labels; an id
with several texts is learnt with the smallest of them (null as empty); with only one label, or none, every score is
`CUT`, so that nothing is rejected; null ids are never used for training and are scored; a very long text is
described in pieces of about a MB; repeated rows give repeated results; other columns play no part. So the
model depends on the rows alone, not on their order or partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from couchlog.llm.common import documents, schema
from couchlog.llm.words import utf8, word_bounds, word_hashes

CUT = 0.7
MAX_ROWS = 4000
PAIRS_PER_ROW = 8
HELD_OUT = 2

# Byte classes: single classes for common signs, the rest by kind.
_SIGNS = b" \n,.;:!?|'\"()-_/#%$&*@=+<>[]{}~^`\\"
_CLASS = np.zeros(256, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[128:192] = 4
_CLASS[192:] = 5
for _i, _sign in enumerate(_SIGNS):
    _CLASS[_sign] = 6 + _i
_N = 6 + len(_SIGNS)
_COARSE = np.minimum(np.arange(_N), 14).astype(np.uint8)
_COARSE[[6 + _SIGNS.index(x) for x in b"!?"]] = 12
_COARSE[[6 + _SIGNS.index(x) for x in b"#%$&*@"]] = 13
_M = 15
_EXTRA = 10
N_FEATURES = _N + _M * _M + _EXTRA
_PIECE = 1 << 20


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of `N_FEATURES` per text; whole texts, in groups of about a MB."""
    out = np.zeros((len(offsets) - 1, N_FEATURES), np.float32)
    i = 0
    while i < len(out):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _PIECE)) - 1)
        _describe(data, offsets[i : j + 1], out[i:j])
        i = j
    return out


def _describe(data: np.ndarray, offsets: np.ndarray, out: np.ndarray) -> None:
    n, size = len(out), np.diff(offsets)
    kinds = _CLASS[data[offsets[0] : offsets[-1]]]
    row = np.repeat(np.arange(n), size)
    ones = np.bincount(row * _N + kinds, minlength=n * _N).reshape(n, _N)
    coarse = _COARSE[kinds].astype(np.int64)
    inner = row[1:] == row[:-1]
    code = (row[1:] * _M + coarse[:-1]) * _M + coarse[1:]
    twos = np.bincount(code[inner], minlength=n * _M * _M).reshape(n, _M * _M)
    weight = 1 / np.maximum(size, 1)[:, None]
    out[:, :_N] = np.sqrt(ones * weight)
    out[:, _N : _N + _M * _M] = np.sqrt(twos * weight)
    starts, ends, first = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends, lower=True)
    lengths = (ends - starts).astype(np.float64)
    owner = np.repeat(np.arange(n), np.diff(first))
    count = np.diff(first).astype(np.float64)
    some = np.maximum(count, 1)
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    distinct = np.bincount(o[fresh], minlength=n)
    runs = np.diff(np.append(np.flatnonzero(fresh), len(h)))
    top = np.zeros(n)
    np.maximum.at(top, o[fresh], runs)
    mean = np.bincount(owner, lengths, n) / some
    spread = np.sqrt(np.maximum(np.bincount(owner, lengths**2, n) / some - mean**2, 0))
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    lines = np.bincount(row[kinds == 6 + _SIGNS.index(b"\n")], minlength=n) + 1
    extra = out[:, _N + _M * _M :]
    extra[:, 0] = np.log1p(size) / 10
    extra[:, 1] = np.log1p(count) / 10
    extra[:, 2] = distinct / some
    extra[:, 3] = top / some
    extra[:, 4] = mean / 10
    extra[:, 5] = spread / 10
    extra[:, 6] = np.bincount(owner, again, n) / some
    extra[:, 7] = np.log1p(size / lines) / 10
    extra[:, 8] = count < 50
    extra[:, 9] = size > 0


@dataclass(frozen=True)
class Model:
    """Weights of the centred features, the score's threshold and scale."""

    center: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x - self.center) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (self.raw(x) - self.threshold) * self.scale + math.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def fit(good: np.ndarray, poor: np.ndarray, penalty: float = 1e-3, rounds: int = 30) -> Model:
    """Newton's method on the logistic loss of feature differences (preferred less other)."""
    if not len(good) or not len(poor):
        return Model(np.zeros(N_FEATURES), np.zeros(N_FEATURES), 0.0, 1.0)
    rng = np.random.default_rng(0)
    pairs = PAIRS_PER_ROW * max(len(good), len(poor))
    every = np.concatenate([good, poor]).astype(np.float64)
    center, spread = every.mean(0), every.std(0) + 1e-3
    a, b = ((x - center) / spread for x in (good, poor))
    first, second = np.arange(pairs) % len(a), rng.permutation(np.arange(pairs) % len(b))
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        gradient, curve = -penalty * w, penalty * np.eye(len(w))
        for i in range(0, pairs, 2048):  # the differences of all pairs are never held at once
            d = a[first[i : i + 2048]] - b[second[i : i + 2048]]
            p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
            gradient += d.T @ (1 - p) / pairs
            curve += (d * (p * (1 - p))[:, None]).T @ d / pairs
        step = np.linalg.solve(curve, gradient)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    raw = Model(center, w / spread, 0.0, 1.0).raw
    up, down = raw(good), raw(poor)
    share = len(poor) / (len(good) + len(poor))
    both = np.concatenate([up, down])
    # the quantile at the share of label 0, between the scores on both sides of it
    threshold = float(np.quantile(both, share, method="midpoint"))
    return Model(center, w / spread, threshold, 1.0)


def _describe_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = features(*utf8(batch.column("text")))
        rows = pa.array([r.tobytes() for r in x], pa.binary())
        yield pa.record_batch([batch.column("quality"), rows], ["quality", "features"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Learn from the labelled documents that are not held out."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    bounds = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"), F.max("quality").cast("int").alias("other"))
    known = bounds.filter("quality = other").drop("other")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [known.filter(F.col("quality") == q).orderBy(*order).limit(max_rows) for q in (0, 1)]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(picked[0].unionByName(picked[1]), "doc_id")
    rows = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # at most `max_rows` of each label
    found = rows.select("quality", "text").mapInArrow(_describe_batches, schema("quality int, features binary")).collect()
    found.sort(key=lambda r: (r["quality"], bytes(r["features"])))
    x = np.array([np.frombuffer(r["features"], np.float32) for r in found], np.float32).reshape(-1, N_FEATURES)
    y = np.array([r["quality"] for r in found], int)
    return fit(x[y == 1], x[y == 0])


def score_quality(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows and columns of `docs`, plus `score` (0 to 1); a column of that name, in upper or lower case, is replaced."""
    out = docs.drop("score")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            scores = model.score(features(*utf8(batch.column(at))).astype(np.float64))
            yield pa.record_batch([*batch.columns, pa.array(scores)], [*batch.schema.names, "score"])

    return out.mapInArrow(score, schema(f"{fields}, score double"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_quality(docs, model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )
