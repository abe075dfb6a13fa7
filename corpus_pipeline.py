"""A training corpus from documents: five stages, each written as Parquet and read again by the next.

quality classifier -> line dedup -> MinHash near-dedup -> benchmark decontamination -> packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; all but the
last return the columns of `docs`. Stages read other tables (labels, benchmark) from `sf_dir`.

Defined cases are those of the operators in `couchlog.llm`. A text that loses all its lines stays as
an empty document, and so does a null text. `n_chars` follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from couchlog.llm import decontamination, line_dedup, minhash_dedup, packing, quality
from couchlog.llm.common import boxed, documents, inputs, stage, unboxed


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    The model is learnt on the documents of `sf_dir`, which the labels belong to.
    """
    model = quality.train(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select(boxed(docs, ("text",)).alias("row"), "text")
    scored = quality.score_quality(rows, model).filter(F.col("score") >= quality.CUT)
    return unboxed(scored, docs.columns, text=F.col("text"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that another document with a smaller id holds."""
    cut = line_dedup.drop_repeated_lines(docs)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("n_dropped") > 0, length).otherwise(F.col("rest.n_chars"))
    return unboxed(cut, docs.columns, "rest", **new)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash_dedup.deduplicate(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of test items."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, neighbours on the curve together."""
    return packing.piece_digests(packing.pack(inputs(docs)))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("packing", pack),
]

# Learnt weights and tokenizer ids are beyond SQL; the tests rebuild every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = documents(spark, sf_dir)
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
