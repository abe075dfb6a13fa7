"""What the operators share: input rows, staged tables, column checks."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Stands for a missing id inside the operators: it sorts after every other id.
NO_ID = (1 << 63) - 1

#: White space between words and around lines.
SPACE = "[\\x20\\x09-\\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_of(name: str = "doc_id") -> Column:
    """The id as bigint, a missing one as `NO_ID`."""
    return F.coalesce(F.col(name).cast("bigint"), F.lit(NO_ID))


def id_back(name: str) -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name))


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def inputs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only `id` (never null) and `text` (never null); other columns cannot clash."""
    return docs.select(id_of(id_col).alias("id"), text_of(text_col).alias("text"))


def boxed(docs: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """The columns of `docs` as one struct (null if there is none left): what an operator adds cannot clash with them."""
    names = [c for c in docs.columns if c not in without]
    return F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.lit(None).cast("struct<none: int>")


def unboxed(df: DataFrame, names: list[str], box: str = "row", **replaced: Column) -> DataFrame:
    """The columns `names` again, from the struct or from `replaced`."""
    return df.select(*[replaced[c].alias(c) if c in replaced else F.col(f"`{box}`.`{c}`").alias(c) for c in names])


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share.

    `spark.checkpoint.dir` of the session names it. Where that is unset, a session of one machine
    takes a folder beside its warehouse for the life of the process; a cluster has to set it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
        root = f"{warehouse}/staged-{os.getpid()}"
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stage(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write as Parquet in the shared folder and go on from the files: cuts the lineage."""
    folder = folder or shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table that is no longer read."""
    spark = df.sparkSession
    for name in {os.path.dirname(f) for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def schema(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)
