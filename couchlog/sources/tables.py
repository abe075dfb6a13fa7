"""Profile tables: Parquet in the shared folder, or a database over JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stage_root(spark: SparkSession) -> str:
    """A new folder name under the session's shared folder.

    `spark.checkpoint.dir` names that folder, or else `SparkContext.setCheckpointDir`. Without either
    this raises: a folder of one machine would be missing on all others.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{shared.rstrip('/')}/couchlog-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """A folder for intermediate tables that is deleted at the end, also after a failure."""
    folder = stage_root(spark)
    try:
        yield folder
    finally:
        remove(spark, folder)


def stage(df: DataFrame, folder: str) -> DataFrame:
    """Write once, go on from the files: later steps neither recompute nor depend on executors."""
    return write_table(df, folder)


def write_table(df: DataFrame, folder: str) -> DataFrame:
    """Overwrite a Parquet table and return it as read back."""
    df.write.mode("overwrite").parquet(folder)
    return read_table(df.sparkSession, folder, df.schema)


def read_table(spark: SparkSession, folder: str, fields: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(fields) if fields else spark.read
    return reader.parquet(folder)


def _run_statements(spark: SparkSession, url: str, properties: Mapping[str, str], statements: Sequence[str]) -> None:
    """Run statements in one transaction, over the driver class that the properties name."""
    jvm = spark._jvm
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"], True, jvm.Thread.currentThread().getContextClassLoader())
    given = jvm.java.util.Properties()
    for key in ("user", "password"):
        if key in properties:
            given.setProperty(key, properties[key])
    connection = jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            connection.createStatement().execute(statement)
        connection.commit()
    finally:
        connection.close()


Run = Callable[[SparkSession, str, Mapping[str, str], Sequence[str]], None]


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    connections: int = 8,
    batch_size: int = 10_000,
    run: Run = _run_statements,
) -> int:
    """Replace a database table and return its row count. Any failure is raised.

    The rows are loaded into a table beside it, counted there by the database and compared with the
    number that Spark wrote; only then do both change names, in one transaction. Readers see the old
    table until then, and keep it if the load fails or a repeated task has inserted rows twice. The
    caller passes user, password and driver class as properties. `df` should come from `write_table`,
    so that narrowing it to a few connections does not narrow the aggregation before it.
    """
    spark, fresh, old = df.sparkSession, f"{table}_new", f"{table}_old"
    sent = Observation()
    (
        df.observe(sent, F.count(F.lit(1)).alias("rows"))
        .write.format("jdbc")
        .options(**properties)
        .option("url", url)
        .option("dbtable", fresh)
        .option("numPartitions", connections)
        .option("batchsize", batch_size)
        .mode("overwrite")
        .save()
    )
    expected, stored = sent.get["rows"], count_jdbc(spark, url, fresh, properties)
    if stored != expected:
        raise RuntimeError(f"{fresh} holds {stored} rows, expected {expected}; {table} is unchanged, write it again")
    bare = table.rsplit(".", 1)[-1]
    swap = [
        f"DROP TABLE IF EXISTS {old}",
        f"ALTER TABLE IF EXISTS {table} RENAME TO {bare}_old",
        f"ALTER TABLE {fresh} RENAME TO {bare}",
        f"DROP TABLE IF EXISTS {old}",
    ]
    run(spark, url, properties, swap)
    return expected


def count_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str]) -> int:
    """Rows of a database table, counted by the database: one row travels."""
    query = f"SELECT COUNT(*) AS n FROM {table}"
    return int(spark.read.format("jdbc").options(**properties).option("url", url).option("query", query).load().first()[0])


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partition_on: tuple[str, int, int, int] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Read a profile table.

    In parallel either by `partition_on` = (number or date column, lower, upper, connections), or by
    `predicates`, conditions that split the table (`split_by_text` makes them for a text key).
    """
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties))
    reader = spark.read.format("jdbc").options(**properties).option("url", url).option("dbtable", table)
    if partition_on:
        column, lower, upper, connections = partition_on
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", connections)
        )
    return reader.load()


def split_by_text(column: str, bounds: Sequence[str]) -> list[str]:
    """Conditions for the ranges between sorted text values; every row, null too, is in exactly one."""
    quoted = ["'" + b.replace("'", "''") + "'" for b in bounds]
    if not quoted:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(quoted, quoted[1:])]
    return [f"{column} < {quoted[0]} OR {column} IS NULL", *inner, f"{column} >= {quoted[-1]}"]
