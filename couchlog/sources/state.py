"""Daily partial aggregates, kept between runs: one Parquet folder per day, replaced as a whole.

A run takes in the days that are new or were delivered again, and folds the state of all days into the
profile; raw days that it already holds are not read. Which delivery a day's rows come from is a column of
those rows, so state and record are replaced together. A day is known by the sizes and times of its files
and by how it was read (fields and rules): other rules make every day new.

Days are overwritten one by one. A run that fails half way leaves whole days, of which some are new, and the
next run takes in the rest. A day that is delivered without a readable record keeps its old rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from couchlog.sources.days import DayFolder

DELIVERY = "delivery"


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(files.exists(path)) and bool(files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/Date=*")))


def read_state(spark: SparkSession, folder: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The kept rows, optionally of the days from start to end (both included): other days are not opened."""
    fields = [f if f.name != "Date" else T.StructField("Date", T.StringType()) for f in spark.read.parquet(folder).schema]
    rows = spark.read.schema(T.StructType(fields)).parquet(folder).drop(DELIVERY)
    if start is not None:
        rows = rows.filter(F.col("Date") >= start)
    return rows if end is None else rows.filter(F.col("Date") <= end)


def deliveries(spark: SparkSession, folder: str) -> dict[str, str]:
    """Day -> delivery of the kept days. One row per day reaches the driver."""
    if not _exists(spark, folder):
        return {}
    fields = T.StructType.fromDDL(f"{DELIVERY} string, Date string")
    rows = spark.read.schema(fields).parquet(folder).groupBy("Date").agg(F.min(DELIVERY).alias(DELIVERY))
    return {r["Date"]: r[DELIVERY] for r in rows.collect()}


def new_days(spark: SparkSession, logs: str, folder: str, entries: Iterable[str], suffix: str, reading: object) -> dict[str, str]:
    """Entry -> delivery of the days under `logs` that the state does not hold as they are now."""
    kept, days = deliveries(spark, folder), DayFolder(spark, logs)
    by_day: dict[str, list[str]] = {}
    for entry in entries:
        by_day.setdefault(entry.replace(suffix, "") if suffix else entry, []).append(entry)
    out = {}
    for day, names in by_day.items():
        found = repr([days.files(name) for name in sorted(names)]) + repr(reading)
        delivery = hashlib.sha256(found.encode()).hexdigest()[:32]
        if kept.get(day) != delivery:
            out |= dict.fromkeys(names, delivery)
    return out


def take_in(
    spark: SparkSession,
    logs: str,
    folder: str,
    entries: list[str],
    suffix: str,
    reading: object,
    daily: Callable[[list[str]], DataFrame],
) -> list[str]:
    """Replace the days that are new or delivered again by `daily` of their entries; returns those entries."""
    wanted = new_days(spark, logs, folder, entries, suffix, reading)
    if not wanted:
        return []
    named = {entry.replace(suffix, "") if suffix else entry: delivery for entry, delivery in wanted.items()}
    delivered = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    rows = daily(sorted(wanted)).withColumn(DELIVERY, delivered[F.col("Date")])
    # files of a day follow its size, however the aggregate was partitioned
    rows.hint("rebalance", "Date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("Date").parquet(folder)
    return sorted(wanted)
