"""The two raw logs, derived from the TPC-H-like test tables, and written in the raw layouts.

Every row of `events` is one view and every row of `lineitem` one search. Days are folded onto the
calendars below, so that the logs span as many days as the jobs expect.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from couchlog.sources import stage_root
from couchlog.sources.days import DayFolder

SEARCH_START, SEARCH_END = "20220601", "20220714"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(col: Column) -> Column:
    return F.replace(col.cast("date").cast("string"), F.lit("-"), F.lit(""))


def _view_columns() -> list[Column]:
    event, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    account = event % 4
    contract = (
        F.when((user % 50 == 1) & (account == 3), F.lit(None).cast("string"))
        .when(account == 0, user.cast("string"))
        .otherwise(F.concat_ws("-", user.cast("string"), account.cast("string")))
    )
    app = (
        F.when(kind == "view", "CHANNEL")
        .when(kind == "click", "RELAX")
        .when(kind == "signup", "CHILD")
        .when(kind == "purchase", F.when(event % 2 == 0, "VOD").otherwise("FIMS"))
        .when(kind == "error", F.when(event % 3 == 0, "KPLUS").when(event % 3 == 1, "SPORT").otherwise("BHD"))
    )
    return [contract.alias("Contract"), app.alias("AppName"), F.col("value").alias("TotalDuration")]


def view_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month of views: up to four contracts per user, each event on its own day."""
    return _table(spark, sf_dir, "events").select(*_view_columns(), _day(F.col("ts")).alias("Date"))


def view_log_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same views, folded onto the seven days from 2024-01-01."""
    weekday = F.concat(F.lit("2024010"), ((F.dayofmonth(F.col("ts").cast("date")) - 1) % 7 + 1).cast("string"))
    return _table(spark, sf_dir, "events").select(*_view_columns(), weekday.alias("Date"))


def view_log_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same views with durations that are finer than a thousandth."""
    fine = (F.col("TotalDuration").cast("decimal(18,2)") * F.expr("0.00037BD")).cast("double")
    return view_log(spark, sf_dir).withColumn("TotalDuration", fine)


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches on 28 days of the 44 from 2022-06-01 to 2022-07-14."""
    lines = (
        _table(spark, sf_dir, "lineitem")
        .join(_table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(_table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(_table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    user, word = F.col("o_custkey"), F.col("l_partkey") % 12
    keyword = (
        F.when(word == 0, "KÊNH VTV3")
        .when(word == 1, "Bóng Đá U23")
        .when(word == 2, "NARUTO tập 5")
        .when(word == 3, "phim season 2")
        .when(word == 4, F.lit(None).cast("string"))
        .when(word == 5, "ep.1")
        .otherwise(F.col("p_name"))
    )
    plan = F.concat_ws(":", "p_type", "p_brand")
    plans = (
        F.when(user % 4 == 1, F.array().cast("array<string>"))
        .when(user % 4 == 2, F.array(plan))
        .when(user % 4 == 3, F.array(F.lit(None).cast("string"), plan, F.col("p_brand")))
    )
    slot = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")) % 28
    offset = F.floor(slot * 11 / 7).cast("int")
    return lines.select(
        F.when((F.col("l_linenumber") == 4) & (F.col("l_orderkey") % 5 == 0), F.lit(None).cast("long"))
        .otherwise(F.col("l_orderkey") * 10 + F.col("l_linenumber"))
        .alias("eventID"),
        F.when(user % 50 == 0, "").when(user % 50 != 1, user.cast("string")).alias("user_id"),
        keyword.alias("keyword"),
        F.when(F.col("l_returnflag") == "A", "enter").when(F.col("l_returnflag") == "R", "quit").alias("category"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("platform"),
        F.when(F.col("n_name") != "NATION_0", F.col("n_name")).alias("proxy_isp"),
        plans.alias("userPlansMap"),
        _day(F.date_add(F.lit("2022-06-01").cast("date"), offset)).alias("Date"),
    )


SEARCH_FIELDS = (
    "eventID long, user_id string, keyword string, category string, "
    "platform string, proxy_isp string, userPlansMap array<string>"
)


def _name_days(spark: SparkSession, root: str, suffix: str) -> str:
    """Turn the `day=x` folders of a partitioned write into `x` plus suffix. Metadata only."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in DayFolder(spark, root).entries("day=*"):
        if not files.rename(path(f"{root}/{name}"), path(f"{root}/{name[len('day='):]}{suffix}")):
            raise OSError(f"cannot rename {root}/{name}")
    return root


def write_view_days(log: DataFrame, root: str) -> str:
    """One `yyyymmdd.json` entry per day, lines as envelopes."""
    spark = log.sparkSession
    source = F.struct("Contract", "AppName", "TotalDuration")
    line = F.to_json(F.struct(F.lit("history").alias("_index"), F.lit(0).alias("_score"), source.alias("_source")))
    log.select(line.alias("value"), F.col("Date").alias("day")).write.partitionBy("day").text(root)
    return _name_days(spark, root, ".json")


def write_broken_days(log: DataFrame, root: str) -> str:
    """As `write_view_days`, but purchases become broken lines between good ones, and sign-ups go
    to days of their own on which every line is broken."""
    spark = log.sparkSession
    source = F.to_json(F.struct("Contract", "AppName", "TotalDuration"))
    good = F.concat(F.lit('{"_source":'), source, F.lit("}"))
    broken = F.concat(F.lit('{"_source":'), source)
    line = F.when(F.col("AppName").isin("VOD", "FIMS", "CHILD"), broken).otherwise(good)
    day = F.when(F.col("AppName") == "CHILD", F.concat("Date", F.lit("_lost"))).otherwise(F.col("Date"))
    log.select(line.alias("value"), day.alias("day")).write.partitionBy("day").text(root)
    return _name_days(spark, root, ".json")


def write_rich_days(log: DataFrame, root: str) -> str:
    """As `write_view_days`, with a field that no schema declares: an object with the day's weekday and a list."""
    spark = log.sparkSession
    day = F.to_date("Date", "yyyyMMdd")
    device = F.struct(F.concat(F.lit("tv"), F.dayofweek(day).cast("string")).alias("model"), F.array(F.dayofmonth(day)).alias("codes"))
    source = F.struct("Contract", "AppName", "TotalDuration", device.alias("Device"))
    line = F.to_json(F.struct(F.lit("history").alias("_index"), source.alias("_source")))
    log.select(line.alias("value"), F.col("Date").alias("day")).write.partitionBy("day").text(root)
    return _name_days(spark, root, ".json")


def write_search_days(log: DataFrame, root: str, mode: str = "error") -> str:
    """One `yyyymmdd` Parquet folder per day."""
    log.withColumnRenamed("Date", "day").write.mode(mode).partitionBy("day").parquet(root)
    return _name_days(log.sparkSession, root, "")


def write_search_deliveries(log: DataFrame, root: str, **holds: Column) -> str:
    """As `write_search_days`, in one pass over the log: below `root` a folder for each of `holds` with the rows it is true of.

    The number of a day's files follows its size, not the number of tasks that make the log.
    """
    spark = log.sparkSession
    names = F.array_compact(F.array(*[F.when(held, F.lit(name)) for name, held in holds.items()]))
    rows = log.select("*", F.explode(names).alias("delivery")).withColumnRenamed("Date", "day")
    rows.hint("rebalance", "delivery", "day").write.partitionBy("delivery", "day").parquet(root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in DayFolder(spark, root).entries("delivery=*"):
        plain = f"{root}/{name[len('delivery='):]}"
        if not files.rename(path(f"{root}/{name}"), path(plain)):
            raise OSError(f"cannot rename {root}/{name}")
        _name_days(spark, plain, "")
    return root


def share_folder(spark: SparkSession) -> None:
    """Name a shared folder in a session of one machine that has none, for the life of the process."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        folder = tempfile.mkdtemp(prefix="couchlog-checks-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)


def raw_folder(spark: SparkSession, layout: str) -> str:
    """A new folder for a raw log, in the shared folder of the session."""
    share_folder(spark)
    return f"{stage_root(spark)}/{layout}"
