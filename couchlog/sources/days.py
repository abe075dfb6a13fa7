"""Raw logs that lie in one folder, one entry (file or folder) per day."""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VIEW_SCHEMA = "Contract string, AppName string, TotalDuration double"
# Event ids are only ordered and counted, so they keep the type they are stored in; see `read_parquet_days`.
SEARCH_SCHEMA = (
    "eventID string, user_id string, keyword string, category string, "
    "platform string, proxy_isp string, userPlansMap array<string>"
)

EIGHT_DIGITS = "[0-9]" * 8


class NoDataError(ValueError):
    """There is no day to read; raised before anything is written."""


class DayFolder:
    """The log's root folder on whatever file system its scheme names."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.root = root.rstrip("/")
        path = self._path(self.root)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.uri_path = self._fs.makeQualified(path).toUri().getRawPath()

    def entries(self, pattern: str) -> list[str]:
        """Names directly under the root that match; one listing, no visit of the days."""
        found = self._fs.globStatus(self._path(f"{self.root}/{pattern}")) or []
        return sorted(status.getPath().getName() for status in found)

    def files(self, entry: str) -> list[tuple[str, int, int]]:
        """Name, size and time of the entry's file, or of the files in its folder."""
        found = self._fs.listStatus(self._path(f"{self.root}/{entry}"))
        return sorted((s.getPath().getName(), int(s.getLen()), int(s.getModificationTime())) for s in found)

    def day(self, entries: list[str], path: str = "_metadata.file_path") -> Column:
        """Name of the entry a row was read from, as plain text."""
        below = F.substring_index(F.col(path), f"{self.uri_path}/", -1)
        name = F.substring_index(below, "/", 1)
        if all(re.fullmatch(r"[\w.-]+", entry, re.ASCII) for entry in entries):
            return name
        return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def with_day(df: DataFrame, folder: DayFolder, entries: list[str], suffix: str = "") -> DataFrame:
    """Add `Date`, the day entry's name without the suffix, as text."""
    day = folder.day(entries)
    return df.withColumn("Date", F.replace(day, F.lit(suffix), F.lit("")) if suffix else day)


def flatten_envelope(envelopes: DataFrame) -> DataFrame:
    """The fields of `_source`; lines that could not be read or hold none are dropped."""
    kept = ["Date"] if "Date" in envelopes.columns else []
    return envelopes.filter(F.col("_source").isNotNull()).select("_source.*", *kept)


def _as_text(fields: T.StructType) -> T.StructType:
    """Numbers as text: a number in quotes is then one too."""
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NumericType) else f.dataType) for f in fields])


def json_days(spark: SparkSession, root: str) -> list[str]:
    """Names of the entries that `read_daily_json` reads."""
    entries = DayFolder(spark, root).entries(f"{EIGHT_DIGITS}*.json")
    if not entries:
        raise NoDataError(f"no day file {EIGHT_DIGITS}*.json in {root}")
    return entries


LOST = "lost_file"
_CORRUPT = "_corrupt_record"


def _json_lines(spark: SparkSession, root: str, wanted: T.StructType, days: list[str] | None, rest: str | None) -> DataFrame:
    """Every line of the days: _source, Date, the line itself if it is no JSON, file; and all of `_source` as VARIANT."""
    folder = DayFolder(spark, root)
    entries = json_days(spark, root)
    paths = f"{folder.root}/{EIGHT_DIGITS}*.json" if days is None else [f"{folder.root}/{day}" for day in days]
    envelope = T.StructType().add("_source", _as_text(wanted)).add(_CORRUPT, T.StringType())
    if rest is None:
        lines = spark.read.schema(envelope).option("columnNameOfCorruptRecord", _CORRUPT).json(paths)
    else:
        options = {"columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"}
        text = spark.read.text(paths).filter(F.trim("value") != "")
        both = text.select("*", F.from_json("value", envelope, options).alias("line"), "_metadata.file_path", "_metadata.file_name")
        whole = F.try_variant_get(F.try_parse_json("value"), "$._source", "variant")
        return both.select(
            "line._source", F.col(f"line.{_CORRUPT}").alias(_CORRUPT), F.when(F.col("line._source").isNotNull(), whole).alias(rest),
            F.replace(folder.day(entries, "file_path"), F.lit(".json"), F.lit("")).alias("Date"), "file_name",
        )
    return with_day(lines, folder, entries, ".json").select("_source", _CORRUPT, "Date", F.col("_metadata.file_name").alias("file_name"))


def read_daily_json(
    spark: SparkSession,
    root: str,
    fields: str = VIEW_SCHEMA,
    days: list[str] | None = None,
    lost: bool = False,
    rest: str | None = None,
) -> DataFrame:
    """All days `yyyymmdd*.json` of a folder in one scan, with their `Date`; or only the entries `days`.

    Fields are declared, so nothing is inferred and a field that a day lacks is null. A declared
    number may be written as text; what is no number is null. A day without a readable record gives
    no row, and so is not a day read; `days_read` names it.

    With `lost`, a line that is no JSON or has no `_source` is a row of nulls with the name of its file as
    `lost_file` (null in all other rows), so that lines can be counted in the same read. `rest` names a column for
    the whole of `_source` as VARIANT: fields that are not declared are read from it by `try_variant_get`.
    """
    wanted = T.StructType.fromDDL(fields)
    lines = _json_lines(spark, root, wanted, days, rest)
    extra = [rest] if rest else []
    if lost:
        gone = F.when(F.col("_source").isNull(), F.col("file_name")).alias(LOST)
        rows = lines.select("_source.*", *extra, "Date", gone)
    else:
        rows = lines.filter(F.col("_source").isNotNull()).select("_source.*", *extra, "Date")
    cast = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in wanted if isinstance(f.dataType, T.NumericType)}
    return rows.withColumns(cast) if cast else rows


def unreadable_lines(spark: SparkSession, root: str, fields: str = VIEW_SCHEMA) -> DataFrame:
    """Date, file and text of each line that is no JSON; text is null for JSON without `_source`. To be kept and repaired."""
    lines = _json_lines(spark, root, T.StructType.fromDDL(fields), None, None)
    return lines.filter(F.col("_source").isNull()).select("Date", F.col("file_name").alias("file"), F.col(_CORRUPT).alias("line"))


def lost_lines(spark: SparkSession, root: str, fields: str = VIEW_SCHEMA) -> DataFrame:
    """Lines and lost lines of each day and file: Date, file, lines, lost. Blank lines and empty lists (`[]`) hold nothing
    and are not counted; a list of objects counts as its objects."""
    lines = _json_lines(spark, root, T.StructType.fromDDL(fields), None, None)
    # the corrupt column has to be read, or else the reader parses no more than it needs
    gone = F.col("_source").isNull() | F.col(_CORRUPT).isNotNull()
    return lines.groupBy("Date", F.col("file_name").alias("file")).agg(F.count("*").alias("lines"), F.count_if(gone).alias("lost"))


def days_read(spark: SparkSession, root: str, log: DataFrame) -> DataFrame:
    """One row per day entry under `root`: Date, and whether the log (or its daily totals) has a row of it."""
    folder = DayFolder(spark, root)
    names = [name.replace(".json", "") for name in folder.entries(f"{EIGHT_DIGITS}*.json")] or folder.entries(EIGHT_DIGITS)
    entries = spark.createDataFrame([(name,) for name in dict.fromkeys(names)], "Date string")
    found = log.select("Date").distinct().withColumn("found", F.lit(True))
    return entries.join(found, "Date", "left").select("Date", F.coalesce("found", F.lit(False)).alias("read"))


def _calendar(start: str, end: str) -> set[str]:
    first, last = (datetime.strptime(text, "%Y%m%d") for text in (start, end))
    count = (last - first).days + 1
    return {(first + timedelta(days=n)).strftime("%Y%m%d") for n in range(count)}


def parquet_days(spark: SparkSession, root: str, start: str, end: str) -> list[str]:
    """Names of the day folders from start to end, both included."""
    wanted = _calendar(start, end)
    days = [name for name in DayFolder(spark, root).entries(EIGHT_DIGITS) if name in wanted]
    if not days:
        raise NoDataError(f"no day folder from {start} to {end} in {root}")
    return days


def read_parquet_days(
    spark: SparkSession,
    root: str,
    start: str,
    end: str,
    fields: str | None = SEARCH_SCHEMA,
    merge_schema: bool = False,
    days: list[str] | None = None,
) -> DataFrame:
    """The days from start to end (`yyyymmdd`, both included) in one scan, with their `Date`; of them only `days`, if given.

    Absent days are skipped; a day that is there but unreadable fails. Only the folders in the
    range are opened. Columns are matched by name to the declared fields. A column that is stored in
    another type is read in that and cast to the declared one; `eventID` keeps the stored type, so
    that numbers order by value and text as text. Days may differ in their types, the files of one day may
    not: one file of each day is asked, days of the same types are one scan, and ids of several types are
    widened as `_mixed_id` says. Pass None to take all columns from the files, with `merge_schema` where
    they were added over time.
    """
    folder = DayFolder(spark, root)
    days = parquet_days(spark, root, start, end) if days is None else days
    paths = [f"{folder.root}/{day}" for day in days]
    if not fields:
        return with_day(spark.read.option("mergeSchema", merge_schema).parquet(*paths), folder, days)
    declared = T.StructType.fromDDL(fields)
    groups = schema_groups(folder, days)
    ids = _id_types([stored for _, stored in groups]) if "eventID" in declared.names else []
    frames = [_read_group(folder, names, stored, declared, ids) for names, stored in groups]
    return reduce(DataFrame.unionByName, frames)


def schema_groups(folder: DayFolder, days: list[str]) -> list[tuple[list[str], dict[str, T.DataType]]]:
    """The days by the types of their columns: (days, type of each column), where columns may be absent in some days.

    One footer of each day is read, those of many days in one Spark job; only where types differ, the days
    are halved until each part agrees. Parts that agree are put together, so there is one scan per set of types.
    """

    def types(names: list[str]) -> list[tuple[list[str], dict[str, T.DataType]]]:
        paths = [f"{folder.root}/{name}/{file}" for name, file in samples.items() if name in set(names)]
        if not paths:
            return [(names, {})]
        try:
            merged = folder.spark.read.option("mergeSchema", True).parquet(*paths).schema
        except Exception as e:
            if len(names) == 1 or "MERGE" not in str(e).upper():
                raise
            half = len(names) // 2
            return types(names[:half]) + types(names[half:])
        return [(names, {f.name: f.dataType for f in merged})]

    samples = {}
    for day in days:
        data = [name for name, size, _ in folder.files(day) if size and not name.startswith(("_", "."))]
        samples |= {day: data[0]} if data else {}
    parts = types(days)
    out: list[tuple[list[str], dict[str, T.DataType]]] = []
    for names, stored in parts:
        same = next((k for k, (_, other) in enumerate(out) if all(other[c] == stored[c] for c in other.keys() & stored.keys())), None)
        if same is None:
            out.append((list(names), dict(stored)))
        else:
            out[same] = (out[same][0] + names, out[same][1] | stored)
    return out


def _id_types(groups: list[dict[str, T.DataType]]) -> list[T.DataType]:
    """The types that event ids are stored in."""
    return list(dict.fromkeys(g["eventID"] for g in groups if "eventID" in g))


def _read_group(folder: DayFolder, days: list[str], stored: dict[str, T.DataType], declared: T.StructType, ids: list[T.DataType]) -> DataFrame:
    """Days of one set of types in one scan, cast to the declared ones; event ids as `ids` of all days ask for."""
    read_as = T.StructType([T.StructField(f.name, stored.get(f.name, f.dataType)) for f in declared])
    rows = folder.spark.read.schema(read_as).parquet(*[f"{folder.root}/{day}" for day in days])
    cast = {}
    for f in declared:
        kind = stored.get(f.name, f.dataType)
        if f.name != "eventID":
            cast |= {} if kind == f.dataType else {f.name: F.col(f"`{f.name}`").cast(f.dataType)}
        elif len(ids) > 1:
            cast["eventID"] = _mixed_id(kind, ids)
        elif not ids:
            cast["eventID"] = F.col("eventID").cast(f.dataType)
        elif kind != ids[0]:  # absent in these days
            cast["eventID"] = F.lit(None).cast(ids[0])
    rows = with_day(rows, folder, days)
    return rows.withColumns(cast) if cast else rows


def _mixed_id(kind: T.DataType, ids: list[T.DataType]) -> Column:
    """An id where days store it in several types: whole numbers as decimal(38,0); with text as well, a pair of which
    one is null, so that numbers go by value and text as text (text first, if one day should have both)."""
    whole = (T.IntegralType, T.DecimalType)
    if all(isinstance(i, whole) and getattr(i, "scale", 0) == 0 for i in ids):
        return F.col("eventID").cast("decimal(38,0)")
    number = isinstance(kind, T.NumericType)
    pair = F.struct(
        (F.col("eventID").cast("decimal(38,6)") if number else F.lit(None).cast("decimal(38,6)")).alias("number"),
        (F.lit(None).cast("string") if number else F.col("eventID").cast("string")).alias("text"),
    )
    return F.when(F.col("eventID").isNotNull(), pair)
