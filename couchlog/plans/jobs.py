"""The two batch jobs: raw days -> profile table -> optional database."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from couchlog.operators import (
    daily_searches,
    daily_totals,
    day_limit,
    profile_from_daily,
    search_profile,
    search_profile_from_daily,
    split_lost,
)
from couchlog.rules import SEARCHES, VIEWS, SearchRules, ViewRules
from couchlog.sources import (
    SEARCH_SCHEMA,
    VIEW_SCHEMA,
    NoDataError,
    days_read,
    json_days,
    parquet_days,
    read_daily_json,
    read_parquet_days,
    read_state,
    stage,
    staging,
    take_in,
    write_table,
)

Sink = Callable[[DataFrame], object]


def content_job(
    spark: SparkSession,
    logs: str,
    target: str,
    sink: Sink | None = None,
    fields: str = VIEW_SCHEMA,
    rules: ViewRules = VIEWS,
    limit: Column | int | None = None,
    on_days: Sink | None = None,
    on_lost: Sink | None = None,
) -> DataFrame:
    """Read all viewing days under `logs`, write the contract profiles to `target`, return them.

    The raw JSON is parsed once: the daily totals are staged, and the activity limit (it depends on
    the number of days read, unless it is given), the profile and the report of days are taken from
    them. They are deleted at the end, also if the job fails. `on_days` gets one row per day entry,
    (Date, read): a day without a readable record was not read. `on_lost` gets the lines that could not be
    read, counted in the same pass over the log: one row per day and file that has any (Date, file, lost).
    """
    log = read_daily_json(spark, logs, fields, lost=True)
    with staging(spark) as folder:
        daily, lost = split_lost(stage(daily_totals(log, rules, keep_invalid=True), f"{folder}/daily"))
        if on_lost is not None:
            on_lost(lost)
        if on_days is not None:
            on_days(days_read(spark, logs, daily))
        if daily.isEmpty():
            raise NoDataError(f"no readable day in {logs}")
        limit = day_limit(daily, rules) if limit is None else limit
        profile = write_table(profile_from_daily(daily, limit, rules), target)
    if sink is not None:
        sink(profile)
    return profile


def update_views(
    spark: SparkSession, logs: str, state: str, fields: str = VIEW_SCHEMA, rules: ViewRules = VIEWS
) -> list[str]:
    """Take the viewing days under `logs` that are new or delivered again into the kept state; returns their entries.

    Only those are read. A day that is no longer under `logs` stays.
    """
    entries = json_days(spark, logs)
    reading = (fields, {k: list(v) for k, v in rules.codes.items()}, rules.categories, rules.invalid_contract)
    totals = lambda days: daily_totals(read_daily_json(spark, logs, fields, days), rules, keep_invalid=True)
    return take_in(spark, logs, state, entries, ".json", reading, totals)


def content_job_kept(
    spark: SparkSession,
    logs: str,
    state: str,
    target: str,
    sink: Sink | None = None,
    fields: str = VIEW_SCHEMA,
    rules: ViewRules = VIEWS,
    limit: Column | int | None = None,
    start: str | None = None,
    end: str | None = None,
    on_days: Sink | None = None,
) -> DataFrame:
    """`content_job` over the kept daily state of `logs` and of earlier runs; start and end choose from its days.

    `on_days` gets one row per day of the state that is folded, as of `days_read`.
    """
    update_views(spark, logs, state, fields, rules)
    daily = read_state(spark, state, start, end)
    if on_days is not None:
        on_days(daily.select("Date").distinct().withColumn("read", F.lit(True)))
    if daily.isEmpty():
        raise NoDataError(f"no day from {start} to {end} in {state}")
    limit = day_limit(daily, rules) if limit is None else limit
    profile = write_table(profile_from_daily(daily, limit, rules), target)
    if sink is not None:
        sink(profile)
    return profile


def update_searches(
    spark: SparkSession, logs: str, start: str, end: str, state: str, fields: str | None = SEARCH_SCHEMA
) -> list[str]:
    """As `update_views`, for the search days from start to end. Counts do not depend on rules, so the state serves any."""
    entries = parquet_days(spark, logs, start, end)
    daily = lambda days: daily_searches(read_parquet_days(spark, logs, start, end, fields, days=days))
    return take_in(spark, logs, state, entries, "", fields, daily)


def search_job_kept(
    spark: SparkSession,
    logs: str,
    start: str,
    end: str,
    state: str,
    target: str,
    sink: Sink | None = None,
    fields: str | None = SEARCH_SCHEMA,
    rules: SearchRules = SEARCHES,
) -> DataFrame:
    """`search_job` over the kept daily state of `logs` and of earlier runs, of the days from start to end."""
    update_searches(spark, logs, start, end, state, fields)
    profile = write_table(search_profile_from_daily(read_state(spark, state, start, end), rules), target)
    if sink is not None:
        sink(profile)
    return profile


def search_job(
    spark: SparkSession,
    logs: str,
    start: str,
    end: str,
    target: str,
    sink: Sink | None = None,
    fields: str | None = SEARCH_SCHEMA,
    rules: SearchRules = SEARCHES,
    on_days: Sink | None = None,
) -> DataFrame:
    """Read the search days from start to end, write the user profiles to `target`, return them.

    `on_days` gets one row per day folder under `logs`, (Date, read): those out of the range, and
    those without a row, were not read.
    """
    log = read_parquet_days(spark, logs, start, end, fields)
    if on_days is not None:
        on_days(days_read(spark, logs, log))
    profile = write_table(search_profile(log, rules), target)
    if sink is not None:
        sink(profile)
    return profile


def preview(profile: DataFrame, rows: int = 5) -> DataFrame:
    """A few rows of a written profile."""
    return profile.limit(rows)
