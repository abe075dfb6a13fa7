"""Viewing log -> one profile row per contract.

Aggregates run in two steps, (contract, day) and then contract. Both steps combine on the map side and
keep a fixed-size state, so a contract that holds a large part of the log costs one row per map task and
day, and distinct days are a plain row count in the second step.

Durations are added up as whole numbers (see `couchlog.functions.exact`). The few that are no whole
thousandths are rows of their own in the daily state, with a `bin` that names category and place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from couchlog.functions import Amount, activity_tier, amount, by_value, checked_sum, combo_label, odd_total, top_label, total
from couchlog.rules import VIEWS, ViewRules
from couchlog.sources.days import LOST
from couchlog.sources.tables import stage

_LIMB = "limb"
_BIN = "bin"
_PLACES = 1000  # bins of one category; a double has fewer places of nine digits, and so has a decimal


def classify_app(view_log: DataFrame, rules: ViewRules = VIEWS, name: str = "Type") -> DataFrame:
    """Add the category of the app code; unlisted codes and null become the unknown one."""
    return view_log.withColumn(name, by_value(F.col("AppName"), rules.codes, rules.unknown_app))


def _valid(rules: ViewRules) -> Column:
    """Real contract and known app code, as predicates that a Parquet scan can take over."""
    listed = [code for values in rules.codes.values() for code in values]
    return (F.col("Contract") != rules.invalid_contract) & F.col("AppName").isin(listed)


def filter_contract(view_log: DataFrame, rules: ViewRules = VIEWS) -> DataFrame:
    """Drop the invalid contract and null, and rows whose app code is in no category."""
    return view_log.filter(_valid(rules))


def _category(rules: ViewRules) -> Column:
    """Number of the row's category, null if it has none."""
    return F.coalesce(*[F.when(F.col("AppName").isin(list(rules.codes[c])), k) for k, c in enumerate(rules.categories)])


def _taken_apart(view_log: DataFrame, rules: ViewRules, keep_invalid: bool = False) -> tuple[DataFrame, Amount]:
    """Contract (null where the row does not count), Date, category `k`, duration as `value`; and its parts."""
    parts = amount(view_log, "TotalDuration")
    rows = view_log if keep_invalid else filter_contract(view_log, rules)
    contract = F.when(_valid(rules), F.col("Contract")) if keep_invalid else F.col("Contract")
    kept = [LOST] if LOST in view_log.columns else []
    return rows.select(contract.alias("Contract"), "Date", _category(rules).alias("k"), F.expr(parts.value).alias("value"), *kept), parts


def _unit_sums(rules: ViewRules, units: str, condition: str = "true") -> list[Column]:
    return [checked_sum(f"CASE WHEN {condition} AND k = {k} THEN {units} END").alias(c) for k, c in enumerate(rules.categories)]


def _limb_sums(limbs: list[str], condition: str = "true") -> list[Column]:
    return [checked_sum(f"CASE WHEN {condition} THEN {limb} END").alias(f"{_LIMB}{i}") for i, limb in enumerate(limbs)]


def _place(parts: Amount) -> str:
    return f"k * {_PLACES} + {parts.bin} + {_PLACES // 2}"


def daily_totals(view_log: DataFrame, rules: ViewRules = VIEWS, keep_invalid: bool = False) -> DataFrame:
    """The state that profiles are made of: one row per contract and day with the thousandths of each category.

    Durations that are no whole thousandths add one row per contract, day and `bin`, with their limbs. All
    amounts are bigints that may be added up further, see `merged_daily`. `keep_invalid` adds one row without a
    contract for each day with rows that do not count, which `days_covered` needs. Rows of lost lines (see
    `read_daily_json`) are counted per day and file, as `lost`, in rows that `split_lost` takes out.
    """
    rows, parts = _taken_apart(view_log, rules, keep_invalid)
    lost = LOST in view_log.columns
    # an odd row counts twice: for its day, and for its bin
    usual = "CAST(NULL AS int)"
    bins = F.expr(f"explode(CASE WHEN k IS NOT NULL AND {parts.odd} THEN array({usual}, {_place(parts)}) ELSE array({usual}) END)")
    return (
        rows.select("*", bins.alias(_BIN))
        .groupBy("Contract", "Date", _BIN, *([LOST] if lost else []))
        .agg(
            *_unit_sums(rules, parts.units, f"{_BIN} IS NULL"),
            *_limb_sums(parts.limbs, f"{_BIN} IS NOT NULL"),
            *([F.count(LOST).alias("lost")] if lost else []),
        )
    )


def split_lost(daily: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Daily totals that were made with lost lines: without them, and the lost lines per Date and file."""
    own = daily.filter(F.col(LOST).isNull()).drop(LOST, "lost")
    return own, daily.filter(F.col(LOST).isNotNull()).select("Date", F.col(LOST).alias("file"), "lost")


def merged_daily(daily: DataFrame, *keys: str) -> DataFrame:
    """Daily totals added up further, for example without the day, or over states that were kept apart."""
    amounts = [c for c in daily.columns if c not in ("Contract", "Date", _BIN)]
    return daily.groupBy(*keys, _BIN).agg(*[checked_sum(f"`{c}`").alias(c) for c in amounts])


def _with_totals(sums: DataFrame, bins: DataFrame, rules: ViewRules) -> DataFrame:
    """Total columns from the thousandths of each category and the odd rest: per contract as many entries as it has bins.

    There is no rest in most logs; AQE then drops the join.
    """
    limbs = [c for c in bins.columns if c.startswith(_LIMB)]
    entry = F.struct(F.col(_BIN).alias("place"), F.array(*limbs).alias("limbs"))
    both = sums.join(bins.groupBy("Contract").agg(F.collect_list(entry).alias("odd")), "Contract", "left")
    own = f"filter(odd, e -> floor(e.place / {_PLACES}) = c.k)"
    entries = f"transform({own}, e -> named_struct('bin', e.place % {_PLACES} - {_PLACES // 2}, 'limbs', e.limbs))"
    every = ", ".join(f"named_struct('k', {k}, 'units', `{c}`)" for k, c in enumerate(rules.categories))
    exact = both.withColumn("exact", F.expr(f"CASE WHEN odd IS NOT NULL THEN transform(array({every}), c -> {odd_total('c.units', entries)}) END"))
    kept = [c for c in sums.columns if c not in rules.categories]
    totals = [F.expr(f"coalesce(get(exact, {k}), {total(f'`{c}`')})").alias(f"Total_{c}") for k, c in enumerate(rules.categories)]
    return exact.select(*kept, *totals)


def _contract_totals(daily: DataFrame, rules: ViewRules) -> DataFrame:
    """Totals and days per contract, from the rows of `daily_totals`."""
    held = daily.filter("Contract IS NOT NULL")
    sums = [checked_sum(f"`{c}`").alias(c) for c in rules.categories]
    usual = held.filter(f"{_BIN} IS NULL").groupBy("Contract").agg(*sums, F.count("Date").alias("DayCount"))
    limbs = [c for c in daily.columns if c.startswith(_LIMB)]
    bins = held.filter(f"{_BIN} IS NOT NULL").groupBy("Contract", _BIN).agg(*[checked_sum(c).alias(c) for c in limbs])
    return _with_totals(usual, bins, rules)


def _log_totals(view_log: DataFrame, rules: ViewRules, days: bool) -> DataFrame:
    """As `_contract_totals`, straight from a log: the odd rest is a second look at the log, for rows that have one."""
    rows, parts = _taken_apart(view_log, rules)
    columns = _unit_sums(rules, parts.units)
    if days:
        daily = rows.groupBy("Contract", "Date").agg(*columns)
        sums = daily.groupBy("Contract").agg(*[checked_sum(f"`{c}`").alias(c) for c in rules.categories], F.count("Date").alias("DayCount"))
    else:
        sums = rows.groupBy("Contract").agg(*columns)
    odd = rows.filter(parts.odd).groupBy("Contract", F.expr(_place(parts)).alias(_BIN)).agg(*_limb_sums(parts.limbs))
    return _with_totals(sums, odd, rules)


def watch_totals(view_log: DataFrame, rules: ViewRules = VIEWS) -> DataFrame:
    """Seconds per contract and category, categories without views 0."""
    return _log_totals(view_log, rules, days=False)


def _totals(rules: ViewRules) -> list[Column]:
    return [F.col(f"Total_{c}") for c in rules.categories]


def most_watch(totals: DataFrame, rules: ViewRules = VIEWS) -> DataFrame:
    """Favourite category of each contract."""
    return totals.withColumn("MostWatch", top_label(_totals(rules), rules.categories))


def taste(totals: DataFrame, rules: ViewRules = VIEWS) -> DataFrame:
    """All categories a contract has watched, as one label."""
    return totals.withColumn("Taste", combo_label(_totals(rules), rules.labels, rules.no_taste))


def days_covered(view_log: DataFrame) -> DataFrame:
    """One row: number of days read, before any filter. Files with the same day name are one day."""
    return view_log.agg(F.count_distinct("Date").alias("days"))


def day_limit(log_or_daily: DataFrame, rules: ViewRules = VIEWS) -> Column:
    """Activity limit for the number of days read, as a scalar subquery."""
    limit = F.when(F.col("days") <= rules.week_days, rules.week_limit).otherwise(rules.month_limit)
    return days_covered(log_or_daily).select(limit.alias("day_limit")).scalar()


def content_activity(view_log: DataFrame, limit: Column | int | None = None, rules: ViewRules = VIEWS) -> DataFrame:
    """Distinct viewing days per contract and the activity level.

    Without a limit, the week's for up to a week of log and the month's beyond, see `content_profile`.
    """
    limit = day_limit(view_log, rules) if limit is None else limit
    days = filter_contract(view_log, rules).select("Contract", "Date").distinct()
    counts = days.groupBy("Contract").agg(F.count("Date").alias("DayCount"))
    return counts.withColumn("Active", activity_tier(F.col("DayCount"), limit, inclusive=False))


def profile_from_daily(daily: DataFrame, limit: Column | int, rules: ViewRules = VIEWS) -> DataFrame:
    """The profile columns, from the rows of `daily_totals`."""
    return _profile(_contract_totals(daily, rules), limit, rules)


def _profile(totals: DataFrame, limit: Column | int, rules: ViewRules) -> DataFrame:
    # Names and order of the profile's columns.
    return totals.select(
        "Contract",
        *_totals(rules),
        top_label(_totals(rules), rules.categories).alias("MostWatch"),
        combo_label(_totals(rules), rules.labels, rules.no_taste).alias("Taste"),
        activity_tier(F.col("DayCount"), limit, inclusive=False).alias("Active"),
    )


def content_profile(
    view_log: DataFrame, limit: Column | int | None = None, rules: ViewRules = VIEWS, folder: str | None = None
) -> DataFrame:
    """One profile row per contract.

    Without a limit, it follows from the number of days in the log, a subquery that reads the log's `Date` alone.
    Where one more look at the log is dear (JSON, or many rows with odd durations), pass a `folder` of the
    caller's (`couchlog.sources.staging` deletes its own): the daily totals are written there at once, and limit
    and profile come from them. `couchlog.plans.content_job` does so.
    """
    if folder is not None:
        daily = stage(daily_totals(view_log, rules, keep_invalid=True), folder)
        return profile_from_daily(daily, day_limit(daily, rules) if limit is None else limit, rules)
    limit = day_limit(view_log, rules) if limit is None else limit
    return _profile(_log_totals(view_log, rules, days=True), limit, rules)
