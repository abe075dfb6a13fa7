"""Search log -> one profile row per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from couchlog.functions import activity_tier, by_regex, plan_name, ratio, top_label
from couchlog.rules import SEARCHES, SearchRules


def filter_users(search_log: DataFrame) -> DataFrame:
    """Drop rows without a user id (null or empty; blanks stay)."""
    return search_log.filter(F.col("user_id") != "")


def classify_keyword(search_log: DataFrame, rules: SearchRules = SEARCHES) -> DataFrame:
    """Add the content category of the keyword."""
    return search_log.withColumn("ContentType", by_regex(F.col("keyword"), rules.patterns, rules.default))


def _is(category: str) -> Column:
    return F.col("category") == category


def _entries() -> Column:
    """The non-null plan entries of an event; null where there is no list."""
    return F.filter("userPlansMap", lambda plan: plan.isNotNull())


def _numbers(search_log: DataFrame, rules: SearchRules) -> DataFrame:
    """The counting columns of the profile: all state is whole numbers, so both steps hash.

    Events are counted per user and keyword, and per user and day, in one pass; a second step folds
    those counts per user. Keywords are classified once per user and keyword.
    """
    counts = (
        search_log.groupingSets([["user_id", "keyword"], ["user_id", "Date"]], "user_id", "keyword", "Date")
        .agg(
            (F.grouping("keyword") == 0).alias("by_keyword"),
            F.count("*").alias("n"),
            F.count("eventID").alias("searches"),
            F.count_if(_is("enter")).alias("enters"),
            F.count_if(_is("quit")).alias("quits"),
            F.sum(F.coalesce(F.size(_entries()), F.lit(0)).cast("bigint")).alias("entries"),
        )
        .transform(classify_keyword, rules)
    )
    return _fold_numbers(counts, rules)


def _fold_numbers(counts: DataFrame, rules: SearchRules) -> DataFrame:
    """Per user, from counts by keyword (`by_keyword`, ContentType) and counts by day."""
    by_keyword = F.col("by_keyword")

    def per_day(name: str) -> Column:
        return F.sum(F.when(by_keyword, 0).otherwise(F.col(name)))

    def interest(category: str) -> Column:
        return F.sum(F.when(by_keyword & (F.col("ContentType") == category), F.col("n")).otherwise(0))

    return counts.groupBy("user_id").agg(
        per_day("searches").alias("SearchCount"),
        F.count("keyword").alias("UniqueKeyword"),
        F.count("Date").alias("SearchDays"),
        per_day("enters").alias("SearchEnter"),
        per_day("quits").alias("SearchQuit"),
        per_day("entries").alias("PlanCount"),
        *[interest(c).alias(f"Interest_{c}") for c in rules.categories],
    )


def search_behavior(search_log: DataFrame, rules: SearchRules = SEARCHES) -> DataFrame:
    """Search counts, distinct keywords and days, enters, quits and quit rate per user."""
    return _numbers(search_log, rules).select(
        "user_id",
        "SearchCount",
        "UniqueKeyword",
        "SearchDays",
        "SearchEnter",
        "SearchQuit",
        ratio(F.col("SearchQuit"), F.col("SearchCount"), 4).alias("QuitRate"),
    )


def interests(search_log: DataFrame, rules: SearchRules = SEARCHES) -> DataFrame:
    """Searches per user and content category."""
    return _numbers(search_log, rules).select("user_id", *[f"Interest_{c}" for c in rules.categories])


def top_interest(counts: DataFrame, rules: SearchRules = SEARCHES) -> DataFrame:
    """Favourite category of each user, from the `Interest_*` columns."""
    cols = [F.col(f"Interest_{c}") for c in rules.categories]
    return counts.withColumn("TopInterest", top_label(cols, rules.categories))


def _favourite(value: str) -> Column:
    """Most frequent of the counted values; on a tie the smallest."""
    counted = F.struct(-F.col("n"), F.col(value).alias("value"))
    return F.min(F.when(F.col(value).isNotNull(), counted))["value"]


def main_value(df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """Most frequent non-null value per key; on a tie the smallest one.

    Values are counted first, so that no task holds all values of a key however many there are.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(_favourite(value).alias(alias))


def explode_plans(search_log: DataFrame) -> DataFrame:
    """One row per plan entry with the plan's name; one null row where there is no entry."""
    return search_log.select("user_id", F.explode_outer("userPlansMap").alias("plan_raw")).withColumn(
        "plan_name", plan_name(F.col("plan_raw"))
    )


def _plans(search_log: DataFrame) -> DataFrame:
    """First plan of each user that holds one: of the earliest day; within the day of the lowest event
    id (missing ids last; numbers by value, text as text); then the smallest name.

    Only events with a plan take part; an event's plan is its first non-null entry.
    """
    held = search_log.withColumn("plan", plan_name(F.get(_entries(), F.lit(0)))).filter("plan IS NOT NULL")
    seen = held.groupBy("user_id", "Date", "plan").agg(F.min("eventID").alias("event"))
    order = F.struct("Date", F.col("event").isNull().alias("no_event"), "event", "plan")
    return seen.groupBy("user_id").agg(F.min(order)["plan"].alias("PlanName"))


def plan_summary(search_log: DataFrame, rules: SearchRules = SEARCHES) -> DataFrame:
    """First plan name (see `_plans`), number of plan entries over all events, and whether there is any."""
    entries = F.sum(F.coalesce(F.size(_entries()), F.lit(0)).cast("bigint"))
    counts = search_log.groupBy("user_id").agg(entries.alias("PlanCount"))
    named = counts.join(_plans(search_log), "user_id", "left").select("user_id", "PlanName", "PlanCount")
    return named.withColumn("HasPlan", F.col("PlanCount") > 0)


def search_activity(search_log: DataFrame, limit: int | None = None, rules: SearchRules = SEARCHES) -> DataFrame:
    """Distinct search days per user and the activity level."""
    limit = rules.day_limit if limit is None else limit
    days = search_log.select("user_id", "Date").distinct().groupBy("user_id").agg(F.count("Date").alias("SearchDays"))
    return days.withColumn("SearchActive", activity_tier(F.col("SearchDays"), limit, inclusive=True))


def _favourites(search_log: DataFrame) -> DataFrame:
    """Favourite platform and provider. The raw rows are only counted, which hashes; text is compared
    among the counts."""
    counts = search_log.groupingSets(
        [["user_id", "platform"], ["user_id", "proxy_isp"]], "user_id", "platform", "proxy_isp"
    ).agg(F.count("*").alias("n"))
    return counts.groupBy("user_id").agg(_favourite("platform").alias("platform"), _favourite("proxy_isp").alias("isp"))


def search_profile(search_log: DataFrame, rules: SearchRules = SEARCHES) -> DataFrame:
    """One profile row per user.

    Three aggregates over disjoint columns (numbers, favourites, plans), joined one to one on the
    partitioning they already have. Each counts first and folds the counts per user in a second step.
    All state is of fixed size and both steps combine on the map side, so a hot user or value does
    not end up in one task. Text stays out of the counting step, because it cannot be updated in a
    hash aggregate's buffer: only events that hold a plan are sorted, and only if their id is text.
    """
    log = filter_users(search_log)
    return _profile(_numbers(log, rules), _favourites(log), _plans(log), rules)


def _profile(numbers: DataFrame, favourites: DataFrame, plans: DataFrame, rules: SearchRules) -> DataFrame:
    users = numbers.join(favourites, "user_id", "left").join(plans, "user_id", "left")
    # Names and order of the profile's columns.
    return top_interest(users, rules).select(
        "user_id",
        "SearchCount",
        "UniqueKeyword",
        "SearchDays",
        "SearchEnter",
        "SearchQuit",
        ratio(F.col("SearchQuit"), F.col("SearchCount"), 4).alias("QuitRate"),
        *[f"Interest_{c}" for c in rules.categories],
        "TopInterest",
        F.coalesce("platform", F.lit(rules.unknown)).alias("MainPlatform"),
        F.coalesce("isp", F.lit(rules.unknown)).alias("MainISP"),
        F.coalesce("PlanName", F.lit(rules.no_plan)).alias("PlanName"),
        "PlanCount",
        (F.col("PlanCount") > 0).alias("HasPlan"),
        activity_tier(F.col("SearchDays"), rules.day_limit, inclusive=True).alias("SearchActive"),
    )


# Kinds of the rows of the daily state.
_KEYWORD, _PLATFORM, _ISP, _PLAN = "keyword", "platform", "isp", "plan"
_COUNTS = ["n", "searches", "enters", "quits", "entries"]


def daily_searches(search_log: DataFrame) -> DataFrame:
    """The state that search profiles are made of, by user and day: counts of each keyword, platform and provider, and
    the day's first plan (see `_plans`). Counts may be added up further; no event id is needed any more, since
    ids only order the plans of one day.

    What is counted is made a number before the rows are multiplied by the kinds of value.
    """
    log = filter_users(search_log)
    events = log.select(
        "user_id",
        "Date",
        "keyword",
        "platform",
        "proxy_isp",
        F.col("eventID").isNotNull().alias("searched"),
        _is("enter").alias("entered"),
        _is("quit").alias("quitted"),
        F.coalesce(F.size(_entries()), F.lit(0)).alias("held"),
    )
    sets = [["user_id", "Date", name] for name in ("keyword", "platform", "proxy_isp")]
    counts = events.groupingSets(sets, "user_id", "Date", "keyword", "platform", "proxy_isp").agg(
        F.when(F.grouping("keyword") == 0, _KEYWORD).when(F.grouping("platform") == 0, _PLATFORM).otherwise(_ISP).alias("kind"),
        F.count("*").alias("n"),
        F.count_if("searched").alias("searches"),
        F.count_if("entered").alias("enters"),
        F.count_if("quitted").alias("quits"),
        F.sum("held").alias("entries"),
    )
    counted = counts.select("user_id", "Date", "kind", F.coalesce("keyword", "platform", "proxy_isp").alias("value"), *_COUNTS)
    held = log.withColumn("plan", plan_name(F.get(_entries(), F.lit(0)))).filter("plan IS NOT NULL")
    seen = held.groupBy("user_id", "Date", "plan").agg(F.min("eventID").alias("event"))
    first = seen.groupBy("user_id", "Date").agg(F.min(F.struct(F.col("event").isNull().alias("no_event"), "event", "plan"))["plan"].alias("value"))
    nothing = [F.lit(0).cast("bigint").alias(c) for c in _COUNTS]
    return counted.unionByName(first.select("user_id", "Date", F.lit(_PLAN).alias("kind"), "value", *nothing))


def search_profile_from_daily(daily: DataFrame, rules: SearchRules = SEARCHES) -> DataFrame:
    """`search_profile`, from the rows of `daily_searches` of any number of days.

    Keywords and days are two aggregates, each of the columns that `_fold_numbers` takes from it.
    """
    keywords = daily.filter(F.col("kind") == _KEYWORD).withColumnRenamed("value", "keyword")
    by_keyword = keywords.groupBy("user_id", "keyword").agg(F.lit(True).alias("by_keyword"), F.sum("n").alias("n"))
    by_day = keywords.groupBy("user_id", "Date").agg(F.lit(False).alias("by_keyword"), *[F.sum(c).alias(c) for c in _COUNTS[1:]])
    counts = by_keyword.unionByName(by_day, allowMissingColumns=True)
    found = daily.filter(F.col("kind").isin(_PLATFORM, _ISP) & F.col("value").isNotNull())
    found = found.groupBy("user_id", "kind", "value").agg(F.sum("n").alias("n"))
    best = lambda kind: F.min(F.when(F.col("kind") == kind, F.struct(-F.col("n"), "value")))["value"]
    favourites = found.groupBy("user_id").agg(best(_PLATFORM).alias("platform"), best(_ISP).alias("isp"))
    plans = daily.filter(F.col("kind") == _PLAN).groupBy("user_id").agg(F.min(F.struct("Date", "value"))["value"].alias("PlanName"))
    return _profile(_fold_numbers(classify_keyword(counts, rules), rules), favourites, plans, rules)
