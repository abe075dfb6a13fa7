"""Reports over the two profile tables.

Each takes a profile DataFrame and returns a DataFrame. Orders end in a unique column, so that a
limit cuts the same rows each time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from couchlog.functions import exact_avg, exact_sum, half_up, share_percent
from couchlog.rules import ACTIVE_LABELS, PLAN_LABELS, SEARCHES, VIEWS, SearchRules, ViewRules


def distribution(
    profile: DataFrame,
    column: str,
    alias: str,
    exclude: str | None = None,
    k: int | None = None,
) -> DataFrame:
    """Customers per value, most frequent first; optionally without a stand-in, optionally top k."""
    rows = profile if exclude is None else profile.filter(F.col(column) != exclude)
    counts = (
        rows.groupBy(F.col(column).alias(alias))
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), F.col(alias))
    )
    return counts if k is None else counts.limit(k)


def ranked(rows: DataFrame, order: Sequence[Column], k: int, podium: int = 3) -> DataFrame:
    """The first k rows with rank 1..k and a mark for the first three. The single window partition
    holds those k rows."""
    top = rows.orderBy(*order).limit(k)
    rank = F.row_number().over(Window.orderBy(*order)).cast("long")
    return top.withColumn("rank", rank).withColumn("is_top3", F.col("rank") <= podium)


def _tier(column: str, value: str) -> Column:
    return F.count_if(F.col(column) == value)


# --- viewing -------------------------------------------------------------------------------------


# The names of report columns below are those that the dashboard reads.
def _watch_hours(rules: ViewRules) -> dict[str, Column]:
    return {f"{name}_h": half_up(exact_sum(F.col(f"Total_{c}")) / 3600, 1) for c, name in zip(rules.categories, rules.names)}


def _named(columns: dict[str, Column]) -> list[Column]:
    return [col.alias(name) for name, col in columns.items()]


def _content_kpi(rules: ViewRules) -> dict[str, Column]:
    return {
        "total_contracts": F.count("*"),
        **{f"avg_{name}": exact_avg(F.col(f"Total_{c}"), 0) for c, name in zip(rules.categories, rules.names)},
        "high_active": _tier("Active", "High"),
        "low_active": _tier("Active", "Low"),
    }


def content_kpi(profile: DataFrame, rules: ViewRules = VIEWS) -> DataFrame:
    """Contracts, average seconds per category, activity levels."""
    return profile.agg(*_named(_content_kpi(rules)))


def watch_hours(profile: DataFrame, rules: ViewRules = VIEWS) -> DataFrame:
    """Hours per category over all contracts."""
    return profile.agg(*_named(_watch_hours(rules)))


def top_contracts(profile: DataFrame, k: int = 20, rules: ViewRules = VIEWS) -> DataFrame:
    """Contracts with the most hours, by the rounded figure."""
    first, *rest = [F.col(f"Total_{c}") for c in rules.categories]
    seconds = sum(rest, first)
    return (
        profile.select(
            F.col("Contract").alias("contract"),
            half_up(seconds / 3600, 1).alias("total_hours"),
            F.col("MostWatch").alias("mostWatch"),
            F.col("Active").alias("active"),
            F.col("Taste").alias("taste"),
        )
        .orderBy(F.col("total_hours").desc(), F.col("contract"))
        .limit(k)
    )


def most_watch_labels(profile: DataFrame) -> DataFrame:
    """Favourite categories with their chart label (first underscore as a blank)."""
    counts = distribution(profile, "MostWatch", "mostWatch")
    return counts.withColumn("label", F.regexp_replace("mostWatch", "^([^_]*)_", "$1 "))


def content_reports(profile: DataFrame, rules: ViewRules = VIEWS) -> dict[str, DataFrame]:
    """All viewing reports. Pass a written profile; each report reads only its columns. See also `content_bundle`."""
    return {
        "kpi": content_kpi(profile, rules),
        "mostWatch": distribution(profile, "MostWatch", "mostWatch"),
        "duration": watch_hours(profile, rules),
        "taste": distribution(profile, "Taste", "taste", k=10),
        "topContracts": top_contracts(profile, rules=rules),
    }


# --- search --------------------------------------------------------------------------------------

def _interest_sums(rules: SearchRules) -> dict[str, Column]:
    return {name: F.sum(f"Interest_{c}") for c, name in zip(rules.categories, rules.names)}


# The names of report columns here and below are those that the dashboard reads.
def _search_kpi() -> dict[str, Column]:
    return {
        "total_users": F.count("*"),
        "avg_search_count": exact_avg(F.col("SearchCount"), 1),
        "avg_unique_kw": exact_avg(F.col("UniqueKeyword"), 1),
        "avg_quit_rate": exact_avg(F.col("QuitRate"), 4),
        "high_active": _tier("SearchActive", "High"),
        "low_active": _tier("SearchActive", "Low"),
        "has_plan": F.count_if("HasPlan"),
        "no_plan": F.count_if(~F.col("HasPlan")),
    }


def search_kpi(profile: DataFrame) -> DataFrame:
    """Users, average searches, keywords and quit rate, activity levels, plan holders."""
    return profile.agg(*_named(_search_kpi()))


def interest_sum(profile: DataFrame, rules: SearchRules = SEARCHES) -> DataFrame:
    """Searches per category over all users."""
    return profile.agg(*_named(_interest_sums(rules)))


def top_users(profile: DataFrame, k: int = 20, flag: bool = False, rules: SearchRules = SEARCHES) -> DataFrame:
    """Users with the most searches; optionally with the mark for a high quit percentage."""
    top = (
        profile.select(
            "user_id",
            "SearchCount",
            "UniqueKeyword",
            "SearchDays",
            half_up(F.col("QuitRate").cast("decimal(10,4)") * 100, 1).alias("quit_pct"),
            "TopInterest",
            "MainPlatform",
            "SearchActive",
        )
        .orderBy(F.col("SearchCount").desc(), F.col("user_id"))
        .limit(k)
    )
    return top.withColumn("high_quit", F.col("quit_pct") > rules.high_quit_pct) if flag else top


def search_reports(profile: DataFrame, rules: SearchRules = SEARCHES) -> dict[str, DataFrame]:
    """All search reports. Pass a written profile; each report reads only its columns. See also `search_bundle`."""
    return {
        "kpi": search_kpi(profile),
        "topInterest": distribution(profile, "TopInterest", "topInterest"),
        "interestSum": interest_sum(profile, rules),
        "platform": distribution(profile, "MainPlatform", "mainPlatform", rules.unknown, 10),
        "isp": distribution(profile, "MainISP", "mainISP", rules.unknown, 10),
        "topUsers": top_users(profile, rules=rules),
        "plan": distribution(profile, "PlanName", "planName", rules.no_plan, 10),
    }


# --- all reports of a profile in one table --------------------------------------------------------


def _summary(
    profile: DataFrame,
    figures: dict[str, dict[str, Column]],
    charts: dict[str, tuple[str, str | None, int]],
) -> DataFrame:
    """Figures over all rows and the most frequent labels of some columns, from one read of the profile.

    `charts` names a column, a label that is left out, and how many labels are kept. All are grouping sets of one
    aggregate. Each chart is ranked on its own; only its first k rows per task take part in that.
    """
    columns = [column for column, _, _ in charts.values()]
    named = {f"{report}.{name}": col for report, cells in figures.items() for name, col in cells.items()}
    number = F.grouping_id(*columns)  # all ones: over all rows; else the bit of its column is 0
    full = (1 << len(columns)) - 1
    rows = profile.groupingSets([[], *[[c] for c in columns]], *columns).agg(
        number.alias("set"), F.count("*").alias("n"), *[col.cast("double").alias(name) for name, col in named.items()]
    )
    chart, label, keep, dropped = (F.lit(None).cast(kind) for kind in ("string", "string", "int", "boolean"))
    for k, (name, (column, without, most)) in enumerate(charts.items()):
        here = F.col("set") == full - (1 << (len(columns) - 1 - k))
        chart = F.when(here, F.lit(name)).otherwise(chart)
        label = F.when(here, F.col(column)).otherwise(label)
        keep = F.when(here, F.lit(most)).otherwise(keep)
        dropped = F.when(here, F.lit(False) if without is None else F.col(column) == without).otherwise(dropped)
    marked = rows.select("set", "n", *[f"`{name}`" for name in named], chart.alias("report"), label.alias("label"), keep.alias("keep"), dropped.alias("dropped"))
    most = max(k for _, _, k in charts.values())
    order = Window.partitionBy("set").orderBy(F.col("n").desc(), F.col("label"))
    kept = marked.filter(F.coalesce(~F.col("dropped"), F.lit(True))).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    nothing = F.lit(None).cast("string")
    cell = lambda report, rank, label, metric, value: F.struct(
        report.alias("report"), rank.cast("bigint").alias("rank"), label.alias("label"), metric.alias("metric"), value.cast("double").alias("value"), nothing.alias("text")
    )
    figures_of = F.array(*[cell(F.lit(n.split(".")[0]), F.lit(1), nothing, F.lit(n.split(".")[1]), F.col(f"`{n}`")) for n in named])
    label_of = F.array(cell(F.col("report"), F.col("rank"), F.col("label"), F.lit("count"), F.col("n")))
    wanted = kept.filter(F.col("report").isNull() | (F.col("rank") <= F.col("keep")))
    return wanted.select(F.inline(F.when(F.col("report").isNull(), figures_of).otherwise(label_of)))


def _top_cells(top: DataFrame, report: str, order: Sequence[Column]) -> DataFrame:
    """The rows of a top-k table as cells: its first column is the label, numbers are values, all else text."""
    label, *rest = top.columns
    ranks = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    cells = []
    for c in rest:
        numeric = isinstance(top.schema[c].dataType, T.NumericType)
        value = F.col(c).cast("double") if numeric else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if numeric else F.col(c).cast("string")
        cells.append(F.struct(F.lit(report).alias("report"), "rank", F.col(label).alias("label"), F.lit(c).alias("metric"), value.alias("value"), text.alias("text")))
    return ranks.select(F.inline(F.array(*cells)))


def content_bundle(profile: DataFrame, rules: ViewRules = VIEWS) -> DataFrame:
    """All viewing reports as cells: report, rank, label, metric, value, text.

    Figures and charts share one read of the profile; the top contracts are another, of which each task
    keeps 20 rows (in the first, all contracts would have to go through the shuffle).
    """
    charts = {"mostWatch": ("MostWatch", None, len(rules.categories)), "taste": ("Taste", None, 10)}
    summary = _summary(profile, {"kpi": _content_kpi(rules), "duration": _watch_hours(rules)}, charts)
    return summary.unionByName(_top_cells(top_contracts(profile, rules=rules), "topContracts", [F.col("total_hours").desc(), F.col("contract")]))


def search_bundle(profile: DataFrame, rules: SearchRules = SEARCHES) -> DataFrame:
    """All search reports as cells, as `content_bundle`."""
    charts = {
        "topInterest": ("TopInterest", None, len(rules.categories)),
        "platform": ("MainPlatform", rules.unknown, 10),
        "isp": ("MainISP", rules.unknown, 10),
        "plan": ("PlanName", rules.no_plan, 10),
    }
    summary = _summary(profile, {"kpi": _search_kpi(), "interestSum": _interest_sums(rules)}, charts)
    return summary.unionByName(_top_cells(top_users(profile, rules=rules), "topUsers", [F.col("SearchCount").desc(), F.col("user_id")]))


# --- both ----------------------------------------------------------------------------------------


def _as_rows(row: DataFrame, cells: Sequence[tuple[str, str, str]], names: Sequence[str]) -> DataFrame:
    """A one-row table as rows of two names and a value; cells are (name, name, column)."""
    entries = [
        F.struct(
            F.lit(first).alias(names[0]),
            F.lit(second).alias(names[1]),
            F.col(column).cast("double").alias("value"),
        )
        for first, second, column in cells
    ]
    return row.select(F.inline(F.array(*entries)))


def kpi_long(content: DataFrame, search: DataFrame, views: ViewRules = VIEWS, searches: SearchRules = SEARCHES) -> DataFrame:
    """Chart series as rows: hours and searches per category, activity levels, plan holders."""
    names = ["chart", "label"]
    hours, sums, kpi = _watch_hours(views), _interest_sums(searches), _search_kpi()
    watch = content.agg(
        *_named(hours),
        _tier("Active", "High").alias("high_active"),
        _tier("Active", "Low").alias("low_active"),
    )
    found = search.agg(*_named(sums), kpi["has_plan"].alias("has_plan"), kpi["no_plan"].alias("no_plan"))
    watch_cells = [("watch_hours", label, c) for label, c in zip(views.titles, hours)]
    active_cells = [("active", label, c) for label, c in zip(ACTIVE_LABELS, ["high_active", "low_active"])]
    interest_cells = [("interest", label, c) for label, c in zip(searches.titles, sums)]
    plan_cells = [("plan", label, c) for label, c in zip(PLAN_LABELS, ["has_plan", "no_plan"])]
    return _as_rows(watch, watch_cells + active_cells, names).unionByName(
        _as_rows(found, interest_cells + plan_cells, names)
    )


def kpi_shares(content: DataFrame, search: DataFrame) -> DataFrame:
    """Headline figures as rows: shares in whole percent, averages to one decimal, and the number
    of categories that are someone's favourite."""
    names = ["tab", "metric"]
    watch = content.agg(
        share_percent(_tier("Active", "High"), F.count("*")).alias("high_active_pct"),
        F.count_distinct("MostWatch").alias("categories"),
    )
    found = search.agg(
        *_named(_search_kpi()), F.count_distinct("TopInterest").alias("categories")
    ).select(
        share_percent(F.col("high_active"), F.col("total_users")).alias("high_active_pct"),
        share_percent(F.col("has_plan"), F.col("total_users")).alias("has_plan_pct"),
        "avg_search_count",
        "avg_unique_kw",
        half_up(F.col("avg_quit_rate").cast("decimal(10,4)") * 100, 1).alias("avg_quit_pct"),
        "categories",
    )
    return _as_rows(watch, [("content", c, c) for c in watch.columns], names).unionByName(
        _as_rows(found, [("search", c, c) for c in found.columns], names)
    )
