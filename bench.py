"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs to its end (all rows computed, none kept) $BENCH_RUNS times; the fastest counts.
`baseline` times both profiles as plain SQL written from their specification (window ranks over
counts, distinct counts, conditional sums) on the same rows. Before anything is timed, both sides
have to return the same columns and rows. The raw logs are first written as day files and folders,
not timed; both sides read those.
"""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from couchlog import operators as ops
from couchlog import plans, rules, sources

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session(shared: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("couchlog-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def fastest(builds: dict[str, Callable[[], list[DataFrame]]]) -> dict[str, float]:
    """Best time of each entry. Runs go round by round, so that none gains from coming last."""
    best = dict.fromkeys(builds, float("inf"))
    for _ in range(RUNS):
        for name, build in builds.items():
            start = time.perf_counter()
            for df in build():
                df.write.format("noop").mode("overwrite").save()
            best[name] = min(best[name], time.perf_counter() - start)
    return {name: round(value, 3) for name, value in best.items()}


def _case(column: str, labels: dict[str, str], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {test.format(column)} THEN '{label}'" for test, label in labels.items()) + f" ELSE '{default}' END"


def _first_largest(columns: list[str], labels: list[str]) -> str:
    top = f"greatest({', '.join(columns)})"
    return "CASE " + " ".join(f"WHEN {c} = {top} THEN '{x}'" for c, x in zip(columns, labels)) + " END"


def content_sql() -> str:
    """The viewing profile in SQL over the view `views`."""
    codes = {"{} IN (" + ", ".join(f"'{x}'" for x in held) + ")": c for c, held in rules.APP_CODES.items()}
    totals = [f"Total_{c}" for c in rules.WATCH_CATEGORIES]
    sums = [
        f"CAST(coalesce(sum(CASE WHEN kind = '{c}' THEN CAST(TotalDuration AS DECIMAL(18, 3)) END), 0) AS DOUBLE) AS {t}"
        for c, t in zip(rules.WATCH_CATEGORIES, totals)
    ]
    taste = ", ".join(f"CASE WHEN {t} > 0 THEN '{c.replace('_', ' ')}' END" for c, t in zip(rules.WATCH_CATEGORIES, totals))
    return f"""
WITH typed AS (SELECT *, {_case("AppName", codes, rules.UNKNOWN_APP)} AS kind FROM views),
summed AS (
  SELECT Contract, {", ".join(sums)}, count(DISTINCT Date) AS days FROM typed
  WHERE Contract <> '{rules.INVALID_CONTRACT}' AND kind <> '{rules.UNKNOWN_APP}' GROUP BY Contract),
span AS (
  SELECT CASE WHEN count(DISTINCT Date) <= {rules.WEEK_DAYS} THEN {rules.WEEK_LIMIT} ELSE {rules.MONTH_LIMIT} END AS least FROM views)
SELECT Contract, {", ".join(totals)}, {_first_largest(totals, rules.WATCH_CATEGORIES)} AS MostWatch,
  coalesce(nullif(concat_ws('-', {taste}), ''), '{rules.NO_TASTE}') AS Taste,
  CASE WHEN days > (SELECT least FROM span) THEN 'High' ELSE 'Low' END AS Active
FROM summed"""


def search_sql() -> str:
    """The search profile in SQL over the view `searches`."""
    kinds = {f"lower({{}}) RLIKE r'{pattern}'": c for c, pattern in rules.KEYWORD_PATTERNS.items()}
    counts = [f"Interest_{c}" for c in rules.SEARCH_CATEGORIES]

    def ranked(column: str) -> str:
        return f"""(SELECT user_id, {column} FROM (
    SELECT user_id, {column}, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, {column}) AS place
    FROM typed WHERE {column} IS NOT NULL GROUP BY user_id, {column}) WHERE place = 1)"""

    return f"""
WITH typed AS (
  SELECT *, {_case("keyword", kinds, rules.DEFAULT_KEYWORD)} AS kind, filter(userPlansMap, p -> p IS NOT NULL) AS held
  FROM searches WHERE user_id <> ''),
summed AS (
  SELECT user_id, count(eventID) AS SearchCount, count(DISTINCT keyword) AS UniqueKeyword, count(DISTINCT Date) AS SearchDays,
    count_if(category = 'enter') AS SearchEnter, count_if(category = 'quit') AS SearchQuit,
    {", ".join(f"count_if(kind = '{c}') AS {n}" for c, n in zip(rules.SEARCH_CATEGORIES, counts))},
    sum(CAST(coalesce(size(held), 0) AS BIGINT)) AS PlanCount
  FROM typed GROUP BY user_id),
named AS (
  SELECT user_id, plan FROM (
    SELECT user_id, plan, row_number() OVER (PARTITION BY user_id ORDER BY Date, eventID NULLS LAST, plan) AS place
    FROM (SELECT *, substring_index(get(held, 0), ':', 1) AS plan FROM typed) WHERE plan IS NOT NULL) WHERE place = 1)
SELECT user_id, SearchCount, UniqueKeyword, SearchDays, SearchEnter, SearchQuit,
  round(try_divide(SearchQuit, SearchCount), 4) AS QuitRate, {", ".join(counts)},
  {_first_largest(counts, rules.SEARCH_CATEGORIES)} AS TopInterest,
  coalesce(platform, '{rules.UNKNOWN}') AS MainPlatform, coalesce(proxy_isp, '{rules.UNKNOWN}') AS MainISP,
  coalesce(plan, '{rules.NO_PLAN}') AS PlanName, PlanCount, PlanCount > 0 AS HasPlan,
  CASE WHEN SearchDays >= {rules.SEARCH_DAY_LIMIT} THEN 'High' ELSE 'Low' END AS SearchActive
FROM summed LEFT JOIN {ranked("platform")} USING (user_id) LEFT JOIN {ranked("proxy_isp")} USING (user_id)
LEFT JOIN named USING (user_id)"""


def same(a: DataFrame, b: DataFrame) -> None:
    """Both return the same columns and rows."""
    if a.columns != b.columns or not a.exceptAll(b).isEmpty() or not b.exceptAll(a).isEmpty():
        raise AssertionError("the profile and its SQL differ")


def main() -> None:
    shared = tempfile.mkdtemp(prefix="couchlog-bench-")
    try:
        run(session(shared))
    finally:
        shutil.rmtree(shared, ignore_errors=True)


def run(spark: SparkSession) -> None:
    folder = fixtures.raw_folder(spark, "bench")
    view_rows, search_rows = fixtures.view_log(spark, SF_DIR), fixtures.search_log(spark, SF_DIR)
    raw_views = fixtures.write_view_days(view_rows, f"{folder}/raw_views")
    raw_searches = fixtures.write_search_days(search_rows, f"{folder}/raw_searches")
    text_ids = search_rows.withColumn("eventID", F.col("eventID").cast("string"))
    raw_text_ids = fixtures.write_search_days(text_ids, f"{folder}/raw_text_ids")
    fixtures.write_search_days(view_rows, f"{folder}/views")
    span = (fixtures.SEARCH_START, fixtures.SEARCH_END)
    views = sources.read_parquet_days(spark, f"{folder}/views", "20240101", "20241231", sources.VIEW_SCHEMA)
    searches = sources.read_parquet_days(spark, raw_searches, *span)
    searches_text = sources.read_parquet_days(spark, raw_text_ids, *span)
    views.createOrReplaceTempView("views")
    searches.createOrReplaceTempView("searches")
    users = ops.filter_users(searches)
    content = sources.write_table(ops.content_profile(views), f"{folder}/content")
    search = sources.write_table(ops.search_profile(searches), f"{folder}/search")
    same(content, spark.sql(content_sql()))
    same(search, spark.sql(search_sql()))

    builds = {
        "content_profile": lambda: [ops.content_profile(views)],
        "search_profile": lambda: [ops.search_profile(searches)],
        "baseline_content_profile": lambda: [spark.sql(content_sql())],
        "baseline_search_profile": lambda: [spark.sql(search_sql())],
        "search_profile_text_ids": lambda: [ops.search_profile(searches_text)],
        "content_job": lambda: [plans.content_job(spark, raw_views, f"{folder}/content_job")],
        "search_job": lambda: [plans.search_job(spark, raw_searches, *span, f"{folder}/search_job")],
        "content_reports": lambda: list(plans.content_reports(content).values()),
        "search_reports": lambda: list(plans.search_reports(search).values()),
        "kpi_shares": lambda: [plans.kpi_shares(content, search)],
        "scan_daily_json": lambda: [sources.read_daily_json(spark, raw_views)],
        "watch_totals": lambda: [ops.watch_totals(views)],
        "content_activity": lambda: [ops.content_activity(views)],
        "classify_keyword": lambda: [ops.classify_keyword(searches)],
        "main_platform": lambda: [ops.main_value(users, "user_id", "platform", "MainPlatform")],
        "plan_summary": lambda: [ops.plan_summary(users)],
    }
    times = fastest(builds)
    baseline = {k.removeprefix("baseline_"): v for k, v in times.items() if k.startswith("baseline_")}
    timed = {k: v for k, v in times.items() if not k.startswith("baseline_")}
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "baseline": baseline,
                "rows": {"views": views.count(), "searches": searches.count()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
