"""One query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from couchlog import operators as ops
from couchlog import plans, sources
from couchlog.rules import VIEWS, SearchRules, ViewRules

Query = Callable[[SparkSession, str], DataFrame]

_FOLDERS: dict[tuple, str] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, size and time of the input tables."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found))


def _written(spark: SparkSession, sf_dir: str, layout: str, write: Callable[[str], str]) -> str:
    """Write a raw layout once per Spark application and input."""
    key = (spark.sparkContext.applicationId, layout, _state(spark, sf_dir))
    if key not in _FOLDERS:
        _FOLDERS[key] = write(fixtures.raw_folder(spark, layout))
    return _FOLDERS[key]


def _json_days(spark: SparkSession, sf_dir: str) -> str:
    return _written(
        spark, sf_dir, "views", lambda root: fixtures.write_view_days(fixtures.view_log(spark, sf_dir), root)
    )


def _odd_days(spark: SparkSession, sf_dir: str) -> str:
    """Errors lie in a second file of their day, named `yyyymmdd_b.json`."""
    log = fixtures.view_log(spark, sf_dir)
    second = F.col("AppName").isin("KPLUS", "SPORT", "BHD")
    named = log.withColumn("Date", F.when(second, F.concat("Date", F.lit("_b"))).otherwise(F.col("Date")))
    return _written(spark, sf_dir, "odd", lambda root: fixtures.write_view_days(named, root))


def _broken_days(spark: SparkSession, sf_dir: str) -> str:
    return _written(
        spark, sf_dir, "broken", lambda root: fixtures.write_broken_days(fixtures.view_log(spark, sf_dir), root)
    )


def _search_days(spark: SparkSession, sf_dir: str) -> str:
    return _written(
        spark, sf_dir, "searches", lambda root: fixtures.write_search_days(fixtures.search_log(spark, sf_dir), root)
    )


def _read_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_parquet_days(
        spark,
        _search_days(spark, sf_dir),
        fixtures.SEARCH_START,
        fixtures.SEARCH_END,
        fixtures.SEARCH_FIELDS,
    )


def _views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.view_log(spark, sf_dir)


def _searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.filter_users(fixtures.search_log(spark, sf_dir))


def _content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.content_profile(_views(spark, sf_dir))


def _search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.search_profile(fixtures.search_log(spark, sf_dir))


# --- sources and sinks ---------------------------------------------------------------------------


def scan_daily_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_daily_json(spark, _json_days(spark, sf_dir))


def flatten_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelopes = spark.read.schema("_index string, _source struct<Contract: string, AppName: string>").json(
        f"{_json_days(spark, sf_dir)}/*.json"
    )
    return sources.flatten_envelope(envelopes)


def day_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_daily_json(spark, _odd_days(spark, sf_dir)).groupBy("Date").agg(F.count("*").alias("views"))


def skip_bad_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = sources.read_daily_json(spark, _broken_days(spark, sf_dir))
    return log.groupBy("Date", "AppName").agg(F.count("*").alias("views"))


def days_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.days_covered(sources.read_daily_json(spark, _broken_days(spark, sf_dir)))


def scan_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    plans_held = F.array_join("userPlansMap", ",", "-")
    return _read_searches(spark, sf_dir).withColumn("userPlansMap", plans_held)


def day_from_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_searches(spark, sf_dir).groupBy("Date").agg(F.count("*").alias("searches"))


def union_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four app groups, with their columns in another order or one column missing."""
    log = _views(spark, sf_dir)
    films = F.col("AppName").isin("VOD", "FIMS")
    return ops.union_days(
        [
            log.filter(F.col("AppName") == "CHANNEL"),
            log.filter(F.col("AppName") == "RELAX").select("Date", "TotalDuration", "AppName", "Contract"),
            log.filter(films).drop("TotalDuration"),
            log.filter((~F.col("AppName").isin("CHANNEL", "RELAX")) & ~films),
        ]
    )


def sink_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.write_table(_content(spark, sf_dir), fixtures.raw_folder(spark, "content_profile"))


def lost_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and lost lines of each day, of which some were read and some not, from the counts per file."""
    counts = sources.lost_lines(spark, _broken_days(spark, sf_dir))
    return counts.groupBy("Date").agg(F.sum("lines").alias("lines"), F.sum("lost").alias("lost"))


def lost_in_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lost lines of each day as the viewing job tells them, beside the profile and from the same read."""
    kept = fixtures.raw_folder(spark, "lost")
    sink = lambda df: df.groupBy("Date").agg(F.sum("lost").alias("lost")).write.parquet(kept)
    plans.content_job(spark, _broken_days(spark, sf_dir), fixtures.raw_folder(spark, "content_job"), on_lost=sink)
    return spark.read.schema("Date string, lost bigint").parquet(kept)


def undeclared_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views by a field of the envelope that is not declared, and a value out of its list."""
    root = _written(spark, sf_dir, "rich", lambda folder: fixtures.write_rich_days(_views(spark, sf_dir), folder))
    log = sources.read_daily_json(spark, root, rest="source")
    model, code = F.try_variant_get("source", "$.Device.model", "string"), F.try_variant_get("source", "$.Device.codes[0]", "bigint")
    return log.groupBy(model.alias("model"), "AppName").agg(F.count("*").alias("views"), F.sum(code).alias("codes"))


def search_job_mixed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids are numbers on odd days and text on even ones."""

    def write(root: str) -> str:
        log = fixtures.search_log(spark, sf_dir)
        even = F.col("Date") % 2 == 0
        fixtures.write_search_days(log.filter(~even), root)
        return fixtures.write_search_days(log.filter(even).withColumn("eventID", F.col("eventID").cast("string")), root, "append")

    days = _written(spark, sf_dir, "mixed", write)
    return plans.search_job(spark, days, fixtures.SEARCH_START, fixtures.SEARCH_END, fixtures.raw_folder(spark, "search_job"))


# --- viewing -------------------------------------------------------------------------------------


def classify_app(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.classify_app(_views(spark, sf_dir)).select("Contract", "AppName", "Type")


def _rule_rows(spark: SparkSession) -> DataFrame:
    """The app codes as a table, with a code twice and one without a category."""
    rows = [(code, category) for category, codes in VIEWS.codes.items() for code in codes]
    return spark.createDataFrame([*rows, ("VOD", "Z"), (None, "Z"), ("BHD", None)], "code string, category string")


def classify_app_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By a rule table that is broadcast."""
    typed = ops.classify_by_table(_views(spark, sf_dir), "AppName", _rule_rows(spark), VIEWS.unknown_app)
    return typed.select("Contract", "AppName", "Type")


def classify_app_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the same table, as if it were too large for a broadcast."""
    typed = ops.classify_by_table(_views(spark, sf_dir), "AppName", _rule_rows(spark), VIEWS.unknown_app, broadcast_bytes=0)
    return typed.select("Contract", "AppName", "Type")


def filter_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.filter_contract(_views(spark, sf_dir))


def watch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.watch_totals(_views(spark, sf_dir))


def most_watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.most_watch(watch_totals(spark, sf_dir)).select("Contract", "MostWatch")


def taste(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.taste(watch_totals(spark, sf_dir)).select("Contract", "Taste")


def content_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.content_activity(fixtures.view_log_week(spark, sf_dir))


def content_activity_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.content_activity(_views(spark, sf_dir))


def content_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fixtures.raw_folder(spark, "content_job")
    return plans.content_job(spark, _json_days(spark, sf_dir), target)


def watch_totals_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations with seven digits after the point."""
    return ops.watch_totals(fixtures.view_log_fine(spark, sf_dir))


def days_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the broken layout: those whose every line is broken were not read."""
    seen: list[DataFrame] = []
    root = _broken_days(spark, sf_dir)
    plans.content_job(spark, root, fixtures.raw_folder(spark, "content_job"), on_days=lambda df: seen.append(df))
    return sources.days_read(spark, root, sources.read_daily_json(spark, root))


def content_job_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a kept daily state: the first is given the odd days, and two even ones with half their views; the
    second the even days."""
    folder, log = fixtures.raw_folder(spark, "kept_views"), _views(spark, sf_dir)
    even = F.col("Date") % 2 == 0
    early = log.filter(~even | (F.col("Date").isin("20240102", "20240104") & (F.hash("TotalDuration") % 2 == 0)))
    fixtures.write_view_days(early, f"{folder}/early")
    fixtures.write_view_days(log.filter(even), f"{folder}/late")
    plans.content_job_kept(spark, f"{folder}/early", f"{folder}/state", f"{folder}/first")
    return plans.content_job_kept(spark, f"{folder}/late", f"{folder}/state", f"{folder}/second")


def search_job_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `content_job_kept`, for searches."""
    folder, log = fixtures.raw_folder(spark, "kept_searches"), fixtures.search_log(spark, sf_dir)
    even, span = F.col("Date") % 2 == 0, (fixtures.SEARCH_START, fixtures.SEARCH_END)
    early = ~even | (F.col("Date").isin("20220602", "20220612") & F.col("platform").isNotNull())
    fixtures.write_search_deliveries(log, folder, early=early, late=even)
    plans.search_job_kept(spark, f"{folder}/early", *span, f"{folder}/state", f"{folder}/first", fields=fixtures.SEARCH_FIELDS)
    return plans.search_job_kept(spark, f"{folder}/late", *span, f"{folder}/state", f"{folder}/second", fields=fixtures.SEARCH_FIELDS)


OTHER_VIEWS = ViewRules({"Screen": ["CHANNEL", "VOD"], "Rest": ["RELAX", "CHILD", "BHD"]}, invalid_contract="1", week_limit=1, month_limit=3)
OTHER_SEARCHES = SearchRules({"News": "vtv", "Letters": "[aeiou]{2}"}, default="None", day_limit=10, unknown="?", no_plan="-")


def other_rules_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The viewing profile of another platform: other categories, codes, contract and limits."""
    return ops.content_profile(_views(spark, sf_dir), rules=OTHER_VIEWS)


def other_rules_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search profile of another platform: other patterns, limit and stand-ins."""
    return ops.search_profile(fixtures.search_log(spark, sf_dir), OTHER_SEARCHES)


# --- search --------------------------------------------------------------------------------------


def classify_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fixtures.search_log(spark, sf_dir)
    return ops.classify_keyword(log).select("eventID", "keyword", "ContentType")


def filter_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _searches(spark, sf_dir).select("eventID", "user_id", "Date")


def search_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.search_behavior(_searches(spark, sf_dir))


def search_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.interests(_searches(spark, sf_dir))


def top_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.top_interest(search_interest(spark, sf_dir)).select("user_id", "TopInterest")


def main_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.main_value(_searches(spark, sf_dir), "user_id", "platform", "MainPlatform")


def main_isp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.main_value(_searches(spark, sf_dir), "user_id", "proxy_isp", "MainISP")


def unique_keywords_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct keywords of June's second half, from daily sketches that are kept as Parquet."""
    sketches = sources.write_table(ops.daily_distinct(_searches(spark, sf_dir), "user_id", "keyword"), fixtures.raw_folder(spark, "sketches"))
    return ops.distinct_over(sketches, "user_id", "20220616", "20220630", "UniqueKeyword")


def frequent_keywords_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 most frequent keywords of June's second half, from daily sketches."""
    log = _searches(spark, sf_dir)
    sketches = sources.write_table(ops.daily_frequent(log, "keyword"), fixtures.raw_folder(spark, "frequent"))
    return ops.frequent_over(sketches, log, "keyword", 5, "20220616", "20220630")


def frequent_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As report_isp, over daily sketches of the users' favourites: each user on the last day of the log."""
    profile = _search(spark, sf_dir).select(F.lit(fixtures.SEARCH_END).alias("Date"), F.col("MainISP").alias("mainISP")).filter("mainISP <> 'unknown'")
    kept = sources.write_table(profile, fixtures.raw_folder(spark, "favourites"))
    sketches = ops.daily_frequent(kept, "mainISP", 1024)
    return ops.frequent_over(sketches, kept, "mainISP", 10, fixtures.SEARCH_START, fixtures.SEARCH_END, 1024)


def explode_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.explode_plans(_searches(spark, sf_dir))


def plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.plan_summary(_searches(spark, sf_dir))


def search_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.search_activity(_searches(spark, sf_dir))


def attach_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [main_platform(spark, sf_dir), main_isp(spark, sf_dir), plan_summary(spark, sf_dir)]
    return ops.attach_profiles(search_behavior(spark, sf_dir), parts)


def search_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fixtures.raw_folder(spark, "search_job")
    days = _search_days(spark, sf_dir)
    return plans.search_job(spark, days, fixtures.SEARCH_START, fixtures.SEARCH_END, target)


# --- reports -------------------------------------------------------------------------------------


def report_top_taste_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = plans.distribution(_content(spark, sf_dir), "Taste", "taste", k=10)
    return plans.ranked(top, [F.col("count").desc(), F.col("taste")], 10)


def report_top_contracts_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = plans.top_contracts(_content(spark, sf_dir))
    return plans.ranked(top, [F.col("total_hours").desc(), F.col("contract")], 20)


def report_top_users_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = plans.top_users(_search(spark, sf_dir), flag=True)
    return plans.ranked(top, [F.col("SearchCount").desc(), F.col("user_id")], 20)


def _content_report(name: str) -> Query:
    return lambda spark, sf_dir: plans.content_reports(_content(spark, sf_dir))[name]


def _search_report(name: str) -> Query:
    return lambda spark, sf_dir: plans.search_reports(_search(spark, sf_dir))[name]


def other_rules_report(name: str) -> Query:
    """A report over the profile of another platform."""
    if name.startswith("search_"):
        return lambda spark, sf_dir: plans.search_reports(other_rules_search(spark, sf_dir), OTHER_SEARCHES)[name[7:]]
    return lambda spark, sf_dir: plans.content_reports(other_rules_content(spark, sf_dir), OTHER_VIEWS)[name]


def other_rules_kpi_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.kpi_long(other_rules_content(spark, sf_dir), other_rules_search(spark, sf_dir), OTHER_VIEWS, OTHER_SEARCHES)


_QUERIES: dict[str, Query] = {
    "scan_daily_json": scan_daily_json,
    "flatten_envelope": flatten_envelope,
    "day_from_file": day_from_file,
    "skip_bad_days": skip_bad_days,
    "days_covered": days_covered,
    "scan_date_range": scan_date_range,
    "day_from_folder": day_from_folder,
    "union_days": union_days,
    "sink_table_roundtrip": sink_table_roundtrip,
    "lost_lines": lost_lines,
    "lost_in_job": lost_in_job,
    "undeclared_fields": undeclared_fields,
    "search_job_mixed_ids": search_job_mixed_ids,
    "classify_app": classify_app,
    "classify_app_table": classify_app_table,
    "classify_app_shuffled": classify_app_shuffled,
    "unique_keywords_range": unique_keywords_range,
    "frequent_keywords_range": frequent_keywords_range,
    "frequent_providers": frequent_providers,
    "filter_contract": filter_contract,
    "watch_totals": watch_totals,
    "most_watch": most_watch,
    "taste": taste,
    "content_activity": content_activity,
    "content_activity_month": content_activity_month,
    "content_profile": _content,
    "content_job": content_job,
    "content_job_kept": content_job_kept,
    "search_job_kept": search_job_kept,
    "watch_totals_fine": watch_totals_fine,
    "days_read": days_read,
    "other_rules_content": other_rules_content,
    "other_rules_search": other_rules_search,
    "classify_keyword": classify_keyword,
    "filter_users": filter_users,
    "search_behavior": search_behavior,
    "search_interest": search_interest,
    "top_interest": top_interest,
    "main_platform": main_platform,
    "main_isp": main_isp,
    "explode_plans": explode_plans,
    "plan_summary": plan_summary,
    "search_activity": search_activity,
    "attach_profiles": attach_profiles,
    "search_profile": _search,
    "search_job": search_job,
    "report_content_kpi": _content_report("kpi"),
    "report_most_watch": _content_report("mostWatch"),
    "report_watch_hours": _content_report("duration"),
    "report_top_taste": _content_report("taste"),
    "report_top_contracts": _content_report("topContracts"),
    "report_search_kpi": _search_report("kpi"),
    "report_top_interest": _search_report("topInterest"),
    "report_interest_sum": _search_report("interestSum"),
    "report_platform": _search_report("platform"),
    "report_isp": _search_report("isp"),
    "report_top_users": _search_report("topUsers"),
    "report_plan": _search_report("plan"),
    "report_bundle_content": lambda s, d: plans.content_bundle(_content(s, d)),
    "report_bundle_search": lambda s, d: plans.search_bundle(_search(s, d)),
    "other_rules_kpi": other_rules_report("kpi"),
    "other_rules_watch_hours": other_rules_report("duration"),
    "other_rules_top_contracts": other_rules_report("topContracts"),
    "other_rules_interest_sum": other_rules_report("search_interestSum"),
    "other_rules_isp": other_rules_report("search_isp"),
    "other_rules_kpi_long": other_rules_kpi_long,
    "report_most_watch_labels": lambda s, d: plans.most_watch_labels(_content(s, d)),
    "report_top_taste_ranked": report_top_taste_ranked,
    "report_top_contracts_ranked": report_top_contracts_ranked,
    "report_top_users_ranked": report_top_users_ranked,
    "kpi_shares": lambda s, d: plans.kpi_shares(_content(s, d), _search(s, d)),
    "kpi_long": lambda s, d: plans.kpi_long(_content(s, d), _search(s, d)),
}


def _shared(query: Query) -> Query:
    """Some queries keep intermediate tables; a session of one machine may not have named a folder for them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fixtures.share_folder(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {name: _shared(query) for name, query in _QUERIES.items()}
