"""Whole-table properties: rewrites agree, order does not matter, one hot key changes nothing."""

import os

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from couchlog import operators as ops
from couchlog import rules

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def views(spark):
    log = fixtures.view_log(spark, SF_DIR)
    return log.cache()


@pytest.fixture(scope="module")
def searches(spark):
    log = fixtures.search_log(spark, SF_DIR)
    return log.cache()


@pytest.fixture(params=["plain", "hot"])
def case(request):
    return request.param


def heat(log, case, key, other):
    """Give half of all rows to one customer."""
    if case == "plain":
        return log
    hot = F.pmod(F.xxhash64(other, "Date"), F.lit(2)) == 0
    return log.withColumn(key, F.when(hot, "hot").otherwise(F.col(key)))


def test_content_profile_agrees_with_pivot_and_join(spark, views, case):
    log = heat(views, case, "Contract", "TotalDuration")
    log.createOrReplaceTempView("views")
    categories = ", ".join(f"'{c}' AS Total_{c}" for c in rules.WATCH_CATEGORIES)
    spark.sql(
        """
        SELECT *, CASE AppName WHEN 'CHANNEL' THEN 'Truyen_Hinh' WHEN 'RELAX' THEN 'Giai_Tri'
          WHEN 'CHILD' THEN 'Thieu_Nhi' WHEN 'FIMS' THEN 'Phim_Truyen' WHEN 'VOD' THEN 'Phim_Truyen'
          WHEN 'KPLUS' THEN 'The_Thao' WHEN 'SPORT' THEN 'The_Thao' END AS Type
        FROM views WHERE Contract <> '0'
        """
    ).filter("Type IS NOT NULL").createOrReplaceTempView("typed")
    pivoted = spark.sql(
        f"""
        SELECT * FROM (SELECT Contract, Type, CAST(TotalDuration AS DECIMAL(18,2)) AS v FROM typed)
        PIVOT (SUM(v) FOR Type IN ({categories}))
        """
    )
    days = spark.sql("SELECT Contract, COUNT(DISTINCT Date) AS d FROM typed GROUP BY Contract")
    joined = pivoted.join(days, "Contract").select(
        "Contract",
        *[F.coalesce(F.col(f"Total_{c}"), F.lit(0)).cast("double").alias(f"Total_{c}") for c in rules.WATCH_CATEGORIES],
        F.when(F.col("d") > 15, "High").otherwise("Low").alias("Active"),
    )
    profile = ops.content_profile(log).drop("MostWatch", "Taste")
    assert profile.count() > 50
    assert same(profile, joined)


def test_search_profile_agrees_with_its_parts(spark, searches, case):
    log = ops.filter_users(heat(searches, case, "user_id", "eventID"))
    parts = [
        ops.top_interest(ops.interests(log)),
        ops.main_value(log, "user_id", "platform", "MainPlatform"),
        ops.main_value(log, "user_id", "proxy_isp", "MainISP"),
        ops.plan_summary(log),
        ops.search_activity(log).drop("SearchDays"),
    ]
    joined = ops.attach_profiles(ops.search_behavior(log), parts).na.fill(
        {"MainPlatform": "unknown", "MainISP": "unknown", "PlanName": "None"}
    )
    profile = ops.search_profile(log)
    assert profile.count() > 50
    assert same(profile, joined)


def test_main_value_agrees_with_mode(searches):
    log = ops.filter_users(searches)
    mode = log.groupBy("user_id").agg(F.mode("platform", True).alias("MainPlatform")).dropna()
    assert same(ops.main_value(log, "user_id", "platform", "MainPlatform"), mode)


def test_row_order_and_partitioning_do_not_matter(views, searches):
    shuffled = views.orderBy(F.rand(7)).repartition(5)
    assert same(ops.content_profile(views), ops.content_profile(shuffled))
    shuffled = searches.orderBy(F.rand(7)).repartition(5)
    assert same(ops.search_profile(searches), ops.search_profile(shuffled))


def test_nothing_is_lost(views, searches):
    kept = ops.filter_contract(views)
    total = sum(F.col(f"Total_{c}").cast("decimal(28,6)") for c in rules.WATCH_CATEGORIES)
    profile = ops.content_profile(views)
    assert (
        profile.agg(F.sum(total)).head()[0]
        == kept.agg(F.sum(F.col("TotalDuration").cast("decimal(28,6)"))).head()[0]
    )
    assert profile.filter("Active IN ('High', 'Low')").count() == kept.select("Contract").distinct().count()
    log = ops.filter_users(searches)
    interests = sum(F.col(f"Interest_{c}") for c in rules.SEARCH_CATEGORIES)
    found = ops.search_profile(searches).agg(F.sum(interests), F.sum("SearchCount"), F.count("*")).head()
    assert tuple(found) == tuple(log.agg(F.count("*"), F.count("eventID"), F.count_distinct("user_id")).head())


def test_both_activity_levels_occur(views, searches):
    assert ops.content_profile(views).select("Active").distinct().count() == 2
    assert ops.search_profile(searches).filter("SearchActive = 'High'").count() > 0
