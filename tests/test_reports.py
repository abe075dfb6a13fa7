import pytest
from pyspark.sql import functions as F

from couchlog import plans
from couchlog.functions import exact_avg, half_up, share_percent

CONTENT = (
    "Contract string, Total_Giai_Tri double, Total_Phim_Truyen double, Total_The_Thao double, "
    "Total_Thieu_Nhi double, Total_Truyen_Hinh double, MostWatch string, Taste string, Active string"
)
SEARCH = (
    "user_id string, SearchCount long, UniqueKeyword long, SearchDays long, SearchEnter long, SearchQuit long, "
    "QuitRate double, Interest_TruyenHinh long, Interest_TheThao long, Interest_ThieuNhi long, Interest_Phim long, "
    "Interest_GiaiTri long, TopInterest string, MainPlatform string, MainISP string, PlanName string, "
    "PlanCount long, HasPlan boolean, SearchActive string"
)


@pytest.fixture(scope="module")
def content(spark):
    rows = [(f"C{i:02d}", 180.0 * i, 0.0, 0.0, 0.0, 0.0, "Giai_Tri", "Giai Tri", "High" if i % 3 else "Low") for i in range(30)]
    return spark.createDataFrame(rows, CONTENT)


@pytest.fixture(scope="module")
def search(spark):
    rows = [
        (f"u{i:02d}", 10, i, 1, 0, 3, q, 1, 0, 0, 0, i, "GiaiTri", p, "isp", "None" if i % 2 else f"plan{i:02d}", i % 2, not i % 2, "Low")
        for i, (q, p) in enumerate([(0.3, "iOS"), (0.3001, "unknown"), (0.3005, "Android"), (None, "iOS")] * 6)
    ]
    return spark.createDataFrame(rows, SEARCH)


def test_rounding(spark):
    row = spark.sql("SELECT 1.005D AS a, 0.05D AS b, -0.05D AS c, 2.5D AS d")
    got = row.select(half_up(F.col("a"), 2), half_up(F.col("b"), 1), half_up(F.col("c"), 1), half_up(F.col("d"), 0)).head()
    assert tuple(got) == (1.01, 0.1, -0.1, 3.0)


def test_shares_and_averages_of_nothing(spark):
    empty = spark.createDataFrame([], "x double")
    got = empty.agg(exact_avg(F.col("x"), 1).alias("a"), share_percent(F.count("x"), F.count("*")).alias("s")).head()
    assert tuple(got) == (None, None)


@pytest.mark.parametrize("part, whole, pct", [(1, 8, 13), (1, 3, 33), (2, 3, 67), (1, 200, 1), (0, 5, 0)])
def test_share_percent(spark, part, whole, pct):
    assert spark.range(1).select(share_percent(F.lit(part), F.lit(whole))).head()[0] == pct


def test_top_contracts_break_ties_on_rounded_hours(content):
    top = plans.top_contracts(content).collect()
    assert len(top) == 20
    assert [(r["contract"], r["total_hours"]) for r in top[:3]] == [("C29", 1.5), ("C27", 1.4), ("C28", 1.4)]


def test_content_figures(content):
    kpi = plans.content_kpi(content).head()
    assert (kpi["total_contracts"], kpi["avg_giai_tri"], kpi["high_active"], kpi["low_active"]) == (30, 2610.0, 20, 10)
    assert plans.watch_hours(content).head()["giai_tri_h"] == 21.8


def test_distribution_leaves_out_the_stand_in(search):
    rows = plans.distribution(search, "MainPlatform", "mainPlatform", "unknown", 10).collect()
    assert [tuple(r) for r in rows] == [("iOS", 12), ("Android", 6)]
    plan_rows = plans.search_reports(search)["plan"].collect()
    assert len(plan_rows) == 10 and plan_rows[0]["planName"] == "plan00"


def test_quit_percent_and_flag(search):
    rows = {r["user_id"]: (r["quit_pct"], r["high_quit"]) for r in plans.top_users(search, 24, flag=True).collect()}
    assert rows["u00"] == (30.0, False) and rows["u01"] == (30.0, False) and rows["u02"] == (30.1, True)
    assert rows["u03"] == (None, None)


def test_rank_and_podium(content):
    rows = plans.ranked(plans.top_contracts(content, 5), [F.col("total_hours").desc(), F.col("contract")], 5).collect()
    assert [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == [1, 2, 3, 4, 5]
    assert {r["contract"] for r in rows if r["is_top3"]} == {"C29", "C27", "C28"}


def test_chart_rows(content, search):
    rows = {(r["chart"], r["label"]): r["value"] for r in plans.kpi_long(content, search).collect()}
    assert len(rows) == 14
    assert rows["watch_hours", "Giải Trí"] == 21.8 and rows["active", "Low Active"] == 10.0
    assert rows["interest", "Truyền Hình"] == 24.0 and rows["plan", "Có gói cước"] == 12.0


def test_shares(content, search):
    rows = {(r["tab"], r["metric"]): r["value"] for r in plans.kpi_shares(content, search).collect()}
    assert rows["content", "high_active_pct"] == 67.0 and rows["search", "has_plan_pct"] == 50.0
    assert rows["search", "categories"] == 1.0


def test_label(content):
    assert [r["label"] for r in plans.most_watch_labels(content).collect()] == ["Giai Tri"]
