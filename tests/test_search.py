import pytest

from couchlog import operators as ops
from couchlog.rules import SearchRules

SEARCHES = (
    "eventID long, user_id string, keyword string, category string, platform string, "
    "proxy_isp string, userPlansMap array<string>, Date string"
)


def searches(spark, rows):
    names = [part.split()[0] for part in SEARCHES.split(", ")]
    defaults = dict.fromkeys(names)
    full = [{**defaults, "user_id": "u", "eventID": i + 1, "Date": "20220601", **r} for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], SEARCHES)


def one(spark, rows):
    got = ops.search_profile(searches(spark, rows)).collect()
    assert len(got) == 1
    return got[0]


@pytest.mark.parametrize(
    "keyword, category",
    [
        ("KÊNH VTV3", "TruyenHinh"),
        ("xem TRỰC TIẾP world cup", "TruyenHinh"),
        ("NARUTO tập 5", "ThieuNhi"),
        ("Running Man tập 9", "TheThao"),
        ("tập 9", "Phim"),
        ("tập ５", "GiaiTri"),
        ("ep.1", "Phim"),
        ("epx1", "GiaiTri"),
        ("deep", "GiaiTri"),
        ("Transport", "TheThao"),
        ("ke\u0302nh", "GiaiTri"),
        ("", "GiaiTri"),
        (None, "GiaiTri"),
    ],
)
def test_keyword_category(spark, keyword, category):
    log = searches(spark, [{"keyword": keyword}])
    assert ops.classify_keyword(log).head()["ContentType"] == category
    assert ops.search_profile(log).head()["TopInterest"] == category


def test_user_filter(spark):
    log = searches(spark, [{"user_id": u} for u in [None, "", " ", "7"]])
    assert {r["user_id"] for r in ops.filter_users(log).collect()} == {" ", "7"}
    assert {r["user_id"] for r in ops.search_profile(log).collect()} == {" ", "7"}


def test_missing_event_id(spark):
    got = one(spark, [{"eventID": None}, {"eventID": 5}])
    assert got["SearchCount"] == 1
    assert sum(got[c] for c in got.asDict() if c.startswith("Interest_")) == 2


def test_quit_rate(spark):
    got = one(spark, [{"category": "quit"}, {"category": "enter"}, {"category": "Quit"}])
    assert (got["SearchEnter"], got["SearchQuit"], got["QuitRate"]) == (1, 1, 0.3333)


def test_quit_rate_without_event_ids(spark):
    got = one(spark, [{"eventID": None, "category": "quit"}])
    assert got["SearchCount"] == 0 and got["QuitRate"] is None


def test_distinct_keywords_are_exact_and_skip_null(spark):
    assert one(spark, [{"keyword": k} for k in ["a", "A", "a", "", None]])["UniqueKeyword"] == 3


def test_activity_is_high_from_the_limit_on(spark):
    rows = [{"user_id": "three", "Date": f"2022060{d}"} for d in range(1, 4)]
    rows += [{"user_id": "four", "Date": f"2022060{d}"} for d in range(1, 5)]
    want = {"three": "Low", "four": "High"}
    assert {r["user_id"]: r["SearchActive"] for r in ops.search_profile(searches(spark, rows)).collect()} == want
    assert {r["user_id"]: r["SearchActive"] for r in ops.search_activity(searches(spark, rows)).collect()} == want


def test_favourite_platform(spark):
    assert one(spark, [{"platform": p} for p in ["iOS", "Android", "iOS", "Android"]])["MainPlatform"] == "Android"
    assert one(spark, [{"platform": p} for p in ["iOS", "Android", "iOS", None, None, None]])["MainPlatform"] == "iOS"
    assert one(spark, [{"platform": None}])["MainPlatform"] == "unknown"
    assert one(spark, [{"platform": p} for p in ["", "", "iOS"]])["MainPlatform"] == ""


def test_favourite_interest_tie(spark):
    assert one(spark, [{"keyword": "phim"}, {"keyword": "vtv"}])["TopInterest"] == "TruyenHinh"


@pytest.mark.parametrize(
    "plans, name, count",
    [
        ([["x:1", None, ""]], "x", 2),
        ([[":x"]], "", 1),
        ([["whole"]], "whole", 1),
        ([[]], "None", 0),
        ([None], "None", 0),
        ([[None]], "None", 0),
        ([None, ["b:1"], ["a:1"]], "b", 2),
    ],
)
def test_plans(spark, plans, name, count):
    rows = [{"userPlansMap": p} for p in plans]
    got = one(spark, rows)
    assert (got["PlanName"], got["PlanCount"], got["HasPlan"]) == (name, count, count > 0)
    summary = ops.plan_summary(searches(spark, rows)).head()
    found = "None" if summary["PlanName"] is None else summary["PlanName"]
    assert (found, summary["PlanCount"], summary["HasPlan"]) == (name, count, count > 0)


def test_plan_name_is_the_earliest(spark):
    late = {"Date": "20220602", "eventID": 1, "userPlansMap": ["late"]}
    early = {"Date": "20220601", "eventID": 9, "userPlansMap": ["early"]}
    unnumbered = {"Date": "20220601", "eventID": None, "userPlansMap": ["a"]}
    assert one(spark, [late, unnumbered, early])["PlanName"] == "early"


def test_explode_plans_keeps_users_without_plan(spark):
    log = searches(spark, [{"userPlansMap": p} for p in [["x:1", None], [], None]])
    rows = sorted(ops.explode_plans(log).collect(), key=str)
    assert sorted(str(r["plan_name"]) for r in rows) == ["None", "None", "None", "x"]


def test_text_event_ids(spark):
    log = searches(spark, [{"userPlansMap": ["p:1"], "platform": "iOS"}])
    text = log.withColumn("eventID", log["eventID"].cast("string"))
    assert ops.search_profile(text).collect() == ops.search_profile(log).collect()


def test_order_of_event_ids(spark):
    """Numbers order by value, text as text."""
    rows = [{"eventID": 9, "userPlansMap": ["nine"]}, {"eventID": 10, "userPlansMap": ["ten"]}]
    log = searches(spark, rows)
    assert ops.search_profile(log).head()["PlanName"] == "nine"
    text = log.withColumn("eventID", log["eventID"].cast("string"))
    assert ops.search_profile(text).head()["PlanName"] == "ten"


def test_other_rules(spark):
    rules = SearchRules({"News": "news"}, "Rest", day_limit=1, no_plan="-", unknown="?")
    log = searches(spark, [{"keyword": "NEWS"}, {"keyword": "phim"}, {"keyword": "news"}])
    got = ops.search_profile(log, rules).head()
    assert (got["Interest_News"], got["Interest_Rest"], got["TopInterest"]) == (2, 1, "News")
    assert (got["MainPlatform"], got["PlanName"], got["SearchActive"]) == ("?", "-", "High")
