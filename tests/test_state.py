"""Kept daily state, lost lines, days of different types, undeclared fields, rule tables, sketches."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from couchlog import operators as ops
from couchlog import plans, sources
from couchlog.rules import VIEWS, ViewRules

SEARCH = "user_id string, keyword string, category string, platform string, proxy_isp string, userPlansMap array<string>, Date string"


def write_day(root, name, lines):
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/{name}", "w") as f:
        f.write("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))


def view(contract, app, seconds, **more):
    return {"_source": {"Contract": contract, "AppName": app, "TotalDuration": seconds, **more}}


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_views_taken_in_day_by_day(spark, tmp_path):
    logs, state = f"{tmp_path}/logs", f"{tmp_path}/state"
    write_day(logs, "20220401.json", [view("C1", "VOD", 10), view("C2", "SPORT", 0.0001)])
    write_day(logs, "20220402.json", [view("C1", "RELAX", 5), view("0", "VOD", 7)])
    assert plans.update_views(spark, logs, state) == ["20220401.json", "20220402.json"]
    assert plans.update_views(spark, logs, state) == []
    write_day(logs, "20220403_b.json", [view("C1", "VOD", 1), view("C2", "SPORT", 1e-19)])
    write_day(logs, "20220401.json", [view("C1", "VOD", 30), "broken"])  # delivered again
    assert plans.update_views(spark, logs, state) == ["20220401.json", "20220403_b.json"]
    kept = plans.content_job_kept(spark, logs, state, f"{tmp_path}/kept", limit=1)
    whole = plans.content_job(spark, logs, f"{tmp_path}/whole", limit=1)
    assert rows_of(kept) == rows_of(whole)
    found = {r["Contract"]: (r["Total_Phim_Truyen"], r["Total_The_Thao"], r["Active"]) for r in kept.collect()}
    assert found == {"C1": (31.0, 0.0, "High"), "C2": (0.0, 1e-19, "Low")}
    assert ops.days_covered(sources.read_state(spark, state)).head()["days"] == 3
    part = plans.content_job_kept(spark, logs, state, f"{tmp_path}/part", start="20220402", end="20220402")
    assert [r["Contract"] for r in part.collect()] == ["C1"]
    with pytest.raises(sources.NoDataError):
        plans.content_job_kept(spark, logs, state, f"{tmp_path}/none", start="20230101")


def test_only_new_days_are_read(spark, tmp_path):
    logs, state = f"{tmp_path}/logs", f"{tmp_path}/state"
    write_day(logs, "20220401.json", [view("C1", "VOD", 10)])
    plans.update_views(spark, logs, state)
    before = {name: os.stat(f"{state}/Date=20220401/{name}").st_mtime_ns for name in os.listdir(f"{state}/Date=20220401")}
    write_day(logs, "20220402.json", [view("C1", "VOD", 10)])
    os.chmod(f"{logs}/20220401.json", 0)
    seen = sources.read_daily_json(spark, logs, days=["20220402.json"]).inputFiles()
    assert [os.path.basename(f) for f in seen] == ["20220402.json"]
    plans.update_views(spark, logs, state)
    assert before == {name: os.stat(f"{state}/Date=20220401/{name}").st_mtime_ns for name in os.listdir(f"{state}/Date=20220401")}
    os.chmod(f"{logs}/20220401.json", 0o644)
    other = ViewRules({"All": ["VOD"]})
    assert plans.update_views(spark, logs, state, rules=other) == ["20220401.json", "20220402.json"]


def test_searches_taken_in_day_by_day(spark, tmp_path):
    rng = random.Random(1)
    pick = lambda *values: rng.choice(values)

    def events(n, day):
        return [
            (k if rng.random() < 0.9 else None, pick("u1", "u2", "u3", "", None), pick("vtv", "phim", "x", None), pick("enter", "quit", None),
             pick("iOS", "tv", None), pick("a", "b"), pick(None, [], ["p1:x", "q"], [None, "p2"], ["p3"]), day)
            for k in range(n)
        ]

    days = {f"2022060{d}": events(40, f"2022060{d}") for d in range(1, 6)}
    logs, state, schema = f"{tmp_path}/logs", f"{tmp_path}/state", f"eventID bigint, {SEARCH}"
    write = lambda day, rows: spark.createDataFrame(rows, schema).drop("Date").write.mode("overwrite").parquet(f"{logs}/{day}")
    for day, rows in days.items():
        write(day, rows if day != "20220603" else rows[:9])
    span = ("20220601", "20220604")
    first = plans.search_job_kept(spark, logs, *span, state, f"{tmp_path}/first")
    assert sorted(sources.deliveries(spark, state)) == [f"2022060{d}" for d in range(1, 5)] and first.count() == 3
    write("20220603", days["20220603"])
    assert plans.update_searches(spark, logs, "20220601", "20220605", state) == ["20220603", "20220605"]
    for span in (("20220601", "20220605"), ("20220602", "20220604")):
        kept = plans.search_job_kept(spark, logs, *span, state, f"{tmp_path}/kept")
        assert rows_of(kept) == rows_of(plans.search_job(spark, logs, *span, f"{tmp_path}/whole"))


def test_deliveries_are_written_in_one_pass(spark, tmp_path):
    """A row may be of several deliveries or of none; a day's files do not grow with the tasks that make the log."""
    rows = [(k, f"u{k % 5}", "x" if k % 3 else None, None, None, "a", [], f"2022060{1 + k % 4}") for k in range(400)] + [(0, "u", None, None, None, "a", None, "20220601")] * 2
    log = spark.createDataFrame(rows, f"eventID bigint, {SEARCH}").repartition(16)
    even, early = F.col("Date") % 2 == 0, (F.col("Date") % 2 == 1) | F.col("keyword").isNotNull()
    root = fixtures.write_search_deliveries(log, f"{tmp_path}/logs", early=early, late=even, empty=F.lit(False))
    assert not os.path.exists(f"{root}/empty")
    for name, held, days in (("early", early, 4), ("late", even, 2)):
        entries = sources.parquet_days(spark, f"{root}/{name}", "20220601", "20220604")
        assert len(entries) == days
        assert all(len([f for f in os.listdir(f"{root}/{name}/{day}") if f.endswith(".parquet")]) == 1 for day in entries)
        read = sources.read_parquet_days(spark, f"{root}/{name}", "20220601", "20220604")
        assert rows_of(read) == rows_of(log.filter(held))


def test_what_is_multiplied_holds_no_plans(spark):
    """The lists of plans are counted once per event, not once per kind of value; keywords and days are folded without copies."""
    log = spark.createDataFrame([(1, "u1", "k", "enter", "tv", "a", ["p"], "20220601")], f"eventID bigint, {SEARCH}")
    daily = ops.daily_searches(log)
    expand = next(line for line in daily._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Expand" in line)
    assert "userPlansMap" not in expand and "held" in expand
    assert "Expand" not in ops.search_profile_from_daily(spark.createDataFrame(daily.collect(), daily.schema))._jdf.queryExecution().optimizedPlan().toString()


def test_lost_lines_are_told_by_day_and_file(spark, tmp_path):
    logs = f"{tmp_path}/logs"
    good = view("C1", "VOD", 1)
    write_day(logs, "20220401.json", [good, *['{"_source": {'] * 99])
    write_day(logs, "20220402.json", ["nothing", '{"other": 1}', "[]"])
    write_day(f"{logs}/20220403.json", "a.json", [good, good])
    write_day(f"{logs}/20220403.json", "b.json", ["", "x", good])
    counts = {(r["Date"], r["file"]): (r["lines"], r["lost"]) for r in sources.lost_lines(spark, logs).collect()}
    assert counts == {("20220401", "20220401.json"): (100, 99), ("20220402", "20220402.json"): (2, 2), ("20220403", "a.json"): (2, 0), ("20220403", "b.json"): (2, 1)}
    seen, days = [], []
    profile = plans.content_job(spark, logs, f"{tmp_path}/out", on_lost=lambda df: seen.extend(df.collect()), on_days=lambda df: days.extend(df.collect()))
    assert {(r["Date"], r["file"]): r["lost"] for r in seen} == {k: v[1] for k, v in counts.items() if v[1]}
    assert {r["Date"]: r["read"] for r in days} == {"20220401": True, "20220402": False, "20220403": True}
    assert profile.head()["Total_Phim_Truyen"] == 4.0
    lines = sources.unreadable_lines(spark, logs).collect()
    assert len(lines) == 102 and ("20220403", "b.json", "x") in [tuple(r) for r in lines]


def test_undeclared_fields(spark, tmp_path):
    logs = f"{tmp_path}/logs"
    lines = [view("C1", "VOD", "12", Device={"os": "tv", "v": [1, 2]}), view("C2", "VOD", 3), "broken", '{"x": 1}', "  "]
    write_day(logs, "20220401.json", lines)
    log = sources.read_daily_json(spark, logs, rest="all")
    got = log.select("Contract", "TotalDuration", "Date", F.try_variant_get("all", "$.Device.v[1]", "int"), F.try_variant_get("all", "$.Contract", "string"))
    assert sorted(map(tuple, got.collect())) == [("C1", 12.0, "20220401", 2, "C1"), ("C2", 3.0, "20220401", None, "C2")]
    assert rows_of(log.drop("all")) == rows_of(sources.read_daily_json(spark, logs))


def test_days_of_different_types(spark, tmp_path):
    logs = f"{tmp_path}/logs"
    event = lambda i, plan: (i, "u1", "k", "enter", "iOS", "isp", [plan], "")

    def write(day, kind, rows, drop=()):
        df = spark.createDataFrame(rows, f"eventID {kind}, {SEARCH}").drop("Date", *drop)
        df.write.parquet(f"{logs}/{day}")

    write("20220601", "string", [event("9", "late"), event("10", "first")])
    write("20220602", "bigint", [event(9, "a"), event(10, "b")])
    write("20220603", "int", [event(7, "c")], drop=("category",))
    write("20220604", "string", [event(None, "d")], drop=("eventID",))
    read = lambda a, b: sources.read_parquet_days(spark, logs, f"2022060{a}", f"2022060{b}")
    log = read(1, 4)
    assert log.count() == 6 and log.schema["eventID"].dataType.simpleString() == "struct<number:decimal(38,6),text:string>"
    assert log.agg(F.count("eventID")).head()[0] == 5 and log.filter("category IS NULL").count() == 1
    assert ops.search_profile(log).select("PlanName", "SearchCount").head() == ("first", 5)  # text: '10' before '9'
    numbers = read(2, 3)
    assert numbers.schema["eventID"].dataType.simpleString() == "decimal(38,0)"
    assert ops.search_profile(numbers).head()["PlanName"] == "a"
    assert read(1, 1).schema["eventID"].dataType.simpleString() == "string"
    assert read(4, 4).schema["eventID"].dataType.simpleString() == "string"


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_rule_tables(spark, limit):
    rules = spark.createDataFrame([("VOD", "B"), ("VOD", "A"), (None, "X"), ("N", None)], "code string, category string")
    log = spark.createDataFrame([("VOD", 1)] * 50 + [("N", 2), (None, 3), ("vod", 4)], "AppName string, Type int")
    got = ops.classify_by_table(log, "AppName", rules, "Other", broadcast_bytes=limit)
    assert got.columns == ["AppName", "Type"] and got.count() == 53
    assert got.filter("Type = 'A'").count() == 50 and got.filter("Type = 'Other'").count() == 3
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == bool(limit)
    assert VIEWS.unknown_app == "Other"


def test_distinct_sketches(spark):
    rows = spark.range(60_000).select(F.lit("big").alias("user"), (F.col("id") % 30_000).cast("string").alias("word"), (F.col("id") % 3).cast("string").alias("Date"))
    small = spark.createDataFrame([("small", w, d) for d in "012" for w in ["a", "b", None]] + [("none", None, "1")], rows.schema)
    sketches = ops.daily_distinct(rows.unionByName(small), "user", "word")
    got = {r["user"]: r["n"] for r in ops.distinct_over(sketches, "user", "0", "2", "n").collect()}
    assert got["small"] == 2 and "none" not in got and abs(got["big"] - 30_000) < 3 * 0.017 * 30_000
    got = {r["user"]: r["n"] for r in ops.distinct_over(sketches, "user", "1", "1", "n").collect()}
    assert got["small"] == 2 and abs(got["big"] - 10_000) < 3 * 0.017 * 10_000


@pytest.mark.parametrize("tracked", [16, 4096])
def test_frequent_values_are_proven_or_counted(spark, tracked):
    rng = random.Random(3)
    rows = [(f"v{min(int(rng.expovariate(0.05)), 300)}", str(rng.randint(0, 3))) for _ in range(5000)] + [("tie1", "2"), ("tie2", "2"), (None, "1")]
    log = spark.createDataFrame(rows, "value string, Date string")
    sketches = ops.daily_frequent(log, "value", tracked)
    for k, days in ((3, ("0", "3")), (10, ("1", "2")), (500, ("2", "2")), (5, ("8", "9"))):
        wanted = log.filter(F.col("Date").between(*days) & F.col("value").isNotNull()).groupBy("value").count()
        wanted = wanted.orderBy(F.col("count").desc(), "value").limit(k).collect()
        assert [tuple(r) for r in ops.frequent_over(sketches, log, "value", k, *days, tracked).collect()] == [tuple(r) for r in wanted]
