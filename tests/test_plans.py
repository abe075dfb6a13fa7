"""The shape of the physical plans: what is scanned, shuffled and joined."""

import re

import pytest

from couchlog import operators as ops
from couchlog.plans import content_bundle, distribution, search_bundle, top_users
from couchlog.sources import write_table

VIEWS = "Contract string, AppName string, TotalDuration double, Date string, unused string"
SEARCHES = (
    "eventID long, user_id string, keyword string, category string, platform string, "
    "proxy_isp string, userPlansMap array<string>, Date string, unused string"
)


@pytest.fixture(scope="module")
def logs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    frames = []
    for name, schema in [("views", VIEWS), ("searches", SEARCHES)]:
        spark.createDataFrame([], schema).write.parquet(f"{root}/{name}")
        frames.append(spark.read.schema(schema).parquet(f"{root}/{name}"))
    return frames


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Subqueries")[0]


def shuffles(df):
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan(df))


def test_content_profile(spark, logs):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = ops.content_profile(logs[0], 4)
    own = [re.sub(r"#\d+", "", keys) for keys in shuffles(df)]
    # contract and day; odd durations by contract and bin; both come together by contract
    assert sorted(own) == ["Contract", "Contract", "Contract, Date", "Contract, _groupingexpression"]
    text = plan(df)
    assert text.count("Join") == 1 and "SortAggregate" not in text and text.count("ObjectHash") <= 2
    assert text.count("FileScan parquet") == 2 and "NestedLoop" not in text and "Cartesian" not in text
    for pushed in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", text):
        assert "Not(EqualTo(Contract,0))" in pushed and "In(AppName" in pushed
    assert "unused" not in text


def test_odd_durations_cost_a_usual_log_no_join(spark):
    """AQE drops the join when there is nothing to join."""
    log = spark.createDataFrame([("C1", "VOD", 1.5, "20220401", "")] * 3, VIEWS)
    df = ops.watch_totals(log)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final and "Join" not in final


def test_profile_from_a_folder_reads_staged_totals(logs, tmp_path):
    df = ops.content_profile(logs[0], folder=f"{tmp_path}/daily")
    text = df._jdf.queryExecution().toString()
    assert df.inputFiles() and all("/daily/" in name for name in df.inputFiles())
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_reports_share_one_read(logs, tmp_path):
    """All figures and charts are one scan of the written profile; the top table is the other."""
    views = write_table(ops.content_profile(logs[0], 4), f"{tmp_path}/views")
    searches = write_table(ops.search_profile(logs[1]), f"{tmp_path}/searches")
    for bundle in (content_bundle(views), search_bundle(searches)):
        text = plan(bundle)
        assert text.count("FileScan") == 2 and text.count("TakeOrderedAndProject") == 1 and "WindowGroupLimit" in text


@pytest.mark.parametrize("kind", ["long", "string"])
def test_search_profile(logs, kind):
    log = logs[1].withColumn("eventID", logs[1]["eventID"].cast(kind))
    df = ops.search_profile(log)
    assert len(shuffles(df)) == 6
    text = plan(df)
    assert text.count("FileScan parquet") == 3
    assert text.count("Not(EqualTo(user_id,))") == 3
    assert "Join [user_id" in text and "NestedLoop" not in text and "Cartesian" not in text
    assert "ObjectHash" not in text and "unused" not in text
    scans = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert sum("platform" in columns for columns in scans) == sum("keyword" in columns for columns in scans) == 1
    assert not any("platform" in columns and "eventID" in columns for columns in scans)


def test_raw_rows_are_counted_by_hash(logs):
    """Below the first shuffle nothing is sorted but events with a plan, and those only if their id is text."""
    text_ids = logs[1].withColumn("eventID", logs[1]["eventID"].cast("string"))
    for log, sorted_keys in ((logs[1], 0), (text_ids, 1)):
        lines = plan(ops.search_profile(log)).splitlines()
        partial = [line for line in lines if "SortAggregate" in line and "partial_" in line and "user_id" in line]
        raw = [line for line in partial if "partial_min(eventID" in line]
        assert len(raw) == sorted_keys
        assert not any("partial_count" in line for line in partial)


def test_behavior_expands_by_the_grouping_sets_only(logs):
    text = plan(ops.search_behavior(logs[1]))
    assert text.count("Expand") == 1 and text.count("FileScan parquet") == 1 and "SortAggregate" not in text


def test_main_value_shuffles_counts_only(logs):
    df = ops.main_value(logs[1], "user_id", "platform", "MainPlatform")
    assert [re.sub(r"#\d+", "", keys) for keys in shuffles(df)] == ["user_id", "user_id, platform"]
    assert "Join" not in plan(df)


def test_top_k_does_not_sort_everything(logs):
    profile = ops.search_profile(logs[1])
    assert "TakeOrderedAndProject" in plan(top_users(profile))
    assert "TakeOrderedAndProject" in plan(distribution(profile, "PlanName", "planName", "None", 10))
