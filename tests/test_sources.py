import os

import pytest

from couchlog import operators as ops
from couchlog import plans, sources
from couchlog.sources import NoDataError

LINE = '{"_index":"history","_id":"1","_score":0,"_source":{"Contract":"%s","AppName":"VOD","TotalDuration":%s}}\n'


def write(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


@pytest.fixture
def logs(tmp_path):
    root = str(tmp_path / "a b+c")
    write(root, "20220404.json", LINE % ("C1", "120") + "{broken\n" + LINE % ("C1", "1.5"))
    write(root, "20220404_b.json", LINE % ("C2", "7"))
    write(root, "20220405.json/part-0.json", LINE % ("C1", "1"))
    write(root, "20220405.json/part-1.json", LINE % ("C3", "2"))
    write(root, "20220406.json", "{broken\n{broken too\n")
    write(root, "20220407.json", "")
    write(root, "20220408.json", '{"other":{"Contract":"C9"}}\n')
    write(root, "20220409 x.json", '{"_source":{"AppName":"VOD","extra":1,"Contract":"C4"}}\n')
    write(root, "x.json", LINE % ("C9", "1"))
    write(root, "1234567.json", LINE % ("C9", "1"))
    write(root, "20220410.txt", LINE % ("C9", "1"))
    return root


def test_daily_json(spark, logs):
    rows = sorted((r["Date"], r["Contract"], r["TotalDuration"]) for r in sources.read_daily_json(spark, logs).collect())
    assert rows == [
        ("20220404", "C1", 1.5),
        ("20220404", "C1", 120.0),
        ("20220404_b", "C2", 7.0),
        ("20220405", "C1", 1.0),
        ("20220405", "C3", 2.0),
        ("20220409 x", "C4", None),
    ]
    assert ops.days_covered(sources.read_daily_json(spark, logs + "/")).head()["days"] == 4


def test_no_daily_json(spark, tmp_path):
    with pytest.raises(NoDataError):
        sources.read_daily_json(spark, str(tmp_path))


def test_flatten_drops_the_envelope(spark):
    df = spark.createDataFrame([(1, ("C1", 2.0)), (2, None)], "_id int, _source struct<Contract:string, v:double>")
    assert [tuple(r) for r in sources.flatten_envelope(df).collect()] == [("C1", 2.0)]


FIELDS = "eventID long, user_id string, keyword string"


@pytest.fixture
def days(spark, tmp_path):
    root = str(tmp_path / "search")
    for day, key in [("20220601", 1), ("20220602", 2), ("20220604", 4), ("20220605", 5)]:
        frame = spark.createDataFrame([(key, "u", f"k{key}")], FIELDS)
        frame = frame.select("keyword", "user_id", "eventID") if key == 2 else frame
        frame = frame.drop("keyword") if key == 4 else frame
        frame.write.parquet(f"{root}/{day}")
    write(root, "notes/readme.txt", "x")
    write(root, "20220699/part-0.parquet", "not a date, so never opened")
    return root


def test_day_range_includes_both_ends_and_skips_gaps(spark, days):
    log = sources.read_parquet_days(spark, days, "20220602", "20220605", FIELDS)
    rows = sorted((r["Date"], r["eventID"], r["keyword"]) for r in log.collect())
    assert rows == [("20220602", 2, "k2"), ("20220604", 4, None), ("20220605", 5, "k5")]
    assert all(f"/{day}/" in "".join(log.inputFiles()) for day in ["20220602", "20220604", "20220605"])
    assert "/20220601/" not in "".join(log.inputFiles())


def test_day_range_with_merged_schema(spark, days):
    log = sources.read_parquet_days(spark, days, "20220601", "20220605", None, merge_schema=True)
    assert {r["Date"]: r["keyword"] for r in log.collect()}["20220604"] is None
    assert set(log.columns) == {"eventID", "user_id", "keyword", "Date"}


def test_day_range_errors(spark, days):
    assert sources.read_parquet_days(spark, days, "20220601", "20220714", FIELDS).count() == 4
    for start, end in [("20220605", "20220601"), ("20230101", "20230102")]:
        with pytest.raises(NoDataError):
            sources.read_parquet_days(spark, days, start, end, FIELDS)
    with pytest.raises(ValueError):
        sources.read_parquet_days(spark, days, "2022-06-01", "20220605", FIELDS)


def test_unreadable_parquet_day_fails(spark, days):
    write(days, "20220603/part-0.parquet", "this is not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        sources.read_parquet_days(spark, days, "20220601", "20220605", FIELDS).count()


def test_union_days_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2), ("y", 2)], "b string, a int")
    c = spark.createDataFrame([(3,)], "a int")
    rows = sorted((r["a"], r["b"]) for r in ops.union_days([a, b, c]).collect())
    assert rows == [(1, "x"), (2, "y"), (2, "y"), (3, None)]


def test_content_job(spark, logs, tmp_path):
    target, sunk = str(tmp_path / "profile"), []
    profile = plans.content_job(spark, logs, target, sink=sunk.append)
    assert {r["Contract"]: r["Active"] for r in profile.collect()} == dict.fromkeys(["C1", "C2", "C3", "C4"], "Low")
    assert sunk == [profile]
    assert sorted(spark.read.parquet(target).collect()) == sorted(profile.collect())
    assert plans.preview(profile, 2).count() == 2
    assert len(plans.content_reports(profile)) == 5


def test_content_job_without_readable_day(spark, tmp_path):
    write(str(tmp_path / "logs"), "20220406.json", "{broken\n")
    with pytest.raises(NoDataError):
        plans.content_job(spark, str(tmp_path / "logs"), str(tmp_path / "target"))
    assert not os.path.exists(tmp_path / "target")


def test_search_job(spark, tmp_path):
    schema = sources.SEARCH_SCHEMA
    rows = [("1", "u", "vtv", "quit", "iOS", "isp", ["p:1"]), ("2", "", "x", None, None, None, None)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "logs/20220601"))
    profile = plans.search_job(spark, str(tmp_path / "logs"), "20220601", "20220714", str(tmp_path / "target"))
    got = profile.collect()
    assert len(got) == 1 and len(profile.columns) == 19
    assert (got[0]["user_id"], got[0]["PlanName"], got[0]["QuitRate"]) == ("u", "p", 1.0)
    assert len(plans.search_reports(profile)) == 7


def test_failing_sink_fails_the_job(spark, logs, tmp_path):
    def sink(profile):
        raise RuntimeError("no connection")

    with pytest.raises(RuntimeError, match="no connection"):
        plans.content_job(spark, logs, str(tmp_path / "profile"), sink=sink)


def shared_folders(spark):
    return set(os.listdir(spark.conf.get("spark.checkpoint.dir")))


def test_nothing_staged_is_left(spark, logs, tmp_path):
    before = shared_folders(spark)
    plans.content_job(spark, logs, str(tmp_path / "profile"))
    write(str(tmp_path / "empty"), "20220406.json", "{broken\n")
    with pytest.raises(NoDataError):
        plans.content_job(spark, str(tmp_path / "empty"), str(tmp_path / "none"))
    assert shared_folders(spark) == before


def test_no_shared_folder_is_an_error(spark, monkeypatch):
    from types import SimpleNamespace

    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sources.stage_root(session)


def test_durations_written_as_text(spark, tmp_path):
    write(str(tmp_path), "20220404.json", "".join(LINE % ("C1", v) for v in ['"120"', "1.5", '"0.25"', '"x"', "null", '""', "1e2"]))
    rows = sources.read_daily_json(spark, str(tmp_path))
    assert dict(rows.dtypes)["TotalDuration"] == "double"
    assert sorted(r["TotalDuration"] for r in rows.collect() if r["TotalDuration"] is not None) == [0.25, 1.5, 100.0, 120.0]
    assert ops.content_profile(rows, 4).head()["Total_Phim_Truyen"] == 221.75


def test_job_reports_the_days(spark, logs, tmp_path):
    seen = {}
    plans.content_job(spark, logs, str(tmp_path / "p"), on_days=lambda df: seen.update({r["Date"]: r["read"] for r in df.collect()}))
    read = {"20220404": True, "20220404_b": True, "20220405": True, "20220409 x": True}
    assert seen == read | {"20220406": False, "20220407": False, "20220408": False}


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_search_job_takes_ids_as_stored(spark, tmp_path, kind):
    rows = [(9, 7, "vtv", ["nine"]), (10, 7, "phim", ["ten"])]
    df = spark.createDataFrame(rows, "eventID int, user_id int, keyword string, userPlansMap array<string>")
    df.withColumn("eventID", df["eventID"].cast(kind)).write.parquet(str(tmp_path / "logs/20220601"))
    seen = {}
    profile = plans.search_job(
        spark, str(tmp_path / "logs"), "20220601", "20220714", str(tmp_path / "target"),
        on_days=lambda d: seen.update({r["Date"]: r["read"] for r in d.collect()}),
    )
    got = profile.head()
    assert (got["user_id"], got["SearchCount"], got["PlanName"]) == ("7", 2, "ten" if kind == "string" else "nine")
    assert seen == {"20220601": True}


def test_stage_root_is_shared(spark):
    assert sources.stage_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert sources.stage_root(spark) != sources.stage_root(spark)
