import random
import struct
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from couchlog import operators as ops
from couchlog.rules import ViewRules

VIEWS = "Contract string, AppName string, TotalDuration double, Date string"


def views(spark, rows, schema=VIEWS):
    return spark.createDataFrame(rows, schema)


def profile_of(spark, rows, limit=4):
    return {r["Contract"]: r for r in ops.content_profile(views(spark, rows), limit).collect()}


@pytest.mark.parametrize(
    "app, category",
    [
        ("VOD", "Phim_Truyen"),
        ("FIMS", "Phim_Truyen"),
        ("KPLUS", "The_Thao"),
        ("SPORT", "The_Thao"),
        ("CHANNEL", "Truyen_Hinh"),
        ("RELAX", "Giai_Tri"),
        ("CHILD", "Thieu_Nhi"),
        ("vod", "Other"),
        ("BHD", "Other"),
        (None, "Other"),
    ],
)
def test_app_category(spark, app, category):
    log = views(spark, [("C1", app, 1.0, "20220401")])
    assert ops.classify_app(log).head()["Type"] == category
    assert ops.filter_contract(log).count() == (0 if category == "Other" else 1)


def test_contract_filter(spark):
    log = views(spark, [(c, "VOD", 1.0, "20220401") for c in ["0", None, "", "00", "C1"]])
    kept = {r["Contract"] for r in ops.filter_contract(log).collect()}
    assert kept == {"", "00", "C1"}


def test_tie_goes_to_the_first_category(spark):
    rows = [("C1", "SPORT", 5.0, "20220401"), ("C1", "RELAX", 5.0, "20220401")]
    assert profile_of(spark, rows)["C1"]["MostWatch"] == "Giai_Tri"


def test_all_zero(spark):
    got = profile_of(spark, [("C1", "SPORT", 0.0, "20220401")])["C1"]
    assert (got["MostWatch"], got["Taste"]) == ("Giai_Tri", "None")


def test_missing_duration_counts_as_zero(spark):
    rows = [("C1", "SPORT", None, "20220401"), ("C1", "VOD", float("nan"), "20220401"), ("C1", "VOD", 2.0, "20220401")]
    got = profile_of(spark, rows)["C1"]
    assert (got["Total_The_Thao"], got["Total_Phim_Truyen"], got["Taste"]) == (0.0, 2.0, "Phim Truyen")


def test_taste_lists_watched_categories_in_order(spark):
    rows = [("C1", "KPLUS", 1.0, "20220401"), ("C1", "RELAX", 3.0, "20220401")]
    got = profile_of(spark, rows)["C1"]
    assert (got["Taste"], got["MostWatch"]) == ("Giai Tri-The Thao", "Giai_Tri")


def test_activity_is_high_above_the_limit(spark):
    days = [f"2022040{d}" for d in range(1, 6)]
    rows = [("C4", "VOD", 1.0, d) for d in days[:4]] + [("C5", "VOD", 1.0, d) for d in days]
    rows += [("C4", "BHD", 1.0, days[4]), ("C5", "VOD", 1.0, days[0])]
    got = profile_of(spark, rows, 4)
    assert (got["C4"]["Active"], got["C5"]["Active"]) == ("Low", "High")


@pytest.mark.parametrize("days, limit", [(7, 4), (8, 15)])
def test_limit_follows_the_days_read(spark, days, limit):
    """Days count as read although no row of theirs counts."""
    rows = [("0", "VOD", 1.0, f"202204{d:02d}") for d in range(1, days + 1)]
    log = views(spark, rows + [("C1", "VOD", 1.0, "20220401")])
    assert ops.days_covered(log).head()["days"] == days
    assert spark.range(1).select(ops.day_limit(log).alias("n")).head()["n"] == limit


def test_daily_totals_give_the_same_profile(spark):
    rows = [("C1", "VOD", 1.5, "20220401"), ("C1", "BHD", 1.0, "20220402"), ("0", "VOD", 1.0, "20220403")]
    log = views(spark, rows)
    daily = ops.daily_totals(log, keep_invalid=True)
    assert ops.days_covered(daily).head()["days"] == 3
    direct, staged = ops.content_profile(log, 0), ops.profile_from_daily(daily, 0)
    assert direct.collect() == staged.collect()


def test_whole_number_and_decimal_durations(spark):
    for kind in ["long", "int", "decimal(10,2)", "float", "string"]:
        log = views(spark, [("C1", "VOD", 2.5, "20220401"), ("C1", "VOD", 4.0, "20220402")])
        log = log.withColumn("TotalDuration", F.col("TotalDuration").cast(kind))
        want = 6.0 if kind in ("long", "int") else 6.5
        assert ops.content_profile(log, 4).head()["Total_Phim_Truyen"] == want


def test_sums_do_not_depend_on_row_order(spark):
    """0.1 + 0.2 + 0.3 differs from 0.3 + 0.2 + 0.1 in binary floating point."""
    rows = [("C1", "VOD", v, "20220401") for v in [0.1, 0.2, 0.3, 1e9, 0.7]]
    results = {
        ops.watch_totals(views(spark, order).repartition(n)).head()["Total_Phim_Truyen"]
        for order in (rows, rows[::-1])
        for n in (1, 3)
    }
    assert results == {1000000001.3}


def test_large_and_fine_durations_are_exact(spark):
    rows = [("big", "VOD", 1e17, "20220401"), ("big", "VOD", 3.0, "20220402"), ("fine", "VOD", 0.0004, "20220401")]
    rows += [("many", "VOD", 0.0001, f"202204{d:02d}") for d in range(1, 11)]
    got = profile_of(spark, rows)
    assert got["big"]["Total_Phim_Truyen"] == 1e17 + 3
    assert (got["fine"]["Total_Phim_Truyen"], got["fine"]["MostWatch"], got["fine"]["Taste"]) == (0.0004, "Phim_Truyen", "Phim Truyen")
    assert got["many"]["Total_Phim_Truyen"] == 0.001


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("values", [[float("inf")], [float("-inf"), 1.0], [1.7e308, 1.7e308]])
def test_a_sum_out_of_range_raises(spark, ansi, values):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="out of range"):
            profile_of(spark, [("C1", "VOD", v, f"2022040{k}") for k, v in enumerate(values)])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def random_double(rng):
    kind = rng.random()
    if kind < 0.3:
        return rng.choice([1, -1]) * rng.randint(0, 10**6) / 1000
    if kind < 0.6:
        return rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randint(-30, 30)
    if kind < 0.8:
        return rng.choice([1e-19, -1e-19, 1e20, -1e20, 0.1, 1e17, 9e19, 5e-324, 1.7e308, -1.7e308, 123456789.123456789, -0.0])
    return struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64) & ~(1 << 62)))[0]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_of_any_doubles_are_exact(spark, ansi, tmp_path):
    """The exact sum of the decimals that the doubles are written as, rounded once, in any order and by any route."""
    rng = random.Random(8)
    rows = []
    for k in range(160):
        for j in range(rng.randint(1, 12)):
            rows.append((f"C{k}", rng.choice(["VOD", "SPORT", "FIMS"]), random_double(rng), f"202204{rng.randint(1, 4):02d}"))
    rows += [("back", "VOD", v, "20220401") for v in (1e20, 1e-19, -1e20)] + [("tiny", "VOD", 1e-19, "20220401")]
    rows += [("neg", "VOD", v, "20220401") for v in (-0.0005, -3.0)] + [("two", "VOD", v, "20220401") for v in (9e19, 9e19)]
    exact = defaultdict(lambda: [Fraction(0), Fraction(0)])
    for c, app, v in views(spark, rows).select("Contract", "AppName", F.col("TotalDuration").cast("string")).collect():
        if v != "NaN":
            exact[c][app == "SPORT"] += Fraction(v)
    exact = {c: v for c, v in exact.items() if max(map(abs, v)) < Fraction(1.7e308)}
    wanted = {c: tuple(float(x) for x in v) for c, v in exact.items()}
    rows = [r for r in rows if r[0] in wanted]
    assert wanted["back"] == (1e-19, 0.0) and wanted["two"] == (1.8e20, 0.0) and len(wanted) > 60
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        found = []
        for order, parts in ((rows, 1), (rng.sample(rows, len(rows)), 5))[: 2 if ansi == "true" else 1]:
            log = views(spark, order).repartition(parts)
            daily = ops.daily_totals(log, keep_invalid=True)
            merged = ops.merged_daily(daily.unionByName(daily.limit(0)), "Contract", "Date")
            routes = [ops.watch_totals(log), ops.content_profile(log, 4), ops.content_profile(log, folder=f"{tmp_path}/{parts}"), ops.profile_from_daily(merged, 4)]
            found += [{r["Contract"]: (r["Total_Phim_Truyen"], r["Total_The_Thao"]) for r in df.collect()} for df in routes]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert all(f == wanted for f in found)
    tiny = profile_of(spark, [("tiny", "VOD", 1e-19, "20220401")])["tiny"]
    assert tiny["Taste"] == "Phim Truyen" and tiny["Total_Phim_Truyen"] == 1e-19


@pytest.mark.parametrize("kind", ["decimal(38,18)", "decimal(20,0)", "decimal(5,5)", "bigint", "string"])
def test_sums_of_other_types_are_exact(spark, kind):
    values = {"decimal(38,18)": ["12345678901234567890.123456789012345678", "-0.000000000000000001", "7.5"], "decimal(20,0)": ["99999999999999999999", "1"]}
    values |= {"decimal(5,5)": ["0.12345", "0.00001", "-0.1"], "bigint": [str(2**63 - 1), str(2**63 - 1), "5"], "string": ["1e20", " 3 ", "x", "1e-19"]}
    log = views(spark, [("C1", "VOD", None, "20220401")]).drop("TotalDuration")
    log = log.crossJoin(spark.createDataFrame([(v,) for v in values[kind]], "TotalDuration string"))
    log = log.withColumn("TotalDuration", F.col("TotalDuration").cast(kind))
    wanted = float(sum(Fraction(v.strip()) for v in values[kind] if v != "x"))
    assert ops.watch_totals(log).head()["Total_Phim_Truyen"] == ops.content_profile(log).head()["Total_Phim_Truyen"] == wanted


def test_invalid_rows_make_one_row_a_day(spark):
    rows = [(c, "VOD", 1.0, d) for c in ["0", None] for d in ["20220401", "20220402"]] + [(f"C{k}", "BHD", 1.0, "20220401") for k in range(9)]
    daily = ops.daily_totals(views(spark, rows), keep_invalid=True)
    assert daily.count() == 2 and ops.days_covered(daily).head()["days"] == 2


def test_other_rules(spark):
    rules = ViewRules({"A_b": ["X"], "C": ["Y", "VOD"]}, invalid_contract="-", week_limit=0)
    rows = [("0", "X", 1.0, "20220401"), ("0", "VOD", 2.0, "20220401"), ("-", "X", 9.0, "20220401"), ("1", "SPORT", 9.0, "20220401")]
    assert [tuple(r) for r in ops.content_profile(views(spark, rows), rules=rules).collect()] == [("0", 1.0, 2.0, "C", "A b-C", "High")]
    with pytest.raises(ValueError):
        ViewRules({"A": ["X"]}, ["A", "B"])
