"""Daily sketches: distinct counts and most frequent values of any range of days, from a few KB per day and group.

Sketches of days are merged, so a report over another range reads sketches and no log. Distinct counts are
HyperLogLog estimates: exact for the few values that a user usually has, else with a relative standard error of
about 1.04 / sqrt(2^lg_k) (at 12: 1.6 %). Most frequent values come with a bound, by which the result is proven or
refused, and exact counts are taken for the proven ones only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12
TRACKED = 4096


def daily_distinct(log: DataFrame, key: str, value: str, lg_k: int = LG_K) -> DataFrame:
    """One sketch per key and day: key, Date, sketch. Nulls do not count."""
    return log.filter(F.col(value).isNotNull()).groupBy(key, "Date").agg(F.hll_sketch_agg(value, lg_k).alias("sketch"))


def distinct_over(sketches: DataFrame, key: str, start: str, end: str, alias: str) -> DataFrame:
    """Distinct values per key over the days from start to end, both included. Keys without a value in them have no row."""
    days = sketches.filter(F.col("Date").between(start, end))
    return days.groupBy(key).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch", False)).alias(alias))


def daily_frequent(log: DataFrame, value: str, tracked: int = TRACKED) -> DataFrame:
    """One sketch of the most frequent values per day: Date, sketch, n (rows with a value)."""
    held = log.filter(F.col(value).isNotNull())
    sketch = F.expr(f"approx_top_k_accumulate(`{value}`, {tracked})")
    return held.groupBy("Date").agg(sketch.alias("sketch"), F.count("*").alias("n"))


def frequent_over(sketches: DataFrame, exact: DataFrame, value: str, k: int, start: str, end: str, tracked: int = TRACKED) -> DataFrame:
    """The k most frequent values over the days from start to end: value, count; most frequent first, ties by value.

    Candidates come from the merged sketch and are counted exactly in `exact`, a log or its daily counts with a
    column n. A value that the sketch has lost occurs at most 4 n / tracked times (its own bound is 3.5), and one that
    it holds no more often than it says: a k-th candidate above both proves that no other value
    belongs to the result. Where that does not hold, all values are counted.
    """
    days = F.col("Date").between(start, end)
    # grouped by a constant, since sketches of no day at all cannot be merged
    merged = sketches.filter(days).groupBy(F.lit(1)).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("n"))
    asked = min(tracked, 4 * k)
    found = merged.select(F.expr(f"inline(approx_top_k_estimate(sketch, {asked}))"), "n")
    candidates = found.select("item", F.col("count").alias("most"), "n").collect()  # at most 4 k
    rows = exact.filter(days & F.col(value).isNotNull())
    amount = F.sum("n") if "n" in exact.columns else F.count("*")
    order = [F.col("count").desc(), F.col(value)]

    def counted(df: DataFrame) -> DataFrame:
        return df.groupBy(value).agg(amount.cast("bigint").alias("count")).orderBy(*order).limit(k)

    if not candidates:
        return counted(rows)
    others = max(4 * candidates[0]["n"] // tracked, min(r["most"] for r in candidates) if len(candidates) == asked else 0)
    top = counted(rows.filter(F.col(value).isin([r["item"] for r in candidates])))
    counts = [r["count"] for r in top.collect()]  # k numbers
    return top if not others or (len(counts) == k and counts[-1] > others) else counted(rows)
