"""Putting frames together: days below each other, per-user parts beside each other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_days(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all days, duplicates kept. Columns are matched by name, an absent one is null.

    Days that lie in one folder are better read by one multi-path scan (`couchlog.sources`).
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def attach_profiles(base: DataFrame, parts: Sequence[DataFrame], key: str = "user_id") -> DataFrame:
    """Left-join per-user parts to the base; users without a part keep nulls.

    Every part holds one row per key, so no key can be hot here. Join strategy is left to AQE.
    """
    return reduce(lambda left, part: left.join(part, key, "left"), parts, base)
