"""Rule-driven classification of one column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def by_value(col: Column, codes: Mapping[str, Sequence[str]], default: str) -> Column:
    """Category whose code list holds the value exactly; `default` for other values and null."""
    return F.coalesce(
        *[F.when(col.isin(list(values)), F.lit(label)) for label, values in codes.items()],
        F.lit(default),
    )


def by_regex(col: Column, patterns: Mapping[str, str], default: str) -> Column:
    """Category of the first pattern found in the lower-cased value; `default` if none is."""
    text = F.lower(col)
    return F.coalesce(
        *[F.when(text.rlike(pattern), F.lit(label)) for label, pattern in patterns.items()],
        F.lit(default),
    )
