"""Row-wise expressions of the customer profiles and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def top_label(cols: Sequence[Column], labels: Sequence[str]) -> Column:
    """Label of the largest column; on a tie the earliest one in the given order."""
    position = F.array_position(F.array(*cols), F.greatest(*cols)).cast("int")
    return F.element_at(F.array(*[F.lit(label) for label in labels]), position)


def combo_label(cols: Sequence[Column], labels: Sequence[str], empty: str, sep: str = "-") -> Column:
    """Labels of all columns above zero, joined in order; `empty` if there is none."""
    joined = F.concat_ws(sep, *[F.when(c > 0, F.lit(label)) for c, label in zip(cols, labels)])
    return F.when(joined == "", F.lit(empty)).otherwise(joined)


def activity_tier(days: Column, limit: Column | int, inclusive: bool) -> Column:
    """High if the day count is above the limit (or equal to it when inclusive), else Low."""
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    active = days >= limit if inclusive else days > limit
    return F.when(active, F.lit("High")).otherwise(F.lit("Low"))


def half_up(col: Column, digits: int) -> Column:
    """Round half up on the decimal value, so that 1.005 gives 1.01 whatever its binary form."""
    return F.round(col.cast("decimal(38,10)"), digits).cast("double")


def ratio(part: Column, whole: Column, digits: int) -> Column:
    """part / whole, rounded; null where whole is 0."""
    return F.round(F.try_divide(part, whole), digits)


def share_percent(part: Column, whole: Column) -> Column:
    """Whole percentage, halves up; null where whole is 0."""
    share = F.try_divide(part.cast("double"), whole.cast("double"))
    return F.floor(share * 100 + F.lit(0.5))


def plan_name(raw: Column) -> Column:
    """Text before the first colon; the whole text if there is none."""
    return F.substring_index(raw, ":", 1)
