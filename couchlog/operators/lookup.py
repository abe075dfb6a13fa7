"""Classification by a rule table, for lists of codes that are too long to be written into a plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A rule table of up to so many bytes (measured, not estimated) is sent to every task.
BROADCAST_BYTES = 32 << 20
_SALTS = 32


def rule_table(rules: DataFrame, code: str = "code", category: str = "category") -> DataFrame:
    """One row per code (`code`, `category`): rules without a code go, and of several for one code the smallest category holds."""
    return rules.filter(F.col(code).isNotNull()).groupBy(F.col(code).alias("code")).agg(F.min(category).alias("category"))


def table_bytes(table: DataFrame) -> int:
    """Bytes of the text in a rule table, and 32 a row for what goes with it."""
    size = F.sum(F.coalesce(F.octet_length("code"), F.lit(0)) + F.coalesce(F.octet_length("category"), F.lit(0)) + 32)
    return table.agg(size).first()[0] or 0


def classify_by_table(
    df: DataFrame,
    column: str,
    rules: DataFrame,
    default: str,
    name: str = "Type",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the category of the rule whose code equals the column exactly; `default` for other values, null, and rules
    without a category.

    The rules are measured first. Small ones are broadcast. Others are joined by a shuffle, with the rules
    repeated `_SALTS` times, so that a code which most rows share is spread over as many tasks.
    """
    table = rule_table(rules)
    label = F.coalesce("_category", F.lit(default)).alias(name)
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]
    if table_bytes(table) <= broadcast_bytes:
        small = F.broadcast(table.toDF("_code", "_category"))
        return df.join(small, F.col(f"`{column}`") == F.col("_code"), "left").select(*kept, label)
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    salted = table.select(F.col("code").alias("_code"), F.col("category").alias("_category"), salts.alias("_salt"))
    own = F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS)).cast("int")
    keyed = df.withColumn("_own", own)
    on = (F.col(f"`{column}`") == F.col("_code")) & (F.col("_own") == F.col("_salt"))
    return keyed.join(salted.hint("shuffle_hash"), on, "left").select(*kept, label)
