"""Joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key counts as hot from this share of all rows on, so there are never more
# than 1 / HOT_SHARE of them and their list can always be broadcast.
HOT_SHARE = 1.0 / 1000


def hot_keys(counts: DataFrame, key: str, count: str, total: int, share: float = HOT_SHARE) -> DataFrame:
    """The at most ``1 / share`` keys with at least ``share`` of ``total`` rows."""
    return counts.filter(F.col(count) >= F.lit(max(total * share, 1.0))).select(key)


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    hot: DataFrame,
    spread_by: str,
    salts: int = 64,
    how: str = "inner",
) -> DataFrame:
    """Join ``facts`` to ``lookup`` (one row per ``key``), spreading the hot keys.

    A hot key's facts are divided over ``salts`` join keys by ``spread_by``
    and its lookup row is repeated for each; all other keys join as usual.
    ``hot`` has to come from :func:`hot_keys`, which bounds its size.
    """
    marked = F.broadcast(hot.select(F.col(key), F.lit(True).alias("_hot")))
    left = facts.join(marked, key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(salts))).otherwise(F.lit(0).cast("bigint"))
    )
    every_salt = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    right = lookup.join(marked, key, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every_salt).otherwise(F.array(F.lit(0).cast("bigint"))))
    )
    return left.drop("_hot").join(right.drop("_hot"), [key, "_salt"], how).drop("_salt")
