"""Joins and lookups that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more than HOT_ROWS rows and is among the HOT_KEYS most frequent; any other holds less than 1/HOT_KEYS of the rows.
HOT_KEYS = 2000
HOT_ROWS = 50_000


def hot_keys(df: DataFrame, key: str, keys: int = HOT_KEYS, rows: int = HOT_ROWS) -> list:
    """The hot keys, from one pass: counts are combined on the map side, and each task hands on its ``keys`` largest."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > rows)
    return [r[0] for r in counts.orderBy(F.col("count").desc(), key).limit(keys).collect()]


def lookup_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", rows: int = HOT_ROWS, n: int | None = None) -> DataFrame:
    """``left`` joined to ``right`` (unique on ``key``) by the shared column ``key``.

    Rows of hot keys meet a broadcast of the at most ``HOT_KEYS`` matching rows of
    ``right`` and never move; all other rows take the ordinary shuffle join.  ``left`` is
    read twice, so it should be a table; its number of rows, if known, is ``n``.
    ``how`` is inner, left, left_semi or left_anti.  Null keys match nothing.
    """
    hot = hot_keys(left, key, rows=rows) if n is None or n > rows else []
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return (
        left.where(is_hot).join(F.broadcast(right.where(F.col(key).isin(hot))), key, how)
        .unionByName(left.where(~is_hot).join(right.where(~F.col(key).isin(hot)), key, how))
    )
