"""Ranks and prefix sums over a total order, without a single-task window."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quillon.storage import Scratch


def prefix_sums(df: DataFrame, group: str, order: list[str], value: str, tmp: Scratch, name: str) -> DataFrame:
    """``df`` with ``upto``: the sum of ``value`` over the rows of its group up to and including this one.

    Rows are range-sorted by (group, order); each task sums its own rows, one row per
    task and group goes to the driver, and the offsets come back as a broadcast of
    that size.  ``order`` must be total within a group.  A group may span all tasks.
    """
    if {"part", "upto"} & set(df.columns):
        raise ValueError("columns 'part' and 'upto' are taken")
    schema = StructType([*df.schema.fields, StructField("part", LongType()), StructField("upto", df.schema[value].dataType)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, so_far = TaskContext.get().partitionId(), {}
        for pdf in batches:
            own = pdf.groupby(group, dropna=False, sort=False)[value].cumsum()
            before = pdf[group].map(lambda g: so_far.get(g, 0))
            pdf["part"] = part
            pdf["upto"] = own + before
            so_far |= pdf.groupby(group, dropna=False, sort=False)["upto"].last().to_dict()
            yield pdf

    keys = [group, *order]
    parts = tmp.put(df.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema), name)
    sums = sorted((r.g, r.part, r.s) for r in parts.groupBy(F.col(group).alias("g"), "part").agg(F.sum(value).alias("s")).collect())
    offsets, last, total = [], None, 0
    for g, part, s in sums:
        total = total if g == last else 0
        offsets.append((g, part, total))
        last, total = g, total + s
    if not offsets:
        return parts.drop("part")
    table = df.sparkSession.createDataFrame(offsets, StructType([StructField(group, df.schema[group].dataType), StructField("part", LongType()), StructField("offset", df.schema[value].dataType)]))
    return parts.join(F.broadcast(table), [group, "part"]).withColumn("upto", F.col("upto") + F.col("offset")).drop("part", "offset")
