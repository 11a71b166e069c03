"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies: the source's
share of the mix over its own size.  The expected copies are summed along the
documents in order of size, one random offset is added, and a document is emitted
once per integer boundary its interval crosses.  Sorting by size spreads the sample
evenly over all sizes, so the tokens reached stay within about one document of the
target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.order import prefix_sums
from quillon.storage import Scratch


def mix_plan(sizes: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """``(source, target_share, max_repeat, documents, available, copies)`` per target source.

    ``copies`` is the expected number of copies of each document.  Without ``total``
    tokens given, the mix is the largest in which every source with tokens reaches its
    share within ``max_repeat``; with it, a source that cannot is capped.  Targets
    repeated for a source count once (the largest share), those with a null source,
    no positive share or no positive ``max_repeat`` are left out; a source without
    tokens gets 0 copies and the others keep their proportions.
    """
    wanted = (
        targets.where("source is not null and target_share > 0 and max_repeat > 0").groupBy("source")
        .agg(F.max("target_share").alias("target_share"), F.max_by("max_repeat", "target_share").alias("max_repeat"))
    )
    have = sizes.groupBy("source").agg(F.count("*").alias("documents"), F.sum("tokens").alias("available"))
    plan = wanted.join(have, "source", "left").fillna(0, ["documents", "available"])
    live = F.col("available") > 0
    whole = F.lit(float(total)) if total is not None else F.col("largest")
    bounds = plan.agg(
        F.min(F.when(live, F.col("max_repeat") * F.col("available") / F.col("target_share"))).alias("largest"),
        F.sum(F.when(live, F.col("target_share"))).alias("reachable"),
    )
    scale = whole if total is None else whole / F.col("reachable")
    return plan.join(F.broadcast(bounds)).select(
        "source", "target_share", "max_repeat", "documents", "available",
        F.when(live, F.least(F.col("max_repeat").cast("double"), F.col("target_share") * scale / F.col("available"))).otherwise(0.0).alias("copies"),
    )


def mix(docs: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 7) -> DataFrame:
    """``(source, doc_id, copy, tokens)``: the mix, one row for every copy of every document.

    ``docs`` has ``doc_id, source, tokens``.  Documents of sources without target, with
    a null source, and those of 0 tokens are not used.  No document is used more than
    ``max_repeat`` times.  The same seed gives the same mix.
    """
    spark = docs.sparkSession
    tmp = Scratch(spark, "mix")
    sizes = docs.select("doc_id", "source", F.col("tokens").cast("bigint").alias("tokens")).where("source is not null and tokens > 0")
    # One row per target source.
    plan = F.broadcast(mix_plan(sizes, targets, total).select("source", "copies").where("copies > 0"))
    placed = sizes.join(plan, "source").withColumn("spread", F.xxhash64(F.lit(seed), "doc_id"))
    summed = prefix_sums(placed.withColumn("one", F.lit(1).cast("bigint")), "source", ["tokens", "spread", "doc_id"], "one", tmp, "ranked")
    start = F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1 << 30)) / float(1 << 30)
    # Rank times copies is the prefix sum of a constant, without its rounding errors.
    n = (F.floor(F.col("upto") * F.col("copies") + start) - F.floor((F.col("upto") - 1) * F.col("copies") + start)).cast("int")
    return (
        summed.select("source", "doc_id", "tokens", n.alias("n")).where("n > 0")
        .select("source", "doc_id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"), "tokens")
    )


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, target_share, share, tokens, copies, most_used)``: what each target source reached."""
    used = mixed.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("copies"), F.max("copy").alias("most_used"))
    whole = used.agg(F.sum("tokens").alias("whole"))
    wanted = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"))
    return wanted.join(used, "source", "left").join(F.broadcast(whole)).select(
        "source", "target_share", F.coalesce(F.col("tokens") / F.col("whole"), F.lit(0.0)).alias("share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("copies", F.lit(0)).alias("copies"), F.coalesce("most_used", F.lit(0)).alias("most_used"),
    )
