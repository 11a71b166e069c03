"""Consolidating pairwise matches into groups: deterministic Borůvka hooking.

Each round every component selects its smallest outgoing edge – which is the edge to
its smallest neighbour –, the selected trees collapse onto their roots by pointer
doubling, and the edges are relabelled by root and deduplicated.  A component with
an edge left at least doubles, so there are O(log n) rounds of O(log n) doublings.
All state lives in tables of the shared folder; lookups split off hot components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.operators.skew import lookup_join
from quillon.storage import Scratch


def _collapse(tmp: Scratch, hook: DataFrame, turn: int) -> DataFrame:
    """Roots ``(c, p)`` of the trees given by the selected neighbours ``(c, p)``."""
    up = hook.select(F.col("c").alias("p"), F.col("p").alias("pp"))
    # The only loops are two components that selected each other: the smaller is the root.
    tree = lookup_join(hook, up, "p").select("c", F.when((F.col("pp") == F.col("c")) & (F.col("c") < F.col("p")), F.col("c")).otherwise(F.col("p")).alias("p"))
    tree, step = tmp.put(tree, f"tree-{turn}-0"), 0
    while True:
        up = tree.select(F.col("c").alias("p"), F.col("p").alias("pp"))
        jumped = lookup_join(tree, up, "p").select("c", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved"))
        step += 1
        jumped = tmp.put(jumped, f"tree-{turn}-{step}")
        tmp.drop(f"tree-{turn}-{step - 1}")
        tree = jumped.select("c", "p")
        if jumped.where("moved").isEmpty():
            return tree


def connected_groups(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, group_id)``: every id of a pair with the smallest id linked to it in any number of steps.

    Pairs with a null end tie nothing; an id paired only with itself is no group and
    gives no row; direction and repetition of pairs do not matter; other columns are
    ignored.  Ids compare as strings.
    """
    tmp = Scratch(pairs.sparkSession, "groups")
    ends = pairs.select(F.col(a).cast("string").alias("u"), F.col(b).cast("string").alias("v")).where("u <> v")
    edges = tmp.put(ends.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges-0")
    levels: list[DataFrame] = []
    while not edges.isEmpty():
        turn = len(levels)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = tmp.put(both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("p")), f"hook-{turn}")
        tree = _collapse(tmp, hook, turn)
        levels.append(tree)
        # Written, as the next join looks for hot keys in it first.
        half = tmp.put(lookup_join(edges, tree.select(F.col("c").alias("u"), F.col("p").alias("x")), "u").select("x", "v"), f"half-{turn}")
        full = lookup_join(half, tree.select(F.col("c").alias("v"), F.col("p").alias("y")), "v").where("x <> y")
        edges = tmp.put(full.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct(), f"edges-{turn + 1}")
        for name in (f"half-{turn}", f"edges-{turn}", f"hook-{turn}"):
            tmp.drop(name)
    if not levels:
        return edges.select(F.col("u").alias("id"), F.col("v").alias("group_id"))
    root = levels.pop().select("c", "p")
    while levels:
        up = root.select(F.col("c").alias("p"), F.col("p").alias("top"))
        root = lookup_join(levels.pop(), up, "p", "left").select("c", F.coalesce("top", "p").alias("p"))
    root = tmp.put(root, "roots")
    least = root.groupBy("p").agg(F.min("c").alias("group_id"))
    return lookup_join(root, least, "p").select(F.col("c").alias("id"), "group_id")


def page_groups(page: DataFrame, title_key, redirect_key) -> DataFrame:
    """``(id, group_id)`` of every page tied to another id by an equal title or by its redirect.

    ``title_key`` and ``redirect_key`` are the normalised title columns.  A null or
    empty key ties nothing, nor does a redirect that names no page's title; rows
    without id are ignored, rows delivered twice count once.
    """
    tmp = Scratch(page.sparkSession, "pages")
    base = tmp.put(
        page.select("id", F.nullif(title_key, F.lit("")).alias("title"), F.nullif(redirect_key, F.lit("")).alias("redirect"))
        .where("id is not null").distinct(), "base",
    )
    # Pages of one title stand for a single node, named by their smallest id.
    titles = tmp.put(
        base.where("title is not null").groupBy("title").agg(F.min("id").alias("node"), (F.min("id") != F.max("id")).alias("shared")), "titles"
    )
    nodes = tmp.put(lookup_join(base, titles, "title", "left").select("id", F.coalesce("node", "id").alias("node"), F.coalesce("shared", F.lit(False)).alias("shared"), "redirect"), "nodes")
    targets = titles.select(F.col("title").alias("redirect"), F.col("node").alias("target"))
    links = lookup_join(nodes.where("redirect is not null"), targets, "redirect").select("node", "target")
    groups = connected_groups(links, "node", "target").withColumnRenamed("id", "node")
    members = nodes.select("id", "node", "shared").distinct()
    return (
        lookup_join(members, groups, "node", "left")
        .select("id", F.coalesce("group_id", F.when(F.col("shared"), F.col("node"))).alias("group_id"))
        .where("group_id is not null")
    )
