"""Parent–child links to full hierarchies by tree contraction.

Rounds alternate two contractions until no edge is left: *rake* removes every node
without children, *compress* splices out nodes with a single child whose per-round
hash is below those of child and parent.  No two neighbours are, and in a chain one
in three is, so a chain of length n takes O(log n) rounds, and each holds a constant
share less than the one before.  Each round is one written table of what is left and
what was removed, a record of node, parent and distance; replaying the records
backwards gives each node root, depth and, on request, its path.  Contraction also
carries how many nodes hang on each node and on each spliced edge, and how far the
farthest, so that numbers of descendants and heights come out of the same records
without any path.  A loop cannot be raked away: compression shrinks it to a self-edge,
its core, which exposes it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.operators.skew import lookup_join
from quillon.storage import Scratch

CYCLE = "cycle"


def _rank(node: str, turn: int) -> Column:
    """Differs between rounds; ties, which block both nodes, do so for one round only."""
    return F.xxhash64(F.lit(turn), F.col(node))


def hierarchy(edges: DataFrame, child: str = "child", parent: str = "parent", with_paths: bool = False, loop_paths: bool = False) -> DataFrame:
    """One row ``(id, root_id, depth[, path])`` for each distinct child id.

    ``root_id`` is the last id reached by going up and ``depth`` the number of steps;
    nodes on a loop or below one get root ``cycle`` and depth -1.  With ``with_paths``
    an ``array<string>`` from the root down to the id follows (null for ``cycle``).
    With ``loop_paths`` as well, the path of a node below a loop runs once round the loop,
    from the loop node after the one it hangs on, and then down to the id; only nodes on
    a loop keep a null path.
    Rows with a null child or parent are no edges; repeated edges count once; of
    several parents the smallest is followed (``rejected_parents`` lists the others); other columns are ignored; an empty
    table gives an empty result.
    """
    tmp = Scratch(edges.sparkSession, "hierarchy")
    extra = {"via": F.array().cast("array<string>")} if with_paths else {}
    first, turns, cores = _contract(tmp, _edges(edges, child, parent), extra)
    found = _replay(tmp, first, turns, cores, with_paths, with_paths and loop_paths)
    return _round_loops(tmp, found, cores) if with_paths and loop_paths else found


def _edges(edges: DataFrame, child: str, parent: str) -> DataFrame:
    return (
        edges.select(F.col(child).cast("string").alias("v"), F.col(parent).cast("string").alias("p"))
        .where("v is not null and p is not null").groupBy("v").agg(F.min("p").alias("p"))
    )


def rejected_parents(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """``(child, parent)`` of the links ``hierarchy`` does not follow: all but the smallest parent of each child."""
    pairs = edges.select(F.col(child).cast("string").alias("child"), F.col(parent).cast("string").alias("parent")).where("child is not null and parent is not null").distinct()
    followed = pairs.groupBy("child").agg(F.min("parent").alias("followed"))
    return pairs.join(followed, "child").where("parent <> followed").select("child", "parent")


_LIVE, _CORE, _RAKED, _SPLICED = range(4)
#: What hangs on a node (n: nodes, itself included; h: steps to the farthest) and on its edge through spliced nodes (w; hh; gg: spliced nodes themselves left out).
_LOADS = {"n": "bigint", "h": "bigint", "w": "bigint", "hh": "bigint", "gg": "bigint"}
_FAR = -(1 << 40)


def _contract(tmp: Scratch, edges: DataFrame, extra: dict[str, Column]) -> tuple[DataFrame, list[tuple[DataFrame, dict[int, int]]], DataFrame]:
    """The edges, the table of each round with its rows by kind, and the cores that are left.

    ``extra`` are the columns carried along: ``via`` (nodes spliced into the edge) or those of ``_LOADS``.
    """
    loads, via = "n" in extra, "via" in extra
    first = tmp.put(edges, "edges")
    now = first.select("v", "p", F.lit(1).cast("bigint").alias("d"), F.when(F.col("v") == F.col("p"), _CORE).otherwise(_LIVE).alias("kind"), *[c.alias(k) for k, c in extra.items()])
    turns: list[tuple[DataFrame, dict[int, int]]] = []
    rows = {_LIVE: 1}
    while rows.get(_LIVE) or loads and rows.get(_RAKED):
        turn = len(turns)
        sums = [F.count_if(F.col("kind") == _LIVE).alias("kids"), F.max(F.when(F.col("kind") == _LIVE, F.col("v"))).alias("kid")]
        if loads:
            raked = F.col("kind") == _RAKED
            sums += [F.sum(F.when(raked, F.col("n") + F.col("w"))).alias("more_n"), F.max(F.when(raked, F.greatest(F.col("h") + F.col("d"), "hh"))).alias("more_h")]
        below = now.where(F.col("kind") != _CORE).groupBy(F.col("p").alias("v")).agg(*sums)
        state = now.where(F.col("kind") < _RAKED).join(below, "v", "left")
        if loads:
            state = state.withColumn("n", F.col("n") + F.coalesce("more_n", F.lit(0))).withColumn("h", F.greatest("h", F.coalesce("more_h", F.lit(0)))).drop("more_n", "more_h")
        state = state.withColumn("kids", F.coalesce("kids", F.lit(0))).withColumn(
            "chosen", (F.col("kind") == _LIVE) & (F.col("kids") == 1) & (_rank("v", turn) < _rank("kid", turn)) & (_rank("v", turn) < _rank("p", turn))
        )
        # What a spliced node hands to its only child, raked in the same round or not: neither end of its edge is spliced as well.
        cols = ["d", *extra]
        spliced = state.where("chosen").select(F.col("kid").alias("v"), F.col("v").alias("mid"), F.col("p").alias("up"), *[F.col(c).alias("m_" + c) for c in cols])
        both = state.where("not chosen").join(spliced, "v", "left")
        cut = F.col("mid").isNotNull()
        new_p, new_d = F.coalesce("up", "p"), F.col("d") + F.coalesce("m_d", F.lit(0))
        kind = F.when((F.col("kind") == _LIVE) & (F.col("kids") == 0), _RAKED).when(F.col("v") == new_p, _CORE).otherwise(F.col("kind"))
        kept = {"v": F.col("v"), "p": new_p, "d": new_d, "kind": kind}
        gone = {"v": F.col("mid"), "p": F.col("up"), "d": F.col("m_d"), "kind": F.lit(_SPLICED)}
        if via:
            kept["via"] = F.when(cut, F.concat("m_via", F.array("mid"), "via")).otherwise(F.col("via"))
            gone["via"] = F.col("m_via")
        if loads:
            kept |= {"n": F.col("n"), "h": F.col("h"), "w": F.col("w") + F.coalesce(F.col("m_n") + F.col("m_w"), F.lit(0))}
            hung = F.when(F.col("m_n") > 1, F.col("m_h")).otherwise(F.lit(_FAR).cast("bigint"))
            kept["hh"] = F.when(cut, F.greatest(F.col("hh") + F.col("m_d"), F.col("m_h") + F.col("m_d"), "m_hh")).otherwise(F.col("hh"))
            kept["gg"] = F.when(cut, F.greatest(F.col("gg") + F.col("m_d"), hung + F.col("m_d"), "m_gg")).otherwise(F.col("gg"))
            gone |= {c: F.col("m_" + c) for c in _LOADS}
            # A spliced node also keeps its child and what hung on the edge between them.
            none = F.lit(None).cast("bigint")
            kept |= {"kid": F.lit(None).cast("string"), **{"k_" + c: none for c in ("d", "w", "hh", "gg")}}
            gone |= {"kid": F.col("v"), **{"k_" + c: F.col(c) for c in ("d", "w", "hh", "gg")}}
        make = lambda r: F.struct(*[r[k].alias(k) for k in kept])
        out = tmp.put(both.select(F.inline(F.when(cut, F.array(make(kept), make(gone))).otherwise(F.array(make(kept))))), f"turn-{turn}")
        rows = {r.kind: r.n for r in out.groupBy("kind").agg(F.count("*").alias("n")).collect()}
        turns.append((out, rows))
        now = out.where(F.col("kind") != _SPLICED).select("v", "p", "d", "kind", *extra)
    return first, turns, now.where(F.col("kind") == _CORE)


def _replay(tmp: Scratch, first: DataFrame, turns: list, cores: DataFrame, with_paths: bool, loop_paths: bool) -> DataFrame:
    """Roots and depths, last removed first: a record's parent was removed in a later round, or is a top or a core.

    Rounds shrink by a constant share, so what is known is never much more than the records that ask for it.
    """
    core_path = (F.array("v") if loop_paths else F.lit(None).cast("array<string>")).alias("path")
    tops = first.select(F.col("p").alias("id")).distinct().join(first.select(F.col("v").alias("id")), "id", "left_anti")
    known = tops.select("id", F.col("id").alias("root_id"), F.lit(0).cast("bigint").alias("depth"), *([F.array("id").alias("path")] if with_paths else []))
    known = known.unionByName(cores.select(F.col("v").alias("id"), F.lit(CYCLE).alias("root_id"), F.lit(-1).cast("bigint").alias("depth"), *([core_path] if with_paths else [])))
    tmp.append(known, "known")
    for table, rows in reversed(turns):
        removed = rows.get(_RAKED, 0) + rows.get(_SPLICED, 0)
        if not removed:
            continue
        ups = tmp.read("known").withColumnRenamed("id", "p")
        found = lookup_join(table.where(F.col("kind") >= _RAKED), ups, "p", n=removed).select(
            F.col("v").alias("id"), "root_id",
            F.when(F.col("root_id") == CYCLE, F.lit(-1)).otherwise(F.col("depth") + F.col("d")).alias("depth"),
            *([F.concat("path", "via", F.array("v")).alias("path")] if with_paths else []),
        )
        tmp.append(found, "known")
    # Depth 0 holds the tops only: they are no children themselves.
    return tmp.read("known").where("depth <> 0").select("id", "root_id", F.col("depth").cast("int").alias("depth"), *(["path"] if with_paths else []))


def descendant_counts(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """``(ancestor_id, n_below, height)`` of every node with descendants: how many, and steps to the farthest.

    All pairs count but those of two nodes on one loop; a node below a loop lies below
    every node of it, at the distance of going up once.  Read off the contraction, so
    the cost is that of the nodes, not of their paths.  Edges are taken as by ``hierarchy``.
    """
    tmp = Scratch(edges.sparkSession, "descendants")
    far = F.lit(_FAR).cast("bigint")
    start = {"n": F.lit(1), "h": F.lit(0), "w": F.lit(0), "hh": F.lit(_FAR), "gg": F.lit(_FAR)}
    first, turns, cores = _contract(tmp, _edges(edges, child, parent), {k: c.cast("bigint") for k, c in start.items()})
    hung = F.when(F.col("n") > 1, F.col("h")).otherwise(far)
    # Tops are no rows of the contraction: they sum what was raked or hung on them.
    tops = first.select("p").distinct().join(first.select(F.col("v").alias("p")), "p", "left_anti")
    raked = reduce(DataFrame.unionByName, [t.where(F.col("kind") == _RAKED).select("p", (F.col("n") + F.col("w")).alias("n"), F.greatest(F.col("h") + F.col("d"), "hh").alias("h")) for t, _ in turns]) if turns else None
    known = ["id", "n_below", "height", "loop", "size", "pos", "before", "after", "hung"]
    none = F.lit(None).cast("bigint")

    def put(df: DataFrame) -> None:
        tmp.append(df.select(known), "known")

    # ``loop`` is the core of a node on a loop, ``size`` the loop's length, ``pos`` the steps up to the core,
    # ``before`` the farthest from the core that hangs above the node, ``after`` the farthest that hangs below it on the
    # loop, ``hung`` the farthest on the node itself.
    put(cores.select(
        F.col("v").alias("id"), (F.col("n") - 1 + F.col("w") - (F.col("d") - 1)).alias("n_below"), F.greatest(hung, "gg").alias("height"),
        F.col("v").alias("loop"), F.col("d").alias("size"), F.lit(0).cast("bigint").alias("pos"), far.alias("before"), far.alias("after"), hung.alias("hung"),
    ))
    if raked is not None:
        sums = raked.groupBy("p").agg(F.sum("n").alias("n_below"), F.max("h").alias("height"))
        put(sums.join(tops, "p", "left_semi").select(F.col("p").alias("id"), "n_below", "height", F.lit(None).cast("string").alias("loop"), none.alias("size"), none.alias("pos"), none.alias("before"), none.alias("after"), none.alias("hung")))
    for table, rows in reversed(turns):
        if rows.get(_RAKED):
            put(table.where(F.col("kind") == _RAKED).select(F.col("v").alias("id"), (F.col("n") - 1).alias("n_below"), F.col("h").alias("height"), F.lit(None).cast("string").alias("loop"), none.alias("size"), none.alias("pos"), none.alias("before"), none.alias("after"), none.alias("hung")))
        if not rows.get(_SPLICED):
            continue
        # A spliced node has one child left, removed later: in a tree, what lies below that lies below it.
        below = tmp.read("known").select(F.col("id").alias("kid"), F.col("n_below").alias("b_n"), F.col("height").alias("b_h"), F.col("loop").alias("b_loop"), F.col("size").alias("b_size"), F.col("pos").alias("b_pos"), F.greatest("hung", "after").alias("b_far"))
        ups = tmp.read("known").where("loop is not null").select(F.col("id").alias("p"), F.col("pos").alias("u_pos"), F.col("before").alias("u_before"), F.col("hung").alias("u_hung"))
        # Parents of nodes on loops are on loops too, each with one child there: both joins are one to one.
        got = table.where(F.col("kind") == _SPLICED).join(below, "kid").join(ups, "p", "left")
        on_loop = F.col("b_loop").isNotNull()
        before = F.greatest("u_before", F.col("u_hung") + F.col("u_pos"), F.col("gg") + F.col("u_pos"))
        after = F.greatest("k_gg", F.when(F.col("b_pos") > 0, F.col("b_far") + F.col("k_d")))
        tree_h = F.greatest("h", F.col("b_h") + F.col("k_d"), "k_hh", "k_d")
        put(got.select(
            F.col("v").alias("id"),
            F.when(on_loop, F.col("b_n")).otherwise(F.col("n") - 1 + F.col("b_n") + 1 + F.col("k_w")).alias("n_below"),
            F.when(on_loop, F.lit(None).cast("bigint")).otherwise(tree_h).alias("height"),
            F.col("b_loop").alias("loop"), F.col("b_size").alias("size"), F.when(on_loop, F.col("u_pos") + F.col("d")).alias("pos"),
            F.when(on_loop, before).alias("before"), F.when(on_loop, after).alias("after"), F.when(on_loop, hung).alias("hung"),
        ))
    done = tmp.read("known")
    # On a loop: the farthest that hangs on the node, below it down to the core, or above it (once round).
    round_ = F.greatest("hung", "after", F.col("before") + F.col("size") - F.col("pos"))
    height = F.when(F.col("loop").isNull() | (F.col("id") == F.col("loop")), F.col("height")).otherwise(round_)
    return done.where("n_below > 0").select(F.col("id").alias("ancestor_id"), "n_below", height.cast("int").alias("height"))


def _round_loops(tmp: Scratch, found: DataFrame, cores: DataFrame) -> DataFrame:
    """Paths that begin at the core of a loop, led once round the loop instead; null on the loop."""
    # Each core's loop from the core down: it and what compression put into its self-edge.
    ring = cores.select(F.col("v").alias("core"), F.concat(F.array("v"), "via").alias("ring"))
    kept = tmp.put(found.withColumn("core", F.when(F.col("root_id") == CYCLE, F.col("path")[0])), "loop-paths")
    # Path and loop share what lies between core and entry, and nothing else.
    shared = F.size(F.array_intersect("path", "ring"))
    path = F.when(F.col("ring").isNull(), F.col("path")).when(
        shared < F.size("path"), F.concat(F.slice("ring", shared + 1, F.size("ring")), "path")
    )
    below = lookup_join(kept.where("core is not null"), tmp.put(ring, "rings"), "core")
    return kept.where("core is null").select("id", "root_id", "depth", "path").unionByName(below.select("id", "root_id", "depth", path.alias("path")))


def descendants(paths: DataFrame) -> DataFrame:
    """``(ancestor_id, id, distance)`` for every ancestor on every path of ``hierarchy(..., with_paths=True)``.

    With ``loop_paths`` these are all pairs but those within a loop; without, nodes on
    or below a loop have no path and so no rows.
    """
    return (
        paths.where("path is not null")
        .select("id", (F.size("path") - 1).alias("last"), F.posexplode("path").alias("pos", "ancestor_id"))
        .where("pos < last")
        .select("ancestor_id", "id", (F.col("last") - F.col("pos")).cast("int").alias("distance"))
    )


def parent_statements(entity: DataFrame, prop: str = "P279") -> DataFrame:
    """``(child, parent)`` of every statement of ``prop`` that has a value.

    The value is the item's ``id`` in the JSON text, or the plain string itself.
    """
    raw = F.col("s.mainsnak.datavalue.value")
    return (
        entity.select("id", F.explode(F.col("claims")[prop]).alias("s"))
        .select(
            F.col("id").alias("child"),
            F.coalesce(F.get_json_object(raw, "$.id"), F.when(~F.ltrim(raw).startswith("{"), raw)).alias("parent"),
        )
        .where("child is not null and parent is not null and parent <> ''")
    )
