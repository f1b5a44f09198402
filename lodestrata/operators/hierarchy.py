"""Parent-child rows as full hierarchies: root, depth, path, descendants and cycles.

Levels are joined as frontiers from the roots down. Real trees are shallow but for a few very long chains, so the first
LEVELS levels are joined one by one; what is left (long chains and everything on or below a loop) doubles its reach with
every join, so a chain of a million links takes twenty joins. Nodes that no root reaches reveal the loops.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import HOT_PARTS, cut, shuffle_width, skew_safe_lookup

LEVELS = 4
_SPACE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def folded_id(column: Column) -> Column:
    """Trimmed of all Unicode white space, in lower case; null if nothing is left."""
    text = F.lower(F.regexp_replace(column.cast("string"), _SPACE, ""))
    return F.when(text != "", text)


def links(rows: DataFrame, *, id: str = "id", parent: str = "parent_artifact_id") -> DataFrame:
    """One row (key, id, up) per id: its folded key, its spelling if that differs, and its parent's key if that is in the table.

    Rows with a null or blank id are no nodes. Where rows of an id disagree, the largest parent reference counts, and the
    smallest spelling of the id.
    """
    key = folded_id(F.col(id))
    nodes = rows.select(key.alias("key"), F.when(F.col(id).cast("string") != key, F.col(id).cast("string")).alias("id"), folded_id(F.col(parent)).alias("up"))
    nodes = cut(nodes.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("id").alias("id"), F.max("up").alias("up")))
    wanted = nodes.where(F.col("up").isNotNull()).groupBy("up").agg(F.count(F.lit(1)).alias("n"))
    present = cut(wanted.join(nodes.select(F.col("key").alias("up")), "up", "left_semi").withColumn("here", F.lit(True)))
    held = skew_safe_lookup(nodes.where(F.col("up").isNotNull()), present, ["up"], "n", nodes.count(), "left")
    held = held.select("key", "id", F.when(F.col("here"), F.col("up")).alias("up"))
    return held.unionByName(nodes.where(F.col("up").isNull()))


def _crowded(rest: DataFrame, n: int) -> DataFrame | None:
    """The values of rest.up that at least a HOT_PARTS-th of its n rows have, so HOT_PARTS at most; null if there are none."""
    least = max(1000.0, n / HOT_PARTS)
    if n < least:
        return None
    found = cut(rest.groupBy("up").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("up"))
    return found if found.take(1) else None


def _through(table: DataFrame, rest: DataFrame, crowded: DataFrame | None) -> DataFrame:
    """rest joined with the table's columns, named up_..., through rest.up = table.key; the table's keys are unique. Rows of a
    crowded key stay where they are and are told the key's one row; the others are shuffled."""
    f = table.select(F.col("key").alias("up"), *[F.col(c).alias(f"up_{c}") for c in table.columns if c not in ("key", "id")])
    if crowded is None:
        return rest.join(f, "up")
    hot = f.join(F.broadcast(crowded), "up", "left_semi")
    return rest.join(F.broadcast(hot), "up").unionByName(rest.join(F.broadcast(crowded), "up", "left_anti").join(f.join(F.broadcast(crowded), "up", "left_anti"), "up"))


def hierarchy(rows: DataFrame, *, id: str = "id", parent: str = "parent_artifact_id", with_path: bool = False) -> DataFrame:
    """One row (id, root_id, node_depth[, path]) per id of a parent-child table.

    A node whose parent is null, blank or absent is a root of depth 0. On a loop node_depth is -1 and root_id the loop's
    smallest id; below a loop -2 with that root_id. path lists the ids from the root to the node, null on or below a loop.
    A node that is its own parent is a loop of one. Empty tables give no rows; other columns are ignored.
    """
    nodes = cut(links(rows, id=id, parent=parent))
    total = nodes.count()
    crowded = _crowded(nodes.where(F.col("up").isNotNull()), total)
    below = lambda frontier, rest: _through(frontier, rest, crowded)

    name = F.coalesce("id", "key")
    path = [F.array(name).alias("path")] if with_path else []
    frontier = nodes.where(F.col("up").isNull()).select("key", "id", name.alias("root_id"), F.lit(0).alias("node_depth"), *path)
    # The children stay partitioned by parent, so that a level shuffles its frontier only.
    rest = nodes.where(F.col("up").isNotNull()).repartition(shuffle_width(rows.sparkSession), "up").persist()
    done = [frontier]
    for level in range(1, LEVELS + 1):
        step = [F.concat("up_path", F.array(name)).alias("path")] if with_path else []
        frontier = cut(below(frontier, rest).select("key", "id", F.col("up_root_id").alias("root_id"), F.lit(level).alias("node_depth"), *step))
        done.append(frontier)
        if not frontier.take(1):
            break
    reached = done[0]
    for d in done[1:]:
        reached = reached.unionByName(d)
    # Not reached is whose parent isn't above the last level.
    above = reached.where(F.col("node_depth") < level).select(F.col("key").alias("up"))
    left = cut(rest.join(above, "up", "left_anti"))
    rest.unpersist()
    # A node that is left and whose parent was reached starts from that parent's place.
    heads = below(frontier, left)
    solved = cut(heads.select("key", "id", F.col("up_root_id").alias("root_id"), (F.col("up_node_depth") + 1).alias("node_depth"), *([F.concat("up_path", F.array(name)).alias("path")] if with_path else [])))
    # open: up is the ancestor `far` links above, least the smallest key of the node and the far - 1 next ones,
    # trail the ids from just below that ancestor to the node.
    open_ = cut(left.join(solved.select("key"), "key", "left_anti").select("key", "id", "up", F.lit(1).alias("far"), F.struct("key", "id").alias("least"), *([F.array(name).alias("trail")] if with_path else [])))
    rounds = 0
    while True:
        n_open = open_.count()
        if not n_open:
            break
        # Far ancestors are shared by more nodes than direct parents: who is crowded is asked anew in every round.
        full = _crowded(open_, n_open)
        hit = _through(solved, open_, full)
        new = cut(hit.select("key", "id", F.col("up_root_id").alias("root_id"), (F.col("up_node_depth") + F.col("far")).alias("node_depth"), *([F.concat("up_path", "trail").alias("path")] if with_path else [])))
        gone = new.count()
        solved = solved.unionByName(new)
        if not gone and rounds:
            # Distances to reached nodes have no gaps: none at 2^(rounds-1) to 2^rounds - 1 links means none farther either.
            break
        every = open_
        open_ = every.join(new.select("key"), "key", "left_anti") if gone else every
        far = every.select("key", F.col("up").alias("up"), "far", "least", *(["trail"] if with_path else []))
        open_ = cut(_through(far, open_, full).select("key", "id", F.col("up_up").alias("up"), (F.col("far") + F.col("up_far")).alias("far"), F.least("least", "up_least").alias("least"), *([F.concat("up_trail", "trail").alias("trail")] if with_path else [])))
        rounds += 1
    n_open = open_.count()
    looped = None
    if n_open:
        open_ = open_.select("key", "id", "up", "least")
        for _ in range(rounds, max(rounds, math.ceil(math.log2(n_open))) + 1):
            far = open_.select("key", "up", "least")
            open_ = cut(_through(far, open_, _crowded(open_, n_open)).select("key", "id", F.col("up_up").alias("up"), F.least("least", "up_least").alias("least")))
        # After at least as many steps as there are nodes everyone's ancestor lies on a loop, and every loop node is reached.
        on_loop = cut(open_.join(open_.select(F.col("up").alias("key")).distinct(), "key", "left_semi"))
        loops = on_loop.select("key", F.coalesce("least.id", "least.key").alias("root_id"))
        named = _through(loops, open_.select("key", "id", "up"), _crowded(open_, n_open)).withColumnRenamed("up_root_id", "root_id")
        nulls = [F.lit(None).cast("array<string>").alias("path")] if with_path else []
        looped = named.join(on_loop.select("key", F.lit(-1).alias("_on")), "key", "left").select("key", "id", "root_id", F.coalesce("_on", F.lit(-2)).alias("node_depth"), *nulls)
    everything = reached.unionByName(solved)
    if looped is not None:
        everything = everything.unionByName(looped)
    return everything.select(name.alias("id"), "root_id", F.col("node_depth").cast("int").alias("node_depth"), *(["path"] if with_path else []))


def descendants(rows: DataFrame, *, id: str = "id", parent: str = "parent_artifact_id") -> DataFrame:
    """Ancestor pairs (ancestor_id, descendant_id, distance) of all nodes of trees, distance 1 for children.

    Nodes on or below loops have no finite set of ancestors and give no pairs. The pairs follow from the paths without a join.
    """
    paths = hierarchy(rows, id=id, parent=parent, with_path=True).where(F.col("node_depth") > 0)
    above = paths.select(F.col("id").alias("descendant_id"), "node_depth", F.posexplode(F.slice("path", 1, F.col("node_depth"))).alias("at", "ancestor_id"))
    return above.select("ancestor_id", "descendant_id", (F.col("node_depth") - F.col("at")).cast("int").alias("distance"))
