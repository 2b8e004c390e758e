"""Merging of coincident entities in cascade: vertices by distance, then edges, faces and volumes by what they are made of.

Each level relabels its children by the level below and groups its entities by a key of fixed size: how many different
children they have, and hashes of all of them with their senses, combined by exclusive or. So keys are made by
partial aggregation, and no entity's children, however many, are ever collected. Edges and faces that have the same children with
all senses turned are one entity, seen from its other side; a volume is another volume then. The smallest id of a group stays.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solidspark.operators.components import smallest_reachable
from solidspark.skew import shuffled
from solidspark.staging import stage, unstage

#: Small cells to a side of a block in the search for neighbours, which reach two cells far.
BLOCK, REACH = 6, 2


def _d2(a: str, b: str) -> Column:
    out = None
    for c in "xyz":
        one = (F.col(a + c) - F.col(b + c)) * (F.col(a + c) - F.col(b + c))
        out = one if out is None else out + one
    return out


def merge_points(points: DataFrame, tol: float, key: str = "vh") -> DataFrame:
    """(key, keep): the smallest id that a point reaches over pairs closer than ``tol`` (closeness is not transitive).

    Points fall into cells whose diagonal is under the tolerance: those of one cell are one node, however many
    they are. Two neighbouring cells are linked by their first points where these are close; only for
    cells that are then still apart are all their different places compared. Null coordinates are close to nothing."""
    w = tol / math.sqrt(3) * (1 - 1e-9)
    cells = [f"c{c}" for c in "xyz"]
    at = points.select(F.col(key).alias("id"), *[F.col(c).cast("double").alias(c) for c in "xyz"])
    whole = at.where("x is not null and y is not null and z is not null").withColumns({k: F.floor(F.col(c) / F.lit(w)).cast("long") for c, k in zip("xyz", cells, strict=True)})
    places = stage(whole.groupBy(*cells, *"xyz").agg(F.min("id").alias("id")), "mg-places")
    first = F.min(F.struct("id", *"xyz"))
    nodes = stage(places.groupBy(*cells).agg(first.alias("f")).select(*cells, F.col("f.id").alias("node"), *[F.col(f"f.{c}").alias(c) for c in "xyz"]), "mg-nodes")
    block = lambda c, d: F.floor((F.col(c) + d) / BLOCK)
    own = nodes.select("node", *[F.col(c).alias(f"a{c}") for c in "xyz"], *[F.col(c).alias(f"a{c}") for c in cells], *[block(c, 0).alias(f"b{c}") for c in cells])
    wide = nodes.select(F.col("node").alias("other"), *[F.col(c).alias(f"o{c}") for c in "xyz"], *[F.col(c).alias(f"o{c}") for c in cells])
    for c in cells:
        wide = wide.withColumn(f"b{c}", F.explode(F.sequence(F.floor((F.col(f"o{c}") - REACH) / BLOCK), F.floor((F.col(f"o{c}") + REACH) / BLOCK))))
    near = F.col("node") < F.col("other")
    for c in cells:
        near = near & (F.abs(F.col(f"a{c}") - F.col(f"o{c}")) <= REACH)
    limit = F.lit(float(tol) * float(tol))
    pairs = stage(own.join(shuffled(wide), [f"b{c}" for c in cells]).where(near).select("node", "other", (_d2("a", "o") < limit).alias("close")), "mg-pairs")
    links = stage(pairs.where("close").select(F.col("node").alias("a"), F.col("other").alias("b")), "mg-links")
    found = smallest_reachable(links)
    of = lambda k: found.select(F.col("node").alias(k), F.col("component").alias(f"{k}_c"))
    apart = pairs.where("not close").join(shuffled(of("node")), "node", "left").join(shuffled(of("other")), "other", "left")
    apart = apart.where(F.coalesce("node_c", "node") != F.coalesce("other_c", "other")).select("node", "other")
    in_cell = nodes.select("node", *cells).join(shuffled(places.drop("id")), cells)
    left = in_cell.select("node", *[F.col(c).alias(f"a{c}") for c in "xyz"])
    right = in_cell.select(F.col("node").alias("other"), *[F.col(c).alias(f"o{c}") for c in "xyz"])
    more = apart.join(shuffled(left), "node").join(shuffled(right), "other").where(_d2("a", "o") < limit).select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()
    labels = smallest_reachable(stage(links.union(more), "mg-links"))
    for t in (pairs, links):
        unstage(t)
    # nodes are named by the smallest id in their cell, so the smallest node is the smallest id of all
    kept = nodes.join(shuffled(labels), nodes["node"] == labels["node"], "left").select(*cells, F.coalesce("component", nodes["node"]).alias("keep"))
    merged = whole.join(kept, cells).select(F.col("id").alias(key), "keep")
    return merged.unionByName(at.where("x is null or y is null or z is null").select(F.col("id").alias(key), F.col("id").alias("keep")))


def _hashes(sense: Column) -> tuple[Column, Column]:
    """Two independent hashes of a child with a sense, combined over all children."""
    return F.bit_xor(F.xxhash64("keep", sense)), F.bit_xor(F.xxhash64(F.lit(0x5EED), sense, "keep"))


def _level(links: DataFrame, below: DataFrame, mirrored: bool) -> DataFrame:
    """(ent_id, keep, sense) of the parents in ``links`` (parent_id, child_id, sense); below: (ent_id, keep, sense) of the children.

    sense: 1, or -1 where an entity is turned against the one that stays."""
    child = below.select(F.col("ent_id").alias("child_id"), "keep", F.col("sense").alias("turned"))
    made = links.join(shuffled(child), "child_id").select("parent_id", "keep", (F.coalesce("sense", F.lit(0)) * F.col("turned")).alias("sense")).distinct()
    ahead, back = _hashes(F.col("sense")), _hashes(-F.col("sense"))
    keyed = made.groupBy("parent_id").agg(F.count("*").alias("n"), F.min("keep").alias("low"), F.max("keep").alias("high"), F.struct(ahead[0].alias("h"), ahead[1].alias("g")).alias("fwd"), F.struct(back[0].alias("h"), back[1].alias("g")).alias("rev"))
    same = ["n", "low", "high", "one", "two"]
    keyed = keyed.withColumns({"one": F.least("fwd", "rev") if mirrored else F.col("fwd"), "two": F.greatest("fwd", "rev") if mirrored else F.col("fwd")})
    keyed = stage(keyed, "mg-keyed")
    stays = keyed.groupBy(*same).agg(F.min(F.struct(F.col("parent_id").alias("id"), F.col("fwd").alias("f"))).alias("s"))
    out = keyed.join(stays, same).select(F.col("parent_id").alias("ent_id"), F.col("s.id").alias("keep"), F.when(F.col("fwd") == F.col("s.f"), 1).otherwise(-1).alias("sense"))
    return stage(out, "mg-level")


def merge_cascade(vertices: DataFrame, links: DataFrame, tol: float) -> DataFrame:
    """(ent_id, dim, keep, sense) of vertices (ent_id, x, y, z) and of all parents in links (parent_id, child_id, parent_dim, sense).

    sense of a link: 1 or -1 (of a curve's vertices: -1 its start, 1 its end), null where it is not known. In the result:
    -1 where the entity is turned against the one that stays. An entity without children is not in the result: it stays."""
    level = stage(merge_points(vertices, tol, "ent_id").withColumn("sense", F.lit(1)), "mg-level")
    out = level.withColumn("dim", F.lit(0))
    for dim in (1, 2, 3):
        level = _level(links.where(F.col("parent_dim") == dim), level, mirrored=dim < 3)
        out = out.unionByName(level.withColumn("dim", F.lit(dim)))
    return out.select("ent_id", "dim", "keep", "sense")


def merged_links(links: DataFrame, merged: DataFrame) -> DataFrame:
    """Links (parent_id, child_id, parent_dim, sense) among the entities that stay, each once, with senses against these."""
    up = merged.select(F.col("ent_id").alias("parent_id"), F.col("keep").alias("_p"), F.col("sense").alias("_ps"))
    down = merged.select(F.col("ent_id").alias("child_id"), F.col("keep").alias("_c"), F.col("sense").alias("_cs"))
    found = links.join(shuffled(up), "parent_id", "left").join(shuffled(down), "child_id", "left")
    turned = F.coalesce("_ps", F.lit(1)) * F.coalesce("_cs", F.lit(1))
    return found.select(F.coalesce("_p", "parent_id").alias("parent_id"), F.coalesce("_c", "child_id").alias("child_id"), "parent_dim", (F.col("sense") * turned).alias("sense")).distinct()


def relabelled(table: DataFrame, merged: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    """``table`` with ids of entities that were merged away replaced by those that stay, each row once; where: of the rows that it concerns."""
    gone = merged.where("ent_id <> keep").select(F.col("ent_id").alias("_g"), F.col("keep").alias("_k"))
    found = table.join(shuffled(gone), (table[key] == gone["_g"]) & (F.lit(True) if where is None else where), "left")
    return found.withColumn(key, F.coalesce("_k", key)).select(*table.columns).distinct()
