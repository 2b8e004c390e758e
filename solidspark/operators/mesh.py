"""Meshes: curve and facet decoding, coincident points, merging, closedness checks."""

from __future__ import annotations

from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from solidspark.operators.components import smallest_reachable
from solidspark.operators.merge import merge_points
from solidspark.skew import shuffled
from solidspark.staging import stage


def curve_points(curves: DataFrame) -> DataFrame:
    """``curves`` with ``points`` in the direction of the curve: reversed where its geometry is."""
    return curves.withColumn("points", F.when(F.col("reversed"), F.reverse("points")).otherwise(F.col("points")))


def running(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """(key, start): for each whole number ``key``, once each, the sum of ``n`` over the smaller ones.

    Keys are dealt to ranges that hold about as many each, whatever their gaps are, and written once, for the ranges' bounds
    are sampled; a range's own sums start where the sums of the ranges before it end."""
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.select(key, F.col(n).alias("_n")).repartitionByRange(parts, key).withColumn("_r", F.spark_partition_id())
    dealt = stage(dealt, "running")
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("_r").agg(F.sum("_n").alias("_s")).select("_r", F.coalesce(F.sum("_s").over(upto(Window.orderBy("_r"))), F.lit(0)).alias("_before"))  # a row a range
    own = F.coalesce(F.sum("_n").over(upto(Window.partitionBy("_r").orderBy(key))), F.lit(0))
    return dealt.withColumn("_own", own).join(F.broadcast(before), "_r").select(key, (F.col("_before") + F.col("_own")).cast("long").alias("start"))


def create_vertices(vertices: DataFrame, base: int = 0) -> DataFrame:
    """(vh, owner_id, x, y, z): one mesh vertex for each geometric vertex (ent_id, x, y, z), handles in order of the ids."""
    start = running(vertices.select("ent_id", F.lit(1).alias("n")), "ent_id")
    return vertices.join(start, "ent_id").select((F.col("start") + base + 1).alias("vh"), F.col("ent_id").alias("owner_id"), "x", "y", "z")


def _distance2(a: Column, b: Column) -> Column:
    d = [(a.getField(c) - b.getField(c)) * (a.getField(c) - b.getField(c)) for c in "xyz"]
    return d[0] + d[1] + d[2]


def curve_status(curves: DataFrame, resabs: float) -> DataFrame:
    """``curves`` with ``status``: failed (no points), point (one point, its ends the same and no longer than the tolerance), skipped (one
    point otherwise), closed or open; and ``warn``: closed by its points but not by its ends, or the other way.

    The length is that of a column ``length``, if there is one."""
    short = F.col("length") <= F.lit(resabs) if "length" in curves.columns else F.lit(True)
    n, first, last = F.size("points"), F.element_at("points", 1), F.element_at("points", -1)
    near = F.when(n > 0, _distance2(first, last) < F.lit(resabs * resabs)).otherwise(False)
    same = F.col("start_vh") == F.col("end_vh")
    status = F.when(F.col("points").isNull() | (n == 0), "failed").when((n < 2) & same & short, "point").when(n < 2, "skipped").when(near, "closed").otherwise("open")
    return curves.withColumns({"status": status, "warn": (n >= 2) & (near != same)})


def curve_edges(ordered: DataFrame, curve: str, vertex: str, *order: str) -> DataFrame:
    """(curve, ord, a, b): consecutive pairs of the vertices of a curve."""
    w = Window.partitionBy(curve).orderBy(*order)
    rows = ordered.select(F.col(curve).alias("curve_id"), (F.row_number().over(w) - 1).alias("ord"), F.col(vertex).alias("a"), F.lead(vertex).over(w).alias("b"))
    return rows.where(F.col("b").isNotNull())


def curve_facets(curves: DataFrame, resabs: float) -> tuple[DataFrame, DataFrame]:
    """New vertices (curve_id, ord, x, y, z) of the inner points, and edges (curve_id, ord, a_kind, a, b_kind, b).

    The ends reuse the geometric vertices: kind ``g`` with a handle, else ``n`` with the point's place."""
    good = curve_status(curve_points(curves), resabs).where(F.col("status").isin("open", "closed"))
    n = F.size("points")
    inner = good.select("curve_id", F.posexplode("points").alias("ord", "p"), n.alias("n")).where((F.col("ord") > 0) & (F.col("ord") < F.col("n") - 1))
    end = lambda k: F.when(k == 0, F.struct(F.lit("g").alias("kind"), F.col("start_vh").alias("v"))).when(
        k == n - 1, F.struct(F.lit("g").alias("kind"), F.col("end_vh").alias("v"))).otherwise(F.struct(F.lit("n").alias("kind"), k.cast("long").alias("v")))
    edges = good.select("curve_id", F.explode(F.transform(F.sequence(F.lit(0), n - 2), lambda k: F.struct(k.alias("ord"), end(k).alias("a"), end(k + 1).alias("b")))).alias("e"))
    return inner.select("curve_id", "ord", "p.x", "p.y", "p.z"), edges.select("curve_id", "e.ord", F.col("e.a.kind").alias("a_kind"), F.col("e.a.v").alias("a"), F.col("e.b.kind").alias("b_kind"), F.col("e.b.v").alias("b"))


def far_ends(curves: DataFrame, vertices: DataFrame, resabs: float) -> DataFrame:
    """(curve_id) of curves whose first or last point is farther than the tolerance from its vertex (vh, x, y, z): what an export warns of."""
    end = lambda name, k: curves.where(F.size("points") > 1).select("curve_id", F.col(name).alias("vh"), F.element_at("points", k).alias("p"))
    ends = end("start_vh", 1).union(end("end_vh", -1)).join(vertices.select("vh", F.struct("x", "y", "z").alias("v")), "vh")
    return ends.where(_distance2(F.col("p"), F.col("v")) > F.lit(resabs * resabs)).select("curve_id").distinct()


def curve_mesh(curves: DataFrame, resabs: float, base: int = 0) -> tuple[DataFrame, DataFrame]:
    """Of :func:`curve_facets`: new vertices (vh, owner_id, x, y, z) and edges (eh, owner_id, conn), all by handles.

    New handles follow ``base``, in order of curve and place; those of edges count from 1 likewise."""
    inner, edges = curve_facets(curves, resabs)
    sizes = curve_status(curves, resabs).where(F.col("status").isin("open", "closed")).select("curve_id", F.size("points").alias("n"))
    start = running(sizes.select("curve_id", (F.col("n") - 2).alias("n")), "curve_id")
    handle = lambda k: F.lit(base) + F.col("start") + k
    vertices = inner.join(start, "curve_id").select(handle(F.col("ord")).alias("vh"), F.col("curve_id").alias("owner_id"), "x", "y", "z")
    first = running(sizes.select("curve_id", (F.col("n") - 1).alias("n")), "curve_id").withColumnRenamed("start", "first")
    end = lambda side: F.when(F.col(f"{side}_kind") == "g", F.col(side)).otherwise(handle(F.col(side)))
    linked = edges.join(start, "curve_id").join(first, "curve_id")
    return vertices, linked.select((F.col("first") + F.col("ord") + 1).alias("eh"), F.col("curve_id").alias("owner_id"), F.array(end("a"), end("b")).alias("conn"))


def facet_type(n: Column) -> Column:
    return F.when(n == 3, "TRI").when(n == 4, "QUAD").otherwise("POLYGON")


def decode(facet_list: str) -> Column:
    """The facets of a flat list [n, i1..in, n, ...], as arrays of indexes.

    A list of facets of one size (a triangle mesh) is cut by place; a mixed list is walked, which built-in
    functions do only in time quadratic in its length, so those lists alone go through an Arrow UDF."""
    lst = F.col(facet_list)
    k = F.get(lst, F.lit(0))
    m = F.floor(F.size(lst) / (k + 1)).cast("int")
    uniform = F.coalesce((F.size(lst) > 0) & (k > 0) & (F.size(lst) % (k + 1) == 0) & F.forall(F.sequence(F.lit(0), m - 1), lambda i: F.get(lst, i * (k + 1)) == k), F.lit(False))
    cut = F.transform(F.sequence(F.lit(0), m - 1), lambda i: F.slice(lst, i * (k + 1) + 2, k))
    return F.when(uniform, cut).otherwise(_walk(F.when(~uniform, lst)))


@F.pandas_udf(ArrayType(ArrayType(IntegerType())))
def _walk(lists: pd.Series) -> pd.Series:
    """Facets of mixed lists; one whose count is under 1 or passes the end is null, and the last."""

    def one(flat):
        out, at, size = [], 0, len(flat)
        while at < size:
            n = flat[at]
            if n is None or not 1 <= n <= size - at - 1:
                out.append(None)
                break
            out.append(list(flat[at + 1 : at + 1 + int(n)]))
            at += 1 + int(n)
        return out

    return lists.map(lambda v: None if v is None else one(v))


def facets(surfaces: DataFrame) -> DataFrame:
    """(surface_id, ord, type, conn, bad) of every facet. Winding stays as it is.

    bad: an index without a point, or (then without conn) a count under 1 or past the end of the list."""
    rows = surfaces.select("surface_id", F.size("points").alias("n"), F.posexplode(decode("facet_list")).alias("ord", "conn"))
    bad = F.coalesce(F.exists("conn", lambda i: i.isNull() | (i < 0) | (i >= F.col("n"))), F.lit(True))
    return rows.select("surface_id", "ord", F.when(F.col("conn").isNotNull(), facet_type(F.size("conn"))).alias("type"), "conn", bad.alias("bad"))


def surface_mesh(surfaces: DataFrame, vertices: DataFrame, resabs: float, base: int = 0) -> tuple[DataFrame, DataFrame]:
    """New vertices (vh, owner_id, x, y, z) and elements (eh, owner_id, type, conn) of surfaces, by handles.

    Points that are geometric vertices of their surface (see :func:`match_points`) take their handles; the others get
    new ones after ``base``, in order of surface and place. Elements count from 1 likewise. Bad facets are left out."""
    matched = match_points(surfaces, vertices, resabs)
    points = surfaces.select("surface_id", F.posexplode("points").alias("ord", "p")).join(matched, ["surface_id", "ord"], "left")
    new = F.sum(F.isnull("vh").cast("long")).over(Window.partitionBy("surface_id").orderBy("ord"))
    start = running(points.groupBy("surface_id").agg(F.count_if(F.isnull("vh")).alias("n")), "surface_id")
    handled = points.withColumn("new", new).join(start, "surface_id").select("surface_id", "ord", "p", F.isnull("vh").alias("is_new"), F.coalesce("vh", F.lit(base) + F.col("start") + F.col("new")).alias("vh"))
    fresh = handled.where("is_new").select("vh", F.col("surface_id").alias("owner_id"), "p.x", "p.y", "p.z")
    # as long as the surface's own array of points
    of = handled.groupBy("surface_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "vh"))), lambda v: v.getField("vh")).alias("handles"))
    good = facets(surfaces).where("not bad")
    first = running(good.groupBy("surface_id").agg((F.max("ord") + 1).alias("n")), "surface_id").withColumnRenamed("start", "first")
    out = good.join(of, "surface_id").join(first, "surface_id")
    conn = F.transform("conn", lambda i: F.get("handles", i))
    return fresh, out.select((F.col("first") + F.col("ord") + 1).alias("eh"), F.col("surface_id").alias("owner_id"), "type", conn.alias("conn"))


def match_points(surfaces: DataFrame, vertices: DataFrame, resabs: float) -> DataFrame:
    """(surface_id, ord, vh): points of a surface that are geometric vertices of it (surface_id, vh, x, y, z).

    A vertex takes the first point within the tolerance; of vertices that take one point the last wins."""
    points = surfaces.select("surface_id", F.posexplode("points").alias("ord", "p")).select("surface_id", "ord", "p.x", "p.y", "p.z")
    near = near_pairs(vertices, points, resabs, on=["surface_id"], left=["vh"], right=["ord"])
    first = near.groupBy("surface_id", "vh").agg(F.min("ord").alias("ord"))
    return first.groupBy("surface_id", "ord").agg(F.max("vh").alias("vh"))


def _cell(c: str, tol: float) -> Column:
    return F.floor(F.col(c) / F.lit(float(tol))).cast("long")


def near_pairs(a: DataFrame, b: DataFrame, tol: float, on: list[str], left: list[str], right: list[str], axes: str = "xyz") -> DataFrame:
    """Pairs closer than ``tol`` (strictly): an equi join on grid cells of that width, one side in its neighbour cells too."""
    cells = [f"_c{c}" for c in axes]
    at = a.select(*on, *left, *[F.col(c).alias(f"_a{c}") for c in axes], *[_cell(c, tol).alias(k) for c, k in zip(axes, cells, strict=True)])
    around = F.explode(F.array(*[F.struct(*[F.lit(d).alias(k) for d, k in zip(ds, cells, strict=True)]) for ds in product((-1, 0, 1), repeat=len(axes))])).alias("_d")
    wide = b.select(*on, *right, *[F.col(c).alias(f"_b{c}") for c in axes], around)
    wide = wide.select(*on, *right, *[f"_b{c}" for c in axes], *[(_cell(f"_b{c}", tol) + F.col(f"_d.{k}")).alias(k) for c, k in zip(axes, cells, strict=True)])
    d2 = sum(((F.col(f"_a{c}") - F.col(f"_b{c}")) * (F.col(f"_a{c}") - F.col(f"_b{c}")) for c in axes[1:]), (F.col(f"_a{axes[0]}") - F.col(f"_b{axes[0]}")) * (F.col(f"_a{axes[0]}") - F.col(f"_b{axes[0]}")))
    return at.join(wide, [*on, *cells]).where(d2 < F.lit(float(tol) * float(tol))).select(*on, *left, *right)


def coincident(points: DataFrame, tol: float, key: str = "vh", axes: str = "xyz") -> DataFrame:
    """(a, b), a < b: pairs of points closer than the tolerance."""
    other = points.withColumnRenamed(key, "_o")
    found = near_pairs(points, other, tol, [], [key], ["_o"], axes)
    return found.where(F.col(key) < F.col("_o")).select(F.col(key).alias("a"), F.col("_o").alias("b"))


def merge_vertices(points: DataFrame, tol: float, key: str = "vh") -> DataFrame:
    """(vh, keep): the smallest id that a point reaches over coincident pairs (closeness is not transitive)."""
    return merge_points(points, tol, key)


def merge_faces(elements: DataFrame) -> DataFrame:
    """(eh, keep): elements on the same vertices, in any order or winding, keep the smallest handle."""
    keyed = elements.select("eh", F.array_sort("conn").alias("key"))
    keep = keyed.groupBy("key").agg(F.min("eh").alias("keep"))
    return keyed.join(keep, "key").select("eh", "keep")


def element_edges(elements: DataFrame) -> DataFrame:
    """(eh, a, b) of every side of an element, a <= b."""
    n = F.size("conn")
    side = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get("conn", i).alias("a"), F.get("conn", (i + 1) % n).alias("b")))
    return elements.where(n > 1).select("eh", F.explode(side).alias("s")).select("eh", F.least("s.a", "s.b").alias("a"), F.greatest("s.a", "s.b").alias("b"))


def open_edges(elements: DataFrame) -> DataFrame:
    """(a, b, n): sides that are not used twice; none in a watertight mesh."""
    return element_edges(elements).groupBy("a", "b").agg(F.count("*").alias("n")).where("n <> 2")


def closedness(elements: DataFrame, senses: DataFrame | None = None) -> DataFrame:
    """(volume_id, n_sides, missing, flipped, crowded, loops) of the elements (eh, owner_id, conn) of volumes.

    senses (child_id, parent_id, sense): the owners are surfaces and bound these volumes, with -1 from inside; without it an owner is a
    volume. A side that two elements use in opposite ways is closed. missing: used once; flipped: twice the same way;
    crowded: more often. loops: the rings that the missing sides make."""
    n = F.size("conn")
    corner = elements.where(n > 1).select("owner_id", "conn", F.posexplode_outer("conn").alias("k", "p"))
    ends = corner.select("owner_id", F.col("p").alias("s"), F.get("conn", (F.col("k") + 1) % n).alias("t"))
    sides = ends.select("owner_id", F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b"), F.when(F.col("s") < F.col("t"), 1).otherwise(-1).alias("way"))
    used = sides.groupBy("owner_id", "a", "b").agg(F.count("*").alias("n"), F.sum("way").alias("way"))
    # sides that are used alike are one row, but those that loops are made of: where elements lie by owners, all others are neither shuffled nor written
    alike = lambda df, of: df.groupBy(of, "n", "way", F.when(F.col("n") == 1, F.struct("a", "b")).alias("side")).agg(F.count("*").alias("k"))
    if senses is None:
        found = alike(used, "owner_id").withColumnRenamed("owner_id", "volume_id")
    else:
        of = senses.select(F.col("child_id").alias("owner_id"), F.col("parent_id").alias("volume_id"), "sense", F.count("*").over(Window.partitionBy("parent_id")).alias("_owners"))
        turned = lambda df, some: df.join(shuffled(of.where(some).drop("_owners")), "owner_id").withColumn("way", F.col("way") * F.col("sense")).drop("owner_id", "sense")
        found = turned(alike(used, "owner_id"), "_owners = 1").select("volume_id", "n", "way", "side", "k")
        if not of.where("_owners > 1").isEmpty():
            # owners of one volume may meet at any side
            shared = turned(used, "_owners > 1").groupBy("volume_id", "a", "b").agg(F.sum("n").alias("n"), F.sum("way").alias("way"))
            found = found.unionByName(alike(shared, "volume_id"))
    # a few rows a volume, of many tasks
    found = stage(found.repartition("volume_id"), "used-sides")
    of_kind = lambda some: F.sum(F.when(some, F.col("k")).otherwise(0))
    counts = found.groupBy("volume_id").agg(
        F.sum("k").alias("n_sides"), of_kind(F.col("n") == 1).alias("missing"), of_kind((F.col("n") == 2) & (F.col("way") != 0)).alias("flipped"), of_kind(F.col("n") > 2).alias("crowded")
    )
    end = lambda c: F.struct("volume_id", F.col(f"side.{c}").alias("v"))
    missing = found.where("n = 1")
    if missing.isEmpty():
        return counts.withColumn("loops", F.lit(0).cast("long"))
    rings = smallest_reachable(missing.select(end("a").alias("a"), end("b").alias("b")))
    loops = rings.select(F.col("node.volume_id").alias("volume_id"), "component").distinct().groupBy("volume_id").agg(F.count("*").alias("loops"))
    return counts.join(shuffled(loops), "volume_id", "left").withColumn("loops", F.coalesce("loops", F.lit(0)))


def euler(elements: DataFrame) -> DataFrame:
    """One row with V - E + F; 2 for a closed sphere."""
    sides = element_edges(elements).select("a", "b").distinct().agg(F.count("*").alias("e"))
    corners = elements.select(F.explode("conn").alias("v")).distinct().agg(F.count("*").alias("v"))
    return corners.join(F.broadcast(sides)).join(F.broadcast(elements.agg(F.count("*").alias("f")))).select((F.col("v") - F.col("e") + F.col("f")).alias("euler"))  # one row each


def imprint(elements: DataFrame) -> DataFrame:
    """(a, b): pairs of volumes' elements that lie on each other: shared faces by their vertices."""
    m = merge_faces(elements)
    return m.where("eh <> keep").select(F.col("keep").alias("a"), F.col("eh").alias("b"))


def faceting_report(status: DataFrame) -> DataFrame:
    """(dim, n_failed, n_total) of (dim, failed)."""
    return status.groupBy("dim").agg(F.count_if("failed").alias("n_failed"), F.count("*").alias("n_total"))
