"""Faceting of primitives: closed meshes of triangles, wound outwards, as fine as the tolerances ask.

All primitives but the brick are surfaces of revolution (stretched along y where they are elliptic): a profile of rings between two
poles, or a closed one. A primitive's counts come from its sizes, and its vertices and triangles are rows made by ``sequence`` and
``explode`` where it is: nothing is shuffled but the counts that handles start from."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solidspark.commands import ExportOptions
from solidspark.operators.mesh import running
from solidspark.skew import shuffled
from solidspark.staging import stage

#: What a primitive's sizes a, b, c, d are.
KINDS = {"brick": "x, y, z", "cylinder": "height, major, minor", "cone": "height, major, minor, top", "sphere": "radius", "torus": "major, minor"}
_TURN = 2 * math.pi
#: Elements that a task makes of its solids, about.
TASK_ELEMENTS = 250_000


def segments(radius: Column, options: ExportOptions) -> Column:
    """Sides of a circle: its chords stray no more than the faceting tolerance, turn no more than the normal tolerance (degrees)
    and, where a length tolerance is set, are no longer than that; 3 at least."""
    near = F.lit(math.pi) / F.acos(F.greatest(F.lit(-1.0), 1 - F.try_divide(F.lit(float(options.faceting_tolerance)), radius)))
    need = [F.lit(3.0), near] if options.faceting_tolerance > 0 else [F.lit(3.0), F.lit(3.0)]
    if options.normal_tolerance > 0:
        need.append(F.lit(360.0 / options.normal_tolerance))
    if options.length_tolerance > 0:
        need.append(F.lit(math.pi) / F.asin(F.least(F.lit(1.0), F.try_divide(F.lit(float(options.length_tolerance)), 2 * radius))))
    return F.ceil(F.greatest(*need) - 1e-9).cast("int")


def _ring(r: Column, z: Column) -> Column:
    return F.struct(r.cast("double").alias("r"), z.cast("double").alias("z"))


def profiles(solids: DataFrame, options: ExportOptions) -> DataFrame:
    """(ent_id, kind, a, b, c, n, rings, low, high, closed, stretch) of solids (ent_id, kind, a, b, c, d).

    n: sides around; rings: (r, z) from below; low and high: z of the poles, of profiles that are not closed. A minor radius of 0 is
    the major one, a brick's y and z both 0 make a cube; sizes that are not positive give no row."""
    a, b, c, d = (F.coalesce(F.col(k).cast("double"), F.lit(0.0)) for k in "abcd")
    is_ = lambda *kinds: F.col("kind").isin(*kinds)
    cube = is_("brick") & (b == 0) & (c == 0)
    sized = solids.select("ent_id", "kind", a.alias("a"), F.when(cube, a).otherwise(b).alias("b"), F.when(cube, a).when(is_("cylinder", "cone") & (c == 0), b).otherwise(c).alias("c"), d.alias("d"))
    a, b, c, d = (F.col(k) for k in "abcd")
    good = (a > 0) & (is_("sphere") | (b > 0)) & (~is_("brick", "cylinder", "cone") | (c > 0)) & (d >= 0)
    around = F.when(is_("cylinder"), F.greatest(b, c)).when(is_("cone"), F.greatest(F.lit(1.0), F.try_divide(d, b)) * F.greatest(b, c)).when(is_("torus"), a + b).otherwise(a)
    closed = is_("torus") & (b < a)
    # half the angle that a torus without a hole spans about its ring
    half = F.lit(math.pi) - F.acos(F.least(F.lit(1.0), F.try_divide(a, b)))
    small = segments(F.when(is_("torus"), b).otherwise(a), options)
    bands = F.when(closed, small).when(is_("torus"), F.greatest(F.lit(2), F.ceil(small * half / math.pi - 1e-9))).otherwise(F.greatest(F.lit(2), F.ceil(small / 2))).cast("int")
    counted = sized.where(is_(*KINDS) & good).select("*", F.when(is_("brick"), 4).otherwise(segments(around, options)).alias("n"), bands.alias("m"), closed.alias("closed"), half.alias("half"))
    m = F.col("m")
    steps = F.sequence(F.lit(0), F.greatest(m - 1, F.lit(1)))
    wheel = F.transform(steps, lambda i: _ring(a + b * F.cos(_TURN * i / m), b * F.sin(_TURN * i / m)))
    inner = F.sequence(F.lit(1), F.greatest(m - 1, F.lit(1)))
    arc = F.transform(inner, lambda i: _ring(a + b * F.cos(F.col("half") * (2 * i / m - 1)), b * F.sin(F.col("half") * (2 * i / m - 1))))
    ball = F.transform(inner, lambda i: _ring(a * F.cos(math.pi * (i / m - 0.5)), a * F.sin(math.pi * (i / m - 0.5))))
    low, high = _ring(b, -a / 2), _ring(d, a / 2)
    rings = F.when(is_("cylinder"), F.array(low, _ring(b, a / 2))).when(is_("cone") & (d == 0), F.array(low)).when(is_("cone"), F.array(low, high))
    rings = rings.when(is_("sphere"), ball).when(F.col("closed"), wheel).when(is_("torus"), arc)
    pole = F.when(is_("cylinder", "cone"), a / 2).when(is_("sphere"), a).when(is_("torus") & ~F.col("closed"), F.sqrt(F.greatest(F.lit(0.0), b * b - a * a)))
    return counted.select("ent_id", "kind", "a", "b", "c", "n", rings.alias("rings"), (-pole).alias("low"), pole.alias("high"), "closed", F.when(is_("cylinder", "cone"), F.try_divide(c, b)).otherwise(1.0).alias("stretch"))


def facet_vertices(found: DataFrame, *more: str) -> DataFrame:
    """(ent_id, at, x, y, z) of profiles: place 0 is the lower pole, the rings follow, then the upper pole; a closed profile has no poles.

    more: columns of the profiles that each row keeps."""
    point = lambda x, y, z: F.struct(x.alias("x"), y.alias("y"), z.alias("z"))
    sign = lambda k, bit: F.when(F.shiftright(k, bit) % 2 == 1, 0.5).otherwise(-0.5)
    corners = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: point(sign(k, 0) * F.col("a"), sign(k, 1) * F.col("b"), sign(k, 2) * F.col("c")))
    n = F.col("n")
    angle = lambda j: _TURN * j / n
    bricks = found.where("kind = 'brick'").select("ent_id", *more, F.posexplode(corners).alias("at", "p")).select("ent_id", *more, "at", "p.x", "p.y", "p.z")
    round_ = found.where("kind <> 'brick'")
    first = F.when(F.col("closed"), 0).otherwise(1)
    each = round_.select("ent_id", *more, "n", "stretch", first.alias("first"), F.posexplode("rings").alias("i", "ring")).select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("j"))
    on_rings = each.select("ent_id", *more, (F.col("first") + F.col("i") * n + F.col("j")).alias("at"), (F.col("ring.r") * F.cos(angle(F.col("j")))).alias("x"), (F.col("stretch") * F.col("ring.r") * F.sin(angle(F.col("j")))).alias("y"), F.col("ring.z").alias("z"))
    ends = F.explode(F.array(F.struct(F.lit(0).alias("at"), F.col("low").alias("z")), F.struct((n * F.size("rings") + 1).alias("at"), F.col("high").alias("z")))).alias("e")
    poles = round_.where("not closed").select("ent_id", *more, ends).select("ent_id", *more, "e.at", F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), "e.z")
    return bricks.unionByName(on_rings).unionByName(poles)


def facet_triangles(found: DataFrame, *more: str, corners: bool = False) -> DataFrame:
    """(ent_id, ord, conn) of profiles: three places each, counter-clockwise from outside; more: columns of the profiles that each row keeps.

    corners: they are (ent_id, ord, corners), the points (x, y, z) that :func:`facet_vertices` has at these places."""
    # a brick's corners by the bits of their place: x 1, y 2, z 4
    sides = [(0, 2, 3, 1), (4, 5, 7, 6), (0, 1, 5, 4), (2, 6, 7, 3), (0, 4, 6, 2), (1, 3, 7, 5)]
    point = lambda x, y, z: F.struct(x.alias("x"), y.alias("y"), z.alias("z"))
    made_of = "corners" if corners else "conn"
    tri = lambda *v: F.array(*[p[corners] for p in v])
    corner = lambda p: (F.lit(p), point(*[F.lit(0.5 if p >> k & 1 else -0.5) * F.col(c) for k, c in enumerate("abc")]))
    halves = F.array(*[tri(*map(corner, t)) for p, q, r, s in sides for t in ((p, q, r), (p, r, s))])
    bricks = found.where("kind = 'brick'").select("ent_id", *more, F.posexplode_outer(halves).alias("ord", made_of))
    n, k = F.col("n"), F.size("rings")
    first = F.when(F.col("closed"), 0).otherwise(1)
    # a band leads from each ring to the next; below the first and above the last ring are fans
    round_ = found.where("kind <> 'brick'").select("ent_id", *more, "n", "rings", "low", "high", "stretch", k.alias("k"), "closed", first.alias("first"), F.explode(F.sequence(F.when(F.col("closed"), 0).otherwise(-1), k - 1)).alias("i"))
    i, j, k = F.col("i"), F.col("j"), F.col("k")
    round_ = round_.withColumn("nxt", F.when(F.col("closed") & (i == k - 1), 0).otherwise(i + 1))
    round_ = round_.select("*", F.get("rings", i).alias("here"), F.get("rings", F.col("nxt")).alias("there")).drop("rings")
    each = round_.select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("j"))
    turn = [_TURN * ((j + side) % n) / n for side in (0, 1)]
    each = each.select("*", *[f(turn[side]).alias(f"{name}{side}") for side in (0, 1) for name, f in (("cos", F.cos), ("sin", F.sin))])

    def at(ring: str, side: int) -> tuple[Column, Column]:
        r, place = F.col(f"{ring}.r"), F.col("first") + F.col("i" if ring == "here" else "nxt") * n + (j + side) % n
        return place, point(r * F.col(f"cos{side}"), F.col("stretch") * r * F.col(f"sin{side}"), F.col(f"{ring}.z"))

    nil = F.lit(0.0)
    low, high = (F.lit(0), point(nil, nil, F.col("low"))), (n * k + 1, point(nil, nil, F.col("high")))
    fan_low, fan_high = F.array(tri(low, at("there", 1), at("there", 0))), F.array(tri(high, at("here", 0), at("here", 1)))
    band = F.array(tri(at("here", 0), at("here", 1), at("there", 1)), tri(at("here", 0), at("there", 1), at("there", 0)))
    made = F.when(i == -1, fan_low).when(~F.col("closed") & (i == k - 1), fan_high).otherwise(band)
    start = F.when(F.col("closed"), 2 * n * i).when(i == -1, 0).otherwise(n + 2 * n * i)
    width = F.when((i == -1) | (~F.col("closed") & (i == k - 1)), 1).otherwise(2)
    out = each.select("ent_id", *more, (start + width * j).alias("_at"), F.posexplode_outer(made).alias("o", made_of))
    return bricks.unionByName(out.select("ent_id", *more, (F.col("_at") + F.col("o")).alias("ord"), made_of))


def _counts(found: DataFrame) -> DataFrame:
    """(ent_id, v, t) of profiles: how many vertices and triangles they have."""
    rings = F.when(F.col("kind") == "brick", F.struct(F.lit(8).alias("v"), F.lit(12).alias("t")))
    rings = rings.when(F.col("closed"), F.struct((F.col("n") * F.size("rings")).alias("v"), (2 * F.col("n") * F.size("rings")).alias("t")))
    rings = rings.otherwise(F.struct((F.col("n") * F.size("rings") + 2).alias("v"), (2 * F.col("n") * F.size("rings")).alias("t")))
    return found.select("ent_id", rings.alias("s")).select("ent_id", "s.v", "s.t")


def _dealt(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Profiles in as many tasks as their elements ask for, not their own bytes."""
    total = counts.agg(F.sum("t")).first()[0] or 0
    return found.repartition(-(-total // TASK_ELEMENTS) or 1, "ent_id")


def solid_mesh(solids: DataFrame, options: ExportOptions | None = None, base: int = 0, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Vertices (vh, owner_id, x, y, z) and elements (eh, owner_id, type, conn) of solids; handles after ``base``, elements from 1, in order of solid and place.

    keep: columns of :func:`facet_triangles` that elements have as well. Tasks make whole solids, so what is asked of each solid needs no shuffle of its vertices and elements."""
    found = profiles(solids, options or ExportOptions())
    counts = _counts(found)
    start = running(counts, "ent_id", "v").withColumnRenamed("start", "_v").join(shuffled(running(counts, "ent_id", "t").withColumnRenamed("start", "_t")), "ent_id")
    # numbers meet the solids before these become vertices and elements, so that only solids are shuffled
    numbered = _dealt(stage(found.join(shuffled(start), "ent_id"), "solids"), counts)
    vertices = facet_vertices(numbered, "_v").select((F.lit(base) + F.col("_v") + F.col("at") + 1).cast("long").alias("vh"), F.col("ent_id").alias("owner_id"), "x", "y", "z")
    conn = F.array(*[(F.lit(base) + F.col("_v") + F.get("conn", F.lit(k)) + 1).cast("long") for k in range(3)])
    elements = facet_triangles(numbered, "_v", "_t").select((F.col("_t") + F.col("ord") + 1).cast("long").alias("eh"), F.col("ent_id").alias("owner_id"), F.lit("TRI").alias("type"), conn.alias("conn"), *keep)
    return vertices, elements


def _measured(tri: DataFrame, p: list[list[Column]]) -> DataFrame:
    cross = lambda u, v: [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]
    normal = cross([b - a for a, b in zip(p[0], p[1], strict=True)], [b - a for a, b in zip(p[0], p[2], strict=True)])
    six = sum((a * b for a, b in zip(p[0], cross(p[1], p[2]), strict=True)), F.lit(0.0))
    return tri.groupBy("owner_id").agg((F.sum(F.sqrt(sum((v * v for v in normal), F.lit(0.0)))) / 2).alias("area"), (F.sum(six) / 6).alias("volume"), F.count("*").alias("n"))


def enclosed(vertices: DataFrame, elements: DataFrame) -> DataFrame:
    """(owner_id, area, volume, n) of triangles, n of them; the volume is positive where they are wound outwards."""
    tri = elements.where("type = 'TRI'").select("owner_id", *[F.get("conn", F.lit(k)).alias(f"v{k}") for k in range(3)])
    for k in range(3):
        tri = tri.join(shuffled(vertices.select(F.col("vh").alias(f"v{k}"), *[F.col(c).alias(f"{c}{k}") for c in "xyz"])), f"v{k}").drop(f"v{k}")
    return _measured(tri, [[F.col(f"{c}{k}") for c in "xyz"] for k in range(3)])


def solid_sizes(solids: DataFrame, options: ExportOptions | None = None) -> DataFrame:
    """What :func:`enclosed` tells of the meshes of solids, by the task that makes them: a triangle has its points at once and joins nothing."""
    found = profiles(solids, options or ExportOptions())
    tri = facet_triangles(_dealt(found, _counts(found)), corners=True).select(F.col("ent_id").alias("owner_id"), "corners")
    return _measured(tri, [[F.get("corners", F.lit(k)).getField(c) for c in "xyz"] for k in range(3)])
