"""Merging, copies, faceting, journals, octrees and regions on small cases."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from solidspark.commands import ExportOptions
from solidspark.errors import ErrorCode, SolidError
from solidspark.model import Model
from solidspark.operators import faceting, journal, merge, mesh, octree
from solidspark.schema import TABLES
from solidspark.sources import regions


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def reach(points, tol):
    keep = {k: k for k, *_ in points}
    near = [(a[0], b[0]) for a, b in itertools.combinations(points, 2) if None not in a + b and math.dist(a[1:], b[1:]) < tol]
    changed = True
    while changed:
        changed = False
        for a, b in near:
            m = min(keep[a], keep[b])
            changed |= keep[a] != m or keep[b] != m
            keep[a] = keep[b] = m
    return keep


@pytest.mark.parametrize("seed", range(3))
def test_merge_points(spark, seed):
    rng = random.Random(seed)
    points = [(k, *(rng.uniform(0, (0.5, 2.0, 0.05)[seed]) for _ in range(3))) for k in range(150)]
    points += [(200, 5.0, 5.0, 5.0), (201, 5.0, 5.0, 5.0), (202, None, 0.0, 0.0), (203, None, 0.0, 0.0)]
    got = {r.vh: r.keep for r in merge.merge_points(spark.createDataFrame(points, "vh long, x double, y double, z double"), 0.1).collect()}
    assert got == reach(points, 0.1)


def two_triangles(spark):
    """Two volumes of one triangle each, in the same place, the second wound the other way and with curves of its own."""
    corners = [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]
    entity, vertex, topo, uses, curves = [], [], [], [], []
    for k, base in ((0, 100), (1, 200)):
        order = (0, 1, 2) if not k else (0, 2, 1)
        entity += [(base + 30, 3), (base + 20, 2), *[(base + 10 + i, 1) for i in range(3)], *[(base + i, 0) for i in range(3)]]
        vertex += [(base + i, base + i, *corners[i], 1e-9 * k) for i in range(3)]
        topo += [(base + 30, base + 20, 3), *[(base + 20, base + 10 + i, 2) for i in range(3)]]
        uses += [(base + 20, base + 30, "A", "A"), *[(base + 10 + i, base + 20, "A", "A") for i in range(3)]]
        for i in range(3):
            a, b = base + order[i], base + order[(i + 1) % 3]
            topo += [(base + 10 + i, a, 1), (base + 10 + i, b, 1)]
            curves.append((base + 10 + i, a, b, False, None))
    made = {
        "entity": spark.createDataFrame([("m", e, d, "", e) for e, d in entity], TABLES["entity"]), "mesh_vertex": spark.createDataFrame(vertex, TABLES["mesh_vertex"]),
        "topology": spark.createDataFrame(topo, TABLES["topology"]), "sense_use": spark.createDataFrame(uses, TABLES["sense_use"]), "curve_points": spark.createDataFrame(curves, TABLES["curve_points"]),
        "body_volume": spark.createDataFrame([(1, 130), (2, 230)], TABLES["body_volume"]), "group_member": spark.createDataFrame([(5, 220, "entity"), (5, 120, "entity"), (5, 2, "body")], TABLES["group_member"]),
    }
    return Model(spark, "m", made)


def test_merge_cascade_of_a_model(spark):
    model = two_triangles(spark)
    found = {r.ent_id: (r.keep, r.sense) for r in model.merge(1e-6).collect()}
    assert {k: v[0] for k, v in found.items() if k < 240 and k % 100 < 3} == {100 + i: 100 + i for i in range(3)} | {200 + i: 100 + i for i in range(3)}
    # the second surface is the first one from behind; its volume is another one
    assert found[220] == (120, -1) and found[230] == (230, 1) and found[130] == (130, 1)
    assert {r.ent_id for r in model["entity"].collect()} == {100, 101, 102, 110, 111, 112, 120, 130, 230}
    assert rows(model.senses().where("child_id = 120").select("parent_id", "sense")) == [(130, 1), (230, -1)]
    assert rows(model["group_member"]) == [(5, 120, "entity"), (5, 2, "body")]
    assert {(r.parent_id, r.child_id) for r in model["topology"].where("parent_dim = 3").collect()} == {(130, 120), (230, 120)}
    assert {r.owner_id for r in model["mesh_vertex"].collect()} == {100, 101, 102}


def test_copy_takes_the_body_and_all_below(spark):
    model = two_triangles(spark)
    new = {r.ent_id: r.new for r in model.copy(spark.createDataFrame([(130,)], "ent_id long")).collect()}
    assert new == {old: 231 + k for k, old in enumerate([100, 101, 102, 110, 111, 112, 120, 130])}
    assert rows(model["body_volume"]) == [(1, 130), (2, 230), (3, 238)]
    assert {(r.curve_id, r.start_vh, r.end_vh) for r in model["curve_points"].where("curve_id > 230").collect()} == {(234, 203, 204), (235, 204, 205), (236, 205, 203)}
    assert model["topology"].where("parent_id > 230").count() == 1 + 3 + 6 and model["sense_use"].where("child_id > 230").count() == 4


def test_delete_leaves_nothing_behind(spark):
    model = two_triangles(spark)
    model.delete(spark.createDataFrame([(130,), (120,), (100,)], "ent_id long"))
    for name, keys in model.OWNED.items():
        for key in keys:
            assert not model[name].where(F.col(key).isin(130, 120, 100)).count(), name
    assert rows(model["group_member"]) == [(5, 2, "body"), (5, 220, "entity")]
    model.delete(spark.createDataFrame([(230,)], "ent_id long"))
    assert rows(model["group_member"]) == [(5, 220, "entity")]


def test_only_surfaces_fail_on_a_side_taken_twice(spark):
    model = two_triangles(spark)
    model.tables["sense_use"] = model["sense_use"].unionByName(spark.createDataFrame([(110, 220, "A", "A")], TABLES["sense_use"]))
    assert model.senses().where("child_id = 110 and sense = 1").count() == 2
    model.tables["sense_use"] = model["sense_use"].unionByName(spark.createDataFrame([(120, 230, "A", "A")], TABLES["sense_use"]))
    with pytest.raises(SolidError) as e:
        model.senses()
    assert e.value.code == ErrorCode.FAILURE


def test_faceting(spark):
    solids = [(1, "brick", 2.0, 0.0, 0.0, 0.0), (2, "cylinder", 2.0, 1.0, 0.5, 0.0), (3, "cone", 2.0, 1.0, 0.0, 0.0), (4, "cone", 2.0, 1.0, 0.5, 2.0), (5, "sphere", 1.0, None, None, None), (6, "torus", 1.0, 0.25, 0.0, 0.0), (7, "torus", 1.0, 1.0, 0.0, 0.0), (8, "brick", -1.0, 1.0, 1.0, 0.0), (9, "sphere", 0.0, 0.0, 0.0, 0.0), (10, None, 1.0, 1.0, 1.0, 1.0)]
    table = spark.createDataFrame(solids, TABLES["solid"])
    vertices, elements = faceting.solid_mesh(table, ExportOptions(faceting_tolerance=1e-3, normal_tolerance=5), 10)
    got = {r.owner_id: r for r in faceting.enclosed(vertices, elements).collect()}
    exact = {1: 8.0, 2: math.pi, 3: math.pi * 2 / 3, 4: math.pi * 0.5 * 2 / 3 * (1 + 2 + 4), 5: math.pi * 4 / 3, 6: 2 * math.pi**2 * 0.0625, 7: 2 * math.pi**2}
    assert set(got) == set(exact)
    for k, v in exact.items():
        assert v * 0.985 < got[k].volume <= v * (1 + 1e-9), k
    closed = mesh.closedness(elements)
    assert all(r.missing == r.flipped == r.crowded == r.loops == 0 for r in closed.collect())
    n_v = {r.owner_id: r.n for r in vertices.groupBy("owner_id").agg(F.count("*").alias("n")).collect()}
    n_t = {r.owner_id: r.n for r in elements.groupBy("owner_id").agg(F.count("*").alias("n")).collect()}
    assert {r.volume_id: n_v[r.volume_id] - r.n_sides + n_t[r.volume_id] for r in closed.collect()} == {k: 0 if k == 6 else 2 for k in exact}
    handles = sorted(r.vh for r in vertices.collect())
    assert handles == list(range(11, 11 + len(handles))) and sorted(r.eh for r in elements.collect()) == list(range(1, elements.count() + 1))
    # chords of every circle of the ball keep the tolerance
    at = {r.vh: (r.x, r.y, r.z) for r in vertices.where("owner_id = 5").collect()}
    mids = [[(a + b) / 2 for a, b in zip(at[p], at[q], strict=True)] for r in elements.where("owner_id = 5").collect() for p, q in itertools.pairwise([*r.conn, r.conn[0]])]
    assert min(math.hypot(*m) for m in mids) >= 1 - 2e-3


@pytest.mark.parametrize(("words", "least"), [({"faceting_tolerance": 0.0, "normal_tolerance": 10}, 36), ({"faceting_tolerance": 0.01, "normal_tolerance": 0}, 23), ({"faceting_tolerance": 0.0, "normal_tolerance": 0, "length_tolerance": 0.1}, 63), ({"faceting_tolerance": 0.0, "normal_tolerance": 0}, 3)])
def test_each_tolerance_acts(spark, words, least):
    assert spark.range(1).select(faceting.segments(F.lit(1.0), ExportOptions(**words)).alias("n")).first().n == least


def test_closedness_tells_missing_flipped_and_crowded(spark):
    four = [(1, [1, 3, 2]), (2, [1, 2, 4]), (3, [2, 3, 4]), (4, [1, 4, 3])]
    table = lambda x: spark.createDataFrame([(k, 7, c) for k, c in x], "eh long, owner_id long, conn array<long>")
    told = lambda x: tuple(mesh.closedness(table(x)).first())[1:]
    assert told(four) == (6, 0, 0, 0, 0)
    assert told(four[1:]) == (6, 3, 0, 0, 1)
    assert told([(1, [1, 2, 3]), *four[1:]]) == (6, 0, 3, 0, 0)
    assert told([*four, (5, [1, 2, 9])]) == (8, 2, 0, 1, 1)
    # the same surface from inside bounds its other volume as well
    senses = spark.createDataFrame([(7, 1, 1), (7, 2, -1)], "child_id long, parent_id long, sense int")
    assert rows(mesh.closedness(table(four), senses).select("volume_id", "flipped")) == [(1, 0), (2, 0)]


def apply(m, p):
    return [m[4 * i] * p[0] + m[4 * i + 1] * p[1] + m[4 * i + 2] * p[2] + m[4 * i + 3] for i in range(3)]


def test_journal(spark):
    ops = [("move", 1, 2, 3, 0, 0, 0), ("rotate", 90, 0, 0, 2, 0, 0), ("scale", 1, 0, 0, 2, 2, -1), ("reflect", 0, 0, 1, 0, 0, 3)]
    table = spark.createDataFrame([(1, "body", k, op, *map(float, a)) for k, (op, *a) in enumerate(ops)], "ent_id long, kind string, seq long, op string, a0 double, a1 double, a2 double, a3 double, a4 double, a5 double")
    done = journal.composed(journal.judged(table)).first()
    # (1, 0, 0) -> (2, 2, 3) -> (-2, 2, 3) -> (-5, 4, -3) -> (-5, 4, 5)
    assert apply(done.map, (1, 0, 0)) == pytest.approx([-5, 4, 5]) and done.n == 4
    assert not spark.createDataFrame([(done.map,)], "map array<double>").select(journal.turned(F.col("map")).alias("t")).first().t
    many = table.where("seq = 0").select("ent_id", "kind", F.explode(F.sequence(F.lit(0), F.lit(999))).alias("seq"), "op", *[f"a{k}" for k in range(6)]).withColumn("seq", F.col("seq").cast("long"))
    for block in (2, 7, 2000):
        assert apply(journal.composed(journal.judged(many), block).first().map, (0, 0, 0)) == pytest.approx([1000, 2000, 3000])


@pytest.mark.parametrize(("kind", "op", "args", "code"), [
    ("surface", "move", [1, 1, 1], ErrorCode.INVALID_ENTITY_TYPE), ("body", "rotate", [1, 0, 0, 0], ErrorCode.INVALID_ARGUMENT), ("body", "reflect", [0, 0, 0, 0, 0, 0], ErrorCode.INVALID_ARGUMENT),
    ("group", "reflect", [0, 0, 0, 1, 0, 0], ErrorCode.INVALID_ENTITY_TYPE), ("surface", "scale", [0, 0, 0, 1, 1, 0], ErrorCode.INVALID_ARGUMENT), ("surface", "scale", [0, 0, 0, 1, 1, 2], ErrorCode.SUCCESS),
    ("body", "shear", [1], ErrorCode.NOT_SUPPORTED), ("body", None, [1], ErrorCode.NOT_SUPPORTED), ("body", "move", [1], ErrorCode.INVALID_ARGUMENT), (None, "move", [1, 1, 1], ErrorCode.INVALID_ENTITY_TYPE),
])
def test_journal_status(spark, kind, op, args, code):
    row = (1, kind, 0, op, *map(float, args), *[None] * (6 - len(args)))
    got = journal.judged(spark.createDataFrame([row], "ent_id long, kind string, seq long, op string, a0 double, a1 double, a2 double, a3 double, a4 double, a5 double")).first()
    assert got.status == int(code) and (got.map is None) == bool(code)


def test_octree(spark):
    term = lambda s, k, op, kind, sizes, at=(0, 0, 0): (s, k, op, kind, *map(float, (*sizes, *[0] * (4 - len(sizes)))), *map(float, at))
    table = spark.createDataFrame([
        term(1, 0, "unite", "sphere", [1]),
        term(2, 0, "unite", "sphere", [0.5], (-2, 0, 0)), term(2, 1, "unite", "sphere", [0.5], (2, 0, 0)),
        term(3, 0, "unite", "brick", [2, 2, 2]), term(3, 1, "subtract", "brick", [3, 3, 3]),
        term(4, 0, "unite", "brick", [4, 2, 2]), term(4, 1, "subtract", "brick", [1, 3, 3]),
        term(5, 0, "unite", "brick", [2, 2, 2]), term(5, 1, "intersect", "brick", [2, 2, 2], (1, 0, 0)),
    ], octree.TERM)
    got = {r.solid_id: r for r in octree.pieces(table, 5).collect()}
    assert {k: (r.status == 0, r.n_pieces) for k, r in got.items()} == {1: (True, 1), 2: (True, 2), 3: (False, 0), 4: (True, 2), 5: (True, 1)}
    assert got[1].volume == pytest.approx(4 / 3 * math.pi, rel=0.02) and got[3].min_x is None and got[3].volume == 0
    assert (got[5].min_x, got[5].max_x, got[5].volume) == pytest.approx((0, 1, 4))
    # what is decided early is as good as a full grid
    assert octree.decided(table.where("solid_id = 5"), 4).count() < 8**4 / 4


def test_postfix():
    assert regions.postfix(["-1", "2"]) == ["-1", "2", "&"]
    assert regions.postfix(["-1:2", "3"]) == ["-1", "2", "3", "&", ":"]
    assert regions.postfix(["#(1:-2)", "#4"]) == ["1", "-2", ":", "!", "#4", "&"]
    assert regions.postfix(["(1", "(2", ":", "3))", "4"]) == ["1", "2", "3", ":", "&", "4", "&"]
    for bad in (["(1"], ["1)"], [":", "1"], ["1", ":"], ["()"]):
        with pytest.raises(ValueError):
            regions.postfix(bad)
    assert regions.resolved({1: ["-1"], 2: ["#1", "2", "&"], 3: ["#4"], 4: ["#3"], 5: ["#9"]}) == {1: ["-1"], 2: ["-1", "!", "2", "&"], 3: None, 4: None, 5: None}


def test_regions_of_decks(spark):
    a = "one\n1 0 -1\n2 0 1 -2\n3 0 #1 #2\n4 0 #5\n5 0 #4\n\n1 so 1\n2 1 box -1 -1 -1 2 0 0 0 2 0 0 0 2\n\n*tr1 3 0 0 0 90 90 90 0 90 90 90 0\n"
    b = "two\n7 0 -1 : -2\n8 0 1 2\n\n1 c/z 2 0 0.5\n2 unknown 5\n\nm1 1001 1\n"
    decks = spark.createDataFrame([("a", a), ("b", b)], "deck string, value string")
    points = [("a", 0.0, 0.0, 0.0, 1), ("a", 3.5, 0.5, -0.5, 2), ("a", 9.0, 0.0, 0.0, 3), ("b", 2.2, 0.1, 8.0, 7), ("b", 0.0, 0.0, 0.0, None), ("c", 0.0, 0.0, 0.0, None)]
    table = spark.createDataFrame(points, "deck string, x double, y double, z double, want int")
    assert all(r.cell == r.want for r in regions.classify(table, decks).collect())
    assert {r.deck: sorted(r.bad) for r in regions.geometry(decks).collect()} == {"a": [4, 5], "b": []}
