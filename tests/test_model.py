import math
import random

import pytest
from pyspark.sql import functions as F

from solidspark.commands import ExportOptions, create_command, geometry_smoke, keys
from solidspark.errors import ErrorCode, LastError, SolidError, describe, error_table
from solidspark.functions import affine
from solidspark.functions.solid import Brick, Cone, Cylinder, Sphere, Torus
from solidspark.model import Model
from solidspark.operators import entities, mesh, sets, tags, topology
from solidspark.plans.carrier import DECK
from solidspark.sources import deck, files

@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(1)
    return spark.createDataFrame([(k, *[rng.uniform(-3, 3) for _ in "xyz"]) for k in range(2000)], "vh long, x double, y double, z double").cache()


XYZ = lambda: (F.col("x"), F.col("y"), F.col("z"))


def test_deck(spark, tmp_path):
    (tmp_path / "own.i").write_text(DECK)
    cards = deck.read_cards(spark, str(tmp_path))
    cells = sorted(deck.cells(cards).drop("deck").collect())
    assert [(c.cell_id, c.material_id, c.density, c.region, c.params["imp:p"]) for c in cells] == [(10, 3, -7.8, ["-1"], "2"), (20, 4, -0.9, ["-2", "1"], "1"), (30, 0, None, ["2"], "0")]
    surfaces = sorted(deck.surfaces(cards).drop("deck").collect())
    assert [tuple(s) for s in surfaces] == [(1, "so", [0.75]), (2, "so", [1.5])]
    assert [tuple(r) for r in sorted(deck.materials(cards).drop("deck").collect())] == [(3, 0, 26056, 1.0), (4, 0, 1001, 0.25), (4, 1, 6012, 0.75)]
    assert [tuple(r) for r in deck.params(cards).drop("deck").collect()] == [(2, "mode", ["p"])]
    at = spark.createDataFrame([(0.5,), (1.25,), (3.0,)], "x double").withColumns({"y": F.lit(0.0), "z": F.lit(0.0)})
    assert [r[0] for r in at.select(deck.cell_of(*XYZ(), cells, surfaces)).collect()] == [10, 20, 30]


def test_deck_grammar(spark):
    text = "t\nc comment\n1 0 -1 $ inner\n     imp:n=1\n2 0 (1 -2):-3 #1\n\n1 px 1\n"
    assert deck.split_cards(text)[1:3] == [("cell", 0, "1 0 -1 imp:n=1"), ("cell", 1, "2 0 (1 -2):-3 #1")]
    v = {k: F.lit(s) for k, s in ((1, 1.0), (2, -1.0), (3, 1.0))}
    one = lambda r: spark.range(1).select(deck.region_predicate(r, v, {1: ["-1"]})).first()[0]
    assert one(["(1", "-2)"]) and not one(["-3"]) and one(["-3:1"]) and one(["#1"]) and not one(["#(1", "-2)"])


def test_deck_options():
    o, w = deck.DeckOptions.parse(["skip_imprint", "tol", "0.5", "debug_input"])
    assert not o.imprint_geometry and o.debug and o.debug_input and len(w) == 2
    o, _ = deck.DeckOptions.parse(["debug", "debug_input"])
    assert o.debug and not o.debug_input


def test_booleans_count(points):
    n = lambda s: points.where(s.contains(*XYZ())).count()
    a, b = Sphere(2), Brick(2, 4, 3).moved(1, 0, 0)
    assert n(a | b) == n(a) + n(b) - n(a & b)
    assert n(a - b) == n(a) - n(a & b)
    assert n(a.section((0, 0, 2), 0.5)) + n(a.section((0, 0, 2), 0.5, True)) == n(a)


@pytest.mark.parametrize("solid", [Brick(2), Cylinder(3, 2, 1), Cone(3, 1, 0, 2), Sphere(2), Torus(2, 0.5), Torus(1, 1.5)])
def test_bounds(points, solid):
    low, high = solid.bounds()
    found = points.where(solid.contains(*XYZ()))
    box = entities.bounding_boxes(found).first()
    assert found.count() and all(low[i] <= box[i] and box[i + 3] <= high[i] for i in range(3))


def test_brick_and_errors():
    assert Brick(2).bounds() == ((-1, -1, -1), (1, 1, 1))
    for bad in (lambda: Brick(1, -1, 1), lambda: Sphere(1).section((0, 0, 0), 1), lambda: affine.reflect(XYZ(), (0, 0, 0), (0, 0, 0)), lambda: affine.rotate(XYZ(), 1, (0, 0, 0))):
        with pytest.raises(SolidError) as e:
            bad()
        assert e.value.code == ErrorCode.INVALID_ARGUMENT
    with pytest.raises(SolidError):
        (Sphere(1) & Sphere(1).moved(5, 0, 0)).bounds()


def test_transforms_are_inverse(points):
    p = XYZ()
    there = affine.rotate(affine.rotate(p, 37, (1, 2, 3)), -37, (1, 2, 3))
    twice = affine.reflect(affine.reflect(p, (1, 0, 0), (1, 1, 0)), (1, 0, 0), (1, 1, 0))
    off = [F.abs(a - b) for q in (there, twice) for a, b in zip(p, q, strict=True)]
    assert points.agg(F.max(F.greatest(*off))).first()[0] < 1e-12
    assert affine.flips((1, -1, 1)) and affine.flips(mirrored=True) and not affine.flips((1, -1, 1), True)


def test_topology_and_senses(spark):
    uses = spark.createDataFrame([(1, 10, "U", "F"), (2, 10, "F", "F"), (2, 11, "R", "F"), (3, 10, "F", "F"), (3, 11, "F", "F")], "child_id long, parent_id long, use_sense string, geom_sense string")
    found = {tuple(r) for r in topology.senses(uses).collect()}
    assert {(1, 10, 1), (1, 10, -1), (2, 10, 1), (2, 11, -1)} <= found
    assert [tuple(r) for r in topology.sense_violations(topology.senses(uses)).collect()] == [(3, 1, 2)]
    with pytest.raises(SolidError):
        topology.surface_senses(uses, strict=True)
    assert [r.parents for r in topology.curve_senses(uses).where("child_id = 3").collect()] == [[10, 11]]


def test_groups(spark):
    groups = spark.createDataFrame([(1, []), (2, ["a" * 40]), (3, ["x", "y"]), (4, ["é" * 20])], "group_id long, names array<string>")
    names = {r.group_id: (r.name, r.truncated) for r in sets.group_names(groups).collect()}
    assert names == {2: ("a" * 31, True), 3: ("x", False), 4: ("é" * 15, True)}
    assert [tuple(r) for r in sets.extra_names(groups).collect()] == [(3, 0, "x"), (3, 1, "y")]
    members = spark.createDataFrame([(1, 2, "group"), (1, 7, "body"), (1, 50, "entity"), (2, 50, "entity"), (2, 1, "group"), (3, 99, "entity")], "group_id long, member_id long, member_kind string")
    ents = spark.createDataFrame([(50, 2), (70, 3), (71, 3)], "ent_id long, dim int")
    bodies = spark.createDataFrame([(7, 70), (7, 71)], "body_id long, volume_id long")
    assert sorted(tuple(r) for r in sets.group_content(members, groups, ents, bodies).collect()) == [(1, 2), (1, 50), (1, 70), (1, 71), (2, 1), (2, 50)]
    assert [r.member_id for r in sets.unmapped(members, groups, ents, bodies).collect()] == [99]
    assert {tuple(r) for r in sets.expand(members, 3).collect()} >= {(1, 50, "entity"), (2, 50, "entity"), (2, 7, "body")}
    more, new = sets.create_set(groups, ["n"])
    assert new == 5 and sets.get_or_create(more, "n").count() == 5
    with pytest.raises(SolidError):
        sets.add_to_set(members, 1, None)


def test_tags(spark):
    reg = tags.registry(spark)
    reg2, h = tags.create_tag(reg, "mine", 8, "BYTES")
    assert h == 1 and [(r.name, r.handle) for r in tags.handles(reg2, spark.createDataFrame([("mine",), ("none",), ("NAME",)], "name string")).orderBy("name").collect()] == [("NAME", -1), ("mine", 1), ("none", 0)]
    with pytest.raises(SolidError):
        tags.create_tag(reg2, "mine", 8, "BYTES")
    off = reg2.withColumn("is_active", (F.col("name") != "mine") & F.col("is_active"))
    assert tags.create_tag(off, "mine", 4, "BYTES")[1] == 1
    values = spark.createDataFrame([(5, 1, bytearray(b"abcdef"), 1), (5, 1, bytearray(b"xyz\xff\x80"), 2), (5, -1, bytearray(b""), 1), (6, 1, bytearray(b"\x00\x01\x02\x03\x04"), 1)], "ent_id long, handle int, value binary, seq long")
    last = tags.upsert(values, "seq")
    packed = tags.pack(last, reg2)
    row = {r.ent_id: r for r in packed.collect()}
    assert row[5].strings == ["TAGS", "NAME", "mine"] and row[5].ints[:3] == [2, 0, 5]
    back = {(r.ent_id, r.name): bytes(r.value) for r in tags.unpack(packed).collect()}
    assert back == {(5, "mine"): b"xyz\xff\x80", (5, "NAME"): b"", (6, "mine"): b"\x00\x01\x02\x03\x04"}
    cut = tags.set_array(spark.createDataFrame([([1, None], bytearray(b"aaaabbbb"))], "ent_ids array<long>, values binary"), 1, 4, null_entity=9)
    assert sorted((r.ent_id, bytes(r.value)) for r in cut.collect()) == [(1, b"aaaa"), (9, b"bbbb")]
    assert [r.ent_id for r in tags.clear(values, spark.createDataFrame([(5,)], "ent_id long")).collect()] == [6]


def test_facets(spark):
    p = "array<struct<x:double,y:double,z:double>>"
    pts = [(float(i), 0.0, 0.0) for i in range(6)]
    rows = [(1, pts, [3, 0, 1, 2, 3, 1, 2, 3]), (2, pts, [4, 0, 1, 2, 3, 3, 0, 1, 2, 5, 0, 1, 2, 3, 4]), (3, pts, []), (4, pts, [3, 0, 1, 9])]
    out = mesh.facets(spark.createDataFrame(rows, f"surface_id long, points {p}, facet_list array<int>"))
    got = {(r.surface_id, r.ord): (r.type, list(r.conn), r.bad) for r in out.collect()}
    assert got[(1, 1)] == ("TRI", [1, 2, 3], False) and got[(2, 0)] == ("QUAD", [0, 1, 2, 3], False) and got[(2, 2)][0] == "POLYGON" and got[(4, 0)][2] and not any(k[0] == 3 for k in got)


def test_bad_facet_lists_end_and_are_flagged(spark):
    pts = [(float(i), 0.0, 0.0) for i in range(6)]
    rows = [(1, pts, [3, 0, 1, 2, -1, 5]), (2, pts, [4, 0, 1, 2, 3, 3, 0, 1]), (3, pts, [0]), (4, pts, [3, 0, 1, 2, 2, 0, 1])]
    out = mesh.facets(spark.createDataFrame(rows, "surface_id long, points array<struct<x:double,y:double,z:double>>, facet_list array<int>"))
    got = {(r.surface_id, r.ord): (r.conn and list(r.conn), r.bad) for r in out.collect()}
    assert got == {(1, 0): ([0, 1, 2], False), (1, 1): (None, True), (2, 0): ([0, 1, 2, 3], False), (2, 1): (None, True), (3, 0): (None, True), (4, 0): ([0, 1, 2], False), (4, 1): ([0, 1], False)}


def test_point_curves_are_short(spark):
    one = [(0.0, 0.0, 0.0)]
    curves = spark.createDataFrame([(1, 5, 5, False, one, 0.0), (2, 5, 5, False, one, 2.0)], "curve_id long, start_vh long, end_vh long, reversed boolean, points array<struct<x:double,y:double,z:double>>, length double")
    assert {r.curve_id: r.status for r in mesh.curve_status(curves, 1e-6).collect()} == {1: "point", 2: "skipped"}


def test_model_counts_errors_and_sets(spark, tmp_path):
    """Smoke: bodies, last errors, tags on sets, deletion with what hangs on it, export on handles."""
    p = "array<struct<x:double,y:double,z:double>>"
    m = Model(spark, tables={
        "entity": spark.createDataFrame([("model", 1, 3, "Volume", 1), ("model", 2, 3, "Volume", 2), ("model", 3, 2, "Surface", 1), ("model", 4, 1, "Curve", 1), ("model", 5, 0, "Vertex", 1)], "model_id string, ent_id long, dim int, category string, global_id int"),
        "body_volume": spark.createDataFrame([(50, 1), (50, 2)], "body_id long, volume_id long"),
        "topology": spark.createDataFrame([(1, 3, 3), (3, 4, 2), (4, 5, 1)], "parent_id long, child_id long, parent_dim int"),
        "mesh_vertex": spark.createDataFrame([(1, 5, 0.0, 0.0, 0.0)], "vh long, owner_id long, x double, y double, z double"),
        "curve_points": spark.createDataFrame([(4, 1, 1, False, [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (1.0, 1.0, 0.0), (0.0, 0.0, 0.0)])], f"curve_id long, start_vh long, end_vh long, reversed boolean, points {p}"),
        "surface_facets": spark.createDataFrame([(3, [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (1.0, 1.0, 0.0)], [3, 0, 1, 2])], f"surface_id long, points {p}, facet_list array<int>"),
    })
    assert (m.num_of_type(3), m.num_of_type(4), m.num_of_type(0)) == (1, 4, 1)
    with pytest.raises(SolidError):
        m.num_of_type(7)
    assert m.error.code == ErrorCode.BAD_TYPE_AND_TOPO and m.error.text
    g = m.create_set(["own"])
    assert m.error.code == ErrorCode.SUCCESS
    m.add_to_set(3, g)
    with pytest.raises(SolidError):
        m.num_of_type(-2, g)
    assert m.error.code == ErrorCode.INVALID_ENTITY_TYPE and m.num_of_type(4, g) == m.num_of_type(2, g) == 1
    h = m.create_tag("t", 4, "INTEGER")
    m.set_set_data(g, h, b"one.")
    m.set_set_data(g, h, b"two.")
    assert [(r.group_id, bytes(r.value)) for r in m.set_values().collect()] == [(g, b"two.")]
    with pytest.raises(SolidError):
        m.set_data(3, 99, b"none")
    assert m.error.code == ErrorCode.INVALID_TAG_HANDLE
    with pytest.raises(SolidError):
        m.bounding_box(3)
    assert m.error.code == ErrorCode.INVALID_ENTITY_HANDLE and m.bounding_box(5).max_x == 0.0
    m.export(str(tmp_path / "out"))
    read = lambda name: spark.read.parquet(str(tmp_path / "out" / name))
    assert sorted((r.eh, r.owner_id, r.type, list(r.conn)) for r in read("mesh_element").collect()) == [(1, 4, "EDGE", [1, 2]), (2, 4, "EDGE", [2, 3]), (3, 4, "EDGE", [3, 1]), (4, 3, "TRI", [1, 4, 5])]
    assert sorted(r.vh for r in read("mesh_vertex").collect()) == [1, 2, 3, 4, 5] and read("export_tag").where("FACETING_TOL = 0.001").count() == 1
    m.delete(spark.createDataFrame([(3,), (1,)], "ent_id long"))
    assert [r.ent_id for r in m["entity"].orderBy("ent_id").collect()] == [4, 5] and m["group_member"].count() == 0 and [r.child_id for r in m["topology"].collect()] == [5] and m["body_volume"].count() == 0


def test_curves(spark):
    p = "array<struct<x:double,y:double,z:double>>"
    line = [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (2.0, 0.0, 0.0)]
    ring = [*line, (0.0, 0.0, 0.0)]
    rows = [(1, 5, 6, True, line), (2, 7, 7, False, ring), (3, 8, 8, False, line[:1]), (4, 8, 9, False, line[:1]), (5, 1, 2, False, []), (6, 1, 2, False, ring)]
    curves = spark.createDataFrame(rows, f"curve_id long, start_vh long, end_vh long, reversed boolean, points {p}")
    status = {r.curve_id: (r.status, r.warn) for r in mesh.curve_status(curves, 1e-6).collect()}
    assert status == {1: ("open", False), 2: ("closed", False), 3: ("point", False), 4: ("skipped", False), 5: ("failed", False), 6: ("closed", True)}
    inner, edges = mesh.curve_facets(curves, 1e-6)
    assert [(r.x) for r in inner.where("curve_id = 2").orderBy("ord").collect()] == [1.0, 2.0]
    assert [(r.a_kind, r.a, r.b_kind, r.b) for r in edges.where("curve_id = 1").orderBy("ord").collect()] == [("g", 5, "n", 1), ("n", 1, "g", 6)]


def test_near_pairs_equal_brute_force(spark, points):
    some = points.limit(300).cache()
    rows = some.collect()
    for tol in (0.3, 0.7):
        want = {(a.vh, b.vh) for a in rows for b in rows if a.vh < b.vh and math.dist(a[1:], b[1:]) < tol}
        assert {(r.a, r.b) for r in mesh.coincident(some, tol).collect()} == want
    assert mesh.merge_vertices(some, 0.0001).where("vh <> keep").count() == 0


def test_closed_mesh(spark):
    faces = [(1, [0, 1, 2]), (2, [0, 3, 1]), (3, [1, 3, 2]), (4, [2, 3, 0])]
    shell = spark.createDataFrame(faces, "eh long, conn array<long>")
    assert mesh.open_edges(shell).count() == 0 and mesh.euler(shell).first()[0] == 2
    assert mesh.open_edges(shell.where("eh < 4")).count() == 3
    double = shell.union(spark.createDataFrame([(9, [2, 1, 0])], shell.schema))
    assert {r.eh: r.keep for r in mesh.merge_faces(double).collect()}[9] == 1
    assert [tuple(r) for r in mesh.imprint(double).collect()] == [(1, 9)]


def test_match_points(spark):
    s = spark.createDataFrame([(1, [(0.0, 0.0, 0.0), (0.0, 0.0, 0.0), (1.0, 0.0, 0.0)])], "surface_id long, points array<struct<x:double,y:double,z:double>>")
    v = spark.createDataFrame([(1, 100, 0.0, 0.0, 0.0), (1, 101, 1.0, 0.0, 0.0), (1, 102, 1.0, 0.0, 0.0)], "surface_id long, vh long, x double, y double, z double")
    assert sorted(tuple(r) for r in mesh.match_points(s, v, 1e-3).collect()) == [(1, 0, 100), (1, 2, 102)]


def test_entities(spark):
    e = spark.createDataFrame([(1, 3), (2, 3), (3, 2)], "ent_id long, dim int")
    for bad in (-1, 5):
        with pytest.raises(SolidError):
            entities.of_type(e, bad)
    with pytest.raises(SolidError) as err:
        entities.num_of_type(e, 9)
    assert err.value.code == ErrorCode.BAD_TYPE_AND_TOPO
    assert sorted(r.ent_id for r in entities.copy(e, spark.createDataFrame([(2,), (3,)], "ent_id long")).collect()) == [1, 2, 3, 4, 5]
    bodies = spark.createDataFrame([(50, 1), (50, 2)], "body_id long, volume_id long")
    assert [r.ent_id for r in entities.delete(e, spark.createDataFrame([(1,)], "ent_id long"), bodies).collect()] == [3]
    assert entities.next_id(e.where("false")) == 1


def test_files(spark):
    df = spark.createDataFrame([("a.igs.txt",), ("b.STEP",), ("c.Sat",), ("d.brep",)], "n string")
    assert [r[0] for r in df.select(files.type_of_name(F.col("n"))).collect()] == ["IGES", "STEP", None, "OCC"]
    o = spark.createDataFrame([(";TYPE=OCC;x;",), (";TYPE=OCC;x",), ("",), (".a.b.",)], "o string")
    assert [r[0] for r in o.select(files.tokenize(F.col("o"))).collect()] == [["TYPE=OCC", "x"], ["TYPE=OCC"], [], ["a", "b"]]
    assert [r[0] for r in o.select(files.match_option(F.lit("TYPE=OCC"), "TYPE"), files.match_option(F.lit("type=OCC"), "TYPE")).limit(1).collect()] == ["OCC"]
    assert files.resolve_save("x.sat") == "ACIS_SAT" and files.resolve_save("x", ["TYPE=occ"]) == "NOT_DEFINED"
    for bad in (lambda: files.resolve_save("x.foo"), lambda: files.resolve_save("x.sat", ["SIZE=1"])):
        with pytest.raises(SolidError):
            bad()


def test_errors_and_commands(spark, points):
    last = LastError()
    last.set(ErrorCode.SUCCESS)
    last.set(ErrorCode.TAG_NOT_FOUND)
    assert last.text == "Tag does not exist" and error_table(spark).count() == 23 and describe(22).startswith("Unknown")
    last.clear()
    assert last.code == ErrorCode.SUCCESS
    assert create_command("none") is None and len(keys()) == 3
    assert ExportOptions.parse(["faceting_tolerance", "0.5", "verbose"]) == ExportOptions(0.5, verbose=True) and ExportOptions().faceting_tolerance == 1e-3
    assert geometry_smoke(points).count() > 0


def test_model_round_trip(spark, tmp_path):
    m = Model(spark)
    m.tables["entity"] = spark.createDataFrame([("model", 1, 3, "Volume", 1), ("model", 2, 2, "Surface", 1)], "model_id string, ent_id long, dim int, category string, global_id int")
    g = m.create_set(["mat:1"])
    m.add_to_set(1, g)
    m.add_to_set(1, g)
    assert m.get_entities(g).count() == 1 and m.num_of_type(4) == 2
    h = m.create_tag("t", 4, "INTEGER")
    m.set_data(1, h, b"abcd")
    m.set_data(1, h, b"wxyz")
    assert [bytes(r.value) for r in m.data().collect()] == [b"wxyz"]
    with pytest.raises(SolidError):
        m.set_data(1, -2, b"1234")
    report = m.export(str(tmp_path / "out"))
    assert report.count() == 0 and spark.read.parquet(str(tmp_path / "out/group_content")).count() == 1
    assert Model.open(spark, str(tmp_path / "out")).num_of_type(3) == 1
